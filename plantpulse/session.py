"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_STAGED: list[str] = []


def build_session(app: str = "plantpulse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Hash instead of sort once every partition of a side is known to be small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.ui.enabled": "false",
        # Checkpoints go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run.

    Spark sends them a zip of its modules, once per application, as it does with
    --py-files; the file itself stays with the driver.
    """
    context = spark.sparkContext
    root = pathlib.Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    target = pathlib.Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are UTC; pin the session so casts agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a scratch folder only for local sessions."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="plantpulse-")


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that survives lost executors.

    Used where one result feeds several branches. The checkpoint keeps the
    partitioning and order of the rows, so later windows need no new shuffle.
    """
    shared_dir_once(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.

    Columnar and with known size: readers prune columns, and small tables join
    by broadcast without a shuffle of the other side.
    """
    path = f"{staged_root(df.sparkSession)}/{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir_once(spark: SparkSession) -> str:
    """As `shared_dir`, and remembered as the session's checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return context.getCheckpointDir()


def staged_root(spark: SparkSession) -> str:
    return f"{shared_dir_once(spark)}/staged-{spark.sparkContext.applicationId}"


def staged_mark() -> int:
    """Where the list of staged tables stands; for `drop_staged`."""
    return len(_STAGED)


def drop_staged(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables staged since a mark, once the results made of them are written."""
    for at in range(since, len(_STAGED)):
        drop_one(spark, at)
    del _STAGED[since:]


def drop_one(spark: SparkSession, mark: int) -> None:
    """Delete the one table that was staged right after a mark, when nothing reads it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_STAGED[mark])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
