"""Versioned Parquet layers and model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import version_stamp
from ..operators import scoring
from ..operators.scaling import KEY
from ..plans.training import Model

VERSION = "run_ts"


def new_version(spark: SparkSession) -> str:
    return spark.range(1).select(version_stamp(F.current_timestamp())).first()[0]


def write_layer(df: DataFrame, root: str, layer: str, version: str) -> bool:
    """Write one version of a layer; an empty frame writes nothing."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/{layer}/{VERSION}={version}")
    return True


def latest_version(spark: SparkSession, root: str, layer: str) -> str | None:
    """Greatest version name, from the folder list alone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{root}/{layer}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    versions = [n.split("=", 1)[1] for n in names if n.startswith(f"{VERSION}=")]
    return max(versions, default=None)


def read_latest(spark: SparkSession, root: str, layer: str) -> DataFrame | None:
    version = latest_version(spark, root, layer)
    return None if version is None else read_version(spark, root, layer, version)


def read_version(spark: SparkSession, root: str, layer: str, version: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{layer}/{VERSION}={version}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(folder.toString())


def replay_source(spark: SparkSession, root: str, fallback: DataFrame | None = None,
                  mode: str = "auto", keep_rows: int = 4000) -> DataFrame:
    """Rows to replay: newest gold, or the given fallback when there is none."""
    gold = read_latest(spark, root, "gold") if mode in ("auto", "gold") else None
    if gold is None and (mode == "gold" or fallback is None):
        raise FileNotFoundError(f"no gold layer under {root}")
    return fallback if gold is None else newest_rows(gold, keep_rows)


def newest_rows(df: DataFrame, n: int) -> DataFrame:
    """The last n rows by time, then machine (L05); a top-n, not a full sort."""
    return df.orderBy(F.col("timestamp").desc(), F.col("machine_id").desc(),
                      F.col("target_cycle").desc()).limit(n) if n > 0 else df


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: Model, root: str, version: str, source: str = "") -> None:
    """Persist scaler, the index of the reference points and one metadata row per model.

    The tree is grown once per model: boxes by level, points by shelf and leaf, so that a
    batch of readings opens only the leaves near it. The metadata table is written last;
    readers pick versions from it, so a half-written version is never used.
    """
    write_layer(model.scaler, root, "scaler_stats", version)
    index = model.index
    shelves = max(1, -(-index.points.count() // scoring.SHELF_ROWS))
    placed = index.points.withColumns({"shelves": F.lit(shelves), "shelf": scoring.shelf(shelves, "leaf")})
    # One file a shelf or more, its leaves in order, so that statistics rule row groups out.
    ordered = placed.repartitionByRange("shelf", KEY, "leaf").sortWithinPartitions("shelf", KEY, "leaf")
    _write_folders(ordered, root, "reference_points", version, ["shelves", "shelf"])
    _write_folders(index.nodes, root, "reference_nodes", version, ["level"])
    write_layer(index.models, root, "reference_models", version)
    runs = model.summary.select(
        "*", F.lit(model.eps).alias("eps"), F.lit(model.min_samples).alias("min_samples"),
        F.lit(",".join(C.FEATURES)).alias("features"), F.lit(source).alias("source_dataset"))
    write_layer(runs, root, "training_runs", version)


def _write_folders(df: DataFrame, root: str, layer: str, version: str, by: list[str]) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{layer}/{VERSION}={version}")


def _folder_values(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Values of a partition column, from the folder list alone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}=")]


def load_model(spark: SparkSession, root: str, version: str | None = None
               ) -> tuple[str, DataFrame, scoring.ReferenceIndex] | None:
    """Version, scaler and reference index of the newest complete model; reads folder lists and footers only."""
    version = version or latest_version(spark, root, "training_runs")
    if version is None:
        return None
    where = {t: f"{root}/{t}/{VERSION}={version}" for t in ("scaler_stats", "reference_points", "reference_nodes")}
    depth = max(_folder_values(spark, where["reference_nodes"], "level"), default=0)
    nodes = spark.read.parquet(where["reference_nodes"]) if depth else None
    shelves = _folder_values(spark, where["reference_points"], "shelves")[0]
    models = read_version(spark, root, "reference_models", version)
    index = scoring.ReferenceIndex(spark.read.parquet(where["reference_points"]), nodes, depth, shelves, models)
    return version, spark.read.parquet(where["scaler_stats"]), index


def registry_status(spark: SparkSession, root: str) -> DataFrame:
    """Newest version, machines trained and readiness."""
    version = latest_version(spark, root, "training_runs")
    if version is None:
        return spark.range(1).select(F.lit("degraded").alias("status"), F.lit(None).cast("string").alias("trained_at"),
                                     F.lit(0).cast("bigint").alias("n_machines"))
    runs = spark.read.parquet(f"{root}/training_runs/{VERSION}={version}")
    return runs.agg(F.lit("ok").alias("status"), F.lit(version).alias("trained_at"),
                    F.count_if(F.col(KEY) != C.GLOBAL_MODEL).alias("n_machines"))


def run_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Metadata of the newest run as one JSON text per model."""
    runs = read_latest(spark, root, "training_runs")
    return runs.select(KEY, F.to_json(F.struct(*runs.columns)).alias("metadata"))
