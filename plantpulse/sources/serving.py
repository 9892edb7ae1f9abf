"""Serving tables: full refresh and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.validation import require_columns
from ..plans.gold import snapshot

VERSION = "table_version"
KEYS = ["machine_id", "target_cycle", "timestamp"]
INTERVENTION_TABLE = ["machine_id", "timestamp", "failure_type", "temperature", "rpm", "vibration", "pressure"]


def check_keys(df: DataFrame, table: str) -> DataFrame:
    """Key columns must exist, and no key may be null."""
    require_columns(df, KEYS, table)
    for c in KEYS:
        df = df.withColumn(c, F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"{table}: null {c}")).cast(df.schema[c].dataType)))
    return df


def replace_table(df: DataFrame, path: str) -> None:
    """Write a new version beside the old one; readers switch once it is complete.

    A failed write leaves the old version in place. Older versions go afterwards,
    but for the one before, which a running reader may still hold.
    """
    spark = df.sparkSession
    done = _versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/{VERSION}={(done[-1] if done else 0) + 1:012d}")
    for old in done[:-1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={old:012d}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table, oldest first, from the folder list alone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marks = hadoop.Path(f"{path}/{VERSION}=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])


def replace_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    """Truncate and reload a database table in batches."""
    (df.write.mode("overwrite").option("truncate", True).option("batchsize", batch)
     .options(**options).jdbc(url, table))


def refresh(silver: DataFrame, interventions: DataFrame, gold: DataFrame, root: str) -> list[str]:
    """Reload the three serving tables; empty inputs leave theirs untouched."""
    done = []
    if silver.isEmpty():
        return done
    replace_table(silver.select(*C.SENSOR_TABLE), f"{root}/sensor_data")
    done.append("sensor_data")
    if not interventions.isEmpty():
        replace_table(interventions.select(*INTERVENTION_TABLE), f"{root}/interventions")
        done.append("interventions")
    if not gold.isEmpty():
        replace_table(snapshot(check_keys(gold, "feature_snapshot")), f"{root}/feature_snapshot")
        done.append("feature_snapshot")
    return done


def prediction_rows(df: DataFrame, model_version: str) -> DataFrame:
    """Scored readings in the predictions shape; `recorded_at` defaults to now."""
    stamp = (F.coalesce("recorded_at", F.current_timestamp()) if "recorded_at" in df.columns
             else F.current_timestamp())
    return (df.withColumn("recorded_at", stamp).withColumn("model_version", F.lit(model_version))
            .select(*C.PREDICTION_TABLE))


def append_batch(df: DataFrame, root: str, table: str, batch: str, stream: str = "job") -> DataFrame:
    """Append one batch of a stream and give it back as stored; repeating the same batch replaces it.

    Batch ids start at 0 in every stream, so the stream is part of the key.
    """
    path = f"{root}/{table}/stream={stream}/batch={batch}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_name(spark: SparkSession) -> str:
    """Id of the stream whose batch runs; a stream keeps it over restarts from its checkpoint."""
    name = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise RuntimeError("not inside a batch of a stream; name the stream")
    return name


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """An appended table, or the newest complete version of a replaced one."""
    done = _versions(spark, f"{root}/{table}")
    return spark.read.parquet(f"{root}/{table}/{VERSION}={done[-1]:012d}" if done else f"{root}/{table}")
