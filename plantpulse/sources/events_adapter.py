"""Bronze sensors, interventions and monitoring tables derived from `events`.

The given tables hold no sensor readings, so every registered query starts from
these projections of the whole `events` table. Each is a plain select; the SQL
checks state the same rules in their own words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def events_of(raw: DataFrame) -> DataFrame:
    """Typed events of a batch or a stream of raw rows."""
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.floor(F.col("user_id") / 10) + 1).cast("int").alias("machine_id"),
    )


def _target_cycle(machine):
    return (F.when(machine % 3 == 0, 10).when(machine % 3 == 1, 30).otherwise(60))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string sensor rows with context columns, exact copies included."""
    e = events(spark, sf_dir)
    eid, k, v = F.col("event_id"), F.col("k"), F.col("value")
    h = F.hour("ts")
    is_error = F.col("event_type") == "error"
    stamp = (F.when(eid % 101 == 0, F.lit("not-a-date"))
             .when((eid % 97 == 0) & (F.col("ts") >= F.lit("2024-01-02").cast("timestamp")),
                   F.col("ts").cast("string"))
             .otherwise(F.date_trunc("hour", "ts").cast("string")))
    failure = (F.when(eid % 23 == 0, F.lit(None).cast("int"))
               .when(eid % 211 == 0, 9)
               .when(is_error & (k < 10), 1).when(is_error & (k < 20), 2).otherwise(0))
    values = {
        "timestamp": stamp,
        "consumption_kWh": F.when(eid % 37 != 0, 12.0 + 0.25 * h + 0.02 * k),
        "temperature_C": F.when(eid % 29 != 0, 45.0 + 0.5 * h + 0.1 * v),
        "vibration": 1.0 + 0.01 * v,
        "pressure": 45.0 + 0.2 * h + 0.05 * k,
        "cycle_duration": 30.0 + 0.5 * (k % 10),
        "rpm": F.when(is_error & (k < 20) & (k % 2 == 0), F.lit(0.0)).otherwise(
            (1500 - 4 * h + k).cast("double")),
        "voltage": (228 + k % 5).cast("double"),
        "failure": failure,
    }
    # Rows with event_id % 50 = 0 appear twice, as exact copies.
    copies = F.when(eid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return e.select(
        (eid * 2).alias("_base"), F.explode(copies).alias("_copy"),
        F.col("machine_id"), _target_cycle(F.col("machine_id")).alias("target_cycle"),
        *[c.cast("string").alias(n) for n, c in values.items()],
    ).withColumn("row_id", F.col("_base") + F.col("_copy")).drop("_base", "_copy")


def bronze_interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter((F.col("event_type") == "error") & (F.col("k") >= 95))
    eid, k, v = F.col("event_id"), F.col("k"), F.col("value")
    kind = (F.when(eid % 7 == 0, "Unknown").when(k % 2 == 0, "Breakage").otherwise("Overheat"))
    return e.select(
        eid.alias("row_id"), "machine_id",
        F.when(eid % 101 == 0, F.lit("bad-date")).otherwise(
            F.date_trunc("hour", "ts").cast("string")).alias("timestamp"),
        kind.alias("failure_type"),
        (50.0 + 0.1 * v).cast("string").alias("temperature"),
        (1500 + k).cast("string").alias("rpm"),
        (1.0 + 0.01 * v).cast("string").alias("vibration"),
        (45.0 + 0.05 * k).cast("string").alias("pressure"),
    )


def interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.interventions import clean_interventions
    return clean_interventions(bronze_interventions(spark, sf_dir))


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sensor rows at event time, one per event, some sensors missing."""
    e = events(spark, sf_dir)
    eid, k, v, h = F.col("event_id"), F.col("k"), F.col("value"), F.hour("ts")
    is_error = F.col("event_type") == "error"
    machine = F.col("machine_id")
    return e.select(
        eid.alias("row_id"), machine,
        F.when(eid % 41 == 0, 0).otherwise(_target_cycle(machine)).alias("target_cycle"),
        F.col("ts").alias("timestamp"),
        F.when(eid % 37 != 0, 12.0 + 0.25 * h + 0.02 * k).alias("consumption_kWh"),
        F.when(eid % 29 != 0, 45.0 + 0.5 * h + 0.1 * v).alias("temperature_C"),
        (1.0 + 0.01 * v).alias("vibration"),
        (45.0 + 0.2 * h + 0.05 * k).alias("pressure"),
        F.when(eid % 43 != 0, 30.0 + 0.5 * (k % 10)).alias("cycle_duration"),
        F.when(is_error & (k < 20) & (k % 2 == 0), F.lit(0.0)).otherwise(
            (1500 - 4 * h + k).cast("double")).alias("rpm"),
        (228 + k % 5).cast("double").alias("voltage"),
        F.when(is_error & (k < 10), 1).when(is_error & (k < 20), 2).otherwise(0).alias("failure"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored readings in the shape of the predictions table."""
    return predictions_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def predictions_of(raw: DataFrame) -> DataFrame:
    e = events_of(raw)
    k = F.col("k")
    noise = F.col("event_type") == "error"
    score = F.when(noise & (k >= 30), F.lit(1.0)).when(noise, 0.5 + 0.01 * k).otherwise(k / 100.0)
    return e.select(
        F.col("event_id"), F.col("ts").alias("recorded_at"), "machine_id",
        F.concat(F.lit("v"), (F.dayofmonth("ts") % 4).cast("string")).alias("model_version"),
        F.when(noise, C.NOISE).otherwise(k % 4).alias("cluster_label"),
        noise.alias("anomaly"), score.alias("anomaly_score"), noise.alias("alert"),
        S.alert_level(noise, score).alias("alert_level"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event: outcome and latency in seconds."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("request_id"), "ts", "machine_id", _instance(F.col("event_id")).alias("instance"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("k") < 3, "unavailable").otherwise("ok").alias("status"),
        (F.col("value") / 50.0).alias("latency"),
    )


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly samples of request counters per replica and status; each restarts every day."""
    return _counted(request_log(spark, sf_dir), ["instance", "status"])


def label_samples(spark: SparkSession, sf_dir: str, what: str, label: str) -> DataFrame:
    """Hourly samples per replica of the counters `predictions`, `alerts` or `anomalies` by a label."""
    rows = predictions(spark, sf_dir).withColumn("instance", _instance(F.col("event_id")))
    rows = rows.filter("anomaly") if what == "anomalies" else rows
    return _counted(rows.withColumnRenamed("recorded_at", "ts"), ["instance", label])


def _instance(event_id):
    """The replica that served an event."""
    return F.concat(F.lit("api-"), (event_id % 2).cast("string"))


def _counted(rows: DataFrame, series: list[str]) -> DataFrame:
    hourly = rows.groupBy(*series, F.date_trunc("hour", "ts").alias("ts")).agg(F.count("*").alias("n"))
    day = Window.partitionBy(*series, F.date_trunc("day", "ts")).orderBy("ts")
    return hourly.select("ts", *series, F.sum("n").over(day).cast("double").alias("value"))


def bucket_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly samples of the cumulative latency buckets; restart every day."""
    bounds = F.array(*[F.lit(b) for b in C.LATENCY_BOUNDS], F.lit(float("inf")))
    hourly = (request_log(spark, sf_dir)
              .select("ts", "instance", "latency", F.explode(bounds).alias("le"))
              .groupBy("instance", "le", F.date_trunc("hour", "ts").alias("ts"))
              .agg(F.count_if(F.col("latency") <= F.col("le")).alias("n")))
    day = Window.partitionBy("instance", "le", F.date_trunc("day", "ts")).orderBy("ts")
    return hourly.select("ts", "instance", "le", F.sum("n").over(day).cast("double").alias("value"))
