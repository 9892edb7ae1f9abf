"""Monitoring queries over serving tables.

Relative windows take an explicit `as_of`, ranges an explicit start and end, so
a result can be repeated. Every grouped query aggregates before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S


def since(df: DataFrame, column: str, as_of: str, interval: str) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    return df.filter(F.col(column) > now - F.expr(f"INTERVAL {interval}"))


def in_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def for_machines(df: DataFrame, machines: list[int]) -> DataFrame:
    return df.filter(F.col("machine_id").isin(machines))


def machine_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("machine_id").alias("value"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("value"))


def anomaly_count(predictions: DataFrame, as_of: str, interval: str) -> DataFrame:
    return row_count(since(predictions, "recorded_at", as_of, interval).filter("anomaly"))


def noise_rate(predictions: DataFrame, as_of: str, interval: str) -> DataFrame:
    recent = since(predictions, "recorded_at", as_of, interval)
    noise = F.count_if(F.col("cluster_label") == C.NOISE).cast("double")
    return recent.agg(F.coalesce(noise / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("value"))


def alerts_daily(predictions: DataFrame) -> DataFrame:
    return (predictions.filter("alert")
            .groupBy(F.date_trunc("day", "recorded_at").alias("day"), "alert_level")
            .agg(F.count("*").alias("n_alerts")))


def latest_alert_days(predictions: DataFrame, n: int = 30) -> DataFrame:
    return alerts_daily(predictions).orderBy(F.col("day").desc(), "alert_level").limit(n)


def cluster_distribution(predictions: DataFrame, as_of: str, interval: str = "24 HOURS") -> DataFrame:
    return (since(predictions, "recorded_at", as_of, interval)
            .groupBy("cluster_label").agg(F.count("*").alias("n_points")))


def cluster_bars(predictions: DataFrame, as_of: str) -> DataFrame:
    return (cluster_distribution(predictions, as_of).orderBy("cluster_label")
            .select(F.col("cluster_label").cast("string").alias("metric"), F.col("n_points").alias("value")))


def max_score_per_instant(predictions: DataFrame, as_of: str, interval: str) -> DataFrame:
    return (since(predictions, "recorded_at", as_of, interval)
            .groupBy(F.col("recorded_at").alias("time")).agg(F.max("anomaly_score").alias("value")))


def last_prediction(predictions: DataFrame, tie: str) -> DataFrame:
    """Newest prediction per machine. The ranked filter runs before the shuffle
    too, so each task ships one row per machine."""
    newest = Window.partitionBy("machine_id").orderBy(F.col("recorded_at").desc(), F.col(tie).desc())
    return (predictions.withColumn("nth", F.row_number().over(newest))
            .filter("nth = 1").select(*C.PREDICTION_TABLE))


def machines_in_anomaly(predictions: DataFrame, tie: str) -> DataFrame:
    return row_count(last_prediction(predictions, tie).filter("anomaly"))


def machine_states(predictions: DataFrame, tie: str) -> DataFrame:
    return last_prediction(predictions, tie).select(
        "machine_id", "recorded_at", "cluster_label", "anomaly",
        F.round("anomaly_score", 3).alias("anomaly_score"), "alert_level").orderBy("machine_id")


def latest_model(predictions: DataFrame, tie: str) -> DataFrame:
    return (predictions.orderBy(F.col("recorded_at").desc(), F.col(tie).desc()).limit(1)
            .select("model_version"))


def recent_anomalies(predictions: DataFrame, as_of: str, tie: str, interval: str = "15 MINUTES",
                     n: int = 50) -> DataFrame:
    return (since(predictions, "recorded_at", as_of, interval).filter("anomaly")
            .orderBy(F.col("recorded_at").desc(), F.col(tie).desc()).limit(n)
            .select("recorded_at", "machine_id", "cluster_label", "anomaly_score", "alert_level"))


def recent_interventions(interventions: DataFrame, start: str, end: str, tie: str = "row_id",
                         n: int = 100) -> DataFrame:
    return (in_range(interventions, "timestamp", start, end)
            .orderBy(F.col("timestamp").desc(), F.col(tie).desc()).limit(n)
            .select(F.col("timestamp").alias("time"), "failure_type", "temperature", "vibration", "pressure"))


def mean_consumption(sensors: DataFrame, start: str, end: str) -> DataFrame:
    return (in_range(sensors, "timestamp", start, end)
            .groupBy(F.col("machine_id").cast("string").alias("metric"))
            .agg(F.avg("consumption_kWh").alias("value")))


def predictions_per_day(predictions: DataFrame, start: str, end: str) -> DataFrame:
    return (in_range(predictions, "recorded_at", start, end)
            .groupBy(F.date_trunc("day", "recorded_at").alias("time"), F.col("alert_level").alias("metric"))
            .agg(F.count("*").alias("value")))


def interventions_by_type(interventions: DataFrame) -> DataFrame:
    return interventions.groupBy(F.col("failure_type").alias("metric")).agg(F.count("*").alias("value"))


def failure_rate(sensors: DataFrame) -> DataFrame:
    """Mean of the failure code in percent, as served (code 2 counts double),
    and the share of failed rows beside it."""
    return sensors.groupBy("machine_id").agg(
        F.round(100.0 * F.avg("failure"), 2).alias("failure_rate_percent"),
        F.round(100.0 * F.avg((F.col("failure") > 0).cast("int")), 2).alias("failed_rows_percent"))


def open_alerts(predictions: DataFrame, as_of: str) -> DataFrame:
    return row_count(since(predictions, "recorded_at", as_of, "24 HOURS")
                     .filter(F.col("alert_level") != "nominal"))


def verdicts(predictions: DataFrame, start: str, end: str) -> DataFrame:
    return (in_range(predictions, "recorded_at", start, end)
            .groupBy(F.col("alert_level").alias("metric")).agg(F.count("*").alias("value")))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def sensor_series(sensors: DataFrame, columns: list[str], machines: list[int], start: str, end: str) -> DataFrame:
    """Long form (time, metric, sensor, value), one scan for all sensors."""
    chosen = in_range(for_machines(sensors, machines), "timestamp", start, end)
    return chosen.select(
        F.col("timestamp").alias("time"), F.col("machine_id").cast("string").alias("metric"), *columns
    ).unpivot(["time", "metric"], columns, "sensor", "value")


def score_series(predictions: DataFrame, start: str, end: str, machines: list[int] | None = None) -> DataFrame:
    rows = in_range(predictions, "recorded_at", start, end)
    if machines is not None:
        rows = for_machines(rows, machines)
    return rows.select(F.col("recorded_at").alias("time"), F.col("machine_id").cast("string").alias("metric"),
                       F.col("anomaly_score").alias("value"))


def machine_panel(sensors: DataFrame, machine: int, start: str, end: str) -> DataFrame:
    return (in_range(sensors.filter(F.col("machine_id") == machine), "timestamp", start, end)
            .select(F.col("timestamp").alias("time"), "temperature_C", "vibration", "pressure", "rpm"))


def cycle_ratio_series(sensors: DataFrame, machines: list[int], start: str, end: str) -> DataFrame:
    ratio = S.cycle_ratio_panel(F.col("cycle_duration"), F.col("target_cycle"))
    return (in_range(for_machines(sensors, machines), "timestamp", start, end)
            .select(F.col("timestamp").alias("time"), F.col("machine_id").cast("string").alias("metric"),
                    ratio.alias("value")))


def noisy_readings(sensors: DataFrame, predictions: DataFrame, column: str, machines: list[int] | None = None,
                   start: str | None = None, end: str | None = None) -> DataFrame:
    """Sensor values at the instants scored as noise (J05), of some machines and a range if given."""
    if machines is not None:
        sensors, predictions = for_machines(sensors, machines), for_machines(predictions, machines)
    if start is not None:
        sensors, predictions = in_range(sensors, "timestamp", start, end), in_range(predictions, "recorded_at", start, end)
    noise = predictions.filter(F.col("cluster_label") == C.NOISE).select(
        "machine_id", F.col("recorded_at").alias("timestamp"))
    return sensors.join(noise, ["machine_id", "timestamp"]).select(
        F.col("timestamp").alias("time"),
        F.concat(F.col("machine_id").cast("string"), F.lit(" (anomalie)")).alias("metric"),
        F.col(column).alias("value"))


def lead_time(anomalies: DataFrame, interventions: DataFrame, hours: int = 24) -> DataFrame:
    """Share of interventions preceded, and of anomalies followed, within `hours`.

    Each row only needs its nearest partner in time, which the merge by order
    gives without forming pairs; both sides are sliced per machine.
    """
    from ..operators.interventions import hours_to_next
    a = anomalies.select("machine_id", "timestamp").distinct()
    i = interventions.select("machine_id", "timestamp").distinct()
    followed = hours_to_next(a, i).agg(
        F.count("*").alias("n_anomalies"),
        F.count_if(F.col("hours_to_next_intervention") <= hours).alias("n_followed"))
    flip = (-F.unix_micros("timestamp")).alias("t")
    back_i = i.select("machine_id", F.timestamp_micros(flip).alias("timestamp"))
    back_a = a.select("machine_id", F.timestamp_micros(flip).alias("timestamp"))
    preceded = hours_to_next(back_i, back_a).agg(
        F.count("*").alias("n_interventions"),
        F.count_if(F.col("hours_to_next_intervention") <= hours).alias("n_preceded"))
    return (followed.select(F.lit("anomalies followed").alias("measure"), F.col("n_followed").alias("hits"),
                            F.col("n_anomalies").alias("total"))
            .unionByName(preceded.select(F.lit("interventions preceded").alias("measure"),
                                         F.col("n_preceded").alias("hits"),
                                         F.col("n_interventions").alias("total")))
            .withColumn("share", F.col("hits") / F.nullif(F.col("total"), F.lit(0))))
