"""Service metrics: counters, histograms, rates and quantiles (A30-A32, ST09-ST12).

Counter samples are `(ts, labels..., value)` with a value that may restart at
zero. Rates are sums of positive steps divided by the width of the window; no
extrapolation to the window's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import clamp_min


def prediction_counters(predictions: DataFrame) -> DataFrame:
    """Totals per machine, per level and of anomalies per machine, in one pass."""
    machine = F.col("machine_id").cast("string")
    entries = F.array_compact(F.array(
        F.struct(F.lit("predictions").alias("metric"), machine.alias("label")),
        F.struct(F.lit("alerts").alias("metric"), F.col("alert_level").alias("label")),
        F.when(F.col("anomaly"), F.struct(F.lit("anomalies").alias("metric"), machine.alias("label")))))
    return (predictions.select(F.explode(entries).alias("e")).groupBy("e.metric", "e.label")
            .agg(F.count("*").alias("value")))


def request_counters(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("value"))


def latency_histogram(log: DataFrame, bounds: list[float] = C.LATENCY_BOUNDS) -> DataFrame:
    """Cumulative counts per upper bound, with the total, in one aggregate."""
    counts = [F.count_if(F.col("latency") <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = log.agg(*counts, F.count("latency").alias("n"), F.sum("latency").alias("total"))
    rows = [F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("n").alias("count")))
    return wide.select(F.explode(F.array(*rows)).alias("e"), "n", "total").select(
        "e.le", "e.count", F.col("n").alias("observations"), F.col("total").alias("latency_sum"))


def increments(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Add `step`: the rise since the previous sample of the series; after a
    restart the value itself. The first sample of a series has no step."""
    w = Window.partitionBy(*labels).orderBy("ts")
    before = F.lag("value").over(w)
    return samples.withColumn("step", F.when(F.col("value") >= before, F.col("value") - before)
                              .when(before.isNotNull(), F.col("value")))


def increase(samples: DataFrame, labels: list[str], at: str, seconds: int) -> DataFrame:
    """Rise over the `seconds` before `at`, summed by `labels`.

    Steps are taken per series, that is per full set of labels: counters of two
    replicas count, and restart, for themselves.
    """
    end = F.lit(at).cast("timestamp")
    recent = samples.filter((F.col("ts") > end - F.expr(f"INTERVAL {seconds} SECONDS")) & (F.col("ts") <= end))
    series = [c for c in samples.columns if c not in ("ts", "value")]
    return increments(recent, series).groupBy(*labels).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("increase"))


def rate(samples: DataFrame, labels: list[str], at: str, seconds: int) -> DataFrame:
    return increase(samples, labels, at, seconds).select(
        *labels, (F.col("increase") / F.lit(float(seconds))).alias("rate"))


def error_ratio(samples: DataFrame, at: str, seconds: int) -> DataFrame:
    rates = rate(samples, ["status"], at, seconds)
    errors = F.coalesce(F.sum(F.when(F.col("status") == "error", F.col("rate"))), F.lit(0.0))
    total = F.coalesce(F.sum("rate"), F.lit(0.0))
    return rates.agg((errors / clamp_min(total, 1e-9)).alias("value"))


def bucket_quantiles(buckets: DataFrame, quantiles: list[float]) -> DataFrame:
    """Quantiles of cumulative bucket counts `(le, count)`, linear in a bucket.

    A target in the open last bucket gives the largest finite bound. The table
    has one row per bound, so one window orders it.
    """
    order = Window.orderBy("le")
    framed = buckets.select(
        "le", F.col("count").alias("upto"),
        F.coalesce(F.lag("count").over(order), F.lit(0.0)).alias("below"),
        F.coalesce(F.lag("le").over(order), F.lit(0.0)).alias("low"),
        F.last("count").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    asked = framed.withColumn("q", F.explode(F.array(*[F.lit(q) for q in quantiles])))
    hit = asked.filter((F.col("upto") >= F.col("q") * F.col("total")) & (F.col("total") > 0))
    first = hit.groupBy("q").agg(F.min_by(F.struct("le", "low", "below", "upto", "total"), "le").alias("b"))
    inside = F.col("b.low") + (F.col("b.le") - F.col("b.low")) * (
        (F.col("q") * F.col("b.total") - F.col("b.below")) / F.nullif(F.col("b.upto") - F.col("b.below"), F.lit(0.0)))
    return first.select("q", F.when(F.col("b.le") == float("inf"), F.col("b.low")).otherwise(inside).alias("value"))


def latency_quantiles(samples: DataFrame, at: str, seconds: int,
                      quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    rates = rate(samples, ["le"], at, seconds).withColumnRenamed("rate", "count")
    return bucket_quantiles(rates, list(quantiles))

