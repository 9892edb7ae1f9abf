"""Event-time windows over a stream of predictions (ST08, A30).

Every batch stores what it adds to each window, under its id: counts, sums and maxima.
A window is the merge of its parts, so rows may come in any order and as late as they
like, no state has to be kept for them, and a repeated batch replaces itself. Parts are
combined as they come (`parts`), so a reader meets few of them however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .parts import FAN, PartTable

WINDOW = ["window_start", "window_end"]


def window_parts(predictions: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """What a batch adds to each window."""
    window = F.window("recorded_at", length, slide) if slide else F.window("recorded_at", length)
    return (predictions.groupBy(window.alias("w")).agg(
        F.count("*").alias("n_points"),
        F.count_if(F.col("anomaly")).alias("n_anomalies"),
        F.count_if(F.col("cluster_label") == C.NOISE).alias("n_noise"),
        F.max("anomaly_score").alias("max_score"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "n_points", "n_anomalies", "n_noise", "max_score"))


def combined(parts: DataFrame) -> DataFrame:
    """One row per window, in the columns of parts."""
    return parts.groupBy(*WINDOW).agg(
        F.sum("n_points").alias("n_points"), F.sum("n_anomalies").alias("n_anomalies"),
        F.sum("n_noise").alias("n_noise"), F.max("max_score").alias("max_score"))


def merged(parts: DataFrame) -> DataFrame:
    """Rows, noise share and top score per window from the parts of all batches."""
    return combined(parts).select(
        *WINDOW, "n_points", "n_anomalies", (F.col("n_noise") / F.col("n_points")).alias("noise_rate"), "max_score")


def run_windows(stream: DataFrame, table: str, checkpoint: str, length: str, slide: str | None = None, fan: int = FAN) -> None:
    """Drain a stream of predictions into the parts of its windows."""
    parts = PartTable(stream.sparkSession, table, combined, fan)
    query = (stream.writeStream.foreachBatch(lambda batch, batch_id: parts.store(window_parts(batch, length, slide), batch_id))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_windows(spark: SparkSession, table: str, fan: int = FAN) -> DataFrame:
    """The windows as of the last complete batch."""
    return merged(PartTable(spark, table, combined, fan).read())


def live_windows(predictions: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """The same for a table of predictions."""
    return merged(window_parts(predictions, length, slide))


def without_repeats(rows: DataFrame) -> DataFrame:
    """One row per machine and instant of all batches; a repeat may come in any later batch."""
    first = F.min_by(F.struct(*rows.columns), "b").alias("row")
    return rows.groupBy("machine_id", "recorded_at").agg(first).select("row.*")


def run_batches(stream: DataFrame, table: str, checkpoint: str,
                make: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> None:
    """Drain the stream; every batch stores what `make` gives for it, under its id."""
    def store(batch: DataFrame, batch_id: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{table}/b={batch_id}")

    query = (stream.writeStream.foreachBatch(store)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
