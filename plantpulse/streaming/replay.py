"""Replay of stored rows as a stream of ticks (ST01-ST03, ST05, L06)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.slices import SLICE, slice_of
from ..session import stage_table

TICK = "tick"


def ticks_by_time(df: DataFrame) -> DataFrame:
    """Number the distinct timestamps in ascending order.

    Only the distinct timestamps are ordered, in slices with a running offset,
    so no task orders all rows.
    """
    times = df.select("timestamp").distinct().withColumn(SLICE, slice_of(F.col("timestamp")))
    local = F.row_number().over(Window.partitionBy(SLICE).orderBy("timestamp"))
    sizes = times.groupBy(SLICE).agg(F.count("*").alias("n"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    numbered = times.join(offsets, SLICE).select(
        "timestamp", (F.col("offset") + local - 1).alias(TICK))
    return df.join(numbered, "timestamp")


def ticks_by_rows(df: DataFrame, rows: int) -> DataFrame:
    """Cut the rows, in (time, machine) order, into ticks of fixed size.

    Range partitions hold equal shares of the order whatever the skew. They are
    staged, so their numbers stay fixed while sizes add up to row numbers.
    """
    order = ["timestamp", "machine_id", "target_cycle", *[c for c in ("row_id",) if c in df.columns]]
    ranged = stage_table(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (ranged.withColumn("nth", nth).join(offsets, "part")
            .withColumn(TICK, F.floor((F.col("offset") + F.col("nth") - 1) / rows)).drop("part", "nth", "offset"))


def last_ticks(df: DataFrame, n: int) -> DataFrame:
    """Rows of the last n distinct timestamps, with their rank from the end."""
    newest = df.select("timestamp").distinct().orderBy(F.col("timestamp").desc()).limit(n)
    # At most n rows: one window orders them.
    rank = F.row_number().over(Window.orderBy(F.col("timestamp").desc())) - 1
    return df.join(newest.withColumn("ticks_back", rank), "timestamp")


def warm_up(df: DataFrame, as_of, n: int = 60, stride_seconds: float = 5.0) -> DataFrame:
    """The last n ticks re-stamped to end at `as_of`, `stride_seconds` apart."""
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("ticks_back") * stride_seconds).cast("decimal(18,6)"))
    return last_ticks(df, n).withColumn("timestamp", as_of - back).drop("ticks_back")


def stored_ticks(ticks: DataFrame) -> DataFrame:
    """The ticks in order of their number, so that file statistics lead to the rows of one; a tick may span files."""
    order = [TICK, *[c for c in ("machine_id", "timestamp", "row_id") if c in ticks.columns]]
    return stage_table(ticks.repartitionByRange(*order).sortWithinPartitions(TICK))


def paced(ticks: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "0 seconds",
          last: int | None = None) -> int:
    """Hand out stored ticks one per micro-batch, every `interval`, up to tick `last`; returns the ticks done so far.

    A built-in source counts 0, 1, 2, .. with its offset in the checkpoint; the rows of the
    tick of that number are read by a filter on the stored table. Nothing is written to feed
    the stream. Stopped or failed, it goes on at the first tick that was not committed, and
    `handle` may see a tick again, under the same number.
    """
    spark = ticks.sparkSession
    top = ticks.agg(F.max(TICK)).first()[0]
    if top is None:
        return 0
    end = top if last is None else min(last, top)
    done = threading.Event()

    def batch(numbers: DataFrame, batch_id: int) -> None:
        for row in numbers.select("value").collect():  # one row
            if row["value"] <= end:
                handle(ticks.filter(F.col(TICK) == row["value"]), row["value"])
            else:
                done.set()
                if end < top:
                    # There is such a tick: it must not be committed, so that the next run takes it up.
                    raise StopAtEnd(row["value"])

    source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    query = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    while query.isActive and not done.wait(0.05):
        pass
    query.stop()
    if not done.is_set():
        query.awaitTermination()  # raises what stopped it
    return end + 1


class StopAtEnd(Exception):
    """Raised in a batch beyond the last tick, to leave it uncommitted."""


def replay(ticks: DataFrame, folder: str, drain: Callable[[], None], ticks_per_batch: int = 1) -> int:
    """Append the ticks in order, `ticks_per_batch` at a time, and let the consumer drain each batch.

    Ticks are staged in order of their number, so a batch reads only its part of the
    table; a tick may span many files and tasks. Returns the number of batches.
    """
    staged = stored_ticks(ticks)
    last = staged.agg(F.max(TICK)).first()[0]
    starts = range(0, -1 if last is None else last + 1, ticks_per_batch)
    for start in starts:
        part = staged.filter((F.col(TICK) >= start) & (F.col(TICK) < start + ticks_per_batch))
        part.write.mode("append").parquet(folder)
        drain()
    return len(starts)
