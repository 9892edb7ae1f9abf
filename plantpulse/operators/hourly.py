"""Hourly grid completion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.slices import SLICE_HOURS
from .conflicts import CELL

# Hours handed to one row before the second explode.
STRETCH_HOURS = SLICE_HOURS
HOUR_MICROS = 3_600_000_000


def grid(cells: DataFrame) -> DataFrame:
    """Every hour from the first to the last timestamp of each series.

    The lattice is anchored at the first timestamp. Long spans are first cut
    into stretches that spread over tasks, then into hours.
    """
    bounds = cells.groupBy(*C.SERIES).agg(F.min("timestamp").alias("first"),
                                          F.max("timestamp").alias("last"))
    stretches = bounds.select(*C.SERIES, "last", F.explode(F.sequence(
        "first", "last", F.expr(f"INTERVAL {STRETCH_HOURS} HOURS"))).alias("start"))
    spread = stretches.repartition(*C.SERIES, "start")
    end = F.least(F.col("last"), F.col("start") + F.expr(f"INTERVAL {STRETCH_HOURS - 1} HOURS"))
    return spread.select(*C.SERIES, F.explode(F.sequence(
        F.col("start"), end, F.expr("INTERVAL 1 HOUR"))).alias("timestamp"))


def complete_hours(cells: DataFrame) -> DataFrame:
    """Left-join the cells on the grid; new rows are marked, and cells off the
    lattice are dropped (see `off_grid` for those)."""
    present = cells.withColumn("present", F.lit(1))
    joined = grid(cells).join(present, CELL, "left")
    return joined.withColumns({
        "is_missing_timestamp": F.when(F.col("present").isNull(), 1).otherwise(0),
        "is_duplicate_corrected": F.coalesce("is_duplicate_corrected", F.lit(0)),
        "bad_failure": F.coalesce("bad_failure", F.lit(0)),
    }).drop("present")


def off_grid(cells: DataFrame) -> DataFrame:
    """Cells the grid drops, kept for quarantine.

    The grid holds the instants that are whole hours after the first one of their series, so
    it is not made: cells meet one row per series. Cells of a series without a name are on no grid.
    """
    first = cells.groupBy(*C.SERIES).agg(F.min("timestamp").alias("first"))
    since = F.unix_micros("timestamp") - F.unix_micros("first")
    kept = cells.join(first, C.SERIES, "left").filter(~F.coalesce(since % HOUR_MICROS == 0, F.lit(False)))
    return kept.select(*cells.columns)
