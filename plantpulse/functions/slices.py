"""Ordered windows over keys of any size.

A machine may hold a large share of all rows, so no window is partitioned by a
machine alone. Time is cut into slices and windows run per (key, slice). On an
hourly lattice a slice holds SLICE_HOURS rows; elsewhere `slice_widths` gives each key
the widest slices that hold at most SLICE_ROWS rows, so a dense machine narrows its own
only. What a window must see beyond its slice is brought to it:

* `grid_halo` copies the few rows next to a slice edge of an hourly lattice;
* `row_halo` does the same by row count when rows are not on one lattice;
* `carry_in` gives each slice the last known value of all earlier slices, or the first
  of all later ones, from a table of one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

SLICE_HOURS = 1024
SLICE_SECONDS = 3600 * SLICE_HOURS
SLICE_ROWS = 2_000_000
SLICE = "slice_id"
HOME = "home_slice"
WIDTH = "slice_seconds"
# Widths of slices in seconds; each divides the one before. A series holds few rows per instant.
WIDTHS = [*(SLICE_SECONDS >> k for k in range(15)), 75, 25, 5, 1]


def hour_index(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 3600)


def slice_of(ts: Column, seconds: int = SLICE_SECONDS) -> Column:
    return F.floor(F.unix_seconds(ts) / seconds)


def slice_widths(df: DataFrame, keys: Sequence[str], ts: str = "timestamp", limit: int | None = None) -> DataFrame:
    """The keys whose slices must be narrower than SLICE_SECONDS, with their width.

    A partial aggregate over the key and time columns finds the keys that exceed the limit;
    only their rows are counted per second, and all widths are tried on those counts at once.
    Each such key has more than `limit` rows, so there are at most rows / limit of them: few
    enough to broadcast. The table has one row per such key.
    """
    limit = limit or SLICE_ROWS
    narrow = df.select(*keys, F.col(ts).alias("_at")).filter("_at IS NOT NULL")
    full = (narrow.groupBy(*keys, slice_of(F.col("_at"))).agg(F.count("*").alias("n"))
            .groupBy(*keys).agg(F.max("n").alias("n")).filter(F.col("n") > limit).select(*keys))
    counts = (narrow.join(F.broadcast(full), list(keys), "left_semi")
              .groupBy(*keys, F.unix_seconds("_at").alias("second")).agg(F.count("*").alias("n")))
    tried = counts.select(*keys, "second", "n", F.explode(F.array(*[F.lit(w).cast("long") for w in WIDTHS[1:]])).alias(WIDTH))
    fullest = (tried.groupBy(*keys, WIDTH, F.floor(F.col("second") / F.col(WIDTH))).agg(F.sum("n").alias("n"))
               .groupBy(*keys, WIDTH).agg(F.max("n").alias("n")))
    fits = F.max(F.when(F.col("n") <= limit, F.col(WIDTH)))
    return stage_table(fullest.groupBy(*keys).agg(F.coalesce(fits, F.lit(WIDTHS[-1]).cast("long")).alias(WIDTH)))


def sliced(df: DataFrame, widths: DataFrame, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """Rows with their slice, as wide as `slice_widths` has it for their key."""
    wide = df.join(widths, list(keys), "left")
    seconds = F.coalesce(WIDTH, F.lit(SLICE_SECONDS).cast("long"))
    return wide.withColumn(SLICE, F.floor(F.unix_seconds(ts) / seconds)).drop(WIDTH)


def grid_halo(df: DataFrame, before: int, after: int, ts: str = "timestamp") -> DataFrame:
    """Copy rows of an hourly lattice to the slices whose windows reach them."""
    home = slice_of(F.col(ts))
    offset = hour_index(F.col(ts)) - home * SLICE_HOURS
    targets = F.array_compact(F.array(
        home,
        F.when(offset >= SLICE_HOURS - before, home + 1),
        F.when(offset < after, home - 1),
    ))
    return df.withColumn(HOME, home).withColumn(SLICE, F.explode(targets))


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SLICE) == F.col(HOME)).drop(HOME)


def row_halo(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int,
             widths: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Copy to each slice the `before` rows that precede it, wherever they lie.

    A row that is r-th from the end of its slice is needed by a later slice when
    r plus the sizes of the slices between is at most `before`. Every slice in
    the directory is non-empty, so at most `before` later slices need a row.
    """
    keys = list(keys)
    base = sliced(df, widths, keys, ts).withColumn(HOME, F.col(SLICE))
    ahead = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(1, before)
    directory = (base.groupBy(*keys, SLICE).agg(F.count("*").alias("n"))
                 .withColumn("later", F.collect_list(F.struct(SLICE, "n")).over(ahead))
                 .select(*keys, SLICE, "later"))
    from_end = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in order])
    copies = (base.withColumn("rank_from_end", F.row_number().over(from_end))
              .filter(F.col("rank_from_end") <= before)
              .join(directory, [*keys, SLICE])
              .select("*", F.posexplode("later").alias("step", "target"))
              .withColumn("between", F.expr(
                  "aggregate(slice(later, 1, step), 0L, (total, s) -> total + s.n)"))
              .filter(F.col("rank_from_end") + F.col("between") <= before)
              .withColumn(SLICE, F.col(f"target.{SLICE}")))
    return base.unionByName(copies.select(*base.columns))


def carry_in(per_slice: DataFrame, wanted: DataFrame, keys: Sequence[str],
             value: str, later: bool = False) -> DataFrame:
    """Last non-null `value` of all earlier slices, for each wanted (key, slice); or the first of all later ones.

    Both inputs hold at most one row per (key, slice).
    """
    beyond = (Window.partitionBy(*keys).orderBy(F.col(SLICE).desc() if later else F.col(SLICE))
              .rowsBetween(Window.unboundedPreceding, -1))
    both = (wanted.select(*keys, SLICE, F.lit(True).alias("wanted"))
            .join(per_slice.select(*keys, SLICE, value), [*keys, SLICE], "full"))
    return (both.withColumn(value, F.last(value, ignorenulls=True).over(beyond))
            .filter("wanted").drop("wanted"))
