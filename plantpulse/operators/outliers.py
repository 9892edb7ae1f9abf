"""Outlier detection and correction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..functions.slices import SLICE, grid_halo, home_rows


def normal_bounds(rows: DataFrame, keys: list[str] = C.SERIES,
                  sigma: float = C.OUTLIER_SIGMA) -> DataFrame:
    """mean -/+ sigma * sample std of each sensor over the failure-free rows."""
    normal = rows.filter(F.col("failure") == 0)
    stats = normal.groupBy(*keys).agg(*[a for c in C.SENSORS for a in (
        F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"))])
    return stats.select(*keys, *[b for c in C.SENSORS for b in (
        F.col(f"mean_{c}").alias(f"mean_{c}"), F.col(f"std_{c}").alias(f"std_{c}"),
        (F.col(f"mean_{c}") - sigma * F.col(f"std_{c}")).alias(f"low_{c}"),
        (F.col(f"mean_{c}") + sigma * F.col(f"std_{c}")).alias(f"high_{c}"))])


def flag_outliers(rows: DataFrame, sigma: float = C.OUTLIER_SIGMA) -> DataFrame:
    """Mark failure-free values strictly outside the bounds of their series.

    `rows` is sliced. The bounds are joined per (series, slice), the rows' own
    partitioning, so a long series is not gathered for the join.
    """
    bounds = normal_bounds(rows, sigma=sigma)
    slices = rows.select(*C.SERIES, SLICE).distinct()
    joined = rows.join(slices.join(bounds, C.SERIES), [*C.SERIES, SLICE], "left")
    normal = F.col("failure") == 0
    hits = {c: normal & ((F.col(c) < F.col(f"low_{c}")) | (F.col(c) > F.col(f"high_{c}")))
            for c in C.SENSORS}
    text = F.concat_ws("", *[
        F.when(hits[c], F.concat(
            F.lit(f"{c} "), S.fixed(F.col(c), 4), F.lit(" lies outside "),
            S.fixed(F.col(f"low_{c}"), 2), F.lit(" to "), S.fixed(F.col(f"high_{c}"), 2),
            F.lit("; "))) for c in C.SENSORS])
    return (joined.withColumn("outlier_names", S.names_where(hits))
            .withColumn("is_outlier", (F.size("outlier_names") > 0).cast("int"))
            .withColumn("correction_details", text)
            .drop(*[f"{p}_{c}" for c in C.SENSORS for p in ("mean", "std", "low", "high")]))


def correct_outliers(rows: DataFrame, radius: int = C.NEIGHBOUR_RADIUS) -> DataFrame:
    """Replace outlier values by the median of usable neighbours.

    Rows with any outlier stay unusable as neighbours, so the step is not
    recursive and one window over the hourly rows is exact.
    """
    w = Window.partitionBy(*C.SERIES, SLICE).orderBy("timestamp")
    halo = grid_halo(rows.drop(SLICE), radius, radius)
    usable = {c: F.when(F.col("is_outlier") == 0, F.col(c)) for c in C.SENSORS}
    steps = [i for i in range(-radius, radius + 1) if i]
    medians = {c: S.small_median([F.lag(usable[c], -i).over(w) for i in steps]) for c in C.SENSORS}
    seen = home_rows(halo.withColumns({
        f"new_{c}": F.when(F.array_contains("outlier_names", c), m) for c, m in medians.items()}))
    fixed = {c: F.col(f"new_{c}").isNotNull() for c in C.SENSORS}
    notes = F.concat_ws("", F.col("correction_details"), *[
        F.when(fixed[c], F.concat(F.lit(f"{c} "), S.fixed(F.col(c), 4), F.lit(" replaced by "),
                                  S.fixed(F.col(f"new_{c}"), 4), F.lit("; "))) for c in C.SENSORS])
    return (seen.withColumn("correction_details", S.strip_right(notes, "; "))
            .withColumn("outlier_fixed", F.greatest(*[fixed[c] for c in C.SENSORS]))
            .withColumns({c: F.coalesce(F.col(f"new_{c}"), F.col(c)) for c in C.SENSORS})
            .drop(*[f"new_{c}" for c in C.SENSORS]))
