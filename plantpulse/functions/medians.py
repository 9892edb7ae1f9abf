"""Exact medians of groups of any size, by one method.

Values collapse to counts, spread over tasks by value, so a repeated value costs one
row per task. A group with many different values is narrowed in rounds: a sketch of its
distinct values gives splits, counts per part are exact, and only the parts that hold
the middle ranks stay. What is left of every group, `BRACKET_VALUES` values at most, is
ordered by a window. No group is held in one buffer and no rank rests on the sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

#: Distinct values of a group that a window may order; parts of a round.
BRACKET_VALUES = 100_000
PARTS = 64


def exact_medians(rows: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  bracket: int | None = None) -> DataFrame:
    """Median of each column per group; nulls do not count, a group without values gives null."""
    bracket = max(2 * PARTS, bracket or BRACKET_VALUES)
    keys = list(keys)
    group = [*keys, "measure"]
    cells = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("m")).select(*keys, "m.*").filter("v IS NOT NULL")
    counted = stage_table(cells.groupBy(*group, "v").agg(F.count("*").alias("w")))
    state = stage_table(counted.groupBy(*group).agg(
        F.sum("w").alias("n"), F.count("*").alias("n_values"), F.min("v").alias("low"), F.max("v").alias("high")
    ).withColumn("below", F.lit(0).cast("bigint")))
    while not state.filter(F.col("n_values") > bracket).isEmpty():
        state = _narrowed(counted, state, group, bracket)
    inside = counted.join(state, group).filter(F.col("v").between(F.col("low"), F.col("high")))
    running = Window.partitionBy(*group).orderBy("v")
    ranked = inside.withColumn("upto", F.col("below") + F.sum("w").over(running))
    low, high = _middle_ranks()
    middle = ranked.groupBy(*group).agg(*[F.min(F.when(F.col("upto") >= rank, F.col("v"))).alias(name)
                                          for name, rank in (("a", low), ("b", high))])
    return middle.groupBy(*keys).agg(*[
        F.max(F.when(F.col("measure") == c, (F.col("a") + F.col("b")) / 2.0)).alias(c) for c in columns])


def _middle_ranks() -> tuple[Column, Column]:
    return F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1


def _narrowed(counted: DataFrame, state: DataFrame, group: list[str], bracket: int) -> DataFrame:
    """The state with wide groups reduced to the parts that hold their middle ranks."""
    wide = state.filter(F.col("n_values") > bracket)
    inside = counted.join(wide, group).filter(F.col("v").between(F.col("low"), F.col("high")))
    shares = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    splits = inside.groupBy(*group).agg(F.percentile_approx("v", shares, 100 * PARTS).alias("splits"))
    part = F.size(F.filter("splits", lambda s: s < F.col("v")))
    counts = inside.join(splits, group).groupBy(*group, "n", "below", part.alias("part")).agg(
        F.sum("w").alias("w"), F.count("*").alias("n_values"), F.min("v").alias("low"), F.max("v").alias("high"))
    running = Window.partitionBy(*group).orderBy("part")
    spans = counts.withColumn("upto", F.col("below") + F.sum("w").over(running))
    low, high = _middle_ranks()
    holds = (F.col("upto") >= low) & (F.col("upto") - F.col("w") < high)
    left = spans.filter(holds).groupBy(*group, "n").agg(
        F.sum("n_values").alias("n_values"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min(F.col("upto") - F.col("w")).alias("below"))
    done = state.filter(F.col("n_values") <= bracket)
    return stage_table(done.unionByName(left.select(*done.columns)))
