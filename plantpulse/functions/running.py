"""Running sums over keys of any size.

A window over a key runs in one task. Here the rows are cut into range partitions of
(keys, order), which hold equal shares whatever the skew; sums run within a partition and
start from an offset, the total of the partitions before, of which there is one row per
key and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Add `name`: the sum of `value` over all earlier rows of the key; 0 for the first.

    `order` must not tie within a key. The rows are staged, so their partitions stay fixed.
    """
    ranged = stage_table(df.withColumn("_value", value).repartitionByRange(*keys, *order).withColumn(
        "_part", F.spark_partition_id()))
    earlier = (Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_part").agg(F.sum("_value").alias("_total"))
    offsets = totals.select(*keys, "_part", F.coalesce(F.sum("_total").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(*earlier)), F.lit(0)).alias("_offset"))
    within = F.sum("_value").over(Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(*earlier))
    return (ranged.withColumn("_within", F.coalesce(within, F.lit(0))).join(offsets, [*keys, "_part"])
            .withColumn(name, F.col("_offset") + F.col("_within")).drop("_value", "_part", "_within", "_offset"))
