"""Reading the given tables, and settings that follow the size of the data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def for_python(df: DataFrame) -> DataFrame:
    """`df`, whose Python workers can import this package."""
    ship_package(df.sparkSession)
    return df


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Number of rows and bytes of text, counted over all rows."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("size")).first()
    return row["n"], row["size"] or 0


def power_of_two(value: float, least: int) -> int:
    """The next power of two at or above `value`, `least` at least."""
    return max(least, 1 << max(0, math.ceil(math.log2(max(1.0, value)))))
