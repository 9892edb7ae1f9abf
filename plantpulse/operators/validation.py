"""Structure and content report of a bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S


def column_report(columns: list[str]) -> dict[str, list[str]]:
    """Missing and extra columns; metadata only."""
    given = set(columns)
    return {
        "missing": sorted(c for c in C.BUSINESS if c not in given),
        "extra": [c for c in columns if c not in C.BUSINESS],
    }


def require_columns(df: DataFrame, needed: list[str], what: str) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def column_table(df: DataFrame, context: list[str] = ()) -> DataFrame:
    """The column report as rows (check, column)."""
    seen = [c for c in df.columns if c not in context]
    report = column_report(seen)
    rows = [(check, c) for check, names in report.items() for c in names]
    return df.sparkSession.createDataFrame(rows, "check string, column string")


def content_report(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Counts of every content problem, in one pass over the rows.

    Long form: (keys, column, check, n). Checks are `unparseable`, `missing`,
    `duplicate` (timestamp only), `below` and `above`. Zero counts stay, so two
    reports can be compared row by row.
    """
    keys = list(keys)
    present = [c for c in C.BUSINESS if c in df.columns]
    aggs, labels = [], []

    def check(column: str, name: str, value):
        labels.append((column, name))
        aggs.append(value.alias(f"c{len(aggs)}"))

    for c in present:
        raw = S.known(F.col(c))
        parsed = S.parse_time(raw) if c == "timestamp" else S.parse_number(raw)
        check(c, "unparseable", F.count_if(raw.isNotNull() & parsed.isNull()))
        check(c, "missing", F.count_if(raw.isNull()))
        if c in C.PHYSICAL_LIMITS:
            low, high = C.PHYSICAL_LIMITS[c]
            check(c, "below", F.count_if(parsed < low))
            if high is not None:
                check(c, "above", F.count_if(parsed > high))
    wide = df.groupBy(*keys).agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(col).alias("column"), F.lit(name).alias("check"), F.col(f"c{i}").alias("n"))
        for i, (col, name) in enumerate(labels)])
    report = wide.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*")
    if "timestamp" not in present:
        return report
    return report.unionByName(timestamp_duplicates(df, keys).select(
        *keys, F.lit("timestamp").alias("column"), F.lit("duplicate").alias("check"), "n"))


def timestamp_duplicates(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Copies of a raw timestamp beyond the first; a missing one is a value.

    Counted per value first, so neither a repeated stamp nor a large key lands
    in one task.
    """
    keys = list(keys)
    return (df.groupBy(*keys, S.known(F.col("timestamp")).alias("stamp")).agg(F.count("*").alias("copies"))
            .groupBy(*keys).agg(F.sum(F.col("copies") - 1).alias("n")))


def unexpected_failures(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Distinct numeric failure codes outside the domain."""
    code = S.parse_number(S.known(F.col("failure")))
    return (df.select(*keys, code.alias("value"))
            .filter(F.col("value").isNotNull() & ~F.col("value").isin(C.FAILURE_CODES)).distinct())
