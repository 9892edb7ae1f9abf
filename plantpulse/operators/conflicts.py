"""Exact copies and conflicting rows for one timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import medians
from ..functions import scalars as S
from ..session import stage_table

CELL = [*C.SERIES, "timestamp"]
SHOWN_VALUES = 5


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """First row of every set of rows equal in all business columns.

    A hash aggregate over all columns: copies collapse map-side, so a value
    repeated in a third of all rows costs one row per task. The row order and
    the invalid-code mark travel in one long, which keeps the buffer primitive.
    """
    first = F.min(F.col("row_id") * 2 + F.col("bad_failure"))
    return (df.groupBy(*C.SERIES, *C.BUSINESS).agg(first.alias("first"))
            .select(*C.SERIES, *C.BUSINESS, F.floor(F.col("first") / 2).alias("row_id"),
                    (F.col("first") % 2).cast("int").alias("bad_failure")))


def _cells(rows: DataFrame) -> DataFrame:
    """One row per (series, timestamp) from primitive partial aggregates."""
    per_sensor = [a for c in C.SENSORS for a in (
        F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    return rows.groupBy(*CELL).agg(
        F.count("*").alias("n_rows"),
        F.min(F.col("row_id") * 2 + F.col("bad_failure")).alias("first"),
        *per_sensor,
        *[F.count_if(F.col("failure") == f).alias(f"f{f}") for f in C.FAILURE_CODES],
    )


def resolve_conflicts(rows: DataFrame, audit: bool = True) -> DataFrame:
    """One row per (series, timestamp): sensor medians and a failure verdict.

    Up to two values, the median is (min + max) / 2 and needs no sort. Only the
    cells with more go back to their rows for the exact median, which holds no
    cell in one buffer. `rows` feeds several branches and should be staged.
    """
    cells = stage_table(_cells(rows))
    many = F.greatest(*[F.col(f"n_{c}") for c in C.SENSORS]) > 2
    crowded = cells.filter(many).select(*CELL)
    found = medians.exact_medians(rows.join(crowded, CELL, "left_semi"), CELL, C.SENSORS)
    joined = cells.join(found.select(*CELL, *[F.col(c).alias(f"med_{c}") for c in C.SENSORS]), CELL, "left")
    out = joined.select(
        *CELL,
        *[F.when(F.col(f"n_{c}") <= 2, (F.col(f"lo_{c}") + F.col(f"hi_{c}")) / 2.0)
          .otherwise(F.col(f"med_{c}")).alias(c) for c in C.SENSORS],
        S.failure_verdict(F.col("f0"), F.col("f1"), F.col("f2")).alias("failure"),
        (F.col("first") % 2).cast("int").alias("bad_failure"),
        F.floor(F.col("first") / 2).alias("row_id"),
        (F.col("n_rows") > 1).cast("int").alias("is_duplicate_corrected"),
        "n_rows",
    )
    if not audit:
        return out
    out = stage_table(out)
    return out.join(conflict_audit(rows, out), CELL, "left")


def shown_values(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Conflicts with `shown`, their first rows in row order.

    At most five rows per cell reach the list: the ranked filter is applied
    before the shuffle as well as after it.
    """
    by_order = Window.partitionBy(*CELL).orderBy("row_id")
    shown = (rows.withColumn("nth", F.row_number().over(by_order))
             .filter(F.col("nth") <= SHOWN_VALUES)
             .groupBy(*CELL)
             .agg(F.sort_array(F.collect_list(F.struct("nth", *C.SENSORS, "failure"))).alias("shown")))
    return cells.filter("n_rows > 1").join(shown, CELL)


def conflict_audit(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Audit text of every conflict: first values, count, median, verdict."""
    conflicts = shown_values(rows, cells)
    more = F.when(F.col("n_rows") > SHOWN_VALUES, F.concat(
        F.lit(", ... +"), (F.col("n_rows") - SHOWN_VALUES).cast("string"), F.lit(" more"))).otherwise("")

    def listed(name: str):
        return F.concat(F.lit("["), F.array_join(F.transform(
            "shown", lambda s: F.coalesce(s[name].cast("string"), F.lit("nan"))), ", "), F.lit("]"))

    parts = [F.concat(F.lit("timestamp conflict resolved for "), F.col("timestamp").cast("string"))]
    parts += [F.concat(F.lit(f"{c}: values="), listed(c), more, F.lit(" (n="),
                       F.col("n_rows").cast("string"), F.lit(") -> median="),
                       F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in C.SENSORS]
    parts.append(F.concat(F.lit("failure: values="), listed("failure"), more, F.lit(" -> "),
                          F.coalesce(F.col("failure").cast("string"), F.lit("unresolved"))))
    return conflicts.select(*CELL, F.concat_ws("; ", *parts).alias("duplicate_correction_details"))


def split_by_conflict(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose timestamp is, and is not, shared within the series."""
    shared = rows.groupBy(*CELL).agg(F.count("*").alias("n")).filter("n > 1").select(*CELL)
    return rows.join(shared, CELL, "left_semi"), rows.join(shared, CELL, "left_anti")
