"""Typing, flags and audit columns of raw sensor rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from .validation import require_columns

FLAGS = "quality_flags"


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add the twelve audit columns, or fill their gaps when present."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d)
        for c, d in C.AUDIT_DEFAULTS.items()
    })


def parse_timestamps(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", S.parse_time(S.known(F.col("timestamp"))))


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Sensors and failure to numbers; an unknown failure code becomes null and
    is remembered in `bad_failure`."""
    code = S.parse_number(S.known(F.col("failure")))
    return df.withColumns({
        **{c: S.parse_number(S.known(F.col(c))) for c in C.SENSORS},
        "failure": S.valid_failure(code),
        "bad_failure": F.when(code.isNotNull() & ~code.isin(C.FAILURE_CODES), 1).otherwise(0),
    })


def initial_flags(bad_failure):
    empty = F.array().cast("array<string>")
    return S.add_flag(empty, "INVALID_FAILURE_VALUE", bad_failure == 1)


def type_bronze(df: DataFrame) -> DataFrame:
    """Typed rows: series keys, row order, business columns, `bad_failure`."""
    require_columns(df, C.BUSINESS, "bronze sensors")
    typed = coerce_numbers(parse_timestamps(df))
    return typed.select(*C.SERIES, "row_id", *C.BUSINESS, "bad_failure")


def drop_undated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("timestamp").isNotNull())


def context_first(df: DataFrame) -> DataFrame:
    front = [*C.SERIES, "timestamp"]
    return df.select(*front, *[c for c in df.columns if c not in front])
