"""Bronze to silver: the cleaning steps in their fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..operators import cleaning, conflicts, failure_repair, hourly, imputation, outliers
from ..session import stage, stage_table

SILVER_COLUMNS = [*C.SERIES, "timestamp", *C.SENSORS, "failure", *C.AUDIT_DEFAULTS]


def resolved_rows(bronze: DataFrame, audit: bool = True) -> DataFrame:
    typed = cleaning.drop_undated(cleaning.type_bronze(bronze))
    return conflicts.resolve_conflicts(stage_table(conflicts.drop_exact_copies(typed)), audit=audit)


def repaired_rows(bronze: DataFrame, audit: bool = True) -> DataFrame:
    """Hourly rows with complete failure codes, sliced and staged."""
    cells = resolved_rows(bronze, audit)
    return stage(failure_repair.repair_failure(hourly.complete_hours(cells)))


def marked_rows(bronze: DataFrame, audit: bool = True, sigma: float = C.OUTLIER_SIGMA) -> DataFrame:
    return outliers.flag_outliers(repaired_rows(bronze, audit), sigma)


def imputed_rows(bronze: DataFrame, audit: bool = True, sigma: float = C.OUTLIER_SIGMA) -> DataFrame:
    return imputation.impute(marked_rows(bronze, audit, sigma))


def silver(bronze: DataFrame, audit: bool = True, sigma: float = C.OUTLIER_SIGMA) -> DataFrame:
    """Silver rows with the twelve audit columns."""
    rows = outliers.correct_outliers(imputed_rows(bronze, audit, sigma))
    return render_audit(rows)


def render_audit(rows: DataFrame) -> DataFrame:
    """Turn internal marks into the audit columns; flags in order of arising."""
    flags = cleaning.initial_flags(F.col("bad_failure"))
    flags = S.add_flag(flags, "TIMESTAMP_CONFLICT_RESOLVED", F.col("is_duplicate_corrected") == 1)
    flags = S.add_flag(flags, "MISSING_TIMESTAMP_IMPUTED", F.col("is_missing_timestamp") == 1)
    steps = rows.withColumn("flags", flags)
    steps = steps.withColumn("flags", failure_repair.failure_flags(F.col("flags"), F.col("failure_rule")))
    steps = steps.withColumn("flags", S.add_flag(F.col("flags"), "OUTLIER_DETECTED", F.col("is_outlier") == 1))
    steps = steps.withColumn("flags", F.concat("flags", "nan_flags"))
    steps = steps.withColumn("flags", S.add_flag(F.col("flags"), "OUTLIER_CORRECTED", F.col("outlier_fixed")))
    details = (F.coalesce("duplicate_correction_details", F.lit(""))
               if "duplicate_correction_details" in rows.columns else F.lit(""))
    return steps.withColumns({
        "quality_flag": S.render_flags(F.col("flags")),
        "outlier_columns": F.array_join("outlier_names", ", "),
        "is_nan_corrected": (F.size("nan_filled") > 0).cast("int"),
        "nan_columns": F.array_join("nan_filled", ", "),
        "duplicate_correction_details": details,
    }).select(*SILVER_COLUMNS)
