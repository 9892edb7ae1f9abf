"""Model matrix and standard scaler."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import medians
from ..functions import scalars as S
from ..session import stage_table
from .validation import require_columns

KEY = "model_key"
POSITION = "pos"
# A spread below this share of the mean is rounding, not variation.
FLAT_SPREAD = 1e-12


def with_cycle_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("cycle_ratio", S.cycle_ratio(F.col("cycle_duration"), F.col("target_cycle")))


def feature_medians(df: DataFrame) -> DataFrame:
    """One row: the exact median of every feature over all machines."""
    keyed = df.select(F.lit(0).alias("all"), *C.FEATURES)
    return medians.exact_medians(keyed, ["all"], C.FEATURES).drop("all")


def model_matrix(df: DataFrame) -> DataFrame:
    """Features with gaps filled by the overall median.

    The eight medians are one row of fixed size; they enter as literals.
    """
    require_columns(df, ["target_cycle", "cycle_duration"], "training")
    rated = with_cycle_ratio(df)
    require_columns(rated, C.FEATURES, "training")
    fill = feature_medians(rated).first()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(fill[c] if fill else None)) for c in C.FEATURES}
    return rated.withColumns(filled)


def row_position(machine, ts, cycle):
    """Sortable row number for (machine, time, cycle), any ints; decimal keeps aggregates hashed.

    Ten digits each for machine and cycle, eighteen for the time.
    """
    micros = F.unix_micros(ts).cast("decimal(18,0)") + F.lit(10 ** 17).cast("decimal(18,0)")
    whole = (machine.cast("decimal(10,0)") * F.lit(10 ** 18).cast("decimal(19,0)")).cast("decimal(28,0)")
    moved = ((whole + micros).cast("decimal(28,0)") * F.lit(10 ** 10).cast("decimal(11,0)")).cast("decimal(38,0)")
    return (moved + cycle.cast("decimal(10,0)")).cast("decimal(38,0)")


def model_rows(matrix: DataFrame, min_samples: int = C.MIN_SAMPLES) -> DataFrame:
    """Rows per model: one per machine with enough rows, plus one global.

    The sizes of the machines come from a partial aggregate and are stored, so that few
    machines join without a shuffle of the rows; machines below
    twice `min_samples` train no own model but stay in the global one.
    """
    base = matrix.select(
        "machine_id", "target_cycle", "timestamp", *C.FEATURES,
        row_position(F.col("machine_id"), F.col("timestamp"), F.col("target_cycle")).alias(POSITION))
    enough = (base.groupBy("machine_id").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= 2 * min_samples).select("machine_id"))
    own = base.join(stage_table(enough), "machine_id", "left_semi").withColumn(KEY, F.col("machine_id").cast("string"))
    return own.unionByName(base.withColumn(KEY, F.lit(C.GLOBAL_MODEL)))


def fit_scaler(rows: DataFrame, keys: list[str] = (KEY,)) -> DataFrame:
    """Mean and population std per model; a flat feature is divided by 1."""
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[a for c in C.FEATURES for a in (F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"scale_{c}"))])
    flat = {f"scale_{c}": F.when(F.col(f"scale_{c}") <= FLAT_SPREAD * F.abs(F.col(f"mean_{c}")), F.lit(1.0))
            .when(F.col(f"scale_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"scale_{c}")) for c in C.FEATURES}
    return stats.withColumns(flat)


def standardise(rows: DataFrame, scaler: DataFrame, key: str = KEY) -> DataFrame:
    """Add z_<feature>. The scaler has one row per model; a large model's rows
    are split by the adaptive skew join when the scaler is not broadcast. A row
    whose model has no scaler is an error: it must not vanish."""
    parts = [f"{p}_{c}" for c in C.FEATURES for p in ("mean", "scale")]
    fitted = scaler.select(key, *parts, F.lit(True).alias("fitted"))
    joined = rows.join(fitted, key, "left").withColumn(key, F.when(F.col("fitted"), F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("no model for "), F.coalesce(F.col(key), F.lit("null")))).cast("string"))).drop("fitted")
    return joined.withColumns({
        f"z_{c}": (F.col(c) - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in C.FEATURES}).drop(*parts)
