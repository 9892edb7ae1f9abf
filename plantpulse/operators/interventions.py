"""Breakdown log: cleaning and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..functions.slices import SLICE, carry_in, sliced, slice_widths

MEASURES = ["temperature", "rpm", "vibration", "pressure"]


def clean_interventions(df: DataFrame) -> DataFrame:
    """Keep dated rows whose type is exactly a known one (no trimming)."""
    typed = df.withColumns({
        "timestamp": S.parse_time(S.known(F.col("timestamp"))),
        **{c: S.parse_number(S.known(F.col(c))) for c in MEASURES if c in df.columns},
    })
    kept = typed.filter(F.col("timestamp").isNotNull() & F.col("failure_type").isin(C.FAILURE_TYPES))
    wanted = ["row_id", "machine_id", "timestamp", "failure_type", *MEASURES]
    return kept.select(*[c for c in wanted if c in kept.columns])


def _per_instant(interventions: DataFrame) -> DataFrame:
    """One row per machine and instant: the last type wins looking back, the
    first looking ahead."""
    return interventions.groupBy("machine_id", F.col("timestamp").alias("at")).agg(
        F.max_by("failure_type", "row_id").alias("last_type"),
        F.min_by("failure_type", "row_id").alias("first_type"))


def common_widths(sensors: DataFrame, interventions: DataFrame) -> DataFrame:
    """Slice widths per machine that suit both sides."""
    both = sensors.select("machine_id", "timestamp").unionByName(interventions.select("machine_id", "timestamp"))
    return slice_widths(both, ["machine_id"])


def attach_interventions(sensors: DataFrame, interventions: DataFrame,
                         tolerance_hours: float = C.ASOF_TOLERANCE_HOURS, widths: DataFrame | None = None,
                         instants: DataFrame | None = None) -> DataFrame:
    """Add `hours_since_last_intervention` and `near_type` to sensor rows.

    Both sides are cut into time slices per machine and merged by order, so no
    row pairs are formed. A slice also receives the last earlier and the first
    later instant of its machine, from a table of one row per slice. `near_type`
    is the type of the nearest instant within the tolerance; at equal distance
    the earlier one wins. `instants` are rows of the same machines and times that cost
    less to read: the slices are told from them, so that `sensors` are computed once.
    """
    keys = ["machine_id"]
    instants = sensors if instants is None else instants
    widths = common_widths(instants, interventions) if widths is None else widths
    left = sliced(sensors, widths, keys)
    right = sliced(_per_instant(interventions), widths, keys, "at")
    instant = F.struct("at", "last_type", "first_type")
    per_slice = right.groupBy(*keys, SLICE).agg(F.max(instant).alias("latest"), F.min(instant).alias("earliest"))
    wanted = _slices(instants, widths, keys)
    events = right.select(*keys, SLICE, "at", "last_type", "first_type")
    for value, later in (("latest", False), ("earliest", True)):
        carried = carry_in(per_slice, wanted, keys, value, later).filter(F.col(value).isNotNull())
        events = events.unionByName(carried.select(*keys, SLICE, f"{value}.*"))
    merged = (left.withColumn("is_row", F.lit(1))
              .unionByName(events.withColumn("is_row", F.lit(0)), allowMissingColumns=True)
              .withColumn("instant", F.coalesce("timestamp", "at")))
    event = F.when(F.col("is_row") == 0, instant)
    back = Window.partitionBy(*keys, SLICE).orderBy("instant", "is_row")
    ahead = Window.partitionBy(*keys, SLICE).orderBy(F.col("instant").desc(), "is_row")
    seen = (merged.withColumn("prev", F.last(event, ignorenulls=True).over(back))
            .withColumn("next", F.last(event, ignorenulls=True).over(ahead))
            .filter("is_row = 1"))
    now, limit = F.unix_micros("timestamp"), int(tolerance_hours * 3_600_000_000)
    gap_back = now - F.unix_micros(F.col("prev.at"))
    gap_ahead = F.unix_micros(F.col("next.at")) - now
    near = (F.when((gap_back <= limit) & (gap_ahead.isNull() | (gap_back <= gap_ahead)),
                   F.col("prev.last_type"))
            .when(gap_ahead <= limit, F.col("next.first_type")))
    return seen.withColumns({
        "hours_since_last_intervention": F.coalesce(
            S.hours_between(F.col("timestamp"), F.col("prev.at")), F.lit(C.NO_INTERVENTION_HOURS)),
        "near_type": near,
    }).drop("prev", "next", "is_row", "instant", "at", "last_type", "first_type", SLICE)


def _slices(instants: DataFrame, widths: DataFrame, keys: list[str]) -> DataFrame:
    return sliced(instants.select(*keys, "timestamp"), widths, keys).select(*keys, SLICE).distinct()


def hours_to_next(sensors: DataFrame, interventions: DataFrame, instants: DataFrame | None = None) -> DataFrame:
    """Hours to the next intervention (as-of forward); null when none follows.

    `instants` are as in `attach_interventions`.
    """
    keys = ["machine_id"]
    instants = sensors if instants is None else instants
    widths = common_widths(instants, interventions)
    right = sliced(interventions.select("machine_id", F.col("timestamp").alias("at")).distinct(), widths, keys, "at")
    left = sliced(sensors, widths, keys)
    per_slice = right.groupBy(*keys, SLICE).agg(F.min("at").alias("carried"))
    carried = carry_in(per_slice, _slices(instants, widths, keys), keys, "carried", later=True)
    events = right.unionByName(carried.filter("carried IS NOT NULL").withColumnRenamed("carried", "at"))
    merged = (left.withColumn("is_row", F.lit(1))
              .unionByName(events.withColumn("is_row", F.lit(0)), allowMissingColumns=True)
              .withColumn("instant", F.coalesce("timestamp", "at")))
    ahead = Window.partitionBy(*keys, SLICE).orderBy(F.col("instant").desc(), "is_row")
    return (merged.withColumn("next_at", F.last("at", ignorenulls=True).over(ahead))
            .filter("is_row = 1")
            .withColumn("hours_to_next_intervention", S.hours_between(F.col("next_at"), F.col("timestamp")))
            .drop("is_row", "instant", "at", "next_at", SLICE))
