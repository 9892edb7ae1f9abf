"""Silver to gold: features, labels and intervention context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.features import derived_features, rolling_features
from ..operators.interventions import attach_interventions, common_widths
from ..session import stage_table


def gold(silver: DataFrame, interventions: DataFrame | None = None) -> DataFrame:
    """Silver grain plus the engineered columns.

    With a breakdown log, rows within an hour of an entry take its type.
    """
    df = derived_features(rolling_features(silver))
    # Widths and slices are chosen on the stored rows, not on the features computed from them.
    if interventions is None:
        return df.withColumn("hours_since_last_intervention", F.lit(C.NO_INTERVENTION_HOURS))
    near = attach_interventions(df, interventions, widths=common_widths(silver, interventions), instants=silver)
    return near.withColumn("failure_type", F.coalesce("near_type", "failure_type")).drop("near_type")


def latest_per_machine(df: DataFrame, ts: str = "timestamp", tie: str = "target_cycle",
                       instants: DataFrame | None = None) -> DataFrame:
    """Newest row per machine (W01). A hash aggregate finds the newest instant; only
    the rows at it, few per machine, are compared as a whole. `instants` are rows of the same
    machines and times that cost less to read than `df`, so that `df` is computed once. The
    instants are stored, one per machine: a small table joins without a shuffle of whole rows."""
    last = (df if instants is None else instants.select("machine_id", ts)).groupBy("machine_id").agg(F.max(ts).alias("newest_ts"))
    last = stage_table(last)
    at_last = df.join(last, (df["machine_id"].eqNullSafe(last["machine_id"])) & df[ts].eqNullSafe(last["newest_ts"]),
                      "left_semi")
    newest = F.max_by(F.struct(*df.columns), F.struct(F.col(tie))).alias("row")
    return at_last.groupBy("machine_id").agg(newest).select("row.*")


def snapshot(gold_rows: DataFrame, instants: DataFrame | None = None) -> DataFrame:
    """Serving snapshot: fixed columns, absent ones as null."""
    last = latest_per_machine(gold_rows, instants=instants)
    return last.select(*[
        F.col(c) if c in last.columns else F.lit(None).cast("double").alias(c) for c in C.SNAPSHOT_TABLE])
