"""Gold features of silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..functions.slices import SLICE, home_rows, row_halo, slice_widths

ORDER = ["timestamp", "target_cycle"]


def rolling_features(silver: DataFrame, rows: int = C.ROLLING_ROWS) -> DataFrame:
    """Rolling mean, rolling sample std and delta per machine in time order.

    A machine's cycles share one window and need not touch in time, so the rows
    before a slice are found by row count. All nine windows share one shuffle.
    """
    w = Window.partitionBy("machine_id", SLICE).orderBy(*ORDER)
    span = w.rowsBetween(1 - rows, 0)
    columns = {}
    for c in C.ROLLED:
        columns[f"{c}_roll_mean_{rows}"] = F.avg(c).over(span)
        columns[f"{c}_roll_std_{rows}"] = F.coalesce(F.stddev_samp(c).over(span), F.lit(0.0))
        columns[f"{c}_delta"] = F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0))
    sliced = row_halo(silver, ["machine_id"], ORDER, rows - 1, slice_widths(silver, ["machine_id"]))
    return home_rows(sliced.withColumns(columns)).drop(SLICE)


def derived_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "load_proxy": S.load_proxy(F.col("rpm"), F.col("pressure"), F.col("voltage")),
        "energy_per_cycle": S.energy_per_cycle(F.col("consumption_kWh"), F.col("cycle_duration")),
        "failure_type": S.failure_label(F.col("failure")),
    })
