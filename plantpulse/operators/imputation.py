"""Imputation of missing sensor values.

A missing value becomes the median of the usable values among rows i-2, i-1,
i+1, i+2. Values imputed earlier count as neighbours, so the rule runs forward
through a gap. Two original values in a row end that dependence: missing cells
at most two rows apart form an island, and islands are independent.

Islands are spread over tasks, and each is read in order as a stream: from cell to
cell only the last two values are kept, so a sensor that never reports costs no row
longer than one cell and no array per island.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.slices import SLICE, carry_in, grid_halo, home_rows, hour_index
from ..session import ship_package

KNOWN = ["p1", "p2", "n1", "n2"]
MARKS = ["null1", "null2", "own"]


def _medians(near: np.ndarray) -> np.ndarray:
    """Median of each row's numbers; NaN stands for none."""
    ranked = np.sort(near, axis=1)  # NaN last
    n = (~np.isnan(near)).sum(axis=1)
    row = np.arange(len(near))
    return (ranked[row, np.maximum(n - 1, 0) // 2] + ranked[row, np.minimum(n // 2, 3)]) / 2


def _median(values: list[float]) -> float:
    near = sorted(v for v in values if v == v)
    n = len(near)
    return (near[(n - 1) // 2] + near[n // 2]) / 2 if n else np.nan


def fold(known: np.ndarray, null1: np.ndarray, null2: np.ndarray, own: np.ndarray,
         state: tuple[float, float]) -> tuple[np.ndarray, tuple[float, float]]:
    """Values of cells in order, and the state behind them.

    `known` holds the original neighbours (columns as KNOWN, NaN for none). The state is
    the usable values of the last two missing cells. Only cells next to a missing one read
    it. Inside a gap, where nothing else is near, a cell is the mean of the state, and once
    both values agree, or both are none, so do all cells up to the gap's far side: those are
    filled at once.
    """
    values = _medians(known)
    chained = np.flatnonzero(null1 | null2)
    # Cells that have nothing near but the state, and the first later cell that is not such.
    bare = null1 & null2 & own & np.isnan(known).all(axis=1)
    far = np.flatnonzero(~bare)
    beyond = np.append(far, len(bare))[np.searchsorted(far, np.arange(len(bare)))] if len(bare) else far
    # Two places before the first cell, for the state.
    usable = np.concatenate([[state[1], state[0]], np.where(own, values, np.nan)])
    filled = 0
    for i in chained.tolist():
        if i < filled:
            continue
        x1, x2 = usable[i + 1], usable[i]
        if bare[i] and (x1 == x2 or (x1 != x1 and x2 != x2)):
            filled = int(beyond[i])
            values[i:filled] = usable[i + 2:filled + 2] = x1
            continue
        p1, p2, n1, n2 = known[i]
        values[i] = _median([x1 if null1[i] else p1, (x2 if null1[i] else x1) if null2[i] else p2, n1, n2])
        usable[i + 2] = values[i] if own[i] else np.nan
    return values, (float(usable[-1]), float(usable[-2]))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells in order, each with its value. The first cell of an island reads no state."""
    state = (np.nan, np.nan)
    for batch in batches:
        known = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in KNOWN], axis=1)
        marks = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in MARKS]
        values, state = fold(known, *marks, state)
        kept = [*C.SERIES, "sensor", "timestamp"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(values, pa.float64(), from_pandas=True)], [*kept, "value"])


def _missing_cells(rows: DataFrame) -> DataFrame:
    """One narrow row per missing cell with its original neighbours."""
    w = Window.partitionBy(*C.SERIES, SLICE).orderBy("timestamp")
    halo = grid_halo(rows.select(*C.SERIES, "timestamp", "is_outlier", *C.SENSORS), 2, 2)
    entries = {}
    for c in C.SENSORS:
        usable = F.when(F.col("is_outlier") == 0, F.col(c))
        gone = F.col(c).isNull()
        entries[f"cell_{c}"] = F.when(gone, F.struct(
            F.lit(c).alias("sensor"),
            F.lag(usable, 1).over(w).alias("p1"), F.lag(usable, 2).over(w).alias("p2"),
            F.coalesce(F.lag(gone, 1).over(w), F.lit(False)).alias("null1"),
            F.coalesce(F.lag(gone, 2).over(w), F.lit(False)).alias("null2"),
            F.lead(usable, 1).over(w).alias("n1"), F.lead(usable, 2).over(w).alias("n2"),
            F.coalesce(F.col("is_outlier") == 0, F.lit(False)).alias("own")))
    seen = home_rows(halo.withColumns(entries))
    cells = F.array_compact(F.array(*[F.col(n) for n in entries]))
    return seen.select(*C.SERIES, SLICE, "timestamp", hour_index(F.col("timestamp")).alias("pos"),
                       F.explode(cells).alias("c")).select(*C.SERIES, SLICE, "timestamp", "pos", "c.*")


def _with_island(cells: DataFrame) -> DataFrame:
    """Island = position of its first cell; islands may cross slices."""
    keys = [*C.SERIES, "sensor"]
    start = F.when(~F.col("null1") & ~F.col("null2"), F.col("pos"))
    marked = cells.withColumn("start", start)
    # A cell at most two rows after a slice edge may continue an older island.
    per_slice = marked.groupBy(*keys, SLICE).agg(F.max("start").alias("carried"))
    carried = carry_in(per_slice, per_slice, keys, "carried")
    local = F.max("start").over(Window.partitionBy(*keys, SLICE).orderBy("pos"))
    return (marked.withColumn("local", local)
            .join(carried, [*keys, SLICE], "left")
            .withColumn("island", F.coalesce("local", "carried")).drop("local", "carried", "start"))


def impute(rows: DataFrame) -> DataFrame:
    """Fill missing sensor values; adds `nan_filled` and `nan_open` name arrays.

    Islands are dealt by their first cell, so a machine with many gaps is many tasks.
    """
    ship_package(rows.sparkSession)
    cells = _with_island(_missing_cells(rows))
    order = [*C.SERIES, "sensor", "island"]
    kept = cells.select(*C.SERIES, "sensor", "timestamp").schema.fields
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", value double"
    filled = (cells.repartition(*order).sortWithinPartitions(*order, "pos")
              .select(*C.SERIES, "sensor", "timestamp", *KNOWN, *MARKS).mapInArrow(_stream, schema))
    per_row = filled.groupBy(*C.SERIES, "timestamp").agg(*[
        F.max(F.when(F.col("sensor") == c, F.col("value"))).alias(f"fill_{c}") for c in C.SENSORS])
    joined = rows.join(per_row, [*C.SERIES, "timestamp"], "left")
    gone = {c: F.col(c).isNull() for c in C.SENSORS}
    got = {c: F.col(f"fill_{c}").isNotNull() for c in C.SENSORS}
    return joined.withColumns({
        "nan_filled": F.array_compact(F.array(*[F.when(gone[c] & got[c], F.lit(c)) for c in C.SENSORS])),
        "nan_open": F.array_compact(F.array(*[F.when(gone[c] & ~got[c], F.lit(c)) for c in C.SENSORS])),
        "nan_flags": F.array_compact(F.array(*[
            F.when(gone[c] & got[c], F.lit("NAN_CORRECTED"))
            .when(gone[c], F.lit("UNCERTAIN_NAN_CORRECTION")) for c in C.SENSORS])),
        "nan_correction_details": F.concat_ws("; ", *[
            F.when(gone[c] & got[c], F.format_string(f"{c} filled with %.4f", F.col(f"fill_{c}")))
            .when(gone[c], F.lit(f"{c} stays empty: no usable neighbour"))
            for c in C.SENSORS]),
    }).withColumns({c: F.coalesce(F.col(c), F.col(f"fill_{c}")) for c in C.SENSORS}
                   ).drop(*[f"fill_{c}" for c in C.SENSORS])
