"""Clustering and scoring of a model whose points fit in one leaf, in one task per model.

A leaf holds a stated number of distinct points at most, so its distances are few and are
taken in blocks; no pair and no cell is stored. Labels are those of the cell method: points
in order of their first row number the clusters, and a point without core takes the
smallest cluster among the core points within eps. Readings stream past the points of their
model, so they may be any number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import ship_package
from .scaling import KEY, POSITION

#: Rows of a block of distances.
BLOCK = 512


def _within(z: np.ndarray, eps: float) -> np.ndarray:
    """Which points are within eps of each other; squares are added in the order of the coordinates."""
    out = np.empty((len(z), len(z)), bool)
    for begin in range(0, len(z), BLOCK):
        gap = 0.0
        for a, b in zip(z[begin:begin + BLOCK].T, z.T, strict=True):
            step = a[:, None] - b[None, :]
            gap = gap + step * step
        out[begin:begin + BLOCK] = gap <= eps * eps
    return out


def fit(z: np.ndarray, weight: np.ndarray, eps: float, min_samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Core flags and cluster labels of points in order of their first row."""
    within = _within(z, eps)
    core = within @ weight >= min_samples
    labels = np.full(len(z), -1, np.int32)
    waiting, found = core.copy(), 0
    for start in np.flatnonzero(core):
        if not waiting[start]:
            continue
        reached = np.array([start])
        while len(reached):
            labels[reached], waiting[reached] = found, False
            reached = np.flatnonzero(within[reached].any(0) & waiting)
        found += 1
    reach = np.where(within[~core][:, core], labels[core], found).min(1, initial=found)
    labels[~core] = np.where(reach < found, reach, -1)
    return core, labels


def fit_leaves(points: DataFrame, coordinates: list[str], eps: float, min_samples: int) -> DataFrame:
    """Add `is_core` and `cluster_label` to the points of models of one leaf each."""
    ship_package(points.sparkSession)
    schema = T.StructType([*points.schema.fields, T.StructField("is_core", T.BooleanType()),
                           T.StructField("cluster_label", T.IntegerType())])
    return points.groupBy(KEY).applyInArrow(_leaf(coordinates, eps, min_samples), schema)


def _leaf(coordinates: list[str], eps: float, min_samples: int) -> Callable[[pa.Table], pa.Table]:
    def labelled(table: pa.Table) -> pa.Table:
        rows = table.sort_by([(c, "ascending") for c in (POSITION, *coordinates)])
        z = np.column_stack([rows.column(c).to_numpy() for c in coordinates])
        core, labels = fit(z, rows.column("weight").to_numpy(), eps, min_samples)
        return rows.append_column("is_core", pa.array(core)).append_column("cluster_label", pa.array(labels))
    return labelled


def nearest_of_leaf(rows: DataFrame, coordinates: list[str], eps: float) -> DataFrame:
    """Readings (`asks`) with the nearest point of their model within eps: `near_gap`, squared, and `near_label`.

    `rows` are parted by model and in order: the points of a model by position, then its readings.
    At equal distance the first point decides.
    """
    ship_package(rows.sparkSession)
    fields = [rows.schema[c] for c in (KEY, *coordinates)]
    schema = T.StructType([*fields, T.StructField("near_gap", T.DoubleType()), rows.schema["near_label"]])
    return rows.select(KEY, *coordinates, "near_label", "asks").mapInArrow(_passing(coordinates, eps), schema)


def closest(asked: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest point of each reading, and its squared distance."""
    place, least = np.empty(len(asked), np.int64), np.empty(len(asked))
    for begin in range(0, len(asked), BLOCK):
        gap = 0.0
        for a, b in zip(asked[begin:begin + BLOCK].T, z.T, strict=True):
            step = a[:, None] - b[None, :]
            gap = gap + step * step
        place[begin:begin + BLOCK] = at = gap.argmin(1)
        least[begin:begin + BLOCK] = gap[np.arange(len(at)), at]
    return place, least


def _passing(coordinates: list[str], eps: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, points, labels = None, [], []
        for batch in batches:
            keys = batch.column(KEY)
            named = keys.dictionary_encode()
            code = named.indices.to_numpy(zero_copy_only=False)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            z = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in coordinates])
            near = batch.column("near_label").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((code[1:] != code[:-1]) | (asks[1:] != asks[:-1])) + 1
            kept, gaps, told = [], [], []
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(code)], strict=True):
                key = named.dictionary[int(code[begin])].as_py() if end > begin else None
                if key != model:
                    model, points, labels = key, [], []
                if end > begin and not asks[begin]:
                    points, labels = [*points, z[begin:end]], [*labels, near[begin:end]]
                elif end > begin and points:
                    points, labels = [np.concatenate(points)], [np.concatenate(labels)]
                    place, least = closest(z[begin:end], points[0])
                    within = np.flatnonzero(least <= eps * eps)
                    kept.append(begin + within)
                    gaps.append(least[within])
                    told.append(labels[0][place[within]])
            if kept:
                out = batch.select([KEY, *coordinates]).take(pa.array(np.concatenate(kept)))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(np.concatenate(gaps)), pa.array(np.concatenate(told).astype(np.int64)).cast(
                        batch.column("near_label").type)],
                    [KEY, *coordinates, "near_gap", "near_label"])
    return answered
