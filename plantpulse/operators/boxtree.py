"""A balanced tree of boxes over rows with coordinates, as tables.

`grow` cuts every group of rows (a model, a cell) into about equal parts of its widest
coordinates, again and again, until no leaf holds more than a stated number of rows. All groups are cut
at once: a round is one aggregate per node and one join of the cuts back to the rows of the
nodes that are still too full, so the number of rounds follows the logarithm of the largest
group and a hot group is spread over all tasks. Nodes of at most TASK_ROWS rows are cut to the end by one
task each, by the same rule: as rounds, their many small nodes cost an aggregate row or more a row.
A node is named by its path, PART characters
a round; a leaf that was finished early stands for itself in later rounds. So level k of the
tree is the set of path prefixes of k parts, and parents are found by cutting a path.

    grow(rows, keys, coordinates, capacity)   rows with `leaf`, and the depth
    level(rows, keys, k, aggregates)          the nodes of level k, with their parent

Every join below goes from level to level by (keys, path): no key meets more than the
children of one node, so work follows the boxes that are near, not the size of a group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stage_table

#: Characters of one round in a path.
PART = 3
#: Coordinates cut in one round, at most; each into up to four intervals.
CUT_COORDINATES = 3
#: Cuts in standard deviations from the mean: the quartiles of a normal distribution. The
#: middle one surely parts the lowest row from the highest, so every round cuts.
CUTS = (-0.6745, 0.0, 0.6745)
#: Rows of a node that one task cuts down to its leaves: a few MB.
TASK_ROWS = 32_768


@dataclass(frozen=True)
class Tree:
    """Rows with the name of their `leaf`, and the number of levels below the root."""

    rows: DataFrame
    depth: int


def _cuts(keys: list[str], coordinates: list[str], capacity: int, rows: DataFrame) -> DataFrame:
    """Nodes with more rows than `capacity`, with the coordinates to cut (`which`) and where (`at`); none for equal rows."""
    facts = [a for i, c in enumerate(coordinates) for a in (
        F.min(c).alias(f"low_{i}"), F.max(c).alias(f"high_{i}"), F.avg(c).alias(f"mean_{i}"), F.stddev_pop(c).alias(f"spread_{i}"))]
    full = rows.groupBy(*keys, "leaf").agg(F.count("*").alias("n_rows"), *facts).filter(F.col("n_rows") > capacity)

    def places(i: int) -> Column:
        # A mean that rounding has put on the highest row would part nothing.
        mean = F.when(F.col(f"mean_{i}") < F.col(f"high_{i}"), F.greatest(f"mean_{i}", f"low_{i}")).otherwise(F.col(f"low_{i}"))
        return F.array(*[mean + cut * F.col(f"spread_{i}") if cut else mean for cut in CUTS])

    spread = F.sort_array(F.array(*[
        F.struct(F.when(F.col(f"low_{i}") < F.col(f"high_{i}"), F.col(f"spread_{i}")).otherwise(-1.0).alias("width"),
                 F.lit(-i).alias("which"), places(i).alias("at")) for i in range(len(coordinates))]), asc=False)
    # A coordinate parts the rows about four-fold.
    wanted = F.least(F.lit(CUT_COORDINATES), F.ceil(F.log(4.0, F.col("n_rows") / capacity)).cast("int"))
    chosen = F.filter(F.slice(spread, 1, F.greatest(F.lit(1), wanted)), lambda s: s["width"] >= 0)
    return full.select(*keys, "leaf", chosen.alias("cuts")).filter(F.size("cuts") > 0)


def grow(rows: DataFrame, keys: list[str], coordinates: list[str], capacity: int) -> Tree:
    """Add `leaf`. Rows of equal coordinates stay together, whatever their number.

    Nodes with a missing or unbounded coordinate are cut in rounds, whatever their size.
    """
    active, done, depth = rows.withColumn("leaf", F.lit("")), [], 0
    values = F.array(*[F.col(c) for c in coordinates])
    # Most groups are small: their rows are counted, no more.
    if _sizes(active, keys, coordinates, capacity).isEmpty():
        return Tree(active, 0)
    while True:
        full = _sizes(active, keys, coordinates, capacity).filter((F.col("n_rows") > TASK_ROWS) | ~F.col("plain"))
        cuts = None if full.isEmpty() else stage_table(_cuts(keys, coordinates, capacity, active.join(
            full.select(*keys, "leaf"), [*keys, "leaf"], "left_semi")))
        if cuts is None or cuts.isEmpty():
            done.append(active)
            break
        depth += 1
        child = F.aggregate("cuts", F.lit(0), lambda name, s: name * (len(CUTS) + 1) + F.aggregate(
            s["at"], F.lit(0), lambda n, at: n + (F.get(values, -s["which"]) > at).cast("int")))
        split = stage_table(active.join(cuts, [*keys, "leaf"], "left").withColumn(
            "open", F.col("cuts").isNotNull()).withColumn("leaf", F.when(
                F.col("open"), F.concat("leaf", F.lpad(child.cast("string"), PART, "0"))).otherwise(F.col("leaf"))).drop("cuts"))
        done.append(split.filter("NOT open").drop("open"))
        active = split.filter("open").drop("open")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return _finished(out, keys, coordinates, capacity, depth)


def _sizes(rows: DataFrame, keys: list[str], coordinates: list[str], capacity: int) -> DataFrame:
    """Nodes with more rows than `capacity`; `plain` ones have finite coordinates only."""
    total = reduce(lambda a, b: a + b, [F.abs(F.col(c)) for c in coordinates])
    return rows.groupBy(*keys, "leaf").agg(F.count("*").alias("n_rows"), F.bool_and(
        F.coalesce(total < float("inf"), F.lit(False))).alias("plain")).filter(F.col("n_rows") > capacity)


def _finished(rows: DataFrame, keys: list[str], coordinates: list[str], capacity: int, depth: int) -> Tree:
    """Cut nodes of at most TASK_ROWS rows down to their leaves, each in one task."""
    full = stage_table(_sizes(rows, keys, coordinates, capacity).filter(
        (F.col("n_rows") <= TASK_ROWS) & F.col("plain")).select(*keys, "leaf"))
    if full.isEmpty():
        return Tree(rows, depth)
    ship_package(rows.sparkSession)
    grown = rows.join(full, [*keys, "leaf"], "left_semi").select(*rows.columns).groupBy(*keys, "leaf").applyInArrow(
        _subtree(coordinates, capacity), rows.schema)
    out = stage_table(rows.join(full, [*keys, "leaf"], "left_anti").select(*rows.columns).unionByName(grown))
    return Tree(out, out.agg(F.max(F.length("leaf"))).first()[0] // PART)


def _subtree(coordinates: list[str], capacity: int) -> Callable[[pa.Table], pa.Table]:
    def cut(table: pa.Table) -> pa.Table:
        z = np.column_stack([table.column(c).to_numpy() for c in coordinates])
        below = paths(z, capacity)
        at, root = table.schema.get_field_index("leaf"), table.column("leaf")[0].as_py()
        return table.set_column(at, table.schema.field(at), pa.array([root + path for path in below], table.schema.field(at).type))
    return cut


def paths(z: np.ndarray, capacity: int) -> np.ndarray:
    """Path of the leaf of each row below the node that holds all rows `z`."""
    out = np.empty(len(z), object)
    waiting = [(np.arange(len(z)), "")]
    while waiting:
        rows, path = waiting.pop()
        name = _child(z[rows], capacity) if len(rows) > capacity else None
        if name is None:
            out[rows] = path
            continue
        order = np.argsort(name, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(name[order])) + 1):
            waiting.append((rows[part], path + str(name[part[0]]).zfill(PART)))
    return out


def _child(x: np.ndarray, capacity: int) -> np.ndarray | None:
    """Number of the child of each row of a full node; none for equal rows. The rule of `_cuts`."""
    low, high, mean, spread = x.min(0), x.max(0), x.mean(0), x.std(0)
    width = np.where(low < high, spread, -1.0)
    wanted = max(1, min(CUT_COORDINATES, int(np.ceil(np.log(len(x) / max(capacity, 1)) / np.log(len(CUTS) + 1)))))
    chosen = [i for i in np.argsort(-width, kind="stable")[:wanted] if low[i] < high[i]]
    if not chosen:
        return None
    # A mean that rounding has put on the highest row would part nothing.
    mean = np.where(mean < high, np.maximum(mean, low), low)
    name = np.zeros(len(x), np.int64)
    for i in chosen:
        at = [mean[i] + cut * spread[i] if cut else mean[i] for cut in CUTS]
        name = name * (len(CUTS) + 1) + (x[:, i, None] > at).sum(1)
    return name


def node(k: int, path: str = "leaf") -> Column:
    """The level-k node of a path."""
    return F.substring(path, 1, PART * k)


def level(rows: DataFrame, keys: list[str], k: int, aggregates: list[Column]) -> DataFrame:
    """One row per node of level k: its `path`, the `parent` path, and the aggregates."""
    return rows.groupBy(*keys, node(k).alias("path")).agg(*aggregates).withColumn("parent", node(k - 1, "path"))
