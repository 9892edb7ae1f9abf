"""Grid cells over standardised points: the unit of every distance join.

Points closer than eps are never searched by pairing rows. Space is cut into
cells whose diagonal is eps, so points of one cell are all within eps. A cell is
one row: its weight and the bounding box of its points. Boxes tell for most cell
pairs that all points are within eps (`near`) or that none are (dropped); only
the rest (`mixed`) is looked at point by point. Copies of a point are one point
with a weight, so the work follows the occupied cells, not the row count.

Which cells are compared at all is found in a balanced tree of boxes over the
cells of each model (`boxtree`): pairs of nodes whose boxes are within eps open
into pairs of their children, down to the cells. Crowded cells are cut by the
same tree, over their points. Joins are by node, so no key holds more rows than
the children of one node times the nodes near it, for one model as for many.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import stage_table
from .boxtree import Tree, grow, level
from .scaling import KEY, POSITION

Z = [f"z_{c}" for c in C.FEATURES]
DIMENSIONS = len(Z)
# A hair below eps / sqrt(d), so rounding cannot push a diagonal above eps.
SIDE_FACTOR = (1.0 - 1e-9) / math.sqrt(DIMENSIONS)
# Box tests use centre and half width, which keeps the generated code small. The
# margin sends rounding cases to the point-by-point test, which is exact.
MARGIN = 1e-12
# Cells of a leaf in the tree of cells: two leaves meet in at most the square of it, a
# fraction of a second. Points of a leaf in the tree of a cell's points.
LEAF_CELLS = 1024
LEAF_POINTS = 512


def unique_points(scaled: DataFrame) -> DataFrame:
    """Distinct points per model with weight and first row."""
    return scaled.groupBy(KEY, *Z).agg(F.count("*").alias("weight"), F.min(POSITION).alias(POSITION))


def _coordinate(z: str, eps: float) -> Column:
    return F.floor(F.col(z) / (eps * SIDE_FACTOR))


def with_cell(points: DataFrame, eps: float) -> DataFrame:
    """Add the cell name."""
    return points.withColumn("cell", F.concat_ws("_", *[_coordinate(z, eps).cast("string") for z in Z]))


def cell_table(points: DataFrame) -> DataFrame:
    return points.groupBy(KEY, "cell").agg(
        F.sum("weight").alias("weight"), F.count("*").alias("n_points"), F.min(POSITION).alias(POSITION), *box_columns())


def box_columns() -> list[Column]:
    """Centre and half width of the box of a group of points."""
    return [c for z in Z for c in (((F.min(z) + F.max(z)) / 2.0).alias(f"mid_{z}"),
                                   ((F.max(z) - F.min(z)) / 2.0).alias(f"half_{z}"))]


BOX = [f"{p}_{z}" for z in Z for p in ("mid", "half")]


def around(boxes: list[str] = BOX) -> list[Column]:
    """The box around a group of boxes."""
    out = []
    for mid, half in zip(boxes[::2], boxes[1::2], strict=True):
        low, high = F.min(F.col(mid) - F.col(half)), F.max(F.col(mid) + F.col(half))
        # A hair wider, so that rounding leaves no member outside.
        out += [((low + high) / 2.0).alias(mid), ((high - low) / 2.0 * (1 + MARGIN) + MARGIN).alias(half)]
    return out


def place(points: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """Points and cells with long ids `pid` and `cell` for all later joins.

    The ids are given right before the tables are written, so no later retry can
    change them.
    """
    named = stage_table(with_cell(points, eps).withColumn("pid", F.monotonically_increasing_id()))
    cells = stage_table(cell_table(named).withColumnRenamed("cell", "cell_name")
                        .withColumn("cell", F.monotonically_increasing_id()))
    ids = cells.select(KEY, F.col("cell_name"), F.col("cell").alias("cell_id"))
    placed = (named.withColumnRenamed("cell", "cell_name")
              .join(ids, [KEY, "cell_name"]).drop("cell_name").withColumnRenamed("cell_id", "cell"))
    return stage_table(placed), cells.drop("cell_name")


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _apart(a: str, b: str, z: str) -> Column:
    return F.abs(F.col(f"{a}.mid_{z}") - F.col(f"{b}.mid_{z}"))


def _positive(x: Column) -> Column:
    return (x + F.abs(x)) / 2.0


def may_touch(a: str, b: str, limit: float) -> Column:
    """Boxes whose squared distance does not exceed `limit`."""
    gaps = [_positive(_apart(a, b, z) - (F.col(f"{a}.half_{z}") + F.col(f"{b}.half_{z}"))) for z in Z]
    return _sum([g * g for g in gaps]) <= limit * (1 + MARGIN)


def all_within(a: str, b: str, limit: float) -> Column:
    """Boxes whose farthest points are within `limit`."""
    spans = [_apart(a, b, z) + (F.col(f"{a}.half_{z}") + F.col(f"{b}.half_{z}")) for z in Z]
    return _sum([x * x for x in spans]) <= limit * (1 - MARGIN)


def _from_point(p: str, b: str, z: str) -> Column:
    return F.abs(F.col(f"{p}.{z}") - F.col(f"{b}.mid_{z}"))


def point_box_gap(p: str, b: str) -> Column:
    gaps = [_positive(_from_point(p, b, z) - F.col(f"{b}.half_{z}")) for z in Z]
    return _sum([g * g for g in gaps]) * (1 - MARGIN)


def point_box_reach(p: str, b: str) -> Column:
    spans = [_from_point(p, b, z) + F.col(f"{b}.half_{z}") for z in Z]
    return _sum([x * x for x in spans]) * (1 + MARGIN)


def point_gap(p: str, q: str) -> Column:
    gaps = [F.col(f"{p}.{z}") - F.col(f"{q}.{z}") for z in Z]
    return _sum([g * g for g in gaps])


def tasks_for(df: DataFrame) -> int:
    """Few bytes but many comparisons: joins of boxes are sized by cores, not by bytes."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def touching_leaves(cells: DataFrame, keys: list[str], depth: int, eps: float) -> DataFrame:
    """Unordered pairs (left <= right) of leaves of the tree of cells whose boxes may touch."""
    pairs = cells.select(*keys).distinct().withColumns({"left": F.lit(""), "right": F.lit("")})
    for k in range(1, depth + 1):
        nodes = level(cells, keys, k, around())
        a, b = nodes.alias("a"), nodes.alias("b")
        same_a = reduce(lambda x, y: x & y, [F.col(f"p.{c}") == F.col(f"a.{c}") for c in keys])
        same_b = reduce(lambda x, y: x & y, [F.col(f"p.{c}") == F.col(f"b.{c}") for c in keys])
        pairs = (pairs.alias("p").join(a, same_a & (F.col("p.left") == F.col("a.parent")))
                 .join(b, same_b & (F.col("p.right") == F.col("b.parent")) & (F.col("a.path") <= F.col("b.path"))
                       & may_touch("a", "b", eps * eps))
                 .select(*[F.col(f"p.{c}") for c in keys], F.col("a.path").alias("left"), F.col("b.path").alias("right")))
    return pairs


def cell_pairs(cells: DataFrame, eps: float) -> DataFrame:
    """Ordered pairs (a, b), a <> b, of cells that may hold points within eps.

    `near` says that all their points are within eps of each other.
    """
    found = met_cells(cells, eps).filter(may_touch("a", "b", eps * eps)).select(
        F.col("a.cell").alias("a"), F.col("b.cell").alias("b"), all_within("a", "b", eps * eps).alias("near"))
    swapped = found.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
                                             )).alias("s"), "near")
    return swapped.select("s.a", "s.b", "near")


def met_cells(cells: DataFrame, eps: float) -> DataFrame:
    """Each pair of cells of touching leaves once, as `a` and `b`."""
    tree = cell_tree(cells)
    pairs = touching_leaves(tree.rows, [KEY], tree.depth, eps)
    return met_by(tree.rows, tree.rows, pairs).filter((F.col("a.leaf") < F.col("a.other")) | (F.col("a.cell") < F.col("b.cell")))


def cell_tree(cells: DataFrame) -> Tree:
    return grow(cells.select(KEY, "cell", "weight", *BOX), [KEY], [f"mid_{z}" for z in Z], LEAF_CELLS)


def met_in_leaf(asking: DataFrame, rows: DataFrame) -> DataFrame:
    """Each cell of `asking`, as `a`, with the other cells of its leaf, as `b`."""
    spread = asking.repartition(tasks_for(rows), KEY, "leaf")
    return spread.alias("a").join(rows.alias("b"), (F.col(f"a.{KEY}") == F.col(f"b.{KEY}")) & (F.col("a.leaf") == F.col("b.leaf"))
                                  & (F.col("a.cell") != F.col("b.cell")))


def met_by(asking: DataFrame, rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Each cell of `asking`, as `a`, with the other cells of the leaves (`right`) that are paired with its own (`left`), as `b`."""
    first = (leaves.alias("p").join(asking.alias("a"), (F.col(f"p.{KEY}") == F.col(f"a.{KEY}")) & (F.col("p.left") == F.col("a.leaf")))
             .select("a.*", F.col("p.right").alias("other")).repartition(tasks_for(rows), KEY, "other"))
    return first.alias("a").join(rows.alias("b"), (F.col(f"a.{KEY}") == F.col(f"b.{KEY}")) & (F.col("a.other") == F.col("b.leaf"))
                                 & (F.col("a.cell") != F.col("b.cell")))


def point_hits(points: DataFrame, pairs: DataFrame, cells: DataFrame, targets: DataFrame,
               eps: float, combine=F.sum) -> DataFrame:
    """Look from single points into the cells paired with their own.

    `cells` and `targets` carry a `value`. For each point of cell a and pair
    (a, b): when the box of b lies within eps as a whole, one row with the value
    of b; when it is out of reach, none. Otherwise the nodes of the tree over the
    points of b are tested the same way, level by level, and only in leaves that
    the limit cuts through are points compared.
    """
    limit = eps * eps
    looking = (points.alias("p").join(pairs.alias("b"), F.col("p.cell") == F.col("b.a"))
               .select(*[F.col(f"p.{c}") for c in ["pid", *Z]], F.col("p.cell").alias("from_cell"), F.col("b.b").alias("cell"),
                       F.lit("").alias("part")))
    out = ["pid", "from_cell", F.col("cell").alias("to_cell"), "value"]
    tree = grow(targets.select("cell", *Z, "value"), ["cell"], Z, LEAF_POINTS)
    boxes = cells.select("cell", *BOX, "value", F.lit("").alias("path"), F.lit("").alias("parent"))
    found = []
    for k in range(tree.depth + 1):
        if k:
            boxes = level(tree.rows, ["cell"], k, [*box_columns(), combine("value").alias("value")])
        kept = looking.alias("p").join(boxes.alias("b"), (F.col("p.cell") == F.col("b.cell")) & (F.col("p.part") == F.col("b.parent"))).select(
            *[F.col(f"p.{c}") for c in looking.columns if c != "part"], F.col("b.path").alias("part"), "b.value",
            point_box_gap("p", "b").alias("gap"), point_box_reach("p", "b").alias("reach")).filter(F.col("gap") <= limit)
        found.append(kept.filter(F.col("reach") <= limit).select(*out))
        looking = kept.filter(F.col("reach") > limit).drop("value", "gap", "reach")
        if tree.depth:
            looking = stage_table(looking)
    found.append(looking.alias("p").join(
        tree.rows.alias("b"), (F.col("p.cell") == F.col("b.cell")) & (F.col("p.part") == F.col("b.leaf")))
        .filter(point_gap("p", "b") <= limit).select("p.*", "b.value").select(*out))
    return reduce(DataFrame.unionByName, found)
