"""Density clustering per model, exact, on grid cells.

Weights count copies, so the core test counts rows. Most models have few points: those of
at most LEAF_MODEL distinct ones are a leaf each, settled by one task without a stored pair
(`leaf_fit`). The points of all others fall into cells. Core points of one cell are
within eps of each other and share a cluster, so clusters are components of a
graph of cells, never of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.running import running_sum
from ..session import stage_table
from .cells import (Z, all_within, box_columns, cell_tree, may_touch, met_by, met_in_leaf, place, point_hits, touching_leaves,
                    unique_points)
from .components import connected_components
from .leaf_fit import fit_leaves
from .scaling import KEY, POSITION

# Distinct points of a model that is one leaf: some 16 MB of distances told at a time.
LEAF_MODEL = 4096
# Cells of a leaf that link it with the leaves around it before all others are looked at.
LINK_CELLS = 32


def core_flags(points: DataFrame, cells: DataFrame, tree: DataFrame, leaves: DataFrame, eps: float,
               min_samples: int) -> tuple[DataFrame, DataFrame]:
    """Add `is_core`: rows within eps, itself included, are >= min_samples; and the pairs (a, b) of cells a that
    their own leaf leaves open, `near` or not.

    Cells settle most points: the own cell and the near cells count as a whole, and near cells are
    many in the own leaf already. Only cells still short of `min_samples` meet the cells of other
    leaves, and only points of cells still short then look into mixed cells.
    """
    limit = eps * eps
    sparse = tree.filter(F.col("weight") < min_samples)
    close = (met_in_leaf(sparse, tree).filter(all_within("a", "b", limit))
             .groupBy(F.col("a.cell").alias("cell")).agg(F.sum("b.weight").alias("close_weight")))
    short = stage_table(sparse.join(close, "cell", "left").filter(
        F.col("weight") + F.coalesce("close_weight", F.lit(0)) < min_samples).select(*tree.columns))
    met = stage_table(met_by(short, tree, leaves).filter(may_touch("a", "b", limit)).select(
        F.col("a.cell").alias("a"), F.col("b.cell").alias("b"), all_within("a", "b", limit).alias("near"), "b.weight"))
    pairs = met.drop("weight")
    near = met.filter("near").groupBy(F.col("a").alias("cell")).agg(F.sum("weight").alias("near_weight"))
    undecided = stage_table(short.join(near, "cell", "left").select(
        "cell", (F.col("weight") + F.coalesce("near_weight", F.lit(0))).alias("sure")).filter(F.col("sure") < min_samples))
    # Points that their cells settle are not joined with what others saw.
    settled = points.join(undecided, "cell", "left_anti").withColumn("is_core", F.lit(True))
    looking = stage_table(points.join(undecided, "cell"))
    hits = point_hits(looking, pairs.filter("NOT near"), cells.withColumn("value", F.col("weight")),
                      points.withColumn("value", F.col("weight")), eps)
    extra = hits.groupBy("pid").agg(F.sum("value").alias("extra"))
    looked = looking.join(extra, "pid", "left").withColumn(
        "is_core", F.col("sure") + F.coalesce("extra", F.lit(0)) >= min_samples)
    return settled.unionByName(looked.select(*settled.columns)), pairs


def _core_cells(core: DataFrame) -> DataFrame:
    return core.groupBy("cell").agg(
        F.first(KEY).alias(KEY), F.min(POSITION).alias("first_row"), F.count("*").alias("n_points"),
        *box_columns())


def _named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Add the classes of both cells; drops pairs with a cell without core."""
    left = names.select(F.col("cell").alias("a"), F.col("component").alias("class_a"))
    right = names.select(F.col("cell").alias("b"), F.col("component").alias("class_b"))
    return pairs.join(left, "a").join(right, "b").filter("class_a <> class_b")


def _merged(names: DataFrame, links: DataFrame) -> DataFrame:
    """Cells with their class (`component`), once the classes of linked cells are one."""
    found = connected_components(names.select(F.col("component").alias("node")).distinct(),
                                 _named(links, names).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    return stage_table(names.withColumnRenamed("component", "node").join(found, "node").select("cell", "component"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a.cell").alias("a"), F.col("b.cell").alias("b"))


def _apart(tree: DataFrame, names: DataFrame, leaves: DataFrame, eps: float) -> DataFrame:
    """All pairs of core cells of different classes that may hold points within eps, each once, `near` or not.

    Of such a pair one cell at least lies outside the largest class of its model, so only the cells outside ask.
    """
    named = tree.join(names, "cell")
    largest = named.groupBy(KEY, "component").agg(F.count("*").alias("n")).groupBy(KEY).agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"))
    named = stage_table(named.join(stage_table(largest), KEY).withColumn("outside", F.col("component") != F.col("largest")).drop("largest"))
    met = met_by(named.filter("outside"), named, leaves).filter(
        (F.col("a.component") != F.col("b.component")) & (~F.col("b.outside") | (F.col("a.cell") < F.col("b.cell"))))
    return stage_table(met.filter(may_touch("a", "b", eps * eps)).select(
        F.col("a.cell").alias("a"), F.col("b.cell").alias("b"), all_within("a", "b", eps * eps).alias("near")))


def core_clusters(core: DataFrame, tree: DataFrame, leaves: DataFrame, eps: float) -> DataFrame:
    """Core cells with their cluster number, in order of the first core row.

    Near cells of one leaf are linked first, then a few cells of each leaf with a few of those that touch it.
    This joins most cells at little cost; all that is left apart is then compared.
    """
    boxes = stage_table(_core_cells(core))
    inside = stage_table(tree.join(boxes.select("cell"), "cell", "left_semi"))
    near = all_within("a", "b", eps * eps)
    names = _merged(boxes.select("cell", F.col("cell").alias("component")),
                    _ends(met_in_leaf(inside, inside).filter((F.col("a.cell") < F.col("b.cell")) & near)))
    nth = F.row_number().over(Window.partitionBy(KEY, "leaf").orderBy("cell"))
    few = inside.withColumn("nth", nth).filter(F.col("nth") <= LINK_CELLS).drop("nth")
    names = _merged(names, _ends(met_by(few, few, leaves.filter("left < right")).filter(near)))
    apart = _apart(inside, names, leaves, eps)
    names = _merged(names, apart.filter("near").select("a", "b"))
    # Mixed pairs matter only between classes the near pairs left apart.
    mixed = _named(apart.filter("NOT near"), names).select("a", "b")
    one = F.lit(1).alias("value")
    hits = point_hits(core, mixed, boxes.select("*", one), core.select("*", one), eps, F.max)
    names = _merged(names, hits.select(F.col("from_cell").alias("a"), F.col("to_cell").alias("b")).distinct())
    clusters = names.join(boxes, "cell")
    firsts = clusters.groupBy(KEY, "component").agg(F.min("first_row").alias("first_row"))
    # A model may have any number of clusters.
    numbered = running_sum(firsts, [KEY], ["first_row"], F.lit(1), "earlier").select(
        "component", F.col("earlier").cast("int").alias("cluster"))
    return clusters.join(numbered, "component").drop("component")


def border_labels(points: DataFrame, clusters: DataFrame, pairs: DataFrame, eps: float) -> DataFrame:
    """Smallest cluster among the core points within eps of each non-core point."""
    named = clusters.select("cell", "cluster")
    border = points.filter("NOT is_core")
    # What the own cell and the near cells tell is the same for all points of a cell.
    near = pairs.filter("near").join(named.withColumnRenamed("cell", "b"), "b").select(F.col("a").alias("cell"), "cluster")
    told = near.unionByName(named).groupBy("cell").agg(F.min("cluster").alias("cluster"))
    sure = border.join(told, "cell").select("pid", "cluster")
    targets = points.filter("is_core").join(
        clusters.select("cell", F.col("cluster").alias("value")), "cell")
    # Only cells that can lower what is told already are looked into.
    lower = (pairs.filter("NOT near").join(named.select(F.col("cell").alias("b"), F.col("cluster").alias("there")), "b")
             .join(told.select(F.col("cell").alias("a"), F.col("cluster").alias("known")), "a", "left")
             .filter("known IS NULL OR there < known").select("a", "b"))
    mixed = point_hits(border, lower, clusters.withColumn("value", F.col("cluster")), targets,
                       eps, F.max).select("pid", F.col("value").alias("cluster"))
    return sure.unionByName(mixed).groupBy("pid").agg(
        F.min("cluster").alias("border_cluster"))


def _leaves_and_rest(scaled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct points of models that are one leaf, and of the others; both in one stored table.

    Points with a missing or unbounded coordinate have no distances; their models go with the others.
    """
    points = stage_table(unique_points(scaled))
    total = reduce(lambda a, b: a + b, [F.abs(z) for z in Z])
    # There are at most points / LEAF_MODEL models of more points, beside those with odd ones.
    large = points.groupBy(KEY).agg(F.count("*").alias("n_points"), F.bool_and(
        F.coalesce(total < float("inf"), F.lit(False))).alias("plain")).filter(
            (F.col("n_points") > LEAF_MODEL) | ~F.col("plain")).select(KEY)
    large = stage_table(large)
    return points.join(large, KEY, "left_anti"), points.join(large, KEY, "left_semi")


@dataclass(frozen=True)
class _Flagged:
    """Distinct points with `is_core`, the pairs of cells that their own leaf leaves open, and the tree of cells."""

    points: DataFrame
    pairs: DataFrame
    tree: DataFrame
    leaves: DataFrame


def _flagged(points: DataFrame, eps: float, min_samples: int) -> _Flagged:
    points, cells = place(points, eps)
    tree = cell_tree(cells)
    once = touching_leaves(tree.rows, [KEY], tree.depth, eps)
    leaves = stage_table(once.unionByName(once.filter("left < right").select(
        KEY, F.col("right").alias("left"), F.col("left").alias("right"))))
    flagged, pairs = core_flags(points, cells, tree.rows, leaves, eps, min_samples)
    return _Flagged(stage_table(flagged), pairs, tree.rows, leaves)


def core_points(scaled: DataFrame, eps: float = C.EPS, min_samples: int = C.MIN_SAMPLES) -> DataFrame:
    """Distinct points per model with `is_core`."""
    leaves, rest = _leaves_and_rest(scaled)
    flagged = fit_leaves(leaves, Z, eps, min_samples).select(KEY, *Z, "is_core")
    if rest.isEmpty():
        return flagged
    return flagged.unionByName(_flagged(rest, eps, min_samples).points.select(*flagged.columns))


def cluster_points(scaled: DataFrame, eps: float = C.EPS, min_samples: int = C.MIN_SAMPLES) -> DataFrame:
    """Distinct points per model with weight, `is_core` and `cluster_label`."""
    leaves, rest = _leaves_and_rest(scaled)
    fitted = fit_leaves(leaves, Z, eps, min_samples)
    if rest.isEmpty():
        return fitted
    return fitted.unionByName(_cluster_cells(rest, eps, min_samples))


def _cluster_cells(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Add `is_core` and `cluster_label` to the points of models of any size."""
    found = _flagged(points, eps, min_samples)
    flagged = found.points
    clusters = stage_table(core_clusters(flagged.filter("is_core"), found.tree, found.leaves, eps))
    border = border_labels(flagged, clusters, found.pairs, eps)
    # A point has its label from its cell or from the border, so it is exchanged for one of them only.
    core = flagged.filter("is_core").join(clusters.select("cell", F.col("cluster").alias("cluster_label")), "cell", "left")
    other = flagged.filter("NOT is_core").join(border, "pid", "left").withColumn(
        "cluster_label", F.coalesce("border_cluster", F.lit(C.NOISE)))
    return core.drop("cell", "pid").unionByName(other.drop("border_cluster", "cell", "pid"))


def label_rows(scaled: DataFrame, points: DataFrame) -> DataFrame:
    """Labels of the single rows; copies share the label of their point."""
    return scaled.join(points.select(KEY, *Z, "is_core", "cluster_label"), [KEY, *Z])


def model_summary(points: DataFrame) -> DataFrame:
    """Counts per model in rows: training size, reference size, noise share."""
    clustered = F.col("cluster_label") != C.NOISE
    totals = points.groupBy(KEY).agg(
        F.sum("weight").alias("n_train"),
        F.sum(F.when(clustered, F.col("weight")).otherwise(0)).alias("n_clustered"),
        (F.max("cluster_label") + 1).alias("n_clusters"))
    return totals.select(
        KEY, "n_train",
        F.when(F.col("n_clustered") > 0, F.col("n_clustered")).otherwise(F.col("n_train")).alias("n_core"),
        ((F.col("n_train") - F.col("n_clustered")) / F.col("n_train")).alias("anomaly_rate"), "n_clusters")


def cluster_counts(points: DataFrame) -> DataFrame:
    return points.groupBy(KEY, "cluster_label").agg(F.sum("weight").alias("n_points"))


def reference_points(points: DataFrame) -> DataFrame:
    """Points new readings are compared with: all clustered points, or every
    point when a model found only noise."""
    usable = (points.groupBy(KEY).agg(F.max("cluster_label").alias("best"))
              .select(KEY, (F.col("best") == C.NOISE).alias("all_noise")))
    return (points.join(usable, KEY)
            .filter(F.col("all_noise") | (F.col("cluster_label") != C.NOISE)).drop("all_noise"))
