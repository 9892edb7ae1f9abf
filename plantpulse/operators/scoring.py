"""Scoring readings against the reference points."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..session import stage_table
from .boxtree import grow, level
from .cells import BOX, Z, around, box_columns, point_box_gap, point_gap, tasks_for
from .leaf_fit import nearest_of_leaf
from .scaling import KEY, POSITION, standardise

# Reference points of a leaf of the index.
LEAF_REFERENCES = 32
# Distinct reference points of a model without a tree: its readings meet them all, in one task.
WHOLE_MODEL = 1024
# Stored reference points lie in shelves of about this many rows; a join reads only the shelves it needs.
SHELF_ROWS = 1_000_000
REPRESENTATIVE = [f"rep_{z}" for z in Z]
READING = ["machine_id", "target_cycle", *C.SENSORS]
_LIMITS = {
    "machine_id": (C.MACHINE_ID_MIN, None),
    "target_cycle": C.TARGET_CYCLE_RANGE,
    **C.READING_LIMITS,
}


def clamp_sensors(df: DataFrame) -> DataFrame:
    return df.withColumns({c: S.clamp(F.col(c), *lim) for c, lim in C.READING_LIMITS.items() if c in df.columns})


def sensor_records(df: DataFrame, stamp=None) -> DataFrame:
    """Replay rows in the serving shape: clamped, re-stamped, defaults filled."""
    out = clamp_sensors(df).withColumns({
        "target_cycle": F.coalesce("target_cycle", F.lit(30)),
        "failure": F.coalesce("failure", F.lit(0)),
    })
    if stamp is not None:
        out = out.withColumn("timestamp", stamp)
    return out.select(*C.SENSOR_TABLE)


def to_readings(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """The nine accepted fields, clamped; `extra` columns ride along."""
    cycle = F.coalesce("target_cycle", F.lit(30))
    return clamp_sensors(df).withColumn("target_cycle", cycle).select(*extra, *READING)


def reading_problems(df: DataFrame) -> DataFrame:
    """Add `problems`: fields that are missing or out of bounds."""
    bad = {}
    for c, (low, high) in _LIMITS.items():
        wrong = F.col(c).isNull() | (F.col(c) < low)
        bad[c] = wrong if high is None else wrong | (F.col(c) > high)
    return df.withColumn("problems", S.names_where(bad))


def valid_readings(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows with their reasons."""
    checked = reading_problems(df)
    ok = F.size("problems") == 0
    return checked.filter(ok).drop("problems"), checked.filter(~ok)


def choose_model(readings: DataFrame, models: DataFrame) -> DataFrame:
    """Own model of the machine, else the global one."""
    trained = models.select(KEY).distinct().withColumnRenamed(KEY, "own_key")
    own = F.col("machine_id").cast("string")
    return (readings.join(trained, own == F.col("own_key"), "left")
            .withColumn(KEY, F.coalesce("own_key", F.lit(C.GLOBAL_MODEL))).drop("own_key"))


@dataclass(frozen=True)
class ReferenceIndex:
    """Reference points by leaf, and the boxes of all levels of the tree above them.

    A node has the box of its points and one of the points, which bounds how far the
    nearest point of the node can be. `models` tells which models are `whole`: those have so few
    points that they are one leaf without nodes. The tables are stored with the model, the points
    in `shelves` folders by leaf.
    """

    points: DataFrame
    nodes: DataFrame
    depth: int
    shelves: int = 1
    models: DataFrame | None = None


def shelf(shelves: int, path: str) -> Column:
    """The folder of a leaf's points."""
    return F.pmod(F.xxhash64(KEY, path), F.lit(shelves)).cast("int")


def index_points(reference: DataFrame) -> ReferenceIndex:
    """The tree over the reference points of every model that is too large to be one leaf.

    Points with a missing or unbounded coordinate have no distances; their models are in the tree.
    """
    rows = reference.select(KEY, *Z, "weight", POSITION, "cluster_label")
    plain = F.coalesce(reduce(lambda a, b: a + b, [F.abs(z) for z in Z]) < float("inf"), F.lit(False))
    models = stage_table(rows.groupBy(KEY).agg(F.count("*").alias("n"), F.bool_and(plain).alias("plain")).select(
        KEY, ((F.col("n") <= WHOLE_MODEL) & F.col("plain")).alias("whole")))
    tree = grow(rows.join(models.filter("NOT whole"), KEY, "left_semi"), [KEY], Z, LEAF_REFERENCES)
    points = stage_table(rows.join(models.filter("whole"), KEY, "left_semi").withColumn("leaf", F.lit("")).unionByName(tree.rows))
    if not tree.depth:
        nodes = rows.limit(0).select(KEY, F.lit(0).alias("level"), F.lit("").alias("parent"), F.lit("").alias("path"),
                                     *[F.lit(0.0).alias(c) for c in (*BOX, *REPRESENTATIVE)])
        return ReferenceIndex(points, stage_table(nodes), 0, models=models)
    tall = points.join(models.filter("NOT whole"), KEY, "left_semi")
    one = F.min_by(F.struct(*[F.col(z).alias(r) for z, r in zip(Z, REPRESENTATIVE, strict=True)]), POSITION)
    leaves = stage_table(level(tall, [KEY], tree.depth, [*box_columns(), one.alias("one"), F.min(POSITION).alias(POSITION)]).select(
        KEY, F.col("path").alias("leaf"), *BOX, "one.*", POSITION))
    above = F.min_by(F.struct(*REPRESENTATIVE), POSITION)
    levels = [level(leaves, [KEY], k, [*around(), above.alias("one")]).select(
        KEY, F.lit(k).alias("level"), "parent", "path", *BOX, "one.*") for k in range(1, tree.depth + 1)]
    return ReferenceIndex(points, stage_table(reduce(DataFrame.unionByName, levels)), tree.depth, models=models)


def score(readings: DataFrame, scaler: DataFrame, reference: DataFrame | ReferenceIndex, eps: float = C.EPS,
          threshold: float = C.ALERT_THRESHOLD, known: bool = True) -> DataFrame:
    """Add cluster label, score and alert columns to every reading.

    The nearest reference point decides when it is within eps; beyond eps the
    answer is always noise with score 1, so only points within eps are sought.
    Equal readings are scored once. `known` readings may equal reference points:
    those are answered by one join with all reference points, stored, and only the others are
    sought and joined again. For new readings nothing is written and only the leaves near them
    are read; the results are the same.
    """
    index = reference if isinstance(reference, ReferenceIndex) else index_points(reference)
    rated = readings.withColumn("cycle_ratio", S.cycle_ratio(F.col("cycle_duration"), F.col("target_cycle")))
    placed = standardise(choose_model(rated, scaler), scaler)
    rest = placed
    if known:
        placed = stage_table(placed.join(index.points.select(KEY, *Z, F.col("cluster_label").alias("near_label")), [KEY, *Z], "left"))
        rest = placed.filter("near_label IS NULL").drop("near_label")
    found = nearest(rest.select(KEY, *Z).distinct(), index, eps, known=False)
    answered = rest.join(found, [KEY, *Z], "left")
    if known:
        same = placed.filter("near_label IS NOT NULL").withColumn("near_gap", F.lit(0.0))
        answered = same.select(*answered.columns).unionByName(answered)
    label = F.coalesce("near_label", F.lit(C.NOISE))
    points = F.coalesce(F.least(F.sqrt("near_gap") / eps, F.lit(1.0)), F.lit(1.0))
    out = answered.withColumns({"cluster_label": label, "anomaly_score": points})
    out = out.withColumn("anomaly", F.col("cluster_label") == C.NOISE)
    return (out.withColumn("alert", F.col("anomaly"))
            .withColumn("alert_level", S.alert_level(F.col("anomaly"), F.col("anomaly_score"), threshold))
            .drop(*Z, "near_label", "near_gap", "cycle_ratio"))


def nearest(unique: DataFrame, index: ReferenceIndex, eps: float, known: bool = True) -> DataFrame:
    """Nearest reference point within eps of each distinct reading, with its squared distance.

    Readings of a `whole` model meet all its points in one task, as a stream behind them (`leaf_fit`).
    Of the others, a `known` reading that equals a reference point has its answer from an equality join;
    the rest go down the tree: a node is opened while its box is no farther than the best
    bound, which starts at eps and falls to the distance of the nearest representative
    met so far. Nothing is written and the reference is not aggregated.
    """
    if index.models is None:
        return _nearest_in_tree(unique, index, eps, known)
    tall = index.models.filter("NOT whole").select(KEY)
    asked = unique.select(KEY, *Z).join(index.models, KEY)
    found = _nearest_of_whole(asked.filter("whole").select(KEY, *Z), index, eps)
    if tall.isEmpty():
        return found
    in_tree = replace(index, points=index.points.join(tall, KEY, "left_semi"))
    return found.unionByName(_nearest_in_tree(asked.filter("NOT whole").select(KEY, *Z), in_tree, eps, known))


def _nearest_of_whole(unique: DataFrame, index: ReferenceIndex, eps: float) -> DataFrame:
    """One exchange: the points of a model first, its readings behind them."""
    whole = index.models.filter("whole").select(KEY)
    points = index.points.join(whole, KEY, "left_semi").select(
        KEY, *Z, POSITION, F.col("cluster_label").alias("near_label"), F.lit(False).alias("asks"))
    rows = points.unionByName(unique.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    ordered = rows.repartition(tasks_for(rows), KEY).sortWithinPartitions(KEY, "asks", POSITION, *Z)
    return nearest_of_leaf(ordered, Z, eps)


def _nearest_in_tree(unique: DataFrame, index: ReferenceIndex, eps: float, known: bool) -> DataFrame:
    opened = opened_leaves(unique, index, eps, known).withColumn("shelf", shelf(index.shelves, "path"))
    points = index.points if "shelf" in index.points.columns else index.points.withColumn("shelf", shelf(index.shelves, "leaf"))
    met = opened.alias("p").join(points.alias("b"), _same("p", "b", {"shelf": "shelf", KEY: KEY, "path": "leaf"})).select(
        *[F.col(f"p.{c}") for c in (KEY, *Z)], "p.bound", point_gap("p", "b").alias("g"), f"b.{POSITION}",
        F.col("b.cluster_label").alias("label"))
    best = met.filter(F.col("g") <= F.col("bound")).groupBy(KEY, *Z).agg(
        F.min("g").alias("near_gap"), F.min_by("label", F.struct("g", POSITION)).alias("near_label"))
    if not known:
        return best
    same = _equal(unique, index).filter(F.col("cluster_label").isNotNull()).select(
        KEY, *Z, F.lit(0.0).alias("near_gap"), F.col("cluster_label").alias("near_label"))
    return same.unionByName(best)


def _equal(unique: DataFrame, index: ReferenceIndex) -> DataFrame:
    return unique.join(index.points.select(KEY, *Z, "cluster_label"), [KEY, *Z], "left")


def opened_leaves(unique: DataFrame, index: ReferenceIndex, eps: float, known: bool = True) -> DataFrame:
    """Leaves (`path`) that may hold the nearest point of a reading, with the `bound` found; none for a reading
    that is `known` to equal a point."""
    rest = _equal(unique, index).filter(F.col("cluster_label").isNull()) if known else unique
    out = rest.select(KEY, *Z, F.lit("").alias("path"), F.lit(eps * eps).alias("bound"))
    for k in range(1, index.depth + 1):
        out = _opened(out, index.nodes.filter(F.col("level") == k))
    return out


def _same(a: str, b: str, columns: dict[str, str]):
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}") == F.col(f"{b}.{d}") for c, d in columns.items()])


def _opened(open_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Children of the open nodes that may hold the nearest point of their reading."""
    gap = reduce(lambda x, y: x + y, [(F.col(f"p.{z}") - F.col(f"b.rep_{z}")) * (F.col(f"p.{z}") - F.col(f"b.rep_{z}")) for z in Z])
    kept = open_nodes.alias("p").join(nodes.alias("b"), _same("p", "b", {KEY: KEY, "path": "parent"})).select(
        *[F.col(f"p.{c}") for c in (KEY, *Z)], F.col("b.path").alias("path"), "p.bound",
        point_box_gap("p", "b").alias("gap"), gap.alias("known"))
    kept = kept.filter(F.col("gap") <= F.col("bound"))
    # A hair above, so that rounding cannot shut the point itself out.
    bound = F.least(F.col("bound"), F.min("known").over(Window.partitionBy(KEY, *Z)) * (1 + 1e-9))
    return kept.withColumn("bound", bound).filter(F.col("gap") <= F.col("bound")).drop("gap", "known")
