"""Models of few points are fitted by one task each, others in cells; both alike."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clustering import blobs, brute_force, frame

from plantpulse import constants as C
from plantpulse.operators import boxtree, cells, dbscan, scoring
from plantpulse.operators.scaling import KEY
from plantpulse.plans import training


def labels_of(spark, sets, eps):
    scaled = frame(spark, sets)
    points = dbscan.cluster_points(scaled, eps, 10)
    assert points.agg(F.sum("weight")).first()[0] == sum(len(x) for x in sets.values())
    flags = dbscan.label_rows(scaled, dbscan.core_points(scaled, eps, 10).withColumn("cluster_label", F.lit(0)))
    assert (flags.select(KEY, "n", "is_core").exceptAll(dbscan.label_rows(scaled, points).select(KEY, "n", "is_core"))).isEmpty()
    return dbscan.label_rows(scaled, points).toPandas()


@pytest.mark.parametrize("eps,leaf,capacity", [(1.2, 0, 12), (0.6, 290, 64), (2.5, 4096, 64)])
def test_leaves_and_cells_agree_with_brute_force(spark, eps, leaf, capacity, monkeypatch):
    monkeypatch.setattr(dbscan, "LEAF_MODEL", leaf)
    monkeypatch.setattr(cells, "LEAF_CELLS", capacity)
    sets = {"1": blobs(1)[:290], "2": blobs(2, copies=300), "3": np.repeat(blobs(3)[:1], 9, 0), "4": blobs(4)[:40] * 9}
    got = labels_of(spark, sets, eps)
    for key, x in sets.items():
        part = got[got[KEY] == key].sort_values("n")
        core, labels = brute_force(x, eps, 10)
        assert part["is_core"].tolist() == core.tolist()
        assert part["cluster_label"].tolist() == labels.tolist()


def test_small_models_store_no_pairs(spark, monkeypatch):
    """Many small models are placed in no cells: cells and their pairs took forty exchanges of all points."""
    monkeypatch.setattr(dbscan, "place", lambda *_: pytest.fail("cells for a small model"))
    sets = {str(k): blobs(k)[:60] for k in range(5)}
    got = labels_of(spark, sets, 1.2)
    for key, x in sets.items():
        assert got[got[KEY] == key].sort_values("n")["cluster_label"].tolist() == brute_force(x, 1.2, 10)[1].tolist()


def test_odd_coordinates_go_with_the_cells(spark):
    x = blobs(6)[:60]
    x[3, 2] = np.nan
    points = dbscan._leaves_and_rest(frame(spark, {"a": x, "b": blobs(7)[:60]}))
    assert [p.select(KEY).distinct().collect()[0][0] for p in points] == ["b", "a"]


def test_known_readings_are_joined_with_the_reference_once(spark, monkeypatch):
    """Readings that equal a reference point are answered by that join and are not sought again."""
    rows = spark.range(60).select(
        F.lit(1).alias("machine_id"), F.lit(30).alias("target_cycle"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
        *[(10.0 + F.col("id") % (3 + i)).alias(c) for i, c in enumerate(C.SENSORS)])
    model = training.train(rows, models="machines")
    asked, seek = [], scoring.nearest
    monkeypatch.setattr(scoring, "nearest", lambda unique, *a, **k: asked.append(unique) or seek(unique, *a, **k))
    odd = rows.limit(2).withColumn("rpm", F.col("rpm") + 0.01).unionByName(rows).withColumn("n", F.monotonically_increasing_id())
    shown = ["n", "cluster_label", "anomaly_score", "alert_level"]
    once, other = (scoring.score(odd, model.scaler, model.index, known=k).select(*shown).orderBy("n").collect() for k in (True, False))
    assert once == other and len(once) == 62
    reference = model.reference.count()
    assert asked[0].count() == asked[1].count() - reference


def test_whole_models_and_trees_score_alike(spark, monkeypatch):
    """Models of few points have no nodes: their tree and its windows took an exchange or more a level."""
    sets = {str(k): blobs(k)[:40 + 50 * k] for k in range(3)} | {"hot": blobs(5, copies=300)}
    points = dbscan.cluster_points(frame(spark, sets), 1.2, 10)
    rng = np.random.default_rng(3)
    near = {k: np.concatenate([x[rng.integers(0, len(x), 700)] + rng.normal(size=(700, 8)) * .2, x[:9]]) for k, x in sets.items()}
    asked = frame(spark, near | {"gone": blobs(9)[:5]}).select(KEY, *cells.Z).distinct()
    got, depths = [], []
    monkeypatch.setattr(scoring, "LEAF_REFERENCES", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for limit in (10 ** 6, 60, 0):
            monkeypatch.setattr(scoring, "WHOLE_MODEL", limit)
            index = scoring.index_points(dbscan.reference_points(points))
            depths.append(index.depth)
            got.append(scoring.nearest(asked, index, 1.2).select(KEY, *cells.Z, "near_gap", "near_label").orderBy(KEY, *cells.Z).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert depths[0] == 0 and min(depths[1:]) > 0
    assert got[0] == got[1] == got[2] and len(got[0]) > 1500


def test_odd_references_stay_in_the_tree(spark):
    x = blobs(6)[:60]
    x[3, 2] = np.nan
    reference = frame(spark, {"a": x, "b": blobs(7)[:60]}).withColumns({"weight": F.lit(1), "cluster_label": F.lit(0)})
    index = scoring.index_points(reference)
    assert sorted(tuple(r) for r in index.models.collect()) == [("a", False), ("b", True)]
    assert scoring.nearest(reference.select(KEY, *cells.Z).distinct(), index, 1.2).count() == 120


@pytest.mark.parametrize("limit", [300, 10 ** 6])
def test_small_nodes_are_cut_by_one_task(spark, monkeypatch, limit):
    """Rounds over many small nodes shuffled an aggregate of every coordinate for nearly each row."""
    rounds, cut = [], boxtree._cuts
    monkeypatch.setattr(boxtree, "_cuts", lambda *a: rounds.append(a) or cut(*a))
    monkeypatch.setattr(boxtree, "TASK_ROWS", limit)
    x = np.concatenate([blobs(8) for _ in range(4)] + [np.repeat(blobs(9)[:1], 400, 0)])
    odd = blobs(3)[:34]
    odd[5, 1] = np.nan
    tree = boxtree.grow(frame(spark, {"a": x, "b": blobs(2)[:20], "odd": odd}), [KEY], cells.Z, 32)
    sizes = tree.rows.groupBy(KEY, "leaf").agg(F.count("*").alias("n"), F.countDistinct(*cells.Z).alias("d")).collect()
    assert sum(r["n"] for r in sizes) == len(x) + 20 + 34
    assert all(r["n"] <= 32 or r["d"] == 1 for r in sizes if r[KEY] != "odd")
    assert max(len(r["leaf"]) for r in sizes) == tree.depth * boxtree.PART
    whole = boxtree.grow(frame(spark, {"a": x}), [KEY], cells.Z, 32)
    if limit == 10 ** 6:
        # The odd group alone is cut in rounds.
        assert all(a[3].select(KEY).distinct().collect()[0][0] == "odd" for a in rounds)
    else:
        assert rounds
    assert whole.rows.count() == len(x)


def test_border_points_look_only_where_a_label_may_fall(spark, monkeypatch):
    """Points whose cell meets the first cluster were exchanged with all their mixed cells for nothing."""
    seen, hits = [], dbscan.point_hits
    monkeypatch.setattr(dbscan, "LEAF_MODEL", 0)
    monkeypatch.setattr(dbscan, "point_hits", lambda *a: seen.append(a) or hits(*a))
    dbscan.cluster_points(frame(spark, {"1": blobs(1)}), 1.2, 10)
    _, pairs, clusters, *_ = seen[-1]
    first = clusters.filter("cluster = 0").select(F.col("cell").alias("a"))
    assert not first.isEmpty() and pairs.join(first, "a", "left_semi").isEmpty()
