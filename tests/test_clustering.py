"""Clustering and scoring against a quadratic numpy version."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators import boxtree, cells, components, dbscan, scaling, scoring
from plantpulse.operators.scaling import KEY


def brute_force(x, eps, min_samples):
    gap = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    near = gap <= eps * eps
    core = near.sum(1) >= min_samples
    labels = np.full(len(x), -1)
    found = 0
    for i in range(len(x)):
        if not core[i] or labels[i] != -1:
            continue
        todo = [i]
        labels[i] = found
        while todo:
            j = todo.pop()
            for n in np.flatnonzero(near[j] & core & (labels == -1)):
                labels[n] = found
                todo.append(n)
        found += 1
    for i in np.flatnonzero(~core):
        reach = labels[near[i] & core]
        if len(reach):
            labels[i] = reach.min()
    return core, labels


def blobs(seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 4, (4, 8))
    x = np.concatenate([rng.normal(c, s, (n, 8)) for c, s, n in zip(centres, (.3, .6, .15, .9), (60, 80, 50, 90))])
    x = np.concatenate([x, rng.uniform(-8, 8, (30, 8)), np.repeat(x[:1], copies, 0)])
    return x[rng.permutation(len(x))]


def frame(spark, sets):
    rows = []
    for key, x in sets.items():
        f = pd.DataFrame(x, columns=cells.Z)
        f.insert(0, KEY, key)
        f["n"] = np.arange(len(x))
        rows.append(f)
    df = spark.createDataFrame(pd.concat(rows))
    return df.withColumn("pos", F.col("n").cast("decimal(38,0)")).repartition(5)


@pytest.mark.parametrize("eps,leaf", [(0.6, 64), (1.2, 64), (2.5, 64), (1.2, 12)])
def test_labels_match_brute_force(spark, eps, leaf, monkeypatch):
    monkeypatch.setattr(cells, "LEAF_CELLS", leaf)
    sets = {"1": blobs(1), "2": blobs(2, copies=300)}
    scaled = frame(spark, sets)
    points = dbscan.cluster_points(scaled, eps, 10)
    got = dbscan.label_rows(scaled, points).select(KEY, "n", "is_core", "cluster_label").toPandas()
    for key, x in sets.items():
        part = got[got[KEY] == key].sort_values("n")
        core, labels = brute_force(x, eps, 10)
        assert part["is_core"].tolist() == core.tolist()
        assert part["cluster_label"].tolist() == labels.tolist()


def test_mixed_cells_link_clusters(spark):
    # Two cells of many points each, whose boxes overlap eps only in part.
    rng = np.random.default_rng(5)
    x = np.zeros((400, 8))
    x[:200, :2] = rng.uniform(0.0, 0.35, (200, 2))
    x[200:, :2] = rng.uniform(0.0, 0.35, (200, 2)) + [1.15, 0.0]
    scaled = frame(spark, {"m": x})
    for eps in (0.8, 0.85, 0.95, 1.0):
        points = dbscan.cluster_points(scaled, eps, 10)
        got = dbscan.label_rows(scaled, points).orderBy("n").select("cluster_label").toPandas()
        assert got["cluster_label"].tolist() == brute_force(x, eps, 10)[1].tolist()


def grown(spark, x, capacity, keys=("m",)):
    rows = pd.DataFrame(np.asarray(x, float), columns=["x", "y"])
    rows.insert(0, "key", [keys[i % len(keys)] for i in range(len(rows))])
    rows["n"] = np.arange(len(rows))
    return boxtree.grow(spark.createDataFrame(rows).repartition(3), ["key"], ["x", "y"], capacity)


def test_leaves_hold_a_stated_number_of_rows(spark):
    """Even, lopsided and repeated coordinates, for groups of one row as for large ones."""
    rng = np.random.default_rng(8)
    far = np.concatenate([rng.normal(size=(700, 2)), 10.0 ** rng.uniform(0, 15, (60, 2)), np.full((40, 2), 3.5)])
    far[:300, 1] = 0.0
    tree = grown(spark, far, 16, ["a"] * 30 + ["b"])
    sizes = tree.rows.groupBy("key", "leaf").agg(F.count("*").alias("n"), F.countDistinct("x", "y").alias("points")).toPandas()
    assert sizes["n"].sum() == 800 and tree.rows.select("n").distinct().count() == 800
    assert (sizes[sizes["points"] > 1]["n"] <= 16).all() and (sizes["points"] == 1).any()
    assert len(sizes) < 800 / 2
    assert grown(spark, far[:10], 16).depth == 0
    assert grown(spark, np.ones((50, 2)), 16).depth == 0
    none = tree.rows.drop("leaf").filter("false")
    assert boxtree.grow(none, ["key"], ["x", "y"], 16).rows.count() == 0


def test_levels_nest(spark):
    rng = np.random.default_rng(9)
    tree = grown(spark, rng.normal(size=(900, 2)), 5)
    assert tree.depth >= 2
    for k in range(1, tree.depth + 1):
        nodes = boxtree.level(tree.rows, ["key"], k, [F.count("*").alias("n")]).toPandas()
        above = boxtree.level(tree.rows, ["key"], k - 1, [F.count("*").alias("n")]).toPandas()
        assert nodes["n"].sum() == 900
        assert nodes.groupby("parent")["n"].sum().to_dict() == above.set_index("path")["n"].to_dict()
        assert nodes.groupby("parent").size().max() <= 64


def test_every_pair_of_near_cells_is_met_once(spark, monkeypatch):
    monkeypatch.setattr(cells, "LEAF_CELLS", 4)
    scaled = frame(spark, {"1": blobs(1), "2": blobs(2)})
    points, table = cells.place(dbscan.unique_points(scaled), 1.2)
    met = cells.cell_pairs(table, 1.2).toPandas()
    assert not met.duplicated(["a", "b"]).any()
    p = points.toPandas()
    have = set(zip(met["a"], met["b"], strict=True))
    for key, x in p.groupby(KEY):
        z, cell = x[cells.Z].to_numpy(), x["cell"].to_numpy()
        near = ((z[:, None] - z[None]) ** 2).sum(-1) <= 1.2 ** 2
        assert {(a, b) for i, j in zip(*np.nonzero(near), strict=True) for a, b in [(cell[i], cell[j])] if a != b} <= have


def test_the_tree_of_a_model_is_grown_once(spark, monkeypatch):
    from plantpulse.plans import training
    grown_from = []
    monkeypatch.setattr(scoring, "index_points", lambda reference: grown_from.append(reference) or len(grown_from))
    points = frame(spark, {"1": blobs(4)}).withColumns({"weight": F.lit(1), "cluster_label": F.lit(0)})
    model = training.Model(points, points, 1.2, 3)
    assert model.index == model.index == 1


def test_work_of_scoring_is_bounded(spark):
    """Readings meet few nodes and points: fewer than a twentieth of all pairs, with and without equal points."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(4000, 8)) * [3, 2, 1, 1, .3, .2, .1, .1]
    reference = frame(spark, {"m": x}).withColumns({"weight": F.lit(1), "cluster_label": F.lit(0)}).drop("n")
    index = scoring.index_points(reference)
    q = np.concatenate([x[:500] + rng.normal(size=(500, 8)) * .05, x[:300]])
    asked = frame(spark, {"m": q}).select(KEY, *cells.Z)
    found = scoring.nearest(asked, index, 1.0)
    assert found.count() == 800
    met = scoring.opened_leaves(asked, index, 1.0)
    sizes = index.points.groupBy(KEY, F.col("leaf").alias("path")).agg(F.count("*").alias("n"))
    opened = met.join(sizes, [KEY, "path"]).agg(F.sum("n")).first()[0]
    assert opened < 0.05 * 500 * 4000
    assert index.nodes.count() < 4000 / 8


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 140)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 140), 500]], "node long")
    edges = spark.createDataFrame(path + star, "a long, b long")
    got = components.connected_components(nodes, edges).toPandas()
    groups = got.groupby("component")["node"].apply(lambda s: sorted(s)).tolist()
    assert sorted(groups) == [list(range(41)), list(range(100, 140)), [500]]


def test_scores_match_brute_force(spark):
    rng = np.random.default_rng(3)
    raw = rng.normal(50, 5, (300, 7)).clip(1)
    train = pd.DataFrame(raw, columns=C.SENSORS)
    train["machine_id"] = np.where(np.arange(300) < 280, 1, 2)
    train["target_cycle"] = 30
    train["timestamp"] = pd.date_range("2026-01-01", periods=300, freq="h")
    from plantpulse.plans import training
    model = training.train(spark.createDataFrame(train), eps=2.0, min_samples=11)
    assert sorted(r[KEY] for r in model.summary.collect()) == ["1", "global"]
    readings = pd.DataFrame(rng.normal(50, 6, (60, 7)).clip(1), columns=C.SENSORS)
    readings["machine_id"] = np.arange(60) % 3 + 1
    readings["target_cycle"] = 30
    readings["n"] = np.arange(60)
    got = scoring.score(spark.createDataFrame(readings), model.scaler, model.reference, eps=2.0)
    got = got.orderBy("n").toPandas()
    for key, mask in (("1", train["machine_id"] == 1), ("global", train["machine_id"] > 0)):
        x = np.column_stack([train.loc[mask, C.SENSORS], train.loc[mask, "cycle_duration"] / 30])
        mean, std = x.mean(0), x.std(0)
        z = (x - mean) / std
        _, labels = brute_force(z, 2.0, 11)
        keep = labels != -1 if (labels != -1).any() else np.ones(len(labels), bool)
        for _, r in got[got[KEY] == key].iterrows():
            q = (np.array([*r[C.SENSORS], r["cycle_duration"] / 30], float) - mean) / std
            d = np.sqrt(((z[keep] - q) ** 2).sum(1))
            best = d.argmin()
            inside = d[best] <= 2.0
            assert r["cluster_label"] == (labels[keep][best] if inside else -1)
            assert r["anomaly_score"] == pytest.approx(min(d[best] / 2.0, 1.0))


def test_all_noise_keeps_every_point(spark):
    scaled = frame(spark, {"m": np.arange(24)[:, None] * np.ones((24, 8)) * 5})
    points = dbscan.cluster_points(scaled, 1.5, 10)
    summary = dbscan.model_summary(points).first()
    assert (summary["n_core"], summary["anomaly_rate"], summary["n_clusters"]) == (24, 1.0, 0)
    assert dbscan.reference_points(points).count() == 24


def test_flat_feature_scales_by_one(spark):
    df = spark.createDataFrame([("a", *[7.3] * 8), ("a", *[7.3] * 8)], [KEY, *C.FEATURES])
    row = scaling.fit_scaler(df).first()
    assert all(row[f"scale_{c}"] == 1.0 for c in C.FEATURES)


def crowd(seed, n=500):
    """Two crowded clouds of a few cells each, closer than eps here and there."""
    rng = np.random.default_rng(seed)
    x = np.zeros((n, 8))
    x[:, :3] = rng.uniform(0, 0.9, (n, 3))
    x[n // 2:, 0] += 1.6
    return np.concatenate([x, rng.uniform(-1, 3.5, (60, 8)) * [1, 1, 1, 0, 0, 0, 0, .4]])


@pytest.mark.parametrize("eps", [0.75, 0.95])
def test_crowded_cells_are_cut_into_parts(spark, monkeypatch, eps):
    monkeypatch.setattr(cells, "LEAF_POINTS", 4)
    monkeypatch.setattr(scoring, "LEAF_REFERENCES", 4)
    x = crowd(11)
    scaled = frame(spark, {"m": x})
    points = dbscan.cluster_points(scaled, eps, 10)
    got = dbscan.label_rows(scaled, points).orderBy("n").toPandas()
    core, labels = brute_force(x, eps, 10)
    assert got["is_core"].tolist() == core.tolist()
    assert got["cluster_label"].tolist() == labels.tolist()
    rng = np.random.default_rng(12)
    q = rng.uniform(-1, 3.5, (80, 8)) * [1, 1, 1, .1, 0, 0, 0, .3]
    asked = frame(spark, {"m": np.concatenate([q, x[:20]])}).select(KEY, *cells.Z).distinct()
    near = scoring.nearest(asked, scoring.index_points(dbscan.reference_points(points)), eps).toPandas()
    have = {tuple(np.round(r[cells.Z].astype(float), 9)): (r["near_gap"], r["near_label"]) for _, r in near.iterrows()}
    keep = labels != -1
    for row in q:
        d = ((x[keep] - row) ** 2).sum(1)
        hit = have.get(tuple(np.round(row, 9)))
        if d.min() <= eps * eps:
            assert hit == (pytest.approx(d.min()), labels[keep][d.argmin()])
        else:
            assert hit is None


def test_joins_of_boxes_are_compiled(spark):
    """The JVM compiles no method of more than 8000 bytes; a join in such a method would be interpreted."""
    scaled = frame(spark, {"1": blobs(1)})
    points, table = cells.place(dbscan.unique_points(scaled), 1.2)
    index = scoring.index_points(points.withColumn("cluster_label", F.lit(0)))
    pairs = cells.cell_pairs(table, 1.2)
    hits = cells.point_hits(points, pairs, table.withColumn("value", F.lit(1)), points.withColumn("value", F.lit(1)), 1.2)
    near = scoring.nearest(points.select(KEY, *cells.Z), index, 1.2)
    sizes = []
    # Adaptive plans have no code before they run.
    for conf in ({"adaptive.enabled": "false"}, {"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1"}):
        for key, value in conf.items():
            spark.conf.set(f"spark.sql.{key}", value)
        try:
            for df in (pairs, hits, near):
                text = spark._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "codegen")
                sizes.append(max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)))
        finally:
            for key in conf:
                spark.conf.unset(f"spark.sql.{key}")
    assert max(sizes) <= 8000, sizes
