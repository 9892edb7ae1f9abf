"""Sliced windows and as-of joins against pandas, with one hot machine."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import slices
from plantpulse.functions.running import running_sum
from plantpulse.operators import features, interventions
from plantpulse.plans import evaluation, monitoring
from plantpulse.session import stage_table
from plantpulse.streaming import parts, replay


@pytest.fixture
def narrow(monkeypatch):
    """Slices of at most 40 rows, so every window crosses slice edges."""
    monkeypatch.setattr(slices, "SLICE_ROWS", 40)


def sensors(seed=1):
    rng = np.random.default_rng(seed)
    parts = []
    for machine, n in ((1, 900), (2, 60), (3, 25)):  # machine 1 holds most rows
        hours = np.sort(rng.choice(4000, n, replace=False))
        parts.append(pd.DataFrame({
            "machine_id": machine, "target_cycle": rng.choice([10, 30], n),
            "timestamp": pd.Timestamp("2026-01-01") + pd.to_timedelta(hours * 1800, unit="s"),
            "temperature_C": np.where(rng.random(n) < .1, np.nan, rng.normal(50, 5, n)),
            "vibration": rng.normal(1, .1, n), "pressure": rng.normal(50, 3, n)}))
    # A burst: many rows within minutes.
    burst = parts[0].head(1).loc[[0] * 300].assign(
        timestamp=pd.Timestamp("2026-01-20") + pd.to_timedelta(np.arange(300), unit="s"),
        temperature_C=rng.normal(50, 5, 300))
    df = pd.concat([*parts, burst]).sort_values(["machine_id", "timestamp", "target_cycle"], kind="stable")
    df["row_id"] = np.arange(len(df))
    return df.reset_index(drop=True)


def rows_of(df):
    clean = df.astype(object).where(df.notna(), None)
    return [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r)
            for r in clean.itertuples(index=False)]


def to_spark(spark, df):
    return spark.createDataFrame(rows_of(df), schema=(
        "machine_id int, target_cycle int, timestamp timestamp, temperature_C double, vibration double, "
        "pressure double, row_id long")).repartition(6)


def test_rolling_features_match_pandas(spark, narrow):
    df = sensors()
    got = features.rolling_features(to_spark(spark, df)).orderBy("row_id").toPandas()
    assert len(got) == len(df)
    g = df.groupby("machine_id", sort=False)
    for c in ("temperature_C", "vibration", "pressure"):
        mean = g[c].transform(lambda s: s.rolling(10, min_periods=1).mean())
        std = g[c].transform(lambda s: s.rolling(10, min_periods=1).std().fillna(0))
        delta = g[c].transform(lambda s: s.diff().fillna(0))
        for name, want in (("roll_mean_10", mean), ("roll_std_10", std), ("delta", delta)):
            np.testing.assert_allclose(got[f"{c}_{name}"].astype(float), want, rtol=1e-9, atol=1e-7, equal_nan=True)


def log(seed=2):
    rng = np.random.default_rng(seed)
    machine = rng.choice([1, 1, 1, 2], 120)
    ts = pd.Timestamp("2026-01-05") + pd.to_timedelta(rng.integers(0, 3200, 120) * 1800, unit="s")
    return pd.DataFrame({"row_id": np.arange(120), "machine_id": machine, "timestamp": ts,
                         "failure_type": rng.choice(["Breakage", "Overheat"], 120)})


def log_frame(spark, df):
    return spark.createDataFrame(rows_of(df), "row_id long, machine_id int, timestamp timestamp, failure_type string")


def test_asof_joins_match_pandas(spark, narrow):
    df, events = sensors(), log()
    got = interventions.attach_interventions(to_spark(spark, df), log_frame(spark, events)).toPandas()
    got = got.set_index("row_id").sort_index()
    assert len(got) == len(df)
    for machine, part in df.groupby("machine_id"):
        sub = events[events["machine_id"] == machine].sort_values(["timestamp", "row_id"])
        left = part[["timestamp", "row_id"]].sort_values("timestamp")
        back = pd.merge_asof(left, sub.assign(at=sub["timestamp"])[["timestamp", "at"]], on="timestamp")
        hours = ((back["timestamp"] - back["at"]).dt.total_seconds() / 3600).fillna(9999.0)
        near = pd.merge_asof(left, sub[["timestamp", "failure_type"]], on="timestamp", direction="nearest",
                             tolerance=pd.Timedelta(hours=1))
        have = got.loc[back["row_id"]]
        np.testing.assert_allclose(have["hours_since_last_intervention"], hours, rtol=1e-12)
        assert have["near_type"].tolist() == near["failure_type"].astype(object).where(
            near["failure_type"].notna(), None).tolist()


def test_hours_to_next_match_pandas(spark, narrow):
    df, events = sensors(), log()
    got = interventions.hours_to_next(to_spark(spark, df), log_frame(spark, events)).toPandas()
    got = got.set_index("row_id")
    for machine, part in df.groupby("machine_id"):
        sub = events[events["machine_id"] == machine].sort_values("timestamp")
        ahead = pd.merge_asof(part[["timestamp", "row_id"]], sub.assign(at=sub["timestamp"])[["timestamp", "at"]],
                              on="timestamp", direction="forward")
        want = (ahead["at"] - ahead["timestamp"]).dt.total_seconds() / 3600
        have = got.loc[ahead["row_id"], "hours_to_next_intervention"].astype(float)
        np.testing.assert_allclose(have, want, equal_nan=True)


def test_lead_time_counts(spark):
    ts = datetime(2026, 1, 1)
    anomalies = spark.createDataFrame([(1, ts), (1, ts + timedelta(hours=30)), (2, ts)],
                                      "machine_id int, timestamp timestamp")
    events = spark.createDataFrame([(1, ts + timedelta(hours=24)), (2, ts + timedelta(hours=25))],
                                   "machine_id int, timestamp timestamp")
    got = {r["measure"]: (r["hits"], r["total"]) for r in monitoring.lead_time(anomalies, events).collect()}
    assert got == {"anomalies followed": (1, 3), "interventions preceded": (1, 2)}


def test_widths_follow_the_densest_slice_of_each_machine(spark):
    """One hot machine narrows its own slices only; each width is the widest that fits."""
    df = to_spark(spark, sensors())
    assert slices.slice_widths(df, ["machine_id"]).count() == 0
    start = datetime(2026, 1, 1)
    rows = [(7, start + timedelta(seconds=20 * k)) for k in range(3000)] + [(8, start + timedelta(hours=k)) for k in range(500)]
    rows += [(9, start)] * 700 + [(10, None)] * 900
    mixed = spark.createDataFrame(rows, "machine_id int, timestamp timestamp")
    widths = slices.slice_widths(mixed, ["machine_id"], limit=600)
    got = {r["machine_id"]: r[slices.WIDTH] for r in widths.collect()}
    assert set(got) == {7, 9} and got[9] == 1
    counts = lambda w: mixed.filter("machine_id = 7").groupBy(
        F.floor(F.unix_seconds("timestamp") / w)).count().agg(F.max("count")).first()[0]
    wider = slices.WIDTHS[slices.WIDTHS.index(got[7]) - 1]
    assert counts(got[7]) <= 600 < counts(wider)
    assert all(a % b == 0 for a, b in zip(slices.WIDTHS, slices.WIDTHS[1:], strict=False))
    cut = slices.sliced(mixed, widths, ["machine_id"])
    assert cut.count() == mixed.count() and cut.columns == [*mixed.columns, slices.SLICE]
    assert cut.filter("machine_id = 8").select(slices.SLICE).distinct().count() <= 2


def test_ticks(spark):
    df = to_spark(spark, sensors()).repartition(9)
    by_rows = replay.ticks_by_rows(df, 4).groupBy("tick").count().orderBy("tick").toPandas()
    total = by_rows["count"].sum()
    assert by_rows["tick"].tolist() == list(range(len(by_rows)))
    assert by_rows["count"].tolist()[:-1] == [4] * (len(by_rows) - 1) and by_rows["count"].iloc[-1] == (total % 4 or 4)
    by_time = replay.ticks_by_time(df).groupBy("tick").agg({"timestamp": "max"}).orderBy("tick").toPandas()
    assert by_time["tick"].tolist() == list(range(len(by_time)))
    assert by_time["max(timestamp)"].is_monotonic_increasing


def test_parts_stay_few_and_keep_every_batch(spark, tmp_path):
    """Late, repeated and empty batches; a reader meets at most fan - 1 parts of each level."""
    def combine(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    table = parts.PartTable(spark, str(tmp_path / "t"), combine, fan=3)
    want = {}
    for i in range(30):
        rows = [] if i % 7 == 3 else [(i % 4, i), (0, 1)]
        df = spark.createDataFrame(rows, "k int, n long").coalesce(1)
        for _ in range(2 if i in (8, 17, 26, 20) else 1):  # a batch that comes again, also one that combines
            table.store(df, i)
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        assert len(table.parts()) <= 2 * 4
        if i % 5 == 4 or i in (8, 26):
            assert {r.k: r.n for r in combine(table.read()).collect()} == want
    # 30 = 1010 in base 3.
    assert [p.split("/")[-2] for p in table.parts()] == ["level=03", "level=01"]
    kept = sum(1 for _ in (tmp_path / "t").glob("level=*/chunk=*"))
    assert kept <= 4 * 3 * 2


def test_a_part_counts_once_it_is_complete(spark, tmp_path):
    table = parts.PartTable(spark, str(tmp_path / "t"), lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), fan=2)
    for i in range(4):
        table.store(spark.createDataFrame([(1, 1)], "k int, n long"), i)
    top = tmp_path / "t" / "level=02" / "chunk=000000000000" / "_SUCCESS"
    assert len(table.parts()) == 1 and table.read().agg(F.sum("n")).first()[0] == 4
    top.unlink()
    assert len(table.parts()) == 2 and table.read().agg(F.sum("n")).first()[0] == 4


def test_paced_replay_goes_on_where_it_stopped(spark, tmp_path):
    times = [datetime(2026, 1, 1) + timedelta(hours=7 * i) for i in range(9)]
    rows = [(m, t, 10 * i + m) for i, t in enumerate(times) for m in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "machine_id int, timestamp timestamp, row_id int")
    ticks = replay.stored_ticks(replay.ticks_by_time(df))
    seen = []

    def handle(tick, number):
        if number == 6 and not any(n == 6 for n, _ in seen):
            seen.append((6, None))
            raise OSError("sink is away")
        seen.append((number, sorted(r.row_id for r in tick.collect())))

    state = str(tmp_path / "state")
    assert replay.paced(ticks, handle, state, last=3) == 4
    with pytest.raises(Exception, match="sink is away"):
        replay.paced(ticks, handle, state)
    assert replay.paced(ticks, handle, state) == 9
    done = [s for s in seen if s[1] is not None]
    assert done == [(i, [10 * i + m for m in range(1 + i % 3)]) for i in range(9)]
    assert replay.paced(ticks.filter("false"), handle, str(tmp_path / "none")) == 0


def test_running_sums_cross_partitions(spark):
    rng = np.random.default_rng(4)
    df = pd.DataFrame({"k": np.where(rng.random(3000) < .9, "hot", rng.choice(list("abc"), 3000)), "o": rng.permutation(3000),
                       "v": rng.integers(0, 9, 3000)})
    got = running_sum(spark.createDataFrame(df).repartition(6), ["k"], ["o"], F.col("v"), "before").toPandas().sort_values("o")
    df = df.sort_values("o")
    assert got["before"].tolist() == (df.groupby("k")["v"].cumsum() - df["v"]).tolist()
    whole = running_sum(spark.createDataFrame(df), [], ["o"], F.lit(1), "nth").agg(F.max("nth"), F.count_distinct("nth")).first()
    assert tuple(whole) == (2999, 3000)


def test_measures_of_predictions(spark):
    rng = np.random.default_rng(6)
    label = rng.integers(0, 2, 400)
    score = np.round(label * .3 + rng.normal(0, .5, 400), 1)
    rows = [(int(a), int(b > .2), float(b)) for a, b in zip(label, score)] + [(1, 0, None), (None, 1, .5), (0, None, .5)]
    got = evaluation.binary(spark.createDataFrame(rows, "label int, prediction int, score double")).first()
    said = np.append(score > .2, False)
    true = np.append(label == 1, True)
    hit = (said & true).sum()
    gap = score[label == 1][:, None] - score[label == 0][None, :]
    assert (got.n_test, got.n_failed) == (401, true.sum())
    assert got.accuracy == pytest.approx((said == true).mean())
    assert got.f1 == pytest.approx(2 * hit / (said.sum() + true.sum()))
    assert (got.precision, got.recall) == (pytest.approx(hit / said.sum()), pytest.approx(hit / true.sum()))
    assert got.roc_auc == pytest.approx(((gap > 0) + .5 * (gap == 0)).mean())
    one = evaluation.binary(spark.createDataFrame([(0, 0, 1.0)], "label int, prediction int, score double")).first()
    assert (one.f1, one.roc_auc, one.accuracy) == (None, None, 1.0)
    three = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")], "label string, prediction string")
    found = evaluation.several(three).first()
    assert (found.n_test, found.n_classes, found.accuracy) == (5, 3, pytest.approx(.4))
    assert found.macro_f1 == pytest.approx((2 / 5 + 2 / 3 + 0 + 0) / 4)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_small_tables_of_machines_move_no_rows(spark):
    """Spans, newest instants and sizes of machines are stored: by their estimated size alone they were
    not broadcast on larger tables, and every pass of a model shuffled all rows."""
    from plantpulse.operators import scaling
    from plantpulse.plans import gold, supervised
    rows = stage_table(to_spark(spark, sensors()).withColumn("cycle_duration", F.lit(1.0)).withColumns(
        {c: F.lit(1.0) for c in C.SENSORS if c not in C.ROLLED + ["cycle_duration"]}))
    # More than a table of three machines, less than what is estimated for one that was not stored.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        train, test = supervised.split(rows)
        assert shuffles(train) == shuffles(test) == 0
        assert train.count() + test.count() == rows.count()
        assert shuffles(scaling.model_rows(rows.withColumn("cycle_ratio", F.lit(1.0)))) == 0
        last = gold.latest_per_machine(rows, instants=rows)
        assert shuffles(last) == 1
        assert sorted(r["row_id"] for r in last.collect()) == sorted(
            sensors().sort_values(["machine_id", "timestamp", "target_cycle"]).groupby("machine_id").tail(1)["row_id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_computed_once_for_their_slices(spark, narrow):
    """Slices are told from the stored rows: the same results, and the features are not computed for them."""
    df, events = sensors(), log()
    rows, entries = to_spark(spark, df), log_frame(spark, events)
    for attach in (interventions.attach_interventions, interventions.hours_to_next):
        plain, told = (attach(rows, entries, **more).orderBy("row_id").collect() for more in ({}, {"instants": rows.select("machine_id", "timestamp")}))
        assert plain == told
