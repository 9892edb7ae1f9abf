"""Files, serving tables, streams and the query registry."""

import gzip
import pathlib
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plantpulse.functions import scalars as S
from plantpulse.operators import scoring
from plantpulse.plans import metrics, training
from plantpulse.sources import bronze_csv, events_adapter, layers, serving
from plantpulse.streaming import live, windows


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    names = ["timestamp", "consumption_kWh", "temperature_C", "vibration", "pressure", "cycle_duration", "rpm", "voltage", "failure"]
    (tmp_path / "machine_1_targetcycle30.csv").write_text(
        ",".join(names) + "\n2026-01-01 00:00:00,1,2,3,4,5,6,7,0\n2026-01-01 01:00:00,1,2,,4,5,6,7,0\n")
    turned = names[::-1]
    (tmp_path / "MACHINE_2_targetCycle10.CSV").write_text(",".join([*turned, "note"]) + "\n0,7,6,5,4,3,2,1,2026-01-01 00:00:00,x\n")
    (tmp_path / "machine_3_targetcycle10.csv").write_text("timestamp,failure\n2026-01-01 00:00:00,0\n")
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    (tmp_path / "machine_4_targetcycle10.csv").write_text("")
    rows = bronze_csv.read_sensors(spark, str(tmp_path)).orderBy("machine_id", "row_id").collect()
    assert [(r["machine_id"], r["target_cycle"]) for r in rows] == [(1, 30), (1, 30), (2, 10)]
    assert [(r["consumption_kWh"], r["rpm"], r["timestamp"][:10]) for r in (rows[0], rows[2])] == [("1", "6", "2026-01-01")] * 2
    assert not rows[1]["vibration"]
    rejected = bronze_csv.rejected_files(spark, str(tmp_path)).collect()
    assert {pathlib.Path(r["file"]).name: r["reason"] for r in rejected} == {
        "machine_3_targetcycle10.csv": "missing columns", "notes.csv": "unknown name", "machine_4_targetcycle10.csv": "empty"}


def test_csv_of_every_layout(spark, tmp_path):
    names = ["timestamp", "consumption_kWh", "temperature_C", "vibration", "pressure", "cycle_duration", "rpm", "voltage", "failure"]
    row = "2026-01-01 00:00:00,1,2,3,4,5,6,7,0"
    files = {
        # an index column without a name, a name given twice, 70 columns, quotes, and a name with too many digits
        "machine_1_targetcycle1.csv": "," + ",".join(names) + "\n0," + row + "\n1," + row,
        "machine_2_targetcycle1.csv": ",".join([*names, "rpm"]) + "\n" + row + ",99",
        "machine_3_targetcycle1.csv": ",".join([f"x{i}" for i in range(61)] + names) + "\n" + ",".join(["-"] * 61) + "," + row,
        "machine_4_targetcycle1.csv": ",".join(f'"{n}"' for n in names) + "\n" + row.replace(",1,", ',"1",') + "\n\n",
        "machine_12345678901_targetcycle1.csv": ",".join(names) + "\n" + row,
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content)
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "machine_9_targetcycle1.csv").write_text(files["machine_2_targetcycle1.csv"])
    packed = gzip.compress((",".join(names) + "\n" + (row + "\n") * 5000).encode())
    for machine, content in ((5, packed), (6, packed[:len(packed) // 2]), (7, packed + packed), (8, b"no archive")):
        (tmp_path / f"machine_{machine}_targetcycle1.csv").mkdir()
        (tmp_path / f"machine_{machine}_targetcycle1.csv" / "part-0.csv.gz").write_bytes(content)
    rows = bronze_csv.read_sensors(spark, str(tmp_path))
    counts = {r["machine_id"]: r["count"] for r in rows.filter("rpm = '6' AND timestamp = '2026-01-01 00:00:00'").groupBy("machine_id").count().collect()}
    assert counts == {1: 2, 2: 1, 3: 1, 4: 1, 5: 5000, 7: 10000}
    reasons = {re.search("machine_([0-9]+)", r["file"])[1]: r["reason"] for r in bronze_csv.rejected_files(spark, str(tmp_path)).collect()}
    assert reasons == {"6": "unreadable", "8": "unreadable", "12345678901": "unknown name"}
    assert rows.select("machine_id", "row_id").distinct().count() == rows.count()
    plan = rows._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("Scan csv") == 5
    assert bronze_csv.read_sensors(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("text,value", [
    ("1", 1.0), ("-1.5e3", -1500.0), (" 3 ", 3.0), (".5", 0.5), ("5.", 5.0), ("+2", 2.0), ("1d", None), ("1.5f", None),
    ("0x1p3", None), ("1_000", None), ("", None), ("NaN", None), ("e5", None), ("1e", None)])
def test_numbers(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(S.parse_number(F.col("t"))).first()[0] == value


def test_appends_of_two_streams_stay_apart(spark, tmp_path):
    for stream, rows in (("a", 5), ("b", 3), ("a", 4)):
        serving.append_batch(spark.range(rows), str(tmp_path), "t", "0", stream)
    assert serving.read_table(spark, str(tmp_path), "t").count() == 4 + 3


def test_batch_without_model_fails(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no model"):
        live.score_batch(spark, spark.range(1), 0, str(tmp_path / "models"), str(tmp_path / "out"), stream="s")


def test_reading_without_any_model_is_an_error(spark, sf):
    from plantpulse.plans import training
    rows = events_adapter.sensor_data(spark, sf)
    model = training.train(rows, models="machines")
    readings = scoring.to_readings(rows.limit(5), extra=["row_id"])
    strange = readings.withColumn("machine_id", F.lit(9999))
    with pytest.raises(Exception, match="no model for global"):
        scoring.score(readings.union(strange), model.scaler, model.reference).collect()


def test_rates_of_two_replicas(spark):
    """Each replica counts for itself; one restarts."""
    rows = [(t, i, "ok", v) for i, values in (("a", [0, 5, 10]), ("b", [100, 110, 3])) for t, v in enumerate(map(float, values))]
    samples = spark.createDataFrame(rows, "t int, instance string, status string, value double").select(
        F.timestamp_seconds("t").alias("ts"), "instance", "status", "value")
    assert metrics.increase(samples, ["status"], "1970-01-01 00:01:00", 3600).first()["increase"] == 10 + 10 + 3


@pytest.mark.parametrize("name,expected", [
    ("a/machine_2_targetcycle60.csv", 60), ("Machine_2_TargetCycle7.CSV", 7), ("machine_2.csv", None), ("x.csv", None)])
def test_file_names(spark, name, expected):
    col = bronze_csv.name_part(F.lit(name), bronze_csv.SENSOR_NAME, 2)
    assert spark.range(1).select(col).first()[0] == expected


def test_clamp_bounds(spark):
    df = spark.createDataFrame([(999.0, -5.0, 99999.0, 230.0, None)],
                               "temperature_C double, vibration double, rpm double, voltage double, pressure double")
    assert tuple(scoring.clamp_sensors(df).first()) == (200.0, 0.0, 5000.0, 230.0, None)


def test_empty_input_leaves_tables(spark, sf, tmp_path):
    rows = events_adapter.sensor_data(spark, sf)
    none = events_adapter.interventions(spark, sf).limit(0)
    assert serving.refresh(rows.limit(0), none, rows, str(tmp_path)) == []
    assert serving.refresh(rows, none, rows.limit(0), str(tmp_path)) == ["sensor_data"]
    assert not layers.write_layer(rows.limit(0), str(tmp_path), "gold", "1")
    with pytest.raises(FileNotFoundError):
        layers.replay_source(spark, str(tmp_path), mode="gold")
    assert layers.registry_status(spark, str(tmp_path)).first()["status"] == "degraded"


def test_null_key_is_refused(spark, sf):
    rows = events_adapter.sensor_data(spark, sf).withColumn("machine_id", F.nullif("machine_id", F.lit(1)))
    with pytest.raises(Exception, match="null machine_id"):
        serving.check_keys(rows, "t").agg(F.sum("machine_id")).collect()


def test_counter_restart_counts_from_zero(spark):
    df = spark.createDataFrame([("a", t, v) for t, v in enumerate([5.0, 8.0, 2.0, 2.0, 6.0])], "s string, t int, value double")
    samples = df.withColumn("ts", F.timestamp_seconds(F.col("t") * 15)).drop("t")
    assert metrics.increase(samples, ["s"], "1970-01-01 00:01:00", 3600).first()["increase"] == 3 + 2 + 0 + 4


def test_bucket_quantiles(spark):
    df = spark.createDataFrame([(0.1, 10.0), (0.5, 30.0), (1.0, 40.0), (float("inf"), 40.0)], "le double, count double")
    got = {r["q"]: r["value"] for r in metrics.bucket_quantiles(df, [0.25, 0.5, 1.0]).collect()}
    assert got == pytest.approx({0.25: 0.1, 0.5: 0.3, 1.0: 1.0})


def test_windows_do_not_depend_on_batches(spark, sf, tmp_path):
    rows = events_adapter.predictions(spark, sf)
    rows.repartition(6, "event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    parts = str(tmp_path / "out")
    windows.run_batches(stream, parts, str(tmp_path / "state"), lambda b: windows.window_parts(b, "15 minutes"))
    assert spark.read.parquet(parts).agg(F.count_distinct("b")).first()[0] == 6
    streamed = windows.merged(spark.read.parquet(parts))
    batch = windows.live_windows(rows, "15 minutes")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["P02_P05_content_report", "W02_last_prediction", "J03_nearest_intervention", "ST12_latency_quantiles"])
def test_registered_queries_match_sql(spark, sf, name):
    import duckdb

    from check_queries import compare
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    df = entry.queries()[name](spark, sf)
    found = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], names, found.fetchall()) is None


def test_plans_avoid_nested_loops(spark, sf):
    for name in ("J03_nearest_intervention", "W03_W05_rolling_features", "J05_noisy_readings", "J08_scores"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2


def test_batch_job_from_files_to_scores(spark, sf, tmp_path):
    from plantpulse.plans import batch
    from plantpulse.streaming import live
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "lake")
    assert batch.ingest(spark, str(tmp_path), root, "v0") is None
    bronze_csv.write_sensors(events_adapter.bronze(spark, sf), bronze)
    bronze_csv.write_interventions(events_adapter.bronze_interventions(spark, sf), bronze)
    assert batch.ingest(spark, bronze, root, "20260101T000000Z") == "20260101T000000Z"
    gold = layers.read_latest(spark, root, "gold")
    assert gold.count() == serving.read_table(spark, f"{root}/serving", "sensor_data").count() > 1000
    assert serving.read_table(spark, f"{root}/serving", "feature_snapshot").count() == 2
    batch.retrain(spark, root, "20260101T010000Z")
    assert layers.registry_status(spark, f"{root}/models").first()["n_machines"] == 2
    live.score_batch(spark, gold, 0, f"{root}/models", f"{root}/live", stream="s")
    scored = serving.read_table(spark, f"{root}/live", "predictions")
    assert scored.count() == gold.count()
    # A batch is worked out once; what is stored is scored.
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    live.score_batch(spark, gold.mapInPandas(count, gold.schema), 1, f"{root}/models", f"{root}/counted", stream="s")
    assert seen.value == gold.count()
    # Trained on the same rows: noise in training is noise in scoring.
    assert scored.filter("anomaly_score = 0 AND anomaly").count() == 0


def test_run_metadata_trains_every_model_itself(spark, tmp_path, monkeypatch):
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i), 10 * (i % 2), "view" if i % 9 else "error", float(i % 5), '{"k": %d}' % (i % 4))
            for i in range(80)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    trained = []
    whole = training.train
    monkeypatch.setattr(training, "train", lambda gold, **given: trained.append(gold.count()) or whole(gold, **given))
    entry.queries()["A12_model_summary"](spark, str(tmp_path)).collect()
    runs = entry.queries()["S13_run_metadata"](spark, str(tmp_path)).collect()
    assert trained == [80, 80]  # the second one does not take the models of the first
    assert {r["model_key"]: r["n_train"] for r in runs} == {"1": 40, "2": 40, "global": 80}
    assert "global" in entry.oracle_sql()["S13_run_metadata"].split("fitrows", 1)[1].split("fit AS", 1)[0]


def test_files_are_listed_by_a_few_tasks(spark, tmp_path):
    """Every path had a task of its own in each of five listings."""
    names = "timestamp,consumption_kWh,temperature_C,vibration,pressure,cycle_duration,rpm,voltage,failure"
    for machine in range(1, 101):
        (tmp_path / f"machine_{machine}_targetcycle1.csv").write_text(names + "\n2026-01-01 00:00:00,1,2,3,4,5,6,7,0\n")
    spark.sparkContext.setJobGroup("listing", "")
    try:
        rows = bronze_csv.read_sensors(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(bronze_csv.LISTING_TASKS) == "10000"
    assert rows.count() == 100
