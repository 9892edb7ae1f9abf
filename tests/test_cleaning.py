"""Behaviour of the cleaning steps on small tables."""

import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import medians
from plantpulse.functions import scalars as S
from plantpulse.operators import (cleaning, conflicts, failure_repair, hourly, imputation, interventions, outliers,
                                  validation)
from plantpulse.plans import gold as gold_plan
from plantpulse.plans import silver as silver_plan

BRONZE = "machine_id int, target_cycle int, row_id long, " + ", ".join(f"{c} string" for c in C.BUSINESS)

# Values of the seven-row sample: a null, a bad date and a conflict.
SAMPLE = [
    ("2026-03-02 10:00:00", 20.5, 55.25, 0.9, 48.0, 33.0, 1490.0, 230.5, 0),
    ("2026-03-02 11:00:00", 18.75, 52.5, 1.1, 47.5, 34.5, 1502.0, 229.0, 0),
    ("2026-03-02 12:00:00", 19.0, 60.0, 1.05, 49.0, 35.5, 1511.0, None, None),
    ("2026-03-02 13:00:00", 22.25, 58.75, 0.95, 50.5, 32.5, 1485.0, 231.5, 0),
    ("someday", 17.0, 51.0, 1.0, 46.0, 36.0, 1495.0, 228.0, 0),
    ("2026-03-02 14:00:00", 300.0, 57.0, 1.2, 51.0, 37.0, 1520.0, 227.0, 0),
    ("2026-03-02 14:00:00", 16.5, 56.0, 1.0, 49.5, 36.5, 1500.0, 232.0, 0),
]


def text(v):
    return None if v is None else str(v)


def bronze(spark, rows):
    data = [(1, 30, i, *map(text, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, BRONZE).repartition(3)


def readings(values, start="2026-01-01 00:00:00", failure=0):
    t = datetime.fromisoformat(start)
    return [(str(t + timedelta(hours=i)), v, 20.0, 1.0, 50.0, 35.0, 1500.0, 230.0, failure)
            for i, v in enumerate(values)]


def silver_rows(spark, rows, **kw):
    return silver_plan.silver(bronze(spark, rows), **kw).orderBy("timestamp").collect()


def test_sample_end_to_end(spark):
    rows = silver_rows(spark, SAMPLE)
    assert [r["timestamp"].hour for r in rows] == [10, 11, 12, 13, 14]
    conflict = rows[4]
    assert conflict["consumption_kWh"] == pytest.approx(158.25)
    assert conflict["quality_flag"] == "TIMESTAMP_CONFLICT_RESOLVED"
    assert "consumption_kWh: values=[300.0, 16.5] (n=2)" in conflict["duplicate_correction_details"]
    filled = rows[2]
    assert (filled["failure"], filled["is_failure_nan_corrected"]) == (0, 1)
    assert filled["voltage"] == pytest.approx(230.0)
    assert filled["quality_flag"] == "FAILURE_NAN_CORRECTED|NAN_CORRECTED"
    assert filled["nan_columns"] == "voltage"
    assert filled["nan_correction_details"] == "voltage filled with 230.0000"
    assert "rule=neighbours_agree" in filled["failure_nan_correction_details"]
    assert not any(r["is_outlier"] for r in rows)


def test_gold_of_sample(spark):
    silver = silver_plan.silver(bronze(spark, SAMPLE))
    log = spark.createDataFrame([
        (0, 1, "2026-03-02 14:00:00", "Breakage", "61.5", "1580.0", "2.75", "52.5"),
        (1, 1, "2026-03-03 20:00:00", "Overheat", "91.0", "1541.0", "1.5", "51.25"),
        (2, 1, "someday", "Breakage", "1", "1", "1", "1"), (3, 1, "2026-03-04 11:00:00", "Unknown", "1", "1", "1", "1"),
        (4, 1, "2026-03-04 12:00:00", " Breakage", "1", "1", "1", "1")],
        "row_id long, machine_id int, timestamp string, failure_type string, temperature string, rpm string, "
        "vibration string, pressure string")
    clean = interventions.clean_interventions(log)
    assert sorted(r["row_id"] for r in clean.collect()) == [0, 1]
    rows = gold_plan.gold(silver, clean).orderBy("timestamp").collect()
    assert [r["failure_type"] for r in rows] == ["none", "none", "none", "Breakage", "Breakage"]
    assert [r["hours_since_last_intervention"] for r in rows] == [9999.0] * 4 + [0.0]
    assert rows[0]["temperature_C_roll_std_10"] == 0 and rows[0]["temperature_C_delta"] == 0
    assert rows[1]["temperature_C_roll_mean_10"] == pytest.approx((55.25 + 52.5) / 2)


def test_grid_fills_hours(spark):
    rows = silver_rows(spark, [readings([10.0])[0], readings([10.0], "2026-01-01 03:00:00")[0]])
    assert [r["is_missing_timestamp"] for r in rows] == [0, 1, 1, 0]
    assert rows[1]["quality_flag"].startswith("MISSING_TIMESTAMP_IMPUTED")
    assert rows[0]["quality_flag"] == rows[3]["quality_flag"] == "OK"


def test_grid_is_anchored_at_the_first_row(spark):
    data = [readings([1.0], f"2026-01-01 {t}")[0] for t in ("00:30:00", "01:00:00", "02:30:00")]
    cells = silver_plan.resolved_rows(bronze(spark, data))
    got = hourly.grid(cells).orderBy("timestamp").collect()
    assert [str(r["timestamp"])[11:16] for r in got] == ["00:30", "01:30", "02:30"]
    assert [str(r["timestamp"])[11:16] for r in hourly.off_grid(cells).collect()] == ["01:00"]


def test_off_grid_cells_are_found_without_the_grid(spark):
    stamps = [(1, "2000-01-01 00:30:00"), (1, "2000-01-01 01:30:00"), (1, "2000-01-01 01:30:00.000001"), (1, "2030-06-01 00:30:00"),
              (1, "2030-06-01 01:00:00"), (1, "2030-06-01 01:00:00"), (2, "1965-01-01 00:00:00"), (2, "1964-12-31 22:59:59"),
              (None, "2026-01-01 00:00:00"), (2, None)]
    cells = spark.createDataFrame([(m, 30, t, i) for i, (m, t) in enumerate(stamps)],
                                  "machine_id int, target_cycle int, timestamp string, row_id int").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    found = hourly.off_grid(cells)
    # The grid of a few cells may hold any number of hours, which a join would take for few and broadcast.
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    lost = cells.join(hourly.grid(cells), [*C.SERIES, "timestamp"], "left_anti")
    assert sorted(map(str, found.collect())) == sorted(map(str, lost.select(*cells.columns).collect()))
    assert sorted(r["row_id"] for r in found.collect()) == [2, 4, 5, 6, 8, 9]


@pytest.mark.parametrize("codes,expected,flag", [
    ([0, None, 0], 0, "FAILURE_NAN_CORRECTED"),
    ([None, 1], 0, "UNCERTAIN_FAILURE_NAN|UNCERTAIN_FAILURE_DEFAULTED_TO_ZERO"),
    ([1, None, 0], 0, "FAILURE_NAN_CORRECTED"),
    ([1, None, 2], 0, "UNCERTAIN_FAILURE_NAN|UNCERTAIN_FAILURE_DEFAULTED_TO_ZERO"),
    ([0, 9, 0, 0], 0, "INVALID_FAILURE_VALUE|FAILURE_NAN_CORRECTED"),
])
def test_failure_repair(spark, codes, expected, flag):
    data = [(*r[:-1], c) for r, c in zip(readings([10.0] * len(codes)), codes, strict=True)]
    rows = silver_rows(spark, data, audit=False)
    at = next(i for i, c in enumerate(codes) if c in (None, 9))
    assert (rows[at]["failure"], rows[at]["quality_flag"]) == (expected, flag)


def test_transition_with_stopped_next_row(spark):
    data = [list(r) for r in readings([10.0] * 3)]
    data[0][-1], data[1][-1], data[2][-1] = 0, None, 2
    data[2][6] = 0.0
    assert silver_rows(spark, data, audit=False)[1]["failure"] == 2


def test_outlier_at_two_sigma(spark):
    rows = silver_rows(spark, readings([15.0] * 9 + [500.0]), sigma=2)
    assert rows[9]["outlier_columns"] == "consumption_kWh"
    assert rows[9]["consumption_kWh"] == 15.0
    assert rows[9]["quality_flag"] == "OUTLIER_DETECTED|OUTLIER_CORRECTED"
    assert "consumption_kWh 500.0000 replaced by 15.0000" in rows[9]["correction_details"]


def test_failed_rows_are_no_outliers(spark):
    data = readings([15.0] * 9) + readings([500.0], "2026-01-01 09:00:00", failure=1)
    assert not any(r["is_outlier"] for r in silver_rows(spark, data, sigma=2))


def test_imputation_uses_neighbours(spark):
    assert silver_rows(spark, readings([50.0, 51.0, None, 53.0, 52.0]))[2]["consumption_kWh"] == 51.5


@pytest.mark.parametrize("values,verdict", [
    ([0, 0, 1, 1, 2], None), ([0, 1], 1), ([1, 2], None), ([0, 0, 2], 0), ([None, None], None), ([0, 2, None], 2)])
def test_failure_verdict(spark, values, verdict):
    n = [F.lit(sum(v == k for v in values)) for k in (0, 1, 2)]
    assert spark.range(1).select(S.failure_verdict(*n)).first()[0] == verdict


def test_all_dates_missing(spark):
    data = [(None, *r[1:]) for r in readings([1.0, 2.0, 3.0])]
    assert silver_plan.resolved_rows(bronze(spark, data)).count() == 0


def test_validation_report(spark):
    data = [("2026-01-01", *r[1:]) if i == 0 else (None, *r[1:]) for i, r in enumerate(readings([1.0, -2.0, "x"]))]
    got = {(r["column"], r["check"]): r["n"] for r in validation.content_report(bronze(spark, data)).collect()}
    assert got[("timestamp", "missing")] == 2 and got[("timestamp", "duplicate")] == 1
    assert got[("consumption_kWh", "unparseable")] == 1 and got[("consumption_kWh", "below")] == 1
    assert validation.unexpected_failures(bronze(spark, data)).count() == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="consumption_kWh"):
        cleaning.type_bronze(bronze(spark, SAMPLE).drop("consumption_kWh"))


def test_audit_columns_fill_gaps(spark):
    df = spark.createDataFrame([("X",), (None,)], "quality_flag string")
    rows = cleaning.with_audit_columns(df).collect()
    assert sorted(r["quality_flag"] for r in rows) == ["OK", "X"] and set(C.AUDIT_DEFAULTS) <= set(rows[0].asDict())


def sequential_fill(values, outlier):
    values = list(values)
    for i, v in enumerate(values):
        if v is None:
            near = [values[j] for j in (i - 2, i - 1, i + 1, i + 2)
                    if 0 <= j < len(values) and values[j] is not None and not outlier[j]]
            values[i] = statistics.median(near) if near else None
    return values


@pytest.mark.parametrize("gap", [0.2, 0.6, 0.93])
def test_imputation_equals_the_sequential_loop(spark, gap):
    rnd = random.Random(gap)
    start = datetime(2026, 1, 1)
    rows, expected = [], {}
    for machine in range(1, 13):
        n = rnd.choice([3, 40, 2200])  # the long one crosses slices
        outlier = [rnd.random() < 0.1 for _ in range(n)]
        columns = {c: [None if rnd.random() < gap else round(rnd.uniform(-9, 9), 3) for _ in range(n)]
                   for c in C.SENSORS}
        columns["voltage"] = [None] * n if machine % 4 == 0 else columns["voltage"]
        for i in range(n):
            rows.append((machine, 30, start + timedelta(hours=i), int(outlier[i]), *[columns[c][i] for c in C.SENSORS]))
        expected[machine] = {c: sequential_fill(v, outlier) for c, v in columns.items()}
    schema = "machine_id int, target_cycle int, timestamp timestamp, is_outlier int, " + ", ".join(
        f"{c} double" for c in C.SENSORS)
    got = imputation.impute(spark.createDataFrame(rows, schema).repartition(7)).toPandas()
    assert len(got) == len(rows)
    for machine, part in got.sort_values("timestamp").groupby("machine_id"):
        for c in C.SENSORS:
            want = expected[machine][c]
            have = [None if v != v else v for v in part[c].astype(float)]
            assert [h is None for h in have] == [w is None for w in want]
            assert [h for h in have if h is not None] == pytest.approx([w for w in want if w is not None])


@pytest.mark.parametrize("bracket", [1, None])
def test_medians_are_exact(spark, bracket):
    rnd = random.Random(4)
    data = [(k, rnd.choice([rnd.gauss(0, 1), 3.5, None])) for k in (1, 2, 3) for _ in range(4000 + k)]
    df = spark.createDataFrame(data, "k int, v double").repartition(6)
    got = {r["k"]: r["v"] for r in medians.exact_medians(df, ["k"], ["v"], bracket=bracket).collect()}
    for k in (1, 2, 3):
        assert got[k] == pytest.approx(statistics.median(v for q, v in data if q == k and v is not None))


def test_narrowed_cells_give_the_same_result(spark, monkeypatch):
    rnd = random.Random(8)
    data = [(str(datetime(2026, 1, 1, h)), *[round(rnd.uniform(1, 9), 2) for _ in C.SENSORS], rnd.choice([0, 0, 1]))
            for h in range(4) for _ in range(60)]
    typed = cleaning.type_bronze(bronze(spark, data))
    a = conflicts.resolve_conflicts(typed, audit=False).orderBy("timestamp").collect()
    monkeypatch.setattr(medians, "BRACKET_VALUES", 1)
    monkeypatch.setattr(medians, "PARTS", 4)
    b = conflicts.resolve_conflicts(typed, audit=False).orderBy("timestamp").collect()
    assert a == b


def test_copies_keep_the_first_row(spark):
    data = [SAMPLE[0]] * 500 + [SAMPLE[1]]
    got = conflicts.drop_exact_copies(cleaning.type_bronze(bronze(spark, data))).collect()
    assert sorted(r["row_id"] for r in got) == [0, 500]


def test_bounds_need_spread(spark):
    rows = spark.createDataFrame([(1, 30, 0, *[1.0] * 7)], "machine_id int, target_cycle int, failure int, " + ", ".join(
        f"{c} double" for c in C.SENSORS))
    assert outliers.normal_bounds(rows).first()["low_rpm"] is None


def test_repair_is_blind_to_partitioning(spark):
    base = silver_plan.resolved_rows(bronze(spark, SAMPLE), audit=False)
    a = failure_repair.repair_failure(hourly.complete_hours(base)).orderBy("timestamp").collect()
    b = failure_repair.repair_failure(hourly.complete_hours(base.repartition(5))).orderBy("timestamp").collect()
    assert a == b


def test_uneven_files_are_written_in_parts(spark, monkeypatch):
    """No file of a machine holds all its rows, and broken ones are found."""
    from plantpulse.registry import etl
    from plantpulse.sources import bronze_csv, events_adapter
    given = events_adapter.bronze
    monkeypatch.setattr(events_adapter, "bronze", lambda *a: given(*a).repartition(3, "row_id"))
    folder = etl._uneven_files(spark, "/root/testdata/sf0.01")
    found = [(r["file"], r["reason"]) for r in bronze_csv.inspect_files(spark, folder).collect()]
    reasons = {k: [r for f, r in found if f"machine_{k}_targetcycle" in f.lower()] for k in (1, 2, 3, 4)}
    assert reasons == {1: ["missing columns"] * 3, 2: [None] * 3, 3: [None] * 3, 4: ["unreadable"] * 3}


def test_bronze_files_do_not_multiply_by_tasks(spark, tmp_path):
    """Rows of all machines in every task: about one file a machine, rows in the order they came."""
    from plantpulse.sources import bronze_csv
    rows = spark.range(0, 3000, 1, 20).select(
        (F.col("id") % 30 + 1).alias("machine_id"), F.lit(10).alias("target_cycle"), F.col("id").cast("string").alias("timestamp"),
        *[F.lit("1").alias(c) for c in C.BUSINESS if c != "timestamp"])
    bronze_csv.write_sensors(rows, str(tmp_path))
    assert len(list(tmp_path.glob("*/*.csv"))) <= 30 + 20
    back = bronze_csv.read_sensors(spark, str(tmp_path)).orderBy("row_id").collect()
    assert len(back) == 3000
    for k in range(1, 31):
        times = [int(r["timestamp"]) for r in back if r["machine_id"] == k]
        assert times == list(range(k - 1, 3000, 30))


def test_many_small_files_are_written_by_several_tasks(spark, tmp_path):
    """Few bytes, many names: the writing is still spread over tasks, and no row is lost."""
    from plantpulse.sources import bronze_csv
    rows = spark.range(200).selectExpr("cast(id % 40 as int) AS machine_id", *[f"cast(id as string) AS {c}"
                                       for c in bronze_csv.INTERVENTION_COLUMNS])
    bronze_csv.write_interventions(rows, str(tmp_path))
    tasks = {f.name.split("-")[1] for f in tmp_path.glob("*/part-*.csv")}
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = bronze_csv.read_interventions(spark, str(tmp_path))
    assert back.select("machine_id", "rpm").exceptAll(rows.select("machine_id", "rpm")).count() == 0
    assert back.count() == 200


def test_compressed_files_are_checked_piece_by_piece(spark, tmp_path):
    """Cut anywhere, in the trailer too; several archives in one file; small batches."""
    import gzip

    from plantpulse.sources import bronze_csv
    header = ",".join(C.BUSINESS).encode() + b"\n"
    rnd = random.Random(3)
    body = gzip.compress(header + b"".join(b"%d,1,2,3,4,5,6,7,0\n" % rnd.getrandbits(60) for _ in range(20_000)))
    line = body.index(b"\n", len(body) // 2)
    cases = {1: body, 2: body + gzip.compress(b"1\n") + body, 3: body[:-1], 4: body[:-9], 5: body[:line], 6: body[:line + 1],
             7: body + body[:-3], 8: body + b"\n", 9: body[:1]}
    for k, content in cases.items():
        (tmp_path / f"machine_{k}_targetcycle1.csv").mkdir()
        (tmp_path / f"machine_{k}_targetcycle1.csv" / "part-0.csv.gz").write_bytes(content)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = bronze_csv.inspect_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    usable = sorted(int(r["file"].split("machine_")[1].split("_")[0]) for r in rows if r["reason"] is None)
    assert len(rows) == 9 and usable == [1, 2]


def test_rows_of_part_files_are_numbered_apart(spark, tmp_path):
    """Part files of one series, in several blocks each: numbers are unique and in the order of files and lines."""
    from plantpulse.sources import bronze_csv
    header = ",".join(C.BUSINESS) + "\n"
    folder = tmp_path / "machine_1_targetcycle30.csv"
    folder.mkdir()
    for part in range(3):
        lines = [f"{part * 20_000 + k},1,2,3,4,5,6,7,0\n" for k in range(20_000)]
        (folder / f"part-{part}.csv").write_text(header + "".join(lines))
    (tmp_path / "machine_2_targetcycle30.csv").write_text(header + "7,1,2,3,4,5,6,7,0\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "131072")
    try:
        rows = bronze_csv.read_sensors(spark, str(tmp_path))
        got = [(r["row_id"], int(r["timestamp"])) for r in rows.filter("machine_id = 1").orderBy("row_id").collect()]
        assert rows.filter("machine_id = 2").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({i for i, _ in got}) == 60_000 and [n for _, n in got] == list(range(60_000))


def test_gaps_are_filled_alike_in_any_batches(spark):
    """The state goes from batch to batch; a long gap ends in one value, as the plain loop has it."""
    rnd = random.Random(12)
    for n, gap in ((1, 1.0), (700, 1.0), (3000, 0.5), (3000, 0.97)):
        values = [None if rnd.random() < gap else rnd.uniform(-9, 9) for _ in range(n)]
        if n > 3:
            values[200:650] = [None] * 450
            values[196:200], values[650:652] = [1.0, None, 3.0, -7.5], [4.0, 5.0]
        outlier = [rnd.random() < 0.05 for _ in range(n)]
        usable = [np.nan if v is None or o else v for v, o in zip(values, outlier, strict=True)]
        at = [i for i in range(n) if values[i] is None]
        pick = lambda i: usable[i] if 0 <= i < n else np.nan
        gone = lambda i: 0 <= i < n and values[i] is None
        known = np.array([[pick(i - 1), pick(i - 2), pick(i + 1), pick(i + 2)] for i in at])
        marks = [np.array([f(i) for i in at], bool) for f in (
            lambda i: gone(i - 1), lambda i: gone(i - 2), lambda i: not outlier[i])]  # noqa: B023
        expected = sequential_fill(values, outlier)
        for size in (1, 7, n):
            state, got = (np.nan, np.nan), []
            for a in range(0, len(at), size):
                part, state = imputation.fold(known[a:a + size], *[m[a:a + size] for m in marks], state)
                got += part.tolist()
            assert [None if v != v else v for v in got] == [expected[i] for i in at]


def test_a_sensor_that_never_reports_makes_no_long_row(spark):
    """150 000 empty hours between two readings: values as the plain loop, and no array in the plan."""
    hours = spark.range(150_000).select(
        F.lit(1).alias("machine_id"), F.lit(30).alias("target_cycle"),
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"), F.lit(0).alias("is_outlier"),
        *[F.when(F.col("id").isin(0, 1, 149_999), F.col("id") % 7 * 1.5 + k).alias(c) for k, c in enumerate(C.SENSORS)])
    done = imputation.impute(hours)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan
    got = done.groupBy().agg(*[F.count(c).alias(c) for c in C.SENSORS], F.count_distinct("rpm").alias("values")).first()
    assert [got[c] for c in C.SENSORS] == [150_000] * len(C.SENSORS) and 3 < got["values"] < 80
    first = [r["rpm"] for r in done.orderBy("timestamp").select("rpm").limit(500).collect()]
    k = C.SENSORS.index("rpm")
    expected = sequential_fill([float(k), 1.5 + k] + [None] * 500, [False] * 502)
    assert first == expected[:500]
