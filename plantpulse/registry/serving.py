"""Queries over serving tables and streams (A16-A32, W02, L, U, F, J05, J10, P27, P28, ST)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..functions.slices import SLICE, slice_widths, sliced
from ..operators import scoring
from ..plans import metrics
from ..plans import monitoring as M
from ..sources import events_adapter, layers, serving
from ..streaming import live, replay, windows
from .base import check, query
from .etl import scratch
from .modeling import _HITS, _QZ, _READ_STEP, _REF, _SCORED, _steps, model

# Fixed instants inside the data: "now" and a range for the dashboards.
NOW = "2024-01-30 20:00:00"
FROM, TO = "2024-01-08 00:00:00", "2024-01-22 12:00:00"
MACHINES = [1, 2, 5, 7, 11]
_IN = f"machine_id IN ({', '.join(map(str, MACHINES))})"
_DAY = f"recorded_at > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"
_QUARTER = f"recorded_at > TIMESTAMP '{NOW}' - INTERVAL 15 MINUTE"
_SPAN = f"BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'"


def _sens(spark, d):
    return events_adapter.sensor_data(spark, d)


def _pred(spark, d):
    return events_adapter.predictions(spark, d)


def _int(spark, d):
    return events_adapter.interventions(spark, d)


def simple(name, needs, select, fn, doubles=(), extra=()):
    query(name, check(needs, select, list(doubles), list(extra)))(fn)


_LAST = "SELECT * FROM pred QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY recorded_at DESC, event_id DESC) = 1"

simple("A16_machine_count", ["sens"], "SELECT count(DISTINCT machine_id) AS value FROM sens",
       lambda s, d: M.machine_count(_sens(s, d)))
simple("A17_anomalies_24h", ["pred"], f"SELECT count(*) AS value FROM pred WHERE anomaly AND {_DAY}",
       lambda s, d: M.anomaly_count(_pred(s, d), NOW, "24 HOURS"))
simple("A17_anomalies_15min", ["pred"], f"SELECT count(*) AS value FROM pred WHERE anomaly AND {_QUARTER}",
       lambda s, d: M.anomaly_count(_pred(s, d), NOW, "15 MINUTES"))
simple("A18_intervention_count", ["interv"], "SELECT count(*) AS value FROM interv", lambda s, d: M.row_count(_int(s, d)))
_NOISE = "SELECT coalesce(sum(CASE WHEN cluster_label = -1 THEN 1e0 ELSE 0e0 END) / nullif(count(*), 0), 0) AS value FROM pred WHERE "
simple("A19_noise_rate_24h", ["pred"], _NOISE + _DAY, lambda s, d: M.noise_rate(_pred(s, d), NOW, "24 HOURS"), ["value"])
simple("A19_noise_rate_15min", ["pred"], _NOISE + _QUARTER, lambda s, d: M.noise_rate(_pred(s, d), NOW, "15 MINUTES"), ["value"])
simple("A19_noise_rate_empty", ["pred"], "SELECT 0e0 AS value FROM pred LIMIT 1",
       lambda s, d: M.noise_rate(_pred(s, d), "2030-01-01 00:00:00", "15 MINUTES"))
_DAILY = "SELECT date_trunc('day', recorded_at)::TIMESTAMP AS day, alert_level, count(*) AS n_alerts FROM pred WHERE alert GROUP BY 1, 2"
simple("A20_alerts_daily", ["pred"], _DAILY, lambda s, d: M.alerts_daily(_pred(s, d)))
simple("L11_latest_alert_days", ["pred"], _DAILY + " ORDER BY day DESC, alert_level LIMIT 30", lambda s, d: M.latest_alert_days(_pred(s, d)))
_CLUSTERS = f"SELECT cluster_label, count(*) AS n_points FROM pred WHERE {_DAY} GROUP BY 1"
simple("A21_cluster_distribution", ["pred"], _CLUSTERS, lambda s, d: M.cluster_distribution(_pred(s, d), NOW))
simple("L13_cluster_bars", ["pred"], f"SELECT CAST(cluster_label AS VARCHAR) AS metric, n_points AS value FROM ({_CLUSTERS})",
       lambda s, d: M.cluster_bars(_pred(s, d), NOW))
simple("A22_max_score_per_instant", ["pred"], f"SELECT recorded_at AS time, max(anomaly_score) AS value FROM pred WHERE {_QUARTER} GROUP BY 1",
       lambda s, d: M.max_score_per_instant(_pred(s, d), NOW, "15 MINUTES"), ["value"])
simple("A23_machines_in_anomaly", ["pred"], f"SELECT count(*) AS value FROM ({_LAST}) WHERE anomaly",
       lambda s, d: M.machines_in_anomaly(_pred(s, d), "event_id"))
simple("W02_last_prediction", ["pred"], f"SELECT {', '.join(C.PREDICTION_TABLE)} FROM ({_LAST})",
       lambda s, d: M.last_prediction(_pred(s, d), "event_id"), ["anomaly_score"])
simple("L12_machine_states", ["pred"], f"""SELECT machine_id, recorded_at, cluster_label, anomaly, round(anomaly_score, 3) AS anomaly_score,
       alert_level FROM ({_LAST})""", lambda s, d: M.machine_states(_pred(s, d), "event_id"), ["anomaly_score"])
simple("A24_mean_consumption", ["sens"], f"""SELECT CAST(machine_id AS VARCHAR) AS metric, avg(consumption_kWh) AS value FROM sens
       WHERE "timestamp" {_SPAN} GROUP BY 1""", lambda s, d: M.mean_consumption(_sens(s, d), FROM, TO), ["value"])
simple("A25_predictions_per_day", ["pred"], f"""SELECT date_trunc('day', recorded_at)::TIMESTAMP AS time, alert_level AS metric, count(*) AS value
       FROM pred WHERE recorded_at {_SPAN} GROUP BY 1, 2""", lambda s, d: M.predictions_per_day(_pred(s, d), FROM, TO))
simple("A26_interventions_by_type", ["interv"], "SELECT failure_type AS metric, count(*) AS value FROM interv GROUP BY 1",
       lambda s, d: M.interventions_by_type(_int(s, d)))
simple("A27_failure_rate", ["sens"], """SELECT machine_id, round(100e0 * avg(failure), 2) AS failure_rate_percent,
       round(100e0 * avg(CAST(failure > 0 AS INTEGER)), 2) AS failed_rows_percent FROM sens GROUP BY 1""",
       lambda s, d: M.failure_rate(_sens(s, d)), ["failure_rate_percent", "failed_rows_percent"])
simple("A28_open_alerts", ["pred"], f"SELECT count(*) AS value FROM pred WHERE alert_level <> 'nominal' AND {_DAY}",
       lambda s, d: M.open_alerts(_pred(s, d), NOW))
simple("A29_verdicts", ["pred"], f"SELECT alert_level AS metric, count(*) AS value FROM pred WHERE recorded_at {_SPAN} GROUP BY 1",
       lambda s, d: M.verdicts(_pred(s, d), FROM, TO))
simple("A30_prediction_counters", ["pred"], """SELECT 'predictions' AS metric, CAST(machine_id AS VARCHAR) AS label, count(*) AS value FROM pred GROUP BY 2
       UNION ALL SELECT 'alerts', alert_level, count(*) FROM pred GROUP BY 2
       UNION ALL SELECT 'anomalies', CAST(machine_id AS VARCHAR), count(*) FROM pred WHERE anomaly GROUP BY 2""",
       lambda s, d: metrics.prediction_counters(_pred(s, d)))
simple("A31_request_counters", ["reqs"], "SELECT status, count(*) AS value FROM reqs GROUP BY 1",
       lambda s, d: metrics.request_counters(events_adapter.request_log(s, d)))
_LE = ", ".join(f"({b}e0)" for b in C.LATENCY_BOUNDS) + ", ('inf'::DOUBLE)"


def _histogram(spark, d):
    h = metrics.latency_histogram(events_adapter.request_log(spark, d))
    return h.select(F.col("le").cast("string").alias("le"), "count", "observations", "latency_sum")


simple("A32_latency_histogram", ["reqs"], f"""SELECT CASE WHEN isinf(le) THEN 'Infinity' ELSE CAST(le AS VARCHAR) END AS le,
       count(*) FILTER (latency <= le) AS count, count(latency) AS observations, sum(latency) AS latency_sum
       FROM reqs, (VALUES {_LE}) t(le) GROUP BY le""", _histogram, ["latency_sum"])

# Sorts, limits, series ----------------------------------------------------

simple("L01_time_order", ["sens"], """SELECT machine_id, "timestamp", row_number() OVER (PARTITION BY machine_id ORDER BY "timestamp", target_cycle) AS nth FROM sens""",
       lambda s, d: _ordered(s, d))


def _ordered(spark, d):
    """Rank in time order per machine, counted over slices."""
    keys = ["machine_id"]
    sensors = _sens(spark, d)
    rows = sliced(sensors, slice_widths(sensors, keys), keys)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, SLICE).agg(F.count("*").alias("n"))
    offsets = sizes.select(*keys, SLICE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    local = F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy("timestamp", "target_cycle"))
    return (rows.withColumn("local", local).join(offsets, [*keys, SLICE])
            .select("machine_id", "timestamp", (F.col("earlier") + F.col("local")).alias("nth")))


simple("L02_latest_model", ["pred"], "SELECT model_version FROM pred ORDER BY recorded_at DESC, event_id DESC LIMIT 1",
       lambda s, d: M.latest_model(_pred(s, d), "event_id"))
simple("L03_recent_anomalies", ["pred"], f"""SELECT recorded_at, machine_id, cluster_label, anomaly_score, alert_level FROM pred
       WHERE anomaly AND recorded_at > TIMESTAMP '{NOW}' - INTERVAL 15 MINUTE ORDER BY recorded_at DESC, event_id DESC LIMIT 50""",
       lambda s, d: M.recent_anomalies(_pred(s, d), NOW, "event_id"), ["anomaly_score"])
simple("L03_recent_anomalies_week", ["pred"], f"""SELECT recorded_at, machine_id, cluster_label, anomaly_score, alert_level FROM pred
       WHERE anomaly AND recorded_at > TIMESTAMP '{NOW}' - INTERVAL 7 DAY ORDER BY recorded_at DESC, event_id DESC LIMIT 50""",
       lambda s, d: M.recent_anomalies(_pred(s, d), NOW, "event_id", "7 DAYS"), ["anomaly_score"])
simple("L04_recent_interventions", ["interv"], f"""SELECT ts AS time, failure_type, temperature, vibration, pressure FROM interv
       WHERE ts {_SPAN} ORDER BY ts DESC, row_id DESC LIMIT 100""",
       lambda s, d: M.recent_interventions(_int(s, d), FROM, TO), ["temperature", "vibration", "pressure"])
simple("L05_newest_rows", ["sens"], """SELECT machine_id, "timestamp", rpm FROM sens ORDER BY "timestamp" DESC, machine_id DESC, target_cycle DESC LIMIT 4000""",
       lambda s, d: layers.newest_rows(_sens(s, d), 4000).select("machine_id", "timestamp", "rpm"), ["rpm"])
_TICKED = ("ticked", """SELECT *, dense_rank() OVER (ORDER BY hour) AS up, dense_rank() OVER (ORDER BY hour DESC) - 1 AS back
    FROM (SELECT *, date_trunc('hour', "timestamp")::TIMESTAMP AS hour FROM sens)""")


def _hourly_ticks(spark, d):
    return _sens(spark, d).withColumn("timestamp", F.date_trunc("hour", "timestamp"))


simple("L06_last_ticks", ["sens"], 'SELECT row_id, hour AS "timestamp", back AS ticks_back FROM ticked WHERE back < 60',
       lambda s, d: replay.last_ticks(_hourly_ticks(s, d), 60).select("row_id", "timestamp", "ticks_back"), extra=[_TICKED])
simple("L07_distinct_machines", ["sens"], "SELECT DISTINCT machine_id FROM sens", lambda s, d: M.distinct_values(_sens(s, d), "machine_id"))
simple("L07_distinct_types", ["interv"], "SELECT DISTINCT failure_type FROM interv", lambda s, d: M.distinct_values(_int(s, d), "failure_type"))
simple("L07_distinct_levels", ["pred"], "SELECT DISTINCT alert_level FROM pred", lambda s, d: M.distinct_values(_pred(s, d), "alert_level"))
_SIX = ["temperature_C", "vibration", "pressure", "rpm", "consumption_kWh", "voltage"]
simple("L08_sensor_series", ["sens"], " UNION ALL ".join(
    f"""SELECT "timestamp" AS time, CAST(machine_id AS VARCHAR) AS metric, '{c}' AS sensor, {c} AS value FROM sens
    WHERE {_IN} AND "timestamp" {_SPAN}""" for c in _SIX),
       lambda s, d: M.sensor_series(_sens(s, d), _SIX, MACHINES, FROM, TO), ["value"])
simple("L09_score_series", ["pred"], f"""SELECT recorded_at AS time, CAST(machine_id AS VARCHAR) AS metric, anomaly_score AS value
       FROM pred WHERE {_IN} AND recorded_at {_SPAN}""", lambda s, d: M.score_series(_pred(s, d), FROM, TO, MACHINES), ["value"])
simple("L10_machine_panel", ["sens"], f"""SELECT "timestamp" AS time, temperature_C, vibration, pressure, rpm FROM sens
       WHERE machine_id = 2 AND "timestamp" {_SPAN}""", lambda s, d: M.machine_panel(_sens(s, d), 2, FROM, TO),
       ["temperature_C", "vibration", "pressure", "rpm"])
simple("P27_predicates", ["pred"], f"""SELECT event_id FROM pred WHERE {_IN} AND recorded_at {_SPAN} AND alert_level <> 'nominal' AND cluster_label = -1""",
       lambda s, d: M.for_machines(M.in_range(_pred(s, d), "recorded_at", FROM, TO), MACHINES)
       .filter((F.col("alert_level") != "nominal") & (F.col("cluster_label") == C.NOISE)).select("event_id"))
simple("P28_cycle_ratio_series", ["sens"], f"""SELECT "timestamp" AS time, CAST(machine_id AS VARCHAR) AS metric,
       CASE WHEN target_cycle > 0 THEN cycle_duration / target_cycle ELSE 1e0 END AS value FROM sens WHERE {_IN} AND "timestamp" {_SPAN}""",
       lambda s, d: M.cycle_ratio_series(_sens(s, d), MACHINES, FROM, TO), ["value"])
simple("J05_noisy_readings", ["sens", "pred"], """SELECT "timestamp" AS time, CAST(s.machine_id AS VARCHAR) || ' (anomalie)' AS metric,
       temperature_C AS value FROM sens s JOIN pred p ON p.machine_id = s.machine_id AND p.recorded_at = s."timestamp" WHERE cluster_label = -1""",
       lambda s, d: M.noisy_readings(_sens(s, d), _pred(s, d), "temperature_C"), ["value"])


simple("J05_noisy_vibration_panel", ["sens", "pred"], f"""SELECT "timestamp" AS time, CAST(s.machine_id AS VARCHAR) || ' (anomalie)' AS metric,
       vibration AS value FROM sens s JOIN pred p ON p.machine_id = s.machine_id AND p.recorded_at = s."timestamp" WHERE cluster_label = -1
       AND s.{_IN} AND "timestamp" {_SPAN}""",
       lambda s, d: M.noisy_readings(_sens(s, d), _pred(s, d), "vibration", MACHINES, FROM, TO), ["value"])


def _lead(spark, d):
    anomalies = _pred(spark, d).filter("anomaly").withColumnRenamed("recorded_at", "timestamp")
    return M.lead_time(anomalies, _int(spark, d))


simple("J10_lead_time", ["pred", "interv"], """SELECT measure, hits, total, CAST(hits AS DOUBLE) / total AS share FROM (
       SELECT 'anomalies followed' AS measure, count(*) FILTER (EXISTS (SELECT 1 FROM ints i WHERE i.machine_id = a.machine_id
         AND i.ts >= a.t AND i.ts <= a.t + INTERVAL 24 HOUR)) AS hits, count(*) AS total FROM ano a
       UNION ALL SELECT 'interventions preceded', count(*) FILTER (EXISTS (SELECT 1 FROM ano a WHERE a.machine_id = i.machine_id
         AND a.t <= i.ts AND a.t >= i.ts - INTERVAL 24 HOUR)), count(*) FROM ints i)""", _lead, ["share"],
       [("ano", "SELECT DISTINCT machine_id, recorded_at AS t FROM pred WHERE anomaly"),
        ("ints", "SELECT DISTINCT machine_id, ts FROM interv")])

# Set operations and scalars -----------------------------------------------

simple("U01_union_all", ["sens", "pred"], """SELECT kind, count(*) AS n FROM (SELECT 'a' AS kind FROM sens UNION ALL SELECT 'b' FROM pred
       UNION ALL SELECT 'a' FROM sens) GROUP BY 1""",
       lambda s, d: _sens(s, d).select(F.lit("a").alias("kind")).unionByName(_pred(s, d).select(F.lit("b").alias("kind")))
       .unionByName(_sens(s, d).select(F.lit("a").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n")))
simple("U02_set_difference", ["pred"], """SELECT 'except' AS op, machine_id FROM (SELECT machine_id FROM pred EXCEPT SELECT machine_id FROM pred WHERE machine_id % 3 = 0)
       UNION ALL SELECT 'intersect', machine_id FROM (SELECT machine_id FROM pred INTERSECT SELECT machine_id FROM pred WHERE machine_id % 3 = 0)""",
       lambda s, d: _set_ops(_pred(s, d).select("machine_id")))


def _set_ops(ids):
    some = ids.filter(F.col("machine_id") % 3 == 0)
    return (ids.subtract(some).select(F.lit("except").alias("op"), "machine_id")
            .unionByName(ids.intersect(some).select(F.lit("intersect").alias("op"), "machine_id")))


simple("U03_key_distinct", ["pred"], "SELECT DISTINCT machine_id, cluster_label FROM pred",
       lambda s, d: _pred(s, d).select("machine_id", "cluster_label").distinct())


def _scalars(spark, d):
    p = _pred(spark, d)
    now = F.lit(NOW).cast("timestamp")
    score = F.col("anomaly_score")
    return p.select(
        "event_id", S.fixed(score, 4).alias("f04"), F.concat_ws("; ", "model_version", "alert_level").alias("f02"),
        S.strip_right(F.concat("alert_level", F.lit("; , ;")), "; ,").alias("f03"),
        F.array_contains(F.split("alert_level", "\\|"), "critical").alias("f05"),
        F.trim(F.concat(F.lit("  "), F.col("machine_id").cast("string"), F.lit(" "))).alias("f06"),
        F.date_trunc("day", "recorded_at").alias("f08"), S.hours_between(now, F.col("recorded_at")).alias("f09"),
        F.round(S.clamp(score * 2 - 0.5, 0.0, 1.0), 3).alias("f11"),
        S.small_median([score, F.when(F.col("cluster_label") > 0, F.col("cluster_label").cast("double")), F.lit(0.25)]).alias("f13"),
        S.failure_label(F.col("cluster_label")).alias("f14"), S.version_stamp(F.col("recorded_at")).alias("f15"),
        S.clamp_min(score, 0.3).alias("f18"))


simple("F01_F18_scalar_functions", ["pred"], f"""SELECT event_id, printf('%.4f', anomaly_score) AS f04, model_version || '; ' || alert_level AS f02,
       rtrim(alert_level || '; , ;', '; ,') AS f03, alert_level = 'critical' AS f05, CAST(machine_id AS VARCHAR) AS f06,
       date_trunc('day', recorded_at)::TIMESTAMP AS f08, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(recorded_at)) / 3.6e9 AS f09,
       round(least(greatest(anomaly_score * 2 - 5e-1, 0e0), 1e0), 3) AS f11,
       list_aggregate([anomaly_score, CASE WHEN cluster_label > 0 THEN CAST(cluster_label AS DOUBLE) END, 25e-2], 'median') AS f13,
       CASE cluster_label WHEN 1 THEN 'Breakage' WHEN 2 THEN 'Overheat' ELSE 'none' END AS f14,
       strftime(recorded_at, '%Y%m%dT%H%M%SZ') AS f15, greatest(anomaly_score, 3e-1) AS f18 FROM pred""", _scalars,
       ["f09", "f11", "f13", "f18"])
simple("F10_hour_series", ["interv"], """SELECT machine_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS hour FROM interv GROUP BY machine_id""",
       lambda s, d: _hours(_int(s, d)))


def _hours(log):
    spans = log.groupBy("machine_id").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    return spans.select("machine_id", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("hour"))


simple("F17_json_rows", ["pred"], """SELECT event_id, '{"machine_id":' || machine_id || ',"alert_level":"' || alert_level || '"}' AS json FROM pred""",
       lambda s, d: _pred(s, d).select("event_id", F.to_json(F.struct("machine_id", "alert_level")).alias("json")))

# Streams ------------------------------------------------------------------

_REPLAY_COLS = ["row_id", *C.SENSOR_TABLE]


_DAILY = ("daily", """SELECT *, date_trunc('day', "timestamp")::TIMESTAMP AS day FROM sens""")


@query("ST01_replay_by_time", check(["sens"], """SELECT day AS "timestamp", dense_rank() OVER (ORDER BY day) - 1 AS batch, count(*) AS n,
    sum(row_id) AS ids FROM daily GROUP BY day""", extra=[_DAILY]))
def _(spark, d):
    """Ticks of one day each, handed out one per batch; the stream is stopped half way and goes on from its checkpoint."""
    root = scratch(spark)
    rows = _sens(spark, d).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    ticks = replay.stored_ticks(replay.ticks_by_time(rows).select("row_id", "timestamp", replay.TICK))

    def handle(tick, number):
        tick.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{root}/out/b={number}")

    replay.paced(ticks, handle, f"{root}/state", last=10)
    replay.paced(ticks, handle, f"{root}/state")
    out = spark.read.parquet(f"{root}/out").drop("b")
    return out.groupBy("timestamp", "batch").agg(F.count("*").alias("n"), F.sum("row_id").alias("ids"))


simple("ST02_replay_by_rows", ["sens"], """SELECT row_id, (row_number() OVER (ORDER BY "timestamp", machine_id, target_cycle, row_id) - 1) // 7 AS tick FROM sens""",
       lambda s, d: replay.ticks_by_rows(_sens(s, d), 7).select("row_id", "tick"))


@query("ST04_live_scoring", check(["sens"], """SELECT machine_id, "timestamp" AS recorded_at, cluster_label, anomaly_score, model_version FROM (
    SELECT s.*, 'v2' AS model_version, c.cluster_label, c.anomaly_score FROM scored c JOIN sens s USING (row_id))""", ["anomaly_score"],
    [*_steps("machines"), _READ_STEP, _QZ, _REF, _HITS, _SCORED]))
def _(spark, d):
    """Stream the sensor rows, in six batches by time, through clamp, validation, scoring and storage."""
    root = scratch(spark)
    ticks = replay.ticks_by_time(_hourly_ticks(spark, d).withColumn("real", F.col("timestamp")))
    ticks = ticks.drop("timestamp").join(_sens(spark, d).select("row_id", "timestamp"), "row_id").select(*_REPLAY_COLS, replay.TICK)
    for version in ("v1", "v2"):
        layers.save_model(model(spark, d), f"{root}/models", version)

    def drain():
        stream = spark.readStream.schema(ticks.schema).parquet(f"{root}/ticks")
        live.live_scoring(stream, f"{root}/models", f"{root}/serving", f"{root}/state").awaitTermination()

    last = ticks.agg(F.max(replay.TICK)).first()[0]
    replay.replay(ticks, f"{root}/ticks", drain, last // 6 + 1)
    return serving.read_table(spark, f"{root}/serving", "predictions").select(
        "machine_id", "recorded_at", "cluster_label", "anomaly_score", "model_version")


@query("ST05_warm_up_scored", check(["sens"], """SELECT row_id, cluster_label, anomaly_score FROM scored JOIN ticked USING (row_id)
    WHERE back < 60""", ["anomaly_score"], [_TICKED, *_steps("machines"), _READ_STEP, _QZ, _REF, _HITS, _SCORED]))
def _(spark, d):
    """The ticks of the warm-up, scored as they are replayed."""
    rows = replay.warm_up(_hourly_ticks(spark, d), F.lit(NOW).cast("timestamp"))
    good, _ = scoring.valid_readings(scoring.to_readings(rows, extra=["row_id"]))
    trained = model(spark, d)
    return scoring.score(good, trained.scaler, trained.index).select("row_id", "cluster_label", "anomaly_score")


simple("ST05_warm_up", ["sens"], f"""SELECT row_id, TIMESTAMP '{NOW}' - CAST(back * 5 AS INTEGER) * INTERVAL 1 SECOND AS "timestamp" FROM ticked WHERE back < 60""",
       lambda s, d: replay.warm_up(_hourly_ticks(s, d), F.lit(NOW).cast("timestamp")).select("row_id", "timestamp"), extra=[_TICKED])


@query("ST06_sink_failure_retried", check(["pred"], "SELECT alert_level, count(*) AS n FROM pred GROUP BY 1"))
def _(spark, d):
    """The first write of a batch fails; the restarted query stores it once."""
    root = scratch(spark)
    stream = spark.readStream.schema(events_raw(spark, d).schema).parquet(f"{d}/events*.parquet")
    tried = []

    def sink(batch, batch_id):
        tried.append(batch_id)
        if len(tried) == 1:
            raise OSError("sink not reachable")
        serving.append_batch(events_adapter.predictions_of(batch), root, "predictions", str(batch_id),
                             serving.stream_name(batch.sparkSession))

    for _ in range(2):
        running = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/state")
                   .trigger(availableNow=True).start())
        try:
            running.awaitTermination()
        except Exception:  # noqa: BLE001 - the first start is meant to fail
            continue
    return serving.read_table(spark, root, "predictions").groupBy("alert_level").agg(F.count("*").alias("n"))


def events_raw(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


@query("ST07_model_swap", check(["sens"], """SELECT model_version, count(*) AS n FROM (SELECT CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN 'v1' ELSE 'v2' END
    AS model_version FROM sens WHERE target_cycle >= 1 AND consumption_kWh IS NOT NULL AND temperature_C IS NOT NULL AND cycle_duration IS NOT NULL) GROUP BY 1"""))
def _(spark, d):
    """A model saved between two batches scores the second one."""
    root = scratch(spark)
    rows = _sens(spark, d)
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for batch_id, (version, part) in enumerate((("v1", rows.filter(early)), ("v2", rows.filter(~early)))):
        layers.save_model(model(spark, d), f"{root}/models", version)
        live.score_batch(spark, part, batch_id, f"{root}/models", f"{root}/serving", stream="test")
    return (serving.read_table(spark, f"{root}/serving", "predictions")
            .groupBy("model_version").agg(F.count("*").alias("n")))


def _unordered(spark, d, files=8):
    """The events as a stream of files without any order, one file per batch."""
    folder = f"{scratch(spark)}/in"
    raw = events_raw(spark, d)
    raw.repartition(files, "event_id").write.mode("append").parquet(folder)
    return spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(folder), folder


def _streamed_windows(spark, d, length, slide=None):
    """Eight unordered batches, combined by threes."""
    root = scratch(spark)
    stream, _ = _unordered(spark, d)
    windows.run_windows(events_adapter.predictions_of(stream), f"{root}/out", f"{root}/state", length, slide, fan=3)
    return windows.read_windows(spark, f"{root}/out", fan=3)


_AGG = """count(*) AS n_points, count(*) FILTER (anomaly) AS n_anomalies,
    count(*) FILTER (cluster_label = -1) / CAST(count(*) AS DOUBLE) AS noise_rate, max(anomaly_score) AS max_score"""


@query("ST08_quarter_hour_windows", check(["pred"], f"""SELECT w AS window_start, w + INTERVAL 15 MINUTE AS window_end, {_AGG}
    FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, recorded_at) AS w FROM pred) GROUP BY w""", ["noise_rate", "max_score"]))
def _(spark, d):
    return _streamed_windows(spark, d, "15 minutes")


@query("ST08_day_windows", check(["pred"], f"""SELECT w AS window_start, w + INTERVAL 24 HOUR AS window_end, {_AGG}
    FROM (SELECT *, date_trunc('hour', recorded_at)::TIMESTAMP - CAST(b AS INTEGER) * INTERVAL 1 HOUR AS w FROM pred, range(24) r(b)) GROUP BY w""",
    ["noise_rate", "max_score"]))
def _(spark, d):
    """Windows of 24 hours, one starting every hour."""
    return _streamed_windows(spark, d, "24 hours", "1 hour")


@query("ST08_without_repeats", check(["pred"], "SELECT count(*) AS n FROM (SELECT DISTINCT machine_id, recorded_at FROM pred)"))
def _(spark, d):
    """Every row sent again in a later batch; repeats are dropped by machine and instant."""
    root = scratch(spark)
    stream, folder = _unordered(spark, d)
    rows = events_adapter.predictions_of(stream).select("machine_id", "recorded_at")
    windows.run_batches(rows, f"{root}/out", f"{root}/state")
    events_raw(spark, d).repartition(3, "ts").write.mode("append").parquet(folder)
    windows.run_batches(rows, f"{root}/out", f"{root}/state")
    return windows.without_repeats(spark.read.parquet(f"{root}/out")).agg(F.count("*").alias("n"))


# Rates: hourly samples stand in for scrapes, so windows are hours, not minutes.
AT = "2024-01-20 06:30:00"
_SAMPLE = """SELECT ts, instance, label, CAST(sum(n) OVER (PARTITION BY instance, label, date_trunc('day', ts) ORDER BY ts) AS DOUBLE) AS value
    FROM (SELECT date_trunc('hour', {ts})::TIMESTAMP AS ts, {instance} AS instance, {label} AS label, count(*){n} AS n FROM {rows} GROUP BY 1, 2, 3)"""
_SAMPLES = ("samples", _SAMPLE.format(ts="ts", instance="instance", label="status", n="", rows="reqs"))
_BUCKETS = ("samples", _SAMPLE.format(ts="ts", instance="instance", label="le", n=" FILTER (latency <= le)",
                                      rows=f"reqs, (VALUES {_LE}) t(le)"))


def _rise(hours: int) -> tuple[str, str]:
    return ("rise", f"""SELECT label, coalesce(sum(CASE WHEN value >= p THEN value - p WHEN p IS NOT NULL THEN value END), 0) AS inc
        FROM (SELECT *, lag(value) OVER (PARTITION BY instance, label ORDER BY ts) AS p FROM samples
        WHERE ts > TIMESTAMP '{AT}' - INTERVAL {hours} HOUR AND ts <= TIMESTAMP '{AT}') GROUP BY label""")


def _counters(spark, d):
    return events_adapter.counter_samples(spark, d)


simple("ST09_rate", ["reqs"], "SELECT label AS status, inc / 43200 AS rate FROM rise",
       lambda s, d: metrics.rate(_counters(s, d), ["status"], AT, 12 * 3600).select("status", F.col("rate")), ["rate"], [_SAMPLES, _rise(12)])
simple("ST10_increase", ["reqs"], "SELECT sum(inc) AS value FROM rise WHERE label <> 'ok'",
       lambda s, d: metrics.increase(_counters(s, d), ["status"], AT, 24 * 3600).filter("status <> 'ok'").agg(F.sum("increase").alias("value")),
       ["value"], [_SAMPLES, _rise(24)])
for _what, _label, _rows in (("predictions", "machine_id", "pred"), ("alerts", "alert_level", "pred"),
                            ("anomalies", "machine_id", "pred WHERE anomaly")):
    simple(f"ST10_{_what}_increase", ["pred"], f"SELECT label AS {_label}, inc AS value FROM rise",
           lambda s, d, w=_what, c=_label: metrics.increase(events_adapter.label_samples(s, d, w, c), [c], AT, 24 * 3600)
           .withColumnRenamed("increase", "value"), ["value"],
           [("samples", _SAMPLE.format(ts="recorded_at", instance="'api-' || (event_id % 2)", label=_label, n="", rows=_rows)), _rise(24)])
simple("ST11_error_ratio", ["reqs"], """SELECT coalesce(sum(inc) FILTER (label = 'error'), 0) / 43200 / greatest(sum(inc) / 43200, 1e-9) AS value FROM rise""",
       lambda s, d: metrics.error_ratio(_counters(s, d), AT, 12 * 3600), ["value"], [_SAMPLES, _rise(12)])
simple("ST12_latency_quantiles", ["reqs"], """SELECT q, CASE WHEN isinf(label) THEN low ELSE low + (label - low) * (q * total - below) / nullif(inc - below, 0) END AS value
       FROM (SELECT q, label, inc, coalesce(lag(inc) OVER w, 0) AS below, coalesce(lag(label) OVER w, 0) AS low, max(inc) OVER (PARTITION BY q) AS total
       FROM rise, (VALUES (5e-1), (95e-2), (99e-2)) t(q) WINDOW w AS (PARTITION BY q ORDER BY label))
       QUALIFY row_number() OVER (PARTITION BY q ORDER BY CASE WHEN inc >= q * total THEN 0 ELSE 1 END, label) = 1""",
       lambda s, d: metrics.latency_quantiles(events_adapter.bucket_samples(s, d), AT, 24 * 3600), ["q", "value"], [_BUCKETS, _rise(24)])
