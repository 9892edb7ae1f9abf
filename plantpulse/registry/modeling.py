"""Queries for training, clustering and scoring (P17-P26, A08-A15, J07-J09, S12-S14, ML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalars as S
from ..operators import dbscan, scaling, scoring
from ..operators.scaling import KEY
from ..plans import batch, evaluation, supervised, training
from ..session import stage_table
from ..sources import bronze_csv, events_adapter, layers
from .base import KEPT, check, each, forget, query  # noqa: F401 - `forget` is asked for here
from .etl import _GOLD_SQL, _GOLD_STEPS, _silver_and_gold, scratch

_F = ", ".join(C.FEATURES)
_LIMIT = C.EPS ** 2


def _gap(a: str, b: str) -> str:
    return " + ".join(f"({a}.z_{c} - {b}.z_{c}) ** 2" for c in C.FEATURES)


def _steps(models: str, eps: float = C.EPS, least: int = C.MIN_SAMPLES) -> list[tuple[str, str]]:
    """SQL of a whole fit: quadratic neighbour search and label spreading."""
    own = f"""SELECT m.*, CAST(machine_id AS VARCHAR) AS model_key FROM mat m WHERE machine_id IN
        (SELECT machine_id FROM mat GROUP BY machine_id HAVING count(*) >= {2 * least})"""
    parts = {"machines": own, "global": "SELECT mat.*, 'global' AS model_key FROM mat"}
    rows = " UNION ALL ".join(parts[m] for m in (["machines", "global"] if models == "all" else [models]))
    return [
        ("rated", "SELECT *, coalesce(cycle_duration / nullif(target_cycle, 0), 1e0) AS cycle_ratio FROM sens"),
        ("med", f"SELECT {each('median({c}) AS d_{c}', C.FEATURES)} FROM rated"),
        ("mat", f"""SELECT row_id, machine_id, target_cycle, "timestamp", {each('coalesce({c}, d_{c}) AS {c}', C.FEATURES)} FROM rated, med"""),
        ("fitrows", rows),
        ("fit", f"""SELECT model_key, count(*) AS n_rows, {each('''avg({c}) AS mean_{c},
            CASE WHEN stddev_pop({c}) <= 1e-12 * abs(avg({c})) OR stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS scale_{c}''', C.FEATURES)}
            FROM fitrows GROUP BY model_key"""),
        ("z", f"""SELECT model_key, row_id, machine_id, row_number() OVER (PARTITION BY model_key ORDER BY machine_id, "timestamp", target_cycle) AS n,
            {each('({c} - mean_{c}) / scale_{c} AS z_{c}', C.FEATURES)} FROM fitrows JOIN fit USING (model_key)"""),
        ("near", f"""SELECT a.model_key, a.n AS a, b.n AS b FROM z a JOIN z b ON a.model_key = b.model_key
            AND {_gap('a', 'b')} <= {eps ** 2}"""),
        ("core", f"SELECT model_key, a AS n FROM near GROUP BY ALL HAVING count(*) >= {least}"),
        ("edge", """SELECT e.* FROM near e JOIN core x ON x.model_key = e.model_key AND x.n = e.a
            JOIN core y ON y.model_key = e.model_key AND y.n = e.b WHERE e.a <> e.b"""),
        ("cc(model_key, n, comp) USING KEY (model_key, n) AS", """(SELECT model_key, n, n FROM core UNION
            (SELECT e.model_key, e.b, min(c.comp) FROM cc c JOIN edge e ON e.model_key = c.model_key AND e.a = c.n
             JOIN recurring.cc r ON r.model_key = e.model_key AND r.n = e.b WHERE c.comp < r.comp GROUP BY 1, 2))"""),
        ("clus", "SELECT model_key, n, dense_rank() OVER (PARTITION BY model_key ORDER BY comp) - 1 AS cluster FROM cc"),
        ("lab", """SELECT z.*, c.n IS NOT NULL AS is_core, CAST(coalesce(c.cluster, b.cluster, -1) AS BIGINT) AS cluster_label FROM z
            LEFT JOIN clus c ON c.model_key = z.model_key AND c.n = z.n
            LEFT JOIN (SELECT e.model_key, e.a AS n, min(k.cluster) AS cluster FROM near e JOIN clus k ON k.model_key = e.model_key
             AND k.n = e.b GROUP BY 1, 2) b ON b.model_key = z.model_key AND b.n = z.n"""),
    ]


def _until(name: str, steps: list[tuple[str, str]]) -> list[tuple[str, str]]:
    names = [n.split("(")[0] for n, _ in steps]
    return steps[:names.index(name) + 1]


_CACHE: dict[tuple, training.Model] = {}
_SENSORS: dict[tuple, DataFrame] = {}
KEPT += [_CACHE, _SENSORS]


def _state(spark, d) -> tuple:
    """The session and the state of the given files: changed data is trained anew."""
    files = spark.read.parquet(f"{d}/events.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    seen = files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    return (spark.sparkContext.applicationId, d, *seen)


def stored_sensors(spark, d) -> DataFrame:
    """The sensor rows as a stored table, as in service. As a bare projection,
    every pushed filter would parse the JSON of `events` again."""
    key = _state(spark, d)
    if key not in _SENSORS:
        _SENSORS[key] = stage_table(events_adapter.sensor_data(spark, d))
    return _SENSORS[key]


def model(spark, d, models="machines", eps=C.EPS) -> training.Model:
    """Trained once per query and data set, so no query lives on the training of another; its tables are staged files."""
    key = (*_state(spark, d), models, eps)
    if key not in _CACHE:
        _CACHE[key] = training.train(stored_sensors(spark, d), eps=eps, models=models)
    return _CACHE[key]


def _scaled(spark, d, models="machines"):
    return training.scaled_rows(stored_sensors(spark, d), models=models)[0]


def _matrix_with_ids(spark, d):
    return scaling.model_matrix(stored_sensors(spark, d))


@query("P17_cycle_ratio", check(["sens"], """SELECT row_id, coalesce(cycle_duration / nullif(target_cycle, 0), 1e0) AS training_ratio,
    CASE WHEN target_cycle > 0 THEN cycle_duration / target_cycle ELSE 1e0 END AS panel_ratio FROM sens""",
    ["training_ratio", "panel_ratio"]))
def _(spark, d):
    c, t = F.col("cycle_duration"), F.col("target_cycle")
    return events_adapter.sensor_data(spark, d).select(
        "row_id", S.cycle_ratio(c, t).alias("training_ratio"), S.cycle_ratio_panel(c, t).alias("panel_ratio"))


@query("P18_P19_model_matrix", check(["sens"], f"SELECT row_id, {_F} FROM mat", C.FEATURES, _until("mat", _steps("machines"))))
def _(spark, d):
    return _matrix_with_ids(spark, d).select("row_id", *C.FEATURES)


@query("A08_scaler", check(["sens"], "SELECT * FROM fit", [f"{p}_{c}" for c in C.FEATURES for p in ("mean", "scale")],
                           _until("fit", _steps("all"))))
def _(spark, d):
    return scaling.fit_scaler(scaling.model_rows(_matrix_with_ids(spark, d)))


@query("F16_standardise", check(["sens"], f"SELECT model_key, row_id, {each('z_{c}', C.FEATURES)} FROM z",
                                [f"z_{c}" for c in C.FEATURES], _until("z", _steps("machines"))))
def _(spark, d):
    rows = _matrix_with_ids(spark, d).withColumn(KEY, F.col("machine_id").cast("string"))
    return scaling.standardise(rows, scaling.fit_scaler(rows)).select(
        KEY, "row_id", *[f"z_{c}" for c in C.FEATURES])


@query("A14_trainable_machines", check(["sens"], "SELECT model_key, count(*) AS n FROM fitrows GROUP BY ALL",
                                       extra=_until("fitrows", _steps("all", least=330))))
def _(spark, d):
    rows = scaling.model_rows(_matrix_with_ids(spark, d), min_samples=330)
    return rows.groupBy(KEY).agg(F.count("*").alias("n"))




def _labelled(spark, d):
    trained = model(spark, d)
    return dbscan.label_rows(_scaled(spark, d), trained.points)


_LABELLED = check(["sens"], """SELECT l.model_key, s."timestamp", CAST(is_core AS INTEGER) AS is_core, cluster_label
    FROM lab l JOIN sens s USING (row_id)""", extra=_steps("machines"))


@query("J07_A09_core_rows", check(["sens"], """SELECT z.model_key, s."timestamp", CAST(c.n IS NOT NULL AS INTEGER) AS is_core
    FROM z JOIN sens s USING (row_id) LEFT JOIN core c ON c.model_key = z.model_key AND c.n = z.n""",
    extra=_until("core", _steps("machines"))))
def _(spark, d):
    """Rows with at least min_samples rows within eps, per machine."""
    scaled = stage_table(_scaled(spark, d))
    return scaled.join(dbscan.core_points(scaled), [KEY, *dbscan.Z]).select(
        KEY, "timestamp", F.col("is_core").cast("int").alias("is_core"))


@query("A10_A11_cluster_labels", _LABELLED)
def _(spark, d):
    return _labelled(spark, d).select(KEY, "timestamp", F.col("is_core").cast("int").alias("is_core"), "cluster_label")


_SUMMARY = """SELECT model_key, count(*) AS n_train,
    CASE WHEN count(*) FILTER (cluster_label <> -1) > 0 THEN count(*) FILTER (cluster_label <> -1) ELSE count(*) END AS n_core,
    avg(CAST(cluster_label = -1 AS INTEGER)) AS anomaly_rate,
    count(DISTINCT CASE WHEN cluster_label <> -1 THEN cluster_label END) AS n_clusters FROM lab GROUP BY ALL"""


@query("A12_model_summary", check(["sens"], _SUMMARY, ["anomaly_rate"], _steps("machines")))
def _(spark, d):
    return model(spark, d).summary


@query("A12_cluster_counts", check(["sens"], "SELECT model_key, cluster_label, count(*) AS n_points FROM lab GROUP BY ALL",
                                   extra=_steps("machines")))
def _(spark, d):
    return dbscan.cluster_counts(model(spark, d).points)


@query("A13_all_noise_reference", check(["sens"], """SELECT l.model_key, count(*) AS n_reference, min(cluster_label) AS lowest
    FROM lab l JOIN (SELECT model_key, max(cluster_label) AS top FROM lab GROUP BY ALL) USING (model_key)
    WHERE top = -1 OR cluster_label <> -1 GROUP BY ALL""", extra=_steps("machines", 0.7)))
def _(spark, d):
    """A small eps leaves some machines with noise only; they keep every point."""
    reference = model(spark, d, eps=0.7).reference
    return reference.groupBy(KEY).agg(F.sum("weight").alias("n_reference"), F.min("cluster_label").alias("lowest"))


@query("A15_global_model", check(["sens"], _SUMMARY, ["anomaly_rate"], _steps("global")))
def _(spark, d):
    """One scaler and one clustering over all machines."""
    return model(spark, d, "global").summary


_READ_STEP = ("reads", """SELECT *, cycle_duration / target_cycle AS cycle_ratio FROM sens WHERE target_cycle >= 1
    AND consumption_kWh IS NOT NULL AND temperature_C IS NOT NULL AND cycle_duration IS NOT NULL""")
_QZ = ("qz", f"""SELECT row_id, f.model_key, {each('({c} - mean_{c}) / scale_{c} AS z_{c}', C.FEATURES)}
    FROM reads r JOIN fit f ON f.model_key = CAST(r.machine_id AS VARCHAR)""")
_REF = ("refs", """SELECT l.* FROM lab l JOIN (SELECT model_key, max(cluster_label) AS top FROM lab GROUP BY ALL) USING (model_key)
    WHERE top = -1 OR cluster_label <> -1""")
_HITS = ("hits", f"""SELECT q.row_id, min({_gap('q', 'r')}) AS g, arg_min(r.cluster_label, {_gap('q', 'r')}) AS label
    FROM qz q JOIN refs r ON q.model_key = r.model_key GROUP BY q.row_id""")
_SCORED = ("scored", f"""SELECT row_id, CASE WHEN g <= {_LIMIT} THEN label ELSE -1 END AS cluster_label,
    least(sqrt(g) / {C.EPS}, 1e0) AS anomaly_score FROM hits""")


def _readings(spark, d):
    rows = stored_sensors(spark, d)
    good, _ = scoring.valid_readings(scoring.to_readings(rows, extra=["row_id", "timestamp"]))
    return good


@query("J08_scores", check(["sens"], """SELECT row_id, cluster_label, anomaly_score, cluster_label = -1 AS alert,
    CASE WHEN cluster_label <> -1 THEN 'nominal' WHEN anomaly_score >= 0.9 THEN 'critical' ELSE 'warning' END AS alert_level
    FROM scored""", ["anomaly_score"], [*_steps("machines"), _READ_STEP, _QZ, _REF, _HITS, _SCORED]))
def _(spark, d):
    """Nearest reference point within eps, per machine model."""
    m = model(spark, d)
    scored = scoring.score(_readings(spark, d), m.scaler, m.index)
    return scored.select("row_id", "cluster_label", "anomaly_score", "alert", "alert_level")


@query("J09_model_lookup", check(["sens"], """SELECT r.row_id, coalesce(f.model_key, 'global') AS model_key FROM reads r
    LEFT JOIN fit f ON f.model_key = CAST(r.machine_id AS VARCHAR)""", extra=[*_until("fit", _steps("all", least=330)), _READ_STEP]))
def _(spark, d):
    """Machines with too few rows fall back to the global model."""
    scaler = scaling.fit_scaler(scaling.model_rows(_matrix_with_ids(spark, d), min_samples=330))
    return scoring.choose_model(_readings(spark, d), scaler).select("row_id", KEY)


_FALLBACK = [*_steps("all", least=330), _READ_STEP,
             ("qz", f"""SELECT row_id, f.model_key, {each('({c} - mean_{c}) / scale_{c} AS z_{c}', C.FEATURES)}
    FROM (SELECT r.*, coalesce(o.model_key, 'global') AS chosen FROM reads r LEFT JOIN fit o ON o.model_key = CAST(r.machine_id AS VARCHAR)) r
    JOIN fit f ON f.model_key = r.chosen"""), _REF, _HITS, _SCORED]


@query("J09_fallback_scores", check(["sens"], f"""SELECT row_id, q.model_key, cluster_label, anomaly_score,
    cluster_label = -1 AS alert FROM scored JOIN qz q USING (row_id)""", ["anomaly_score"], _FALLBACK))
def _(spark, d):
    """All readings scored, those of machines with too few rows by the global model."""
    m = training.train(stored_sensors(spark, d), min_samples=330, models="all")
    scored = scoring.score(_readings(spark, d), m.scaler, m.index)
    return scored.select("row_id", KEY, "cluster_label", "anomaly_score", "alert")


def _odd(spark, d):
    """Sensor rows pushed out of bounds here and there."""
    far = F.when(F.col("row_id") % 10 == 0, 30.0).otherwise(1.0)
    rows = events_adapter.sensor_data(spark, d)
    return rows.withColumns({"temperature_C": (F.col("temperature_C") - 40.0) * far,
                             "rpm": F.col("rpm") * far, "vibration": F.col("vibration") - 1.1,
                             "target_cycle": F.when(F.col("row_id") % 7 != 0, F.col("target_cycle")),
                             "failure": F.when(F.col("row_id") % 11 != 0, F.col("failure"))})


_ODD = ("odd", """SELECT * REPLACE ((temperature_C - 40) * far AS temperature_C, rpm * far AS rpm, vibration - 11e-1 AS vibration,
    CASE WHEN row_id % 7 <> 0 THEN target_cycle END AS target_cycle, CASE WHEN row_id % 11 <> 0 THEN failure END AS failure)
    FROM (SELECT *, CASE WHEN row_id % 10 = 0 THEN 30e0 ELSE 1e0 END AS far FROM sens)""")


def _clip(c: str) -> str:
    lo, hi = C.READING_LIMITS[c]
    return f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {lo}), {hi}) END AS {c}"


_WRONG = [("machine_id", "machine_id IS NULL OR machine_id < 1"),
          ("target_cycle", "target_cycle IS NULL OR target_cycle < 1 OR target_cycle > 10000"),
          *[(c, f"{c} IS NULL OR {c} < {lo} OR {c} > {hi}") for c, (lo, hi) in C.READING_LIMITS.items()]]


@query("P20_reading_validation", check(["sens"], f"""SELECT row_id, coalesce(array_to_string([{', '.join(f"CASE WHEN {w} THEN '{c}' END" for c, w in _WRONG)}], ','), '')
    AS problems FROM odd""", extra=[_ODD]))
def _(spark, d):
    good, bad = scoring.valid_readings(_odd(spark, d))
    return (good.select("row_id", F.lit("").alias("problems"))
            .unionByName(bad.select("row_id", F.array_join("problems", ",").alias("problems"))))


@query("P21_P22_sensor_records", check(["sens"], f"""SELECT machine_id, coalesce(target_cycle, 30) AS target_cycle,
    TIMESTAMP '2026-01-01 00:00:00' AS "timestamp", {", ".join(_clip(c) for c in C.SENSORS)}, coalesce(failure, 0) AS failure FROM odd""",
    list(C.SENSORS), [_ODD]))
def _(spark, d):
    """Clamped and re-stamped rows in the serving shape (ST03)."""
    return scoring.sensor_records(_odd(spark, d), F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query("P23_readings", check(["sens"], f"SELECT machine_id, coalesce(target_cycle, 30) AS target_cycle, {', '.join(_clip(c) for c in C.SENSORS)} FROM odd",
                             list(C.SENSORS), [_ODD]))
def _(spark, d):
    return scoring.to_readings(_odd(spark, d))


@query("P26_alert_level", check(["pred"], """SELECT event_id, alert_level, CASE WHEN NOT anomaly THEN 'nominal'
    WHEN anomaly_score >= 95e-2 THEN 'critical' ELSE 'warning' END AS strict_level FROM pred"""))
def _(spark, d):
    p = events_adapter.predictions(spark, d)
    return p.select("event_id", "alert_level",
                    S.alert_level(F.col("anomaly"), F.col("anomaly_score"), 0.95).alias("strict_level"))


@query("S12_model_round_trip", check(["sens"], """SELECT row_id, cluster_label, anomaly_score FROM scored""", ["anomaly_score"],
                                     [*_steps("machines"), _READ_STEP, _QZ, _REF, _HITS, _SCORED]))
def _(spark, d):
    """Score with a model that was saved and loaded."""
    root = scratch(spark)
    layers.save_model(model(spark, d), root, "20260101T000000Z", "gold")
    _, scaler, reference = layers.load_model(spark, root)
    return scoring.score(_readings(spark, d), scaler, reference).select("row_id", "cluster_label", "anomaly_score")


@query("S13_run_metadata", check(["sens"], f"""SELECT model_key, n_train, n_core, anomaly_rate, n_clusters, {C.EPS} AS eps,
    {C.MIN_SAMPLES} AS min_samples, '{",".join(C.FEATURES)}' AS features, 'gold' AS source_dataset FROM ({_SUMMARY})""",
    ["anomaly_rate", "eps"], _steps("all")))
def _(spark, d):
    """Train the models of the machines and the global one, whose row tells all rows and the overall rate; store all and read the facts back."""
    root = scratch(spark)
    layers.save_model(model(spark, d, "all"), root, "20260101T000000Z", "gold")
    return layers.read_latest(spark, root, "training_runs")


@query("S14_registry_status", check(["sens"], """SELECT 'ok' AS status, '20260102T000000Z' AS trained_at,
    count(DISTINCT machine_id) AS n_machines FROM sens"""))
def _(spark, d):
    root = scratch(spark)
    for version in ("20260102T000000Z", "20260101T000000Z"):
        layers.save_model(model(spark, d), root, version)
    return layers.registry_status(spark, root)


@query("batch_end_to_end", check(["silver", "interv"], """SELECT machine_id, count(*) AS n,
    count(*) FILTER (cluster_label = -1) AS n_anomalies FROM scored JOIN sens USING (row_id) GROUP BY 1""",
    extra=[*_GOLD_STEPS, *_steps("machines"), _READ_STEP, _QZ, _REF, _HITS, _SCORED]))
def _(spark, d):
    """Bronze files to layers, serving tables and a model, and the newest gold rows scored with it."""
    root = scratch(spark)
    bronze_csv.write_sensors(events_adapter.bronze(spark, d), f"{root}/bronze")
    bronze_csv.write_interventions(events_adapter.bronze_interventions(spark, d), f"{root}/bronze")
    batch.ingest(spark, f"{root}/bronze", f"{root}/lake", "20260101T000000Z")
    batch.retrain(spark, f"{root}/lake", "20260101T010000Z")
    _, scaler, reference = layers.load_model(spark, f"{root}/lake/models")
    good, _ = scoring.valid_readings(scoring.to_readings(layers.read_latest(spark, f"{root}/lake", "gold")))
    return scoring.score(good, scaler, reference).groupBy("machine_id").agg(
        F.count("*").alias("n"), F.count_if("anomaly").alias("n_anomalies"))


# Supervised models --------------------------------------------------------


def _labelled_gold(spark, d):
    """Gold rows with remaining hours, stored: a model passes over them many times."""
    log = events_adapter.interventions(spark, d)
    silver, gold = _silver_and_gold(spark, d)
    return stage_table(supervised.label_remaining_hours(gold, log, instants=silver))


_ML_GOLD = [*_GOLD_STEPS, ("gold", _GOLD_SQL), ("late", """SELECT g.*, (SELECT count(*) FROM interv i WHERE i.machine_id = g.machine_id
    AND i.ts >= g.timestamp) > 0 AS known FROM (SELECT *, floor(epoch_us("timestamp") / 1e6) AS s,
    min(floor(epoch_us("timestamp") / 1e6)) OVER (PARTITION BY machine_id) AS lo,
    max(floor(epoch_us("timestamp") / 1e6)) OVER (PARTITION BY machine_id) AS hi FROM gold) g WHERE s > lo + 8e-1 * (hi - lo)""")]


@query("ML01_failure_classifier", check(["silver", "interv"], """SELECT count(*) AS n_test, count(*) FILTER (failure > 0) AS n_failed,
    true AS beats_majority FROM late""", extra=_ML_GOLD))
def _(spark, d):
    """Scores every test row, and no worse than always naming the commoner class."""
    out = supervised.failure_classifier(*supervised.split(_labelled_gold(spark, d)))
    share = F.greatest(F.col("n_failed"), F.col("n_test") - F.col("n_failed")) / F.col("n_test")
    return out.select("n_test", "n_failed", (F.col("accuracy") >= share).alias("beats_majority"))


@query("ML02_type_classifier", check(["silver", "interv"], """SELECT sum(n) AS n_test, count(*) AS n_classes, true AS beats_majority
    FROM (SELECT failure_type, count(*) AS n FROM late GROUP BY 1)""", extra=_ML_GOLD))
def _(spark, d):
    out = supervised.type_classifier(*supervised.split(_labelled_gold(spark, d)))
    return out.select("n_test", "n_classes", (F.col("accuracy") >= F.col("n_commonest") / F.col("n_test")).alias("beats_majority"))


@query("ML03_remaining_hours_regressor", check(["silver", "interv"], "SELECT count(*) AS n_test, true AS bounded FROM late WHERE known",
                                               extra=_ML_GOLD))
def _(spark, d):
    """Scores every test row with a next intervention; the error stays near that of the training mean."""
    out = supervised.remaining_hours_regressor(*supervised.split(_labelled_gold(spark, d)))
    return out.select("n_test", (F.col("mae") <= 1.25 * F.col("mae_of_mean")).alias("bounded"))


@query("ML01_metrics")
def _(spark, d):
    """The values themselves; a forest cannot be written in SQL, the measures can (ML01_rule_metrics)."""
    return supervised.failure_classifier(*supervised.split(_labelled_gold(spark, d)))


@query("ML02_class_metrics")
def _(spark, d):
    """F1 of each failure type, and the mean over the types."""
    scored = supervised.type_predictions(*supervised.split(_labelled_gold(spark, d)))
    each_class = evaluation.classes(scored)
    mean = F.avg("f1").over(Window.partitionBy(F.lit(1)))
    return each_class.withColumn("macro_f1", mean)


@query("ML03_machine_errors")
def _(spark, d):
    """Mean absolute error per machine."""
    return evaluation.errors(supervised.remaining_hours_predictions(*supervised.split(_labelled_gold(spark, d))), ["machine_id"])


# Rules of thumb over the sensor rows: what a model has to beat, with measures that SQL can check.
_SLOW, _HOT, _USUAL_HOURS = 100, 62, 100
_RULED = ("ruled", f"""SELECT CAST(failure > 0 AS INTEGER) AS label, CAST(coalesce(rpm < {_SLOW}, false) AS INTEGER) AS prediction,
    -rpm AS score, failure AS kind, CASE WHEN rpm < {_SLOW} THEN 1 WHEN temperature_C > {_HOT} THEN 2 ELSE 0 END AS said
    FROM sens WHERE failure IS NOT NULL""")


def _ruled(spark, d):
    rows = stored_sensors(spark, d).filter(F.col("failure").isNotNull())
    slow = F.coalesce(F.col("rpm") < _SLOW, F.lit(False))
    return rows.select((F.col("failure") > 0).cast("int").alias("label"), slow.cast("int").alias("prediction"), (-F.col("rpm")).alias("score"),
                       F.col("failure").alias("kind"), F.when(slow, 1).when(F.col("temperature_C") > _HOT, 2).otherwise(0).alias("said"))


@query("ML01_rule_metrics", check(["sens"], """SELECT count(*) AS n_test, count(*) FILTER (label = 1) AS n_failed,
    avg(CAST(label = prediction AS INTEGER)) AS accuracy,
    count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (prediction = 1) AS precision,
    count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1) AS recall,
    2e0 * count(*) FILTER (label = 1 AND prediction = 1) / (count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1)) AS f1,
    (SELECT avg(CASE WHEN a.score > b.score THEN 1e0 WHEN a.score = b.score THEN 5e-1 ELSE 0 END)
     FROM ruled a JOIN ruled b ON a.label = 1 AND b.label = 0 AND a.score IS NOT NULL AND b.score IS NOT NULL) AS roc_auc FROM ruled""",
    ["accuracy", "precision", "recall", "f1", "roc_auc"], [_RULED]))
def _(spark, d):
    """Failed when the machine stands almost still: all measures of ML01, checked pair by pair."""
    return evaluation.binary(_ruled(spark, d))


@query("ML02_rule_metrics", check(["sens"], """SELECT sum(l) AS n_test, count(*) FILTER (l > 0) AS n_classes, max(l) AS n_commonest,
    sum(h) / sum(l) AS accuracy, avg(2e0 * h / (l + p)) AS macro_f1 FROM (SELECT c, count(*) FILTER (kind = c) AS l,
    count(*) FILTER (said = c) AS p, count(*) FILTER (kind = c AND said = c) AS h
    FROM ruled, (SELECT kind AS c FROM ruled UNION SELECT said FROM ruled) GROUP BY c)""", ["accuracy", "macro_f1"], [_RULED]))
def _(spark, d):
    """Three kinds told by speed and heat: accuracy and macro F1."""
    return evaluation.several(_ruled(spark, d).select(F.col("kind").alias("label"), F.col("said").alias("prediction")))


@query("ML03_rule_errors", check(["sens", "interv"], f"""SELECT machine_id, count(*) AS n_test, avg(abs(h - {_USUAL_HOURS})) AS mae FROM (
    SELECT s.machine_id, s.row_id, min(epoch_us(i.ts) - epoch_us(s.timestamp)) / 3.6e9 AS h FROM sens s JOIN interv i
    ON i.machine_id = s.machine_id AND i.ts >= s.timestamp GROUP BY ALL) GROUP BY machine_id""", ["mae"]))
def _(spark, d):
    """The same number of hours for every row: mean absolute error per machine."""
    rows = supervised.label_remaining_hours(events_adapter.sensor_data(spark, d), events_adapter.interventions(spark, d))
    return evaluation.errors(rows.select("machine_id", F.col("hours_to_next_intervention").alias("label"),
                                         F.lit(float(_USUAL_HOURS)).alias("prediction")), ["machine_id"])


@query("ML04_remaining_hours_label", check(["sens", "interv"], """SELECT s.row_id,
    min(epoch_us(i.ts) - epoch_us(s.timestamp)) / 3.6e9 AS hours_to_next_intervention FROM sens s LEFT JOIN interv i
    ON i.machine_id = s.machine_id AND i.ts >= s.timestamp GROUP BY 1""", ["hours_to_next_intervention"]))
def _(spark, d):
    return supervised.label_remaining_hours(
        events_adapter.sensor_data(spark, d), events_adapter.interventions(spark, d)
    ).select("row_id", "hours_to_next_intervention")


@query("ML05_time_split", check(["sens"], """SELECT machine_id, count(*) FILTER (early) AS n_train, count(*) FILTER (NOT early) AS n_test
    FROM (SELECT machine_id, s <= lo + 8e-1 * (hi - lo) AS early FROM (SELECT machine_id, floor(epoch_us("timestamp") / 1e6) AS s,
    min(floor(epoch_us("timestamp") / 1e6)) OVER (PARTITION BY machine_id) AS lo,
    max(floor(epoch_us("timestamp") / 1e6)) OVER (PARTITION BY machine_id) AS hi FROM sens)) GROUP BY ALL"""))
def _(spark, d):
    train, test = supervised.split(events_adapter.sensor_data(spark, d))
    both = train.withColumn("early", F.lit(True)).unionByName(test.withColumn("early", F.lit(False)))
    return both.groupBy("machine_id").agg(F.count_if("early").alias("n_train"), F.count_if(~F.col("early")).alias("n_test"))
