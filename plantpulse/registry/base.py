"""Registration of queries and the shared parts of their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# What the steps of one query share. Every query starts without it and does its whole job itself.
KEPT: list[dict] = []

# Shown digits of derived doubles; decisions are taken on unrounded values.
DIGITS = 6
# Averages of short decimals end in exact halves; the nudge rounds them alike.
NUDGE = 1e-9


def finish(df: DataFrame) -> DataFrame:
    """Round doubles, show times without zone and integers as bigint."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            col = F.round(col + NUDGE, DIGITS)
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(field.name))
    return df.select(*out)


def forget() -> None:
    """Drop what the steps of the last query shared."""
    for kept in KEPT:
        kept.clear()


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            forget()
            return finish(fn(use_utc(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def each(template: str, columns: list[str] = C.SENSORS, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in columns)


_KEYS = "machine_id, target_cycle"
_S = ", ".join(C.SENSORS)

# Every entry: (name, text). A check takes the chain up to what it needs.
_STEPS: list[tuple[str, str]] = [
    ("ev", """SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CAST(user_id // 10 + 1 AS INTEGER) AS machine_id, hour(ts) AS h FROM events"""),
    ("bronze", """SELECT event_id * 2 + copy AS row_id, machine_id,
        CASE machine_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 30 ELSE 60 END AS target_cycle,
        CASE WHEN event_id % 101 = 0 THEN 'not-a-date'
             WHEN event_id % 97 = 0 AND ts >= TIMESTAMP '2024-01-02' THEN CAST(ts AS VARCHAR)
             ELSE CAST(date_trunc('hour', ts) AS VARCHAR) END AS stamp,
        CASE WHEN event_id % 37 <> 0 THEN 12e0 + 25e-2 * h + 2e-2 * k END AS consumption_kWh,
        CASE WHEN event_id % 29 <> 0 THEN 45e0 + 5e-1 * h + 1e-1 * value END AS temperature_C,
        1e0 + 1e-2 * value AS vibration, 45e0 + 2e-1 * h + 5e-2 * k AS pressure,
        30e0 + 5e-1 * (k % 10) AS cycle_duration,
        CASE WHEN event_type = 'error' AND k < 20 AND k % 2 = 0 THEN 0e0 ELSE CAST(1500 - 4 * h + k AS DOUBLE) END AS rpm,
        CAST(228 + k % 5 AS DOUBLE) AS voltage,
        CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 211 = 0 THEN 9
             WHEN event_type = 'error' AND k < 10 THEN 1 WHEN event_type = 'error' AND k < 20 THEN 2 ELSE 0 END AS code
        FROM (SELECT *, unnest(CASE WHEN event_id % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM ev)"""),
    ("typed", f"""SELECT row_id, {_KEYS}, TRY_CAST(stamp AS TIMESTAMP) AS ts, {_S},
        CASE WHEN code IN (0, 1, 2) THEN code END AS failure,
        CASE WHEN code NOT IN (0, 1, 2) THEN 1 ELSE 0 END AS bad_failure FROM bronze"""),
    ("dedup", f"""SELECT {_KEYS}, ts, {_S}, failure, min(row_id) AS row_id, arg_min(bad_failure, row_id) AS bad_failure
        FROM typed GROUP BY {_KEYS}, ts, {_S}, failure"""),
    ("votes", f"""SELECT {_KEYS}, ts, {each('median({c}) AS {c}')}, arg_min(bad_failure, row_id) AS bad_failure,
        min(row_id) AS row_id, count(*) AS n_rows,
        count(*) FILTER (failure = 0) AS f0, count(*) FILTER (failure = 1) AS f1, count(*) FILTER (failure = 2) AS f2
        FROM dedup WHERE ts IS NOT NULL GROUP BY {_KEYS}, ts"""),
    ("cells", f"""SELECT {_KEYS}, ts, {_S}, bad_failure, row_id, n_rows, CAST(n_rows > 1 AS INTEGER) AS dup,
        CASE WHEN f0 + f1 + f2 = 0 THEN NULL
             WHEN f0 > f1 AND f0 > f2 THEN 0 WHEN f1 > f0 AND f1 > f2 THEN 1 WHEN f2 > f0 AND f2 > f1 THEN 2
             WHEN f1 > 0 AND f2 = 0 THEN 1 WHEN f2 > 0 AND f1 = 0 THEN 2 END AS failure FROM votes"""),
    ("lattice", f"""SELECT {_KEYS}, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
        FROM (SELECT {_KEYS}, min(ts) AS lo, max(ts) AS hi FROM cells GROUP BY {_KEYS})"""),
    ("hourly", f"""SELECT l.machine_id, l.target_cycle, l.ts, {_S}, failure, coalesce(dup, 0) AS dup,
        coalesce(bad_failure, 0) AS bad_failure, CAST(c.row_id IS NULL AS INTEGER) AS missing
        FROM lattice l LEFT JOIN cells c ON c.machine_id = l.machine_id AND c.target_cycle = l.target_cycle AND c.ts = l.ts"""),
    ("around", f"""SELECT *, lag(failure) OVER w AS fb, lead(failure) OVER w AS fa, lead(rpm) OVER w AS ra
        FROM hourly WINDOW w AS (PARTITION BY {_KEYS} ORDER BY ts)"""),
    ("repaired", f"""SELECT {_KEYS}, ts, {_S}, dup, bad_failure, missing, CAST(failure IS NULL AS INTEGER) AS fixed,
        failure IS NULL AND guess IS NULL AS unsure, coalesce(failure, guess, 0) AS failure
        FROM (SELECT *, CASE WHEN fb = fa THEN fb
             WHEN fb = 0 AND fa IN (1, 2) AND ra > 0 THEN 0 WHEN fb = 0 AND fa IN (1, 2) AND ra = 0 THEN fa
             WHEN fb IN (1, 2) AND fa = 0 AND rpm = 0 THEN fb WHEN fb IN (1, 2) AND fa = 0 AND rpm > 0 THEN 0 END AS guess
             FROM around)"""),
    ("bounds", f"""SELECT {_KEYS}, {each('avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}')}
        FROM repaired WHERE failure = 0 GROUP BY {_KEYS}"""),
    ("marked", f"""SELECT r.*, {each('coalesce(failure = 0 AND ({c} < m_{c} - 5 * s_{c} OR {c} > m_{c} + 5 * s_{c}), false) AS o_{c}')}
        FROM repaired r LEFT JOIN bounds b USING ({_KEYS})"""),
    ("flagged", f"""SELECT *, ({each('o_{c}', sep=' OR ')}) AS is_out,
        row_number() OVER (PARTITION BY {_KEYS} ORDER BY ts) AS pos FROM marked"""),
    ("long", f"""SELECT {_KEYS}, pos, is_out, sensor, v, CASE WHEN NOT is_out THEN v END AS u FROM (
        {' UNION ALL '.join(f"SELECT {_KEYS}, pos, is_out, '{c}' AS sensor, {c} AS v FROM flagged" for c in C.SENSORS)})"""),
    ("ahead", f"""SELECT *, lead(u, 1) OVER w AS n1, lead(u, 2) OVER w AS n2 FROM long
        WINDOW w AS (PARTITION BY {_KEYS}, sensor ORDER BY pos)"""),
    ("walk", """SELECT machine_id, target_cycle, sensor, CAST(0 AS BIGINT) AS pos, CAST(NULL AS DOUBLE) AS val,
        CAST(NULL AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b FROM ahead WHERE pos = 1
        UNION ALL
        SELECT machine_id, target_cycle, sensor, pos, val, b, CASE WHEN NOT is_out THEN val END
        FROM (SELECT x.machine_id, x.target_cycle, x.sensor, x.pos, w.b, x.is_out,
              coalesce(x.v, list_aggregate([w.a, w.b, x.n1, x.n2], 'median')) AS val
              FROM walk w JOIN ahead x ON x.machine_id = w.machine_id AND x.target_cycle = w.target_cycle
               AND x.sensor = w.sensor AND x.pos = w.pos + 1)"""),
    ("filled", f"""SELECT {_KEYS}, pos, {each("max(val) FILTER (sensor = '{c}') AS i_{c}")} FROM walk
        WHERE pos > 0 GROUP BY {_KEYS}, pos"""),
    ("imputed", f"""SELECT f.*, {each('i_{c}')} FROM flagged f JOIN filled USING ({_KEYS}, pos)"""),
    ("beside", f"""SELECT *, {each('''list_aggregate([
        lag(CASE WHEN NOT is_out THEN i_{c} END, 2) OVER w, lag(CASE WHEN NOT is_out THEN i_{c} END, 1) OVER w,
        lead(CASE WHEN NOT is_out THEN i_{c} END, 1) OVER w, lead(CASE WHEN NOT is_out THEN i_{c} END, 2) OVER w], 'median') AS x_{c}''')}
        FROM imputed WINDOW w AS (PARTITION BY {_KEYS} ORDER BY pos)"""),
    ("silver", f"""SELECT {_KEYS}, ts, {each('CASE WHEN o_{c} THEN coalesce(x_{c}, i_{c}) ELSE i_{c} END AS {c}')}, failure,
        CAST(is_out AS INTEGER) AS is_outlier, coalesce(array_to_string([{each("CASE WHEN o_{c} THEN '{c}' END")}], ', '), '') AS outlier_columns,
        missing AS is_missing_timestamp, fixed AS is_failure_nan_corrected, dup AS is_duplicate_corrected,
        CAST({each('({c} IS NULL AND i_{c} IS NOT NULL)', sep=' OR ')} AS INTEGER) AS is_nan_corrected,
        coalesce(array_to_string([{each("CASE WHEN {c} IS NULL AND i_{c} IS NOT NULL THEN '{c}' END")}], ', '), '') AS nan_columns,
        list_filter([CASE WHEN bad_failure = 1 THEN 'INVALID_FAILURE_VALUE' END,
          CASE WHEN dup = 1 THEN 'TIMESTAMP_CONFLICT_RESOLVED' END,
          CASE WHEN missing = 1 THEN 'MISSING_TIMESTAMP_IMPUTED' END,
          CASE WHEN fixed = 1 AND NOT unsure THEN 'FAILURE_NAN_CORRECTED' END,
          CASE WHEN unsure THEN 'UNCERTAIN_FAILURE_NAN' END,
          CASE WHEN unsure THEN 'UNCERTAIN_FAILURE_DEFAULTED_TO_ZERO' END,
          CASE WHEN is_out THEN 'OUTLIER_DETECTED' END,
          {each("CASE WHEN {c} IS NULL AND i_{c} IS NOT NULL THEN 'NAN_CORRECTED' WHEN {c} IS NULL THEN 'UNCERTAIN_NAN_CORRECTION' END")},
          CASE WHEN {each('(o_{c} AND x_{c} IS NOT NULL)', sep=' OR ')} THEN 'OUTLIER_CORRECTED' END], lambda z: z IS NOT NULL) AS flags
        FROM beside"""),
    ("raw_int", """SELECT event_id AS row_id, machine_id,
        CASE WHEN event_id % 101 <> 0 THEN date_trunc('hour', ts) END AS ts,
        CASE WHEN event_id % 7 = 0 THEN 'Unknown' WHEN k % 2 = 0 THEN 'Breakage' ELSE 'Overheat' END AS failure_type,
        50e0 + 1e-1 * value AS temperature, CAST(1500 + k AS DOUBLE) AS rpm,
        1e0 + 1e-2 * value AS vibration, 45e0 + 5e-2 * k AS pressure
        FROM ev WHERE event_type = 'error' AND k >= 95"""),
    ("interv", "SELECT * FROM raw_int WHERE ts IS NOT NULL AND failure_type IN ('Breakage', 'Overheat')"),
    ("sens", """SELECT event_id AS row_id, machine_id, CASE WHEN event_id % 41 = 0 THEN 0 ELSE
        CASE machine_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 30 ELSE 60 END END AS target_cycle, ts AS "timestamp",
        CASE WHEN event_id % 37 <> 0 THEN 12e0 + 25e-2 * h + 2e-2 * k END AS consumption_kWh,
        CASE WHEN event_id % 29 <> 0 THEN 45e0 + 5e-1 * h + 1e-1 * value END AS temperature_C,
        1e0 + 1e-2 * value AS vibration, 45e0 + 2e-1 * h + 5e-2 * k AS pressure,
        CASE WHEN event_id % 43 <> 0 THEN 30e0 + 5e-1 * (k % 10) END AS cycle_duration,
        CASE WHEN event_type = 'error' AND k < 20 AND k % 2 = 0 THEN 0e0 ELSE CAST(1500 - 4 * h + k AS DOUBLE) END AS rpm,
        CAST(228 + k % 5 AS DOUBLE) AS voltage,
        CASE WHEN event_type = 'error' AND k < 10 THEN 1 WHEN event_type = 'error' AND k < 20 THEN 2 ELSE 0 END AS failure
        FROM ev"""),
    ("pred", """SELECT event_id, ts AS recorded_at, machine_id, 'v' || CAST(day(ts) % 4 AS VARCHAR) AS model_version,
        CASE WHEN event_type = 'error' THEN -1 ELSE k % 4 END AS cluster_label, event_type = 'error' AS anomaly,
        CASE WHEN event_type = 'error' AND k >= 30 THEN 1e0 WHEN event_type = 'error' THEN 5e-1 + 1e-2 * k
             ELSE k / 1e2 END AS anomaly_score, event_type = 'error' AS alert,
        CASE WHEN event_type <> 'error' THEN 'nominal' WHEN k >= 30 OR 5e-1 + 1e-2 * k >= 9e-1 THEN 'critical'
             ELSE 'warning' END AS alert_level FROM ev"""),
    ("reqs", """SELECT event_id AS request_id, ts, machine_id, 'api-' || (event_id % 2) AS instance,
        CASE WHEN event_type = 'error' THEN 'error' WHEN k < 3 THEN 'unavailable' ELSE 'ok' END AS status,
        value / 50e0 AS latency FROM ev"""),
]
_TEXT = dict(_STEPS)
_NEEDS = {
    "ev": [], "bronze": ["ev"], "raw_int": ["ev"], "interv": ["raw_int"], "sens": ["ev"], "pred": ["ev"], "reqs": ["ev"],
    "typed": ["bronze"], "dedup": ["typed"], "votes": ["dedup"], "cells": ["votes"], "lattice": ["cells"],
    "hourly": ["lattice"], "around": ["hourly"], "repaired": ["around"], "bounds": ["repaired"], "marked": ["bounds"],
    "flagged": ["marked"], "long": ["flagged"], "ahead": ["long"], "walk": ["ahead"], "filled": ["walk"],
    "imputed": ["filled"], "beside": ["imputed"], "silver": ["beside"],
}


def chain(*needed: str, extra: list[tuple[str, str]] = ()) -> str:
    """WITH clause of all steps the named ones build on, plus own steps."""
    wanted: set[str] = set()
    todo = list(needed)
    while todo:
        step = todo.pop()
        if step not in wanted:
            wanted.add(step)
            todo += _NEEDS[step]
    parts = [(n, t) for n, t in _STEPS if n in wanted] + list(extra)
    return "WITH RECURSIVE " + ",\n".join(f"{n} {t}" if "(" in n else f"{n} AS ({t})" for n, t in parts) + "\n"


def check(needed: list[str], select: str, doubles: list[str] = (), extra: list[tuple[str, str]] = ()) -> str:
    """Full SQL of a check; `doubles` are rounded like the query's columns."""
    rounded = ", ".join(f'round(CAST({d} AS DOUBLE) + {NUDGE}, {DIGITS}) AS {d}' for d in doubles)
    body = f"SELECT * {'REPLACE (' + rounded + ') ' if doubles else ''}FROM (\n{select}\n)"
    return chain(*needed, extra=extra) + body
