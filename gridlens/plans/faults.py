"""Fault labelling queries on the driver tables.

Mapping: telemetry = ``events`` (device = user_id, time = ts, signal = value).
Fault windows are *derived from the data*: every ``error`` event with
value >= 150 opens a fault on that device at its ts, lasting value/10 hours
(value >= 400: never repaired).  Its type is picked by event_id from the
five-row fault-type table below, so the event table grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.exprs import r6, r6_sql, epoch_s, severity_class_sql
from gridlens.operators import faults as fo
from gridlens.plans.registry import register, table

# Fault-type table used by the test mapping: k, type, shape, max severity,
# ramp seconds, ramp-down seconds.  Type names are the reference's solar
# fault names; 'downtime' is ordered last.
FAULT_TYPES = [
    (0, "soiling", "linear", 1.0, 21600.0, 7200.0),
    (1, "inverter_overheat", "intermittent", 1.0, 3600.0, 0.0),
    (2, "tracker_stuck", "linear", 0.8, 21600.0, 0.0),
    (3, "dc_string_outage", "abrupt", 1.0, None, 0.0),
    (4, "downtime", "abrupt", 1.0, None, 0.0),
]
TYPE_NAMES = [t[1] for t in FAULT_TYPES if t[1] != "downtime"]
MIN_VALUE, OPEN_VALUE = 150.0, 400.0

_CFG_SCHEMA = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("shape", T.StringType()), T.StructField("max_severity", T.DoubleType()),
    T.StructField("ramp_seconds", T.DoubleType()), T.StructField("ramp_down_seconds", T.DoubleType())])


def _cfg_values_sql(types=None) -> str:
    rows = []
    for k, name, shape, mx, ramp, rd in (types or FAULT_TYPES):
        ramp_s = "CAST(NULL AS DOUBLE)" if ramp is None else f"CAST({ramp!r} AS DOUBLE)"
        rows.append(f"({k}, '{name}', '{shape}', CAST({mx!r} AS DOUBLE), {ramp_s}, CAST({rd!r} AS DOUBLE))")
    return ("cfg(k, event_type, shape, max_severity, ramp_seconds, ramp_down_seconds) AS "
            f"(VALUES {', '.join(rows)})")


def telemetry(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"), "value")


def fault_events(spark, sf, types=None):
    """Derived fault-event table in the unified schema."""
    cfg = F.broadcast(spark.createDataFrame(types or FAULT_TYPES, _CFG_SCHEMA))
    trig = (table(spark, sf, "events")
            .where((F.col("event_type") == "error") & (F.col("value") >= MIN_VALUE))
            .select("event_id", "user_id", "ts", "value"))
    end = F.when(F.col("value") < OPEN_VALUE,
                 F.timestamp_add("SECOND", F.floor(F.col("value") * 360.0), F.col("ts")))
    return (trig.join(cfg, F.pmod(F.col("event_id"), F.lit(5)) == F.col("k"))
            .select(F.col("user_id").alias("device"), "event_type", F.col("ts").alias("start_time"),
                    end.alias("end_time"), "shape", "max_severity", "ramp_seconds", "ramp_down_seconds",
                    F.col("k").cast("int").alias("ord")))


def fe_sql(types=None) -> str:
    """Oracle text of the derived fault events, joined to telemetry, with severity (CTE ``s``)."""
    return f"""{_cfg_values_sql(types)},
fe AS (
  SELECT e.user_id AS device, c.event_type, e.ts AS start_time,
         CASE WHEN e.value < {OPEN_VALUE} THEN e.ts + to_seconds(CAST(floor(e.value * 360.0) AS BIGINT)) END AS end_time,
         c.shape, c.max_severity, c.ramp_seconds, c.ramp_down_seconds, c.k AS ord
  FROM events e JOIN cfg c ON c.k = ((e.event_id % 5) + 5) % 5
  WHERE e.event_type = 'error' AND e.value >= {MIN_VALUE}),
j AS (
  SELECT t.event_id, t.user_id AS device, t.ts AS time, t.value, f.event_type, f.start_time, f.end_time,
         f.shape, f.max_severity, f.ramp_seconds, f.ramp_down_seconds, f.ord,
         epoch_us(t.ts) / 1e6 - epoch_us(f.start_time) / 1e6 AS _dt,
         epoch_us(f.end_time) / 1e6 - epoch_us(f.start_time) / 1e6 AS _dur
  FROM events t LEFT JOIN fe f ON f.device = t.user_id AND t.ts >= f.start_time
       AND (f.end_time IS NULL OR t.ts < f.end_time)),
s AS (SELECT *, CASE WHEN event_type IS NULL THEN 0.0 ELSE {fo.severity_sql()} END AS severity FROM j)"""


FE_SQL = fe_sql()


def _labelled(spark, sf, **how):
    return fo.label_telemetry(telemetry(spark, sf), fault_events(spark, sf), TYPE_NAMES,
                              keep=["event_id", "value"], **how)


# --- L1 -------------------------------------------------------------------------

@register("fault_interval_join", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, start_time, end_time FROM s WHERE event_type IS NOT NULL""")
def q_fault_interval_join(spark, sf):
    j = fo.attach_faults(telemetry(spark, sf), fault_events(spark, sf), how="inner")
    return j.select("event_id", "device", "time", "event_type", "start_time", "end_time")


@register("fault_interval_join_bucketed", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, start_time, end_time FROM s WHERE event_type IS NOT NULL""")
def q_fault_interval_join_bucketed(spark, sf):
    """Same join through the (device, day) equi-join used when the event table is too big to broadcast."""
    j = fo.attach_faults(telemetry(spark, sf), fault_events(spark, sf), how="inner", force="bucketed")
    return j.select("event_id", "device", "time", "event_type", "start_time", "end_time")


@register("fault_interval_join_sweep", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, start_time, end_time FROM s WHERE event_type IS NOT NULL""")
def q_fault_interval_join_sweep(spark, sf):
    """Same join through the sweep over each device's fault bounds, used where a device has many faults."""
    j = fo.attach_faults(telemetry(spark, sf), fault_events(spark, sf), how="inner", force="sweep")
    return j.select("event_id", "device", "time", "event_type", "start_time", "end_time")


# --- L2 -------------------------------------------------------------------------

@register("fault_severity", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, shape, {r6_sql('severity')} AS severity
FROM s WHERE event_type IS NOT NULL""")
def q_fault_severity(spark, sf):
    j = fo.with_severity(fo.attach_faults(telemetry(spark, sf), fault_events(spark, sf), how="inner"))
    return j.select("event_id", "device", "time", "event_type", "shape", r6("severity").alias("severity"))


# --- L3 + L4 ----------------------------------------------------------------------

def _label_sql(tail: str) -> str:
    flags = ",\n  ".join(
        f"max(CASE WHEN severity > 0 AND event_type = '{t}' THEN 1 ELSE 0 END) AS fault_{t}"
        for t in TYPE_NAMES + ["downtime"])
    return f"""WITH {FE_SQL},
a AS (SELECT event_id, event_type, min(ord) AS o FROM s WHERE severity > 0 GROUP BY event_id, event_type),
lab AS (SELECT event_id, string_agg(event_type, '|' ORDER BY o, event_type) AS labels FROM a GROUP BY event_id),
g AS (
  SELECT event_id, device, time, value, max(severity) AS severity,
  {flags}
  FROM s GROUP BY event_id, device, time, value),
st AS (SELECT device, min(time) AS fault_start_time FROM g WHERE severity > 0 GROUP BY device),
L AS (
  SELECT g.*, CAST(g.severity > 0 AS INTEGER) AS is_faulted, coalesce(lab.labels, 'healthy') AS fault_labels,
         {severity_class_sql('g.severity')} AS fault_severity, st.fault_start_time,
         CASE WHEN g.time >= st.fault_start_time THEN epoch_us(g.time) / 1e6 - epoch_us(st.fault_start_time) / 1e6 END AS time_since_fault
  FROM g LEFT JOIN lab USING (event_id) LEFT JOIN st USING (device))
{tail}"""


_LABEL_COLS = ["event_id", "device", "time", "value"] + [f"fault_{t}" for t in TYPE_NAMES] + [
    "fault_downtime", "is_faulted", "fault_labels", "fault_severity", "fault_start_time"]


@register("label_telemetry", _label_sql(
    f"SELECT {', '.join(_LABEL_COLS)}, {r6_sql('severity')} AS severity, "
    f"{r6_sql('time_since_fault')} AS time_since_fault FROM L"))
def q_label_telemetry(spark, sf):
    L = _labelled(spark, sf)
    return L.select(*_LABEL_COLS, r6("severity").alias("severity"),
                    r6("time_since_fault").alias("time_since_fault"))


@register("label_telemetry_sweep", _label_sql(
    f"SELECT {', '.join(_LABEL_COLS)}, {r6_sql('severity')} AS severity, "
    f"{r6_sql('time_since_fault')} AS time_since_fault FROM L"))
def q_label_telemetry_sweep(spark, sf):
    """Same labels through the sweep, used where a device has many faults."""
    L = _labelled(spark, sf, force="sweep")
    return L.select(*_LABEL_COLS, r6("severity").alias("severity"),
                    r6("time_since_fault").alias("time_since_fault"))


@register("fault_start_broadcast", _label_sql(
    "SELECT device, min(fault_start_time) AS fault_start_time, count(*) AS n_rows, "
    "CAST(sum(is_faulted) AS BIGINT) AS n_faulted FROM L GROUP BY device"))
def q_fault_start(spark, sf):
    L = _labelled(spark, sf)
    return L.groupBy("device").agg(F.min("fault_start_time").alias("fault_start_time"),
                                   F.count(F.lit(1)).alias("n_rows"),
                                   F.sum("is_faulted").cast("long").alias("n_faulted"))


@register("fault_rates", _label_sql(
    f"SELECT device, count(*) AS n_rows, {r6_sql('avg(is_faulted)')} AS fault_rate, "
    f"{r6_sql('avg(severity)')} AS mean_severity, "
    + ", ".join(f"{r6_sql(f'avg(fault_{t})')} AS rate_{t}" for t in TYPE_NAMES + ['downtime'])
    + " FROM L GROUP BY device"))
def q_fault_rates(spark, sf):
    """Fault rate and per-type rates per device (P10 on labelled telemetry) - the flagship."""
    L = _labelled(spark, sf)
    return L.groupBy("device").agg(
        F.count(F.lit(1)).alias("n_rows"), r6(F.avg("is_faulted")).alias("fault_rate"),
        r6(F.avg("severity")).alias("mean_severity"),
        *[r6(F.avg(f"fault_{t}")).alias(f"rate_{t}") for t in TYPE_NAMES + ["downtime"]])


@register("label_counts", _label_sql(
    "SELECT fault_labels, fault_severity, count(*) AS n FROM L GROUP BY fault_labels, fault_severity"))
def q_label_counts(spark, sf):
    return _labelled(spark, sf).groupBy("fault_labels", "fault_severity").agg(F.count(F.lit(1)).alias("n"))


@register("severity_counts", _label_sql(
    "SELECT device, fault_severity, count(*) AS n FROM L GROUP BY device, fault_severity"))
def q_severity_counts(spark, sf):
    """Severity class counts per device."""
    return _labelled(spark, sf).groupBy("device", "fault_severity").agg(F.count(F.lit(1)).alias("n"))


# --- W8 -------------------------------------------------------------------------

@register("fault_progress", f"""WITH {FE_SQL},
p AS (SELECT *, least(coalesce(ramp_seconds, 0.0), coalesce(_dur, ramp_seconds, 0.0)) AS rl FROM s WHERE event_type IS NOT NULL)
SELECT device, time, event_type, {r6_sql('_dt')} AS seconds_since_start,
       {r6_sql("CASE WHEN shape = 'abrupt' OR rl <= 0 THEN 1.0 ELSE least(1.0, _dt / rl) END")} AS progress,
       {r6_sql('severity')} AS severity
FROM p""")
def q_fault_progress(spark, sf):
    p = fo.fault_progress(telemetry(spark, sf), fault_events(spark, sf))
    return p.select("device", "time", "event_type", r6("seconds_since_start").alias("seconds_since_start"),
                    r6("progress").alias("progress"), r6("severity").alias("severity"))


# --- F9 -------------------------------------------------------------------------

@register("outage_mask", f"""WITH {FE_SQL},
d AS (SELECT DISTINCT event_id FROM s WHERE event_type = 'downtime')
SELECT t.event_id, t.user_id AS device, t.ts AS time,
       CASE WHEN d.event_id IS NOT NULL THEN 0.0 ELSE t.value END AS value,
       CAST(d.event_id IS NOT NULL AS INTEGER) AS in_outage
FROM events t LEFT JOIN d ON d.event_id = t.event_id""")
def q_outage_mask(spark, sf):
    from gridlens.operators.clean import apply_outages
    return apply_outages(telemetry(spark, sf), fault_events(spark, sf), ["value"], key="event_id")


# --- W2 -------------------------------------------------------------------------

EPISODE_THRESHOLD = 60.0


@register("fault_episodes", f"""WITH f AS (
  SELECT user_id AS device, ts AS time, CAST(value > {EPISODE_THRESHOLD} AS INTEGER) AS flag,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
g AS (SELECT device, time, rn - row_number() OVER (PARTITION BY device ORDER BY time, rn) AS island
      FROM f WHERE flag = 1)
SELECT device, min(time) AS start_time, max(time) AS end_time, count(*) AS n_rows
FROM g GROUP BY device, island""")
def q_fault_episodes(spark, sf):
    """Runs of consecutive readings above a threshold per device -> episode table."""
    t = telemetry(spark, sf).withColumn("flag", (F.col("value") > EPISODE_THRESHOLD).cast("int"))
    return fo.episodes(t, "flag", tiebreak=["event_id"])


# --- L5 -------------------------------------------------------------------------
SITE_START = "2024-01-01 00:00:00"


def fault_config(spark, sf):
    """Configuration rows in the reference's form (day offsets from the site
    start, ramp days, outage hours), derived from the events: error events
    with value >= 150 are faults, those with 100 <= value < 150 outages."""
    cfg = F.broadcast(spark.createDataFrame(FAULT_TYPES, _CFG_SCHEMA))
    ev = table(spark, sf, "events").where(F.col("event_type") == "error").select("event_id", "user_id", "ts", "value")
    day = F.floor(epoch_s(F.col("ts")) - epoch_s(F.expr(f"TIMESTAMP_NTZ'{SITE_START}'"))) / F.lit(86400.0)
    faults = (ev.where(F.col("value") >= MIN_VALUE).join(cfg, F.pmod(F.col("event_id"), F.lit(5)) == F.col("k"))
              .where(F.col("event_type") != "downtime")
              .select(F.col("user_id").cast("string").alias("device"), "event_type", day.alias("start_day"),
                      F.when(F.col("value") < OPEN_VALUE, day + F.col("value") / F.lit(240.0)).alias("end_day"),
                      "shape", "max_severity", (F.col("ramp_seconds") / F.lit(86400.0)).alias("ramp_days"),
                      (F.col("ramp_down_seconds") / F.lit(86400.0)).alias("ramp_down_days"), F.col("k").cast("int").alias("ord")))
    outages = (ev.where((F.col("value") >= 100.0) & (F.col("value") < MIN_VALUE))
               .select(F.col("user_id").cast("string").alias("device"), day.alias("start_day"),
                       (F.col("value") / F.lit(50.0)).alias("hours"), F.lit(1.0).alias("severity")))
    return faults, outages


_DAY_SQL = "(floor(epoch_us(ts) / 1e6 - epoch_us(TIMESTAMP '2024-01-01 00:00:00') / 1e6) / 86400.0)"
_AT_SQL = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(round({d} * 86400.0) AS BIGINT))"


@register("normalise_events", f"""WITH {_cfg_values_sql()},
f AS (SELECT CAST(e.user_id AS VARCHAR) AS device, c.event_type, {_DAY_SQL} AS start_day,
        CASE WHEN e.value < {OPEN_VALUE} THEN {_DAY_SQL} + e.value / 240.0 END AS end_day, c.shape, c.max_severity,
        c.ramp_seconds / 86400.0 AS ramp_days, c.ramp_down_seconds / 86400.0 AS ramp_down_days, CAST(c.k AS INTEGER) AS ord
      FROM events e JOIN cfg c ON c.k = ((e.event_id % 5) + 5) % 5
      WHERE e.event_type = 'error' AND e.value >= {MIN_VALUE} AND c.event_type <> 'downtime'),
o AS (SELECT CAST(user_id AS VARCHAR) AS device, {_DAY_SQL} AS start_day, value / 50.0 AS hours FROM events
      WHERE event_type = 'error' AND value >= 100.0 AND value < {MIN_VALUE})
SELECT device, event_type, {_AT_SQL.format(d='start_day')} AS start_time,
  CASE WHEN end_day IS NOT NULL THEN {_AT_SQL.format(d='end_day')} END AS end_time, shape, max_severity,
  greatest(600.0, coalesce(ramp_days, 1.0) * 86400.0) AS ramp_seconds, coalesce(ramp_down_days, 0.0) * 86400.0 AS ramp_down_seconds, ord
FROM f
UNION ALL
SELECT device, 'downtime', {_AT_SQL.format(d='start_day')},
  {_AT_SQL.format(d='start_day')} + to_seconds(CAST(round(hours * 3600.0) AS BIGINT)), 'abrupt', CAST(1.0 AS DOUBLE),
  CAST(NULL AS DOUBLE), CAST(0.0 AS DOUBLE), {1 << 30}
FROM o""")
def q_normalise_events(spark, sf):
    """Configuration rows (day offsets, ramp days, outage hours) -> wall-clock fault events."""
    faults, outages = fault_config(spark, sf)
    return fo.normalise_events(faults, SITE_START, outages)
