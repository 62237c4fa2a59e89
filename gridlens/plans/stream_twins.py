"""Streaming-twin queries (T1-T6): run to completion, return the sink.

Oracles are the batch semantics restricted to what a watermarked append
stream emits: windows whose end is at or before (max event time - 10 min).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens import streaming as ST
from gridlens.functions.exprs import r6, r6_sql as R
from gridlens.plans.faults import FE_SQL, fault_events
from gridlens.plans.registry import register
from gridlens.session import scratch_path

DELAY_SQL = "INTERVAL 10 MINUTE"


def _ev(spark, sf):
    return ST.file_stream(spark, sf, "events.parquet")


@register("stream_resample", f"""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, value FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n, {R('sum(value)')} AS sum_value
FROM w GROUP BY window_start, event_type
HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - {DELAY_SQL}""")
def q_stream_resample(spark, sf):
    """Daily counts and sums per event type from a watermarked stream."""
    s = ST.stream_resample(_ev(spark, sf), "ts", ["event_type"], "value", "1 day")
    out = ST.run_available_now(s, "resample")
    return out.withColumn("sum_value", r6("sum_value"))


@register("stream_velocity", f"""WITH x AS (SELECT event_type, ts, time_bucket(INTERVAL 1 HOUR, ts) AS b FROM events),
w AS (SELECT event_type, b - to_hours(CAST(k AS BIGINT)) AS window_start FROM x, range(6) r(k))
SELECT window_start, event_type, count(*) AS n FROM w
GROUP BY window_start, event_type
HAVING count(*) >= 25 AND window_start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - {DELAY_SQL}""")
def q_stream_velocity(spark, sf):
    """6-hour windows sliding by 1 hour with >= 25 events per event type."""
    s = ST.stream_velocity(_ev(spark, sf), "ts", ["event_type"], 25, "6 hours", "1 hour")
    return ST.run_available_now(s, "velocity")


@register("stream_velocity_exact", f"""SELECT event_type, event_id, ts, n_in_window FROM (
  SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
    RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS n_in_window FROM events)
WHERE n_in_window >= 25 AND time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR < (SELECT max(ts) FROM events) - {DELAY_SQL}""")
def q_stream_velocity_exact(spark, sf):
    """T2 exact: a stateful operator per merchant and six-hour slice; equals A1 on closed slices."""
    s = ST.stream_velocity_exact(_ev(spark, sf), "ts", ["event_type"], "event_id", 25, 6 * 3600)
    return ST.run_available_now(s, "velocity_exact")


@register("stream_ping", f"""WITH t AS (SELECT user_id, ts, event_id FROM events WHERE value < 5.0),
l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM t),
s AS (SELECT *, max(CASE WHEN p IS NULL OR ts - p >= INTERVAL 12 HOUR THEN ts END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM l)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM s GROUP BY user_id, sid
HAVING count(*) BETWEEN 3 AND 5 AND max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - {DELAY_SQL}""")
def q_stream_ping(spark, sf):
    """Closed 12-hour-gap sessions of 3-5 tiny payments per customer."""
    s = ST.stream_ping(_ev(spark, sf), "ts", ["user_id"], "value", 5.0, "12 hours", 3, 5)
    return ST.run_available_now(s, "ping")


@register("stream_episodes", f"""WITH t AS (SELECT user_id, ts, event_id FROM events WHERE value >= 60.0),
l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM t),
s AS (SELECT *, max(CASE WHEN p IS NULL OR ts - p >= INTERVAL 24 HOUR THEN ts END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM l)
SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n_rows FROM s GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 24 HOUR <= (SELECT max(ts) FROM t) - {DELAY_SQL}""")
def q_stream_episodes(spark, sf):
    """Closed runs of high readings per device, at most a day apart.
    (The filter runs before the watermark, so that follows the flagged rows.)"""
    s = ST.stream_episodes(_ev(spark, sf), "ts", ["user_id"], F.col("value") >= 60.0, "24 hours")
    return ST.run_available_now(s, "episodes")


@register("stream_label", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, start_time, end_time FROM s WHERE event_type IS NOT NULL""")
def q_stream_label(spark, sf):
    """T4: stream x static broadcast interval join (fault windows)."""
    ev = _ev(spark, sf).select("event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"))
    s = ST.stream_label(ev, fault_events(spark, sf), "device", "time")
    s = s.select("event_id", "device", "time", "event_type", "start_time", "end_time")
    return ST.run_available_now(s, "label")


@register("stream_label_refresh", f"""WITH {FE_SQL}
SELECT event_id, device, time, event_type, start_time, end_time FROM s WHERE event_type IS NOT NULL""")
def q_stream_label_refresh(spark, sf):
    """T4: half of the faults arrive in files after the telemetry has been read; equals the batch join."""
    folder = scratch_path(spark, "late-faults")
    faults = fault_events(spark, sf)
    files = 0
    for half in (0, 1):
        faults.where(F.pmod(F.unix_seconds(F.col("start_time").cast("timestamp")), F.lit(2)) == half).write.mode("append").parquet(folder)
        # the first batch takes the files of the first half, however many tasks wrote it: batches don't grow with the table
        files = files or len(spark.read.schema(faults.schema).parquet(folder).inputFiles())
    late = ST.file_stream(spark, folder, "*.parquet", faults.schema, max_files_per_trigger=files)
    ev = _ev(spark, sf).select("event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"))
    s = ST.stream_label_late(ev, late, "device", "time", "400 days")
    return ST.run_available_now(s.select("event_id", "device", "time", "event_type", "start_time", "end_time"), "label-late")


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_dedup(spark, sf):
    """T5: the events stream arriving twice; duplicates dropped within the watermark."""
    a, b = _ev(spark, sf), _ev(spark, sf)
    s = ST.stream_dedup(a.unionByName(b), "ts", ["event_id"])
    return ST.run_available_now(s, "dedup")


@register("stream_copy", "SELECT * FROM events")
def q_stream_copy(spark, sf):
    """Parquet source -> Parquet sink with checkpoint, read back."""
    return ST.run_available_now(ST.stream_copy(_ev(spark, sf)), "copy")
