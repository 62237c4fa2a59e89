"""Time-series queries (W1, W3-W7, W9, W10, L13) on ``events`` as telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6, r6_sql as R, angle_diff, angle_diff_sql, wrap_deg, wrap_deg_sql
from gridlens.operators import timeseries as TS
from gridlens.operators.windows import top_k_per
from gridlens.plans.faults import telemetry
from gridlens.plans.registry import register, table

LAG = ("lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)")


@register("step_audit", f"""WITH d AS (
  SELECT user_id AS device, epoch_us(ts) / 1e6 - epoch_us({LAG}) / 1e6 AS s FROM events),
d2 AS (SELECT device, s, CAST(floor(s / 60.0) AS BIGINT) AS m FROM d WHERE s IS NOT NULL),
per AS (SELECT device, count(*) AS n_steps, {R('min(s)')} AS min_step_s, {R('max(s)')} AS max_step_s, {R('avg(s)')} AS mean_step_s FROM d2 GROUP BY device),
mc AS (SELECT device, m, count(*) AS n FROM d2 GROUP BY device, m),
mo AS (SELECT device, m AS mode_step_min, n AS nm FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY n DESC, m) AS rk FROM mc) WHERE rk = 1)
SELECT per.device, n_steps, min_step_s, max_step_s, mean_step_s, mode_step_min, n_steps - nm AS n_irregular
FROM per JOIN mo USING (device)""", digits=6)
def q_step_audit(spark, sf):
    return TS.step_audit(telemetry(spark, sf), tiebreak=["event_id"])


@register("assign_ids", "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 999 AS seq_id FROM orders")
def q_assign_ids(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return TS.assign_ids(o, "o_orderdate", ["o_orderkey"], start=1000)


@register("ar1_fit", f"""WITH p AS (
  SELECT user_id AS device, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pv FROM events),
q AS (SELECT * FROM p WHERE pv IS NOT NULL),
f AS (SELECT device, regr_slope(value, pv) AS slope, regr_intercept(value, pv) AS intercept, count(*) AS n_pairs FROM q GROUP BY device)
SELECT device, n_pairs, {R('slope')} AS slope, {R('intercept')} AS intercept,
       {R('stddev_samp(value - (intercept + slope * pv))')} AS innovation_std
FROM q JOIN f USING (device) GROUP BY device, n_pairs, slope, intercept""", digits=6)
def q_ar1_fit(spark, sf):
    return TS.ar1_fit(telemetry(spark, sf), "value", tiebreak=["event_id"])


@register("seasonal_residual", f"""WITH t AS (SELECT event_id, ts, value, dayofweek(ts) + 1 AS dw, hour(ts) AS hr FROM events),
b AS (SELECT dw, hr, avg(value) AS baseline FROM t GROUP BY dw, hr)
SELECT event_id, {R('baseline')} AS baseline, {R('value - baseline')} AS residual FROM t JOIN b USING (dw, hr)""")
def q_seasonal_residual(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    s = TS.seasonal_residual(ev, "value", "ts")
    return s.select("event_id", r6("baseline").alias("baseline"), r6("residual").alias("residual"))


@register("spike_windows", f"""WITH r AS (
  SELECT event_id, user_id AS device, ts AS time, value,
    avg(value) OVER w AS roll_mean, stddev_samp(value) OVER w AS roll_std
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT event_id, device, time, value, {R('roll_mean')} AS roll_mean, {R('roll_std')} AS roll_std,
  coalesce(CAST(value > roll_mean + 2.0 * roll_std AS INTEGER), 0) AS is_spike FROM r""")
def q_spike_windows(spark, sf):
    s = TS.spike_windows(telemetry(spark, sf), "value", 5, 2.0, tiebreak=["event_id"])
    return s.select("event_id", "device", "time", "value", r6("roll_mean").alias("roll_mean"),
                    r6("roll_std").alias("roll_std"), "is_spike")


# Heading of the test mapping: nacelle = wrap(7.3 * value), wind = wrap(11 * event_id).
def _yaw_err_sql():
    return f"abs({angle_diff_sql(wrap_deg_sql('11.0 * event_id'), wrap_deg_sql('7.3 * value'))})"


@register("angle_error_trend", f"""WITH e AS (SELECT event_id, user_id AS device, ts AS time, {_yaw_err_sql()} AS yaw_err FROM events)
SELECT event_id, device, time, {R('yaw_err')} AS yaw_err,
  {R('avg(yaw_err) OVER (PARTITION BY device ORDER BY time, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS yaw_err_trend
FROM e""")
def q_angle_error_trend(spark, sf):
    """Rolling mean absolute yaw error (signed shortest angle difference)."""
    t = telemetry(spark, sf)
    t = t.withColumn("yaw_err", F.abs(angle_diff(wrap_deg(F.lit(11.0) * F.col("event_id")),
                                                 wrap_deg(F.lit(7.3) * F.col("value")))))
    r = TS.rows_agg(t, ["device"], "time", ["event_id"], 6, {"yaw_err_trend": F.avg("yaw_err")}, include_current=True)
    return r.select("event_id", "device", "time", r6("yaw_err").alias("yaw_err"), r6("yaw_err_trend").alias("yaw_err_trend"))


@register("resample", f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
  {R('avg(value)')} AS mean_value FROM events GROUP BY 1, 2""", digits=6)
def q_resample(spark, sf):
    return TS.resample(table(spark, sf, "events"), "1 hour", "ts", ["event_type"], ["value"])


@register("top_k_per", """SELECT user_id, event_id, value, rank FROM (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events)
WHERE rank <= 3""")
def q_top_k_per(spark, sf):
    """3 largest readings per device, two-phase (salted) so a hot device is split."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "value")
    return top_k_per(ev, ["user_id"], [F.desc("value"), F.col("event_id")], 3, salt_col="event_id")


@register("missing_steps", """WITH d AS (SELECT DISTINCT user_id AS device, CAST(ts AS DATE) AS day FROM events),
b AS (SELECT device, min(day) AS a, max(day) AS z FROM d GROUP BY device),
s AS (SELECT device, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT device, day FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.device = s.device AND d.day = s.day)""")
def q_missing_steps(spark, sf):
    return TS.time_spine_gaps(telemetry(spark, sf))
