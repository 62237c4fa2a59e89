"""Thermal residuals of wind turbines and pumps, and drift against the fleet.

The signals are derived from the events and order lines; the oracles state the
relations in SQL of their own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6_sql as R
from gridlens.operators import thermal as TH
from gridlens.plans.registry import register, table

_WIND_SQL = """t AS (SELECT user_id AS device, 10.0 + event_id % 25 AS ambient, least(value * 20.0, 4400.0) AS kw, 4.0 + event_id % 13 AS rotor,
    95.0 * (4.0 + event_id % 13) AS gen, (event_id % 9) * 1.0 AS yaw, CAST(event_id % 17 - 4 AS DOUBLE) AS off FROM events),
e AS (SELECT device, off, ambient + 17.0 + 0.010 * kw + 0.10 * rotor AS gearbox, ambient + 20.0 + 0.014 * kw + 0.0008 * gen AS generator,
    ambient + 12.0 + 0.007 * kw + 0.06 * rotor + 0.015 * pow(yaw, 1.7) AS bearing, ambient + 14.0 + 0.011 * kw AS converter,
    20.0 + ambient + 0.012 * kw AS seen FROM t)"""


@register("wind_thermal_residual", f"""WITH {_WIND_SQL},
r AS (SELECT device, 'gearbox_oil_temp' AS part, seen + off - gearbox AS r FROM e UNION ALL SELECT device, 'generator_temp', seen + off - generator FROM e
  UNION ALL SELECT device, 'bearing_temp', seen + off - bearing FROM e UNION ALL SELECT device, 'converter_temp', seen + off - converter FROM e)
SELECT device, part, count(*) AS n, {R('avg(r)')} AS mean_residual, {R('max(r)')} AS max_residual,
  {R('avg(CASE WHEN r > 10.0 THEN 1.0 ELSE 0.0 END)')} AS share_over FROM r GROUP BY device, part""", digits=6)
def q_wind_thermal_residual(spark, sf):
    """Gearbox, generator, bearing and converter against ambient, power, speeds and yaw error."""
    e = F.col("event_id")
    ev = table(spark, sf, "events").select(
        F.col("user_id").alias("device"), (10.0 + e % 25).alias("ambient"), F.least(F.col("value") * 20.0, F.lit(4400.0)).alias("kw"),
        (4.0 + e % 13).alias("rotor"), (95.0 * (4.0 + e % 13)).alias("gen"), ((e % 9) * 1.0).alias("yaw"), (e % 17 - 4).cast("double").alias("off"))
    seen = 20.0 + F.col("ambient") + 0.012 * F.col("kw") + F.col("off")
    tel = ev.withColumns({part: seen for part in TH.WIND_PARTS})
    return TH.residual_report(tel, TH.wind_thermal_expected("ambient", "kw", "rotor", "gen", "yaw"), ["device"])


@register("bearing_residual", f"""WITH t AS (SELECT l_returnflag, 15.0 + l_linenumber AS ambient, l_quantity AS shaft, l_extendedprice / 90000.0 AS ratio,
    40.0 + l_discount * 100.0 AS seen FROM lineitem),
r AS (SELECT l_returnflag, seen - (ambient + 16.0 + 0.55 * shaft + 5.0 * pow(abs(ratio - 1.0), 1.6)) AS r FROM t)
SELECT l_returnflag, 'bearing_temp_c' AS part, count(*) AS n, {R('avg(r)')} AS mean_residual, {R('max(r)')} AS max_residual,
  {R('avg(CASE WHEN r > 10.0 THEN 1.0 ELSE 0.0 END)')} AS share_over FROM r GROUP BY l_returnflag""", digits=6)
def q_bearing_residual(spark, sf):
    """Pump bearing temperature against ambient, shaft power and distance from the best flow."""
    tel = table(spark, sf, "lineitem").select(
        "l_returnflag", (15.0 + F.col("l_linenumber")).alias("ambient"), F.col("l_quantity").alias("shaft"), (F.col("l_extendedprice") / 90000.0).alias("ratio"),
        (40.0 + F.col("l_discount") * 100.0).alias("bearing_temp_c"))
    return TH.residual_report(tel, {"bearing_temp_c": TH.pump_bearing_expected("ambient", "shaft", "ratio")}, ["l_returnflag"])


DRIFT_SLACK, DRIFT_ALARM = 800, 12000

# Running totals in whole hundredths, so that both engines add exactly.
_DRIFT_SQL = f"""WITH d AS (SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(floor(value * 100.0) AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM events GROUP BY 1),
x AS (SELECT e.event_id, e.user_id AS device, e.ts AS time, CAST(floor(e.value * 100.0) AS BIGINT) - d.s // d.n - {DRIFT_SLACK} AS x
  FROM events e JOIN d ON d.day = CAST(e.ts AS DATE)),
p AS (SELECT *, CAST(sum(x) OVER (PARTITION BY device ORDER BY time, event_id) AS BIGINT) AS p FROM x),
q AS (SELECT *, p - x AS q FROM p),
l AS (SELECT *, min(q) OVER (PARTITION BY device ORDER BY time, event_id) AS low FROM q),
a AS (SELECT *, greatest(p - low, 0) AS cusum FROM l),
f AS (SELECT * FROM a WHERE cusum > {DRIFT_ALARM} QUALIFY row_number() OVER (PARTITION BY device ORDER BY time, event_id) = 1)
SELECT f.device, f.time AS alarm_time, (SELECT min(l.time) FROM l WHERE l.device = f.device AND l.q = f.low AND l.time <= f.time) AS drift_start, f.cusum
FROM f"""


def _excess(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"),
                                           F.floor(F.col("value") * 100.0).cast("long").alias("v")).withColumn("day", F.col("time").cast("date"))
    fleet = ev.groupBy("day").agg(F.expr("sum(v) div count(1)").alias("base"))  # a row per day
    return ev.join(fleet, "day").withColumn("excess", F.col("v") - F.col("base") - F.lit(DRIFT_SLACK))


@register("fleet_drift", _DRIFT_SQL)
def q_fleet_drift(spark, sf):
    """D5 over time: when a device's readings drift above the day's fleet mean, and since when."""
    return TH.fleet_drift(_excess(spark, sf), ["device"], "time", "excess", DRIFT_ALARM, ["event_id"])


@register("fleet_drift_bucketed", _DRIFT_SQL)
def q_fleet_drift_bucketed(spark, sf):
    """The same through summaries of time buckets, used where a device is full."""
    return TH.fleet_drift(_excess(spark, sf), ["device"], "time", "excess", DRIFT_ALARM, ["event_id"], bucket_seconds=86400)
