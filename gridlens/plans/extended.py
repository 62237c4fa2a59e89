"""Variants of operators with all their parts: horizons, merchants, seasons, thermal and electrical checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6_sql as R, safe_div
from gridlens.operators import clean as C
from gridlens.operators import fraud as A
from gridlens.operators import joins as J
from gridlens.operators import overlay as OV
from gridlens.operators import profile as P
from gridlens.operators import sales as SL
from gridlens.operators import timeseries as TS
from gridlens.plans.faults import FAULT_TYPES, fault_events, telemetry
from gridlens.plans.registry import register, table

# --- null keys (a null group is a group) ---------------------------------------------


def _nulled(spark, sf):
    return table(spark, sf, "events").withColumn("device", F.expr("nullif(user_id % 10, 3)")).select(
        "event_id", "device", F.col("ts").alias("time"), "value", "event_type")


NULLED = "n AS (SELECT event_id, nullif(user_id % 10, 3) AS device, ts AS time, value, event_type FROM events)"


@register("spike_windows_nulls", f"""WITH {NULLED}
SELECT event_id, device, {R('avg(value) OVER w')} AS roll_mean FROM n
WINDOW w AS (PARTITION BY device ORDER BY time, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""", digits=6)
def q_spike_windows_nulls(spark, sf):
    return TS.spike_windows(_nulled(spark, sf), "value", tiebreak=["event_id"]).select("event_id", "device", "roll_mean")


@register("step_audit_nulls", f"""WITH {NULLED},
d AS (SELECT device, epoch_us(time) / 1e6 - epoch_us(lag(time) OVER (PARTITION BY device ORDER BY time, event_id)) / 1e6 AS s FROM n)
SELECT device, count(s) AS n_steps, {R('min(s)')} AS min_step_s, {R('max(s)')} AS max_step_s FROM d GROUP BY device""", digits=6)
def q_step_audit_nulls(spark, sf):
    return TS.step_audit(_nulled(spark, sf), tiebreak=["event_id"]).select("device", "n_steps", "min_step_s", "max_step_s")


@register("split_by_share_nulls", f"""WITH {NULLED}, c AS (SELECT device, count(*) AS n FROM n GROUP BY device)
SELECT device, CAST(floor(n * 0.8) AS BIGINT) AS n_train, CAST(n - floor(n * 0.8) AS BIGINT) AS n_test FROM c""")
def q_split_by_share_nulls(spark, sf):
    from gridlens.operators.sampling import split_by_share
    s = split_by_share(_nulled(spark, sf), ["device"], "event_id", [("train", 0.8), ("test", 0.2)], 11)
    return s.groupBy("device").agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))


# --- L12, L13, W5 -------------------------------------------------------------------------

@register("missing_charges_until", """WITH h AS (SELECT DISTINCT o_custkey, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
s AS (SELECT o_custkey, o_orderpriority, min(month) AS a, greatest(max(month), DATE '1998-12-01') AS z FROM h GROUP BY ALL),
sp AS (SELECT o_custkey, o_orderpriority, CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS month FROM s)
SELECT * FROM sp WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.o_custkey = sp.o_custkey AND h.o_orderpriority = sp.o_orderpriority AND h.month = sp.month)""")
def q_missing_charges_until(spark, sf):
    """L12 per customer and product, up to a horizon: who stopped paying is reported."""
    return J.missing_charges(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], "o_orderdate", until="1998-12-31")


@register("late_charges", """WITH l AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate,
  lag(o_orderdate) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS p FROM orders)
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(date_diff('day', CAST(p AS DATE), CAST(o_orderdate AS DATE)) - 31 AS INTEGER) AS days_late
FROM l WHERE date_diff('day', CAST(p AS DATE), CAST(o_orderdate AS DATE)) - 31 > 3""")
def q_late_charges(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return J.late_charges(o, ["o_custkey", "o_orderpriority"], "o_orderdate", tiebreak=["o_orderkey"]).drop("o_orderdate")


@register("spine_gaps", """WITH d AS (SELECT DISTINCT user_id AS device FROM events),
s AS (SELECT device, TIMESTAMP '2024-01-05 00:00:00' + to_hours(CAST(6 * k AS BIGINT)) AS time FROM d, range(40) r(k)),
h AS (SELECT DISTINCT user_id AS device, time_bucket(INTERVAL 6 HOUR, ts) AS time FROM events)
SELECT device, time FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.device = s.device AND h.time = s.time)""")
def q_spine_gaps(spark, sf):
    """Six-hour steps from 5 to 14 January that a device has no reading in."""
    return TS.spine_gaps(telemetry(spark, sf), 6 * 3600, "2024-01-05 00:00:00", "2024-01-15 00:00:00")


@register("yearly_residual", f"""WITH t AS (SELECT event_id, value, dayofyear(ts) AS dy, hour(ts) AS hr FROM events),
b AS (SELECT dy, hr, avg(value) AS baseline FROM t GROUP BY dy, hr)
SELECT event_id, {R('baseline')} AS baseline, {R('value - baseline')} AS residual FROM t JOIN b USING (dy, hr)""", digits=6)
def q_yearly_residual(spark, sf):
    """Day of year and hour."""
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    return TS.yearly_residual(ev, "value", "ts").select("event_id", "baseline", "residual")


# --- A2, A5, A6, A9, A15 ---------------------------------------------------------------------

@register("ping_merchant", f"""WITH t AS (SELECT user_id, event_type, ts, value, event_id FROM events WHERE value < 20.0 AND event_type IN ('click', 'view')),
l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p FROM t),
s AS (SELECT *, max(CASE WHEN p IS NULL OR epoch_us(ts) / 1e6 - epoch_us(p) / 1e6 > 172800.0 THEN ts END)
  OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start FROM l)
SELECT user_id, event_type, session_start, max(ts) AS session_end, count(*) AS n, {R('sum(value)')} AS total_amount,
  CAST(hour(session_start) < 5 AS INTEGER) AS late_night FROM s GROUP BY user_id, event_type, session_start HAVING count(*) BETWEEN 3 AND 5""", digits=6)
def q_ping_merchant(spark, sf):
    """A2 per customer and merchant, on the listed channels only."""
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts", "value", "event_id")
    return A.ping(ev, ["user_id", "event_type"], "ts", "value", max_amount=20.0, gap_seconds=172800, tiebreak=["event_id"],
                  channel="event_type", channels=["click", "view"])


@register("distance_score_abroad", f"""WITH d AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000.0 AS dist, greatest(abs(c_acctbal) / 100.0, 1.0) AS radius,
  c_nationkey % 2 = 0 AS abroad FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, {R('dist / radius')} AS distance_ratio,
  CASE WHEN o_orderstatus IN ('O') AND NOT abroad THEN 0 WHEN dist / radius > 3.0 THEN 1 ELSE 0 END AS distance_flag FROM d""", digits=6)
def q_distance_score_abroad(spark, sf):
    """A5: a cross-border row is scored whatever its channel."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumn("dist", F.col("o_totalprice") / 1000.0).withColumn("radius", F.greatest(F.abs(F.col("c_acctbal")) / 100.0, F.lit(1.0)))
    o = o.withColumn("abroad", F.col("c_nationkey") % 2 == 0)
    return A.distance_score(o, "dist", "radius", "o_orderstatus", ["O"], cross_border="abroad").select("o_orderkey", "distance_ratio", "distance_flag")


@register("off_primary_device", f"""WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
p AS (SELECT user_id, event_type AS pd FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1),
j AS (SELECT value >= 150.0 AS suspicious, event_type <> pd AS off FROM events JOIN p USING (user_id))
SELECT suspicious, count(*) AS n, CAST(count_if(off) AS BIGINT) AS n_off, {R('count_if(off) / count(*)')} AS off_rate FROM j GROUP BY suspicious""", digits=6)
def q_off_primary_device(spark, sf):
    """Transactions off the primary device, by class."""
    ev = table(spark, sf, "events").withColumn("suspicious", F.col("value") >= 150.0)
    return A.off_primary_device(ev, "user_id", "event_type", "suspicious")


@register("subscriptions", """WITH l AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_totalprice, lag(o_orderdate) OVER w AS pd, lag(o_totalprice) OVER w AS pa
  FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderpriority, count(*) AS n_links, min(o_orderdate) AS first_link_time, max(o_orderdate) AS last_link_time FROM l
WHERE date_diff('day', CAST(pd AS DATE), CAST(o_orderdate AS DATE)) BETWEEN 1 AND 200 AND abs(o_totalprice / pa - 1.0) <= 0.5
GROUP BY o_custkey, o_orderpriority HAVING count(*) >= 2""")
def q_subscriptions(spark, sf):
    """A9 per customer and merchant with three charges or more (wide limits: the test table has no subscriptions)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")
    return A.recurring(o, ["o_custkey", "o_orderpriority"], "o_orderdate", "o_totalprice", min_days=1, max_days=200, tol=0.5,
                       tiebreak=["o_orderkey"], min_charges=3)


#: Expected orders of a calendar month: mean and spread, given.
EXPECTED = [(m, 120.0 + 2.0 * m, 15.0) for m in range(1, 13)]


@register("volume_against", f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1),
e(moy, mu, sd) AS (VALUES {', '.join(f'({m}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))' for m, a, b in EXPECTED)})
SELECT month, n, mu AS expected_mean, sd AS expected_sd, {R('(n - mu) / sd')} AS z FROM m JOIN e ON month(month) = moy""", digits=6)
def q_volume_against(spark, sf):
    """Monthly volume against a given mean and spread."""
    m = P.monthly_counts(table(spark, sf, "orders"), "o_orderdate").drop("month_name")
    return A.volume_against(m, spark.createDataFrame(EXPECTED, "month_of_year int, expected_mean double, expected_sd double"))


# --- D5, D6, D15: thermal and electrical checks -------------------------------------------------
# Fixed values that must equal the reference: module and inverter temperature
# per W/m2 and kW, DC voltage and its temperature coefficient, current factor.
CHECKS = {
    "irr": "least(value * 4e0, 1.25e3)",
    "ambient": "1e1 + (event_id % 25e0)",
    "power": "solar_curve(irr)",
    "module_expected": "ambient + 2.8e-2 * irr",
    "inverter_expected": "ambient + 1.05e-2 * power",
    "module_seen": "module_expected + (event_id % 7e0) - 3e0",
    "inverter_seen": "inverter_expected + (event_id % 5e0) - 2e0",
    "volt_expected": "CASE WHEN power > 1e0 THEN least(greatest(8.2e2 - 5.5e-1 * least(greatest(module_expected - 2.5e1, -2.5e1), 5.5e1), 0e0), 9.5e2) ELSE 0e0 END",
    "amp_expected": "CASE WHEN volt_expected > 0e0 THEN power * 1.03e0 / greatest(volt_expected, 1e0) ELSE 0e0 END",
    "amp_seen": "amp_expected * (9.5e-1 + (event_id % 11e0) / 1e2)",
}


def _check_sql(keys):
    from gridlens.operators.scoring import chain_sql
    return chain_sql("SELECT event_id, user_id AS device, value FROM events", CHECKS, "k")


def _checked(spark, sf):
    from gridlens.operators.scoring import with_exprs
    return with_exprs(telemetry(spark, sf).select("event_id", "device", "value"), CHECKS)


_CK_CTE, _CK = _check_sql(CHECKS)


@register("thermal_residual", f"""WITH {_CK_CTE}
SELECT device, count(*) AS n, {R('avg(module_seen - module_expected)')} AS module_mean, {R('max(module_seen - module_expected)')} AS module_max,
  {R('avg(inverter_seen - inverter_expected)')} AS inverter_mean, {R('max(inverter_seen - inverter_expected)')} AS inverter_max FROM {_CK} GROUP BY device""", digits=6)
def q_thermal_residual(spark, sf):
    """Module and inverter temperature against ambient, irradiance and load."""
    m, i = F.col("module_seen") - F.col("module_expected"), F.col("inverter_seen") - F.col("inverter_expected")
    return _checked(spark, sf).groupBy("device").agg(F.count(F.lit(1)).alias("n"), F.avg(m).alias("module_mean"), F.max(m).alias("module_max"),
                                                     F.avg(i).alias("inverter_mean"), F.max(i).alias("inverter_max"))


@register("dc_audit", f"""WITH {_CK_CTE}
SELECT device, count(*) AS n, {R('avg(volt_expected)')} AS mean_voltage, {R('avg(amp_expected)')} AS mean_current,
  {R('avg(CASE WHEN amp_expected <> 0 THEN amp_seen / amp_expected ELSE 0.0 END)')} AS current_ratio,
  CAST(count_if(abs(amp_seen - amp_expected) > 0.03 * amp_expected) AS BIGINT) AS n_off FROM {_CK} GROUP BY device""", digits=6)
def q_dc_audit(spark, sf):
    """DC voltage and current implied by power; measured over expected, 0 where nothing flows."""
    off = F.abs(F.col("amp_seen") - F.col("amp_expected")) > 0.03 * F.col("amp_expected")
    return _checked(spark, sf).groupBy("device").agg(
        F.count(F.lit(1)).alias("n"), F.avg("volt_expected").alias("mean_voltage"), F.avg("amp_expected").alias("mean_current"),
        F.avg(safe_div("amp_seen", "amp_expected")).alias("current_ratio"), F.count_if(off).alias("n_off"))


# --- D18, D19, F2, P18, J15 --------------------------------------------------------------------

@register("sales_by_city_hour", f"""SELECT s_nationkey AS city, CAST(hour(l_shipdate + to_hours(l_linenumber)) AS INTEGER) AS hr, p_type AS product, count(*) AS n_lines,
  CAST(sum(l_quantity) AS DOUBLE) AS units, {R('sum(CAST(l_quantity * p_retailprice AS DOUBLE))')} AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""", digits=6)
def q_sales_by_city_hour(spark, sf):
    """Lines, units and revenue by place, hour and product."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    at = F.timestamp_add("HOUR", F.col("l_linenumber").cast("long"), F.col("l_shipdate").cast("timestamp_ntz"))
    return SL.sales_by(li, [F.col("s_nationkey").alias("city"), F.hour(at).alias("hr"), F.col("p_type").alias("product")], "l_quantity", "p_retailprice")


@register("rejected_lines", """SELECT count(*) AS n_rows, CAST(count_if(o_orderkey % 7 = 0) AS BIGINT) AS n_no_date, CAST(count_if(o_orderkey % 5 = 0) AS BIGINT) AS n_no_city,
  CAST(count_if(o_orderkey % 7 = 0 OR o_orderkey % 5 = 0) AS BIGINT) AS n_rejected FROM orders""")
def q_rejected_lines(spark, sf):
    """How many order lines do not parse, by reason."""
    o = table(spark, sf, "orders")
    lines = o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "Order Date").otherwise("04/19/19 08:46").alias("d"),
                     F.when(F.col("o_orderkey") % 5 == 0, "Purchase Address").otherwise("917 1st St, Dallas, TX 75001").alias("a"))
    return SL.rejected_lines(SL.parse_sales(lines, "d", "a", "o_orderkey"))


@register("stringify", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderstatus FROM orders""")
def q_stringify(spark, sf):
    """every column as text, timestamps in a fixed format."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderstatus")
    return C.stringify(o)


#: What orders the sample rows of each table; the first column tells which rows they are.
SAMPLE_ORDER = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
                "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
                "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}


def _kinds_sql(t: str) -> str:
    return (f"(SELECT string_agg(column_name || ':' || CASE WHEN column_type IN ('INTEGER', 'BIGINT') THEN 'int' WHEN column_type = 'DOUBLE' THEN 'float' "
            f"WHEN column_type = 'VARCHAR' THEN 'string' WHEN column_type = 'TIMESTAMP' THEN 'datetime' WHEN column_type = 'FLOAT[]' THEN 'array<float>' END, ',') "
            f"FROM (DESCRIBE {t}))")


@register("manifest_samples", "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS dataset, count(*) AS n_rows, {_kinds_sql(t)} AS schema_kinds,
  (SELECT string_agg({o[0]}, '|' ORDER BY {', '.join(o)}) FROM (SELECT * FROM {t} ORDER BY {', '.join(o)} LIMIT 3)) AS sample_keys FROM {t}"""
    for t, o in SAMPLE_ORDER.items()))
def q_manifest_samples(spark, sf):
    """Every table's rows, column kinds and three sample rows."""
    m = P.manifest({t: table(spark, sf, t) for t in SAMPLE_ORDER}, with_samples=True, sample_order=SAMPLE_ORDER)
    first = F.element_at(F.split(F.element_at(F.split("schema_kinds", ","), 1), ":"), 1)
    rows = F.from_json("sample_rows", "array<string>")
    keys = F.transform(rows, lambda r: F.element_at(F.from_json(r, "map<string,string>"), first))
    return m.select("dataset", "n_rows", "schema_kinds", F.array_join(keys, "|").alias("sample_keys"))


@register("missing_charges_nulls", """WITH o AS (SELECT CASE WHEN o_custkey % 40 <> 0 THEN o_custkey END AS o_custkey, o_orderdate FROM orders),
m AS (SELECT DISTINCT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS k FROM o),
n AS (SELECT o_custkey, k, lead(k) OVER (PARTITION BY o_custkey ORDER BY k) AS nxt FROM m),
g AS (SELECT o_custkey, unnest(range(k + 1, nxt)) AS k FROM n WHERE nxt > k + 1)
SELECT o_custkey, make_date(k // 12, k % 12 + 1, 1) AS month FROM g""")
def q_missing_charges_nulls(spark, sf):
    """L12 where some charges have no customer: those are one calendar of their own."""
    o = table(spark, sf, "orders").select(F.when(F.col("o_custkey") % 40 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderdate")
    return J.missing_charges(o, ["o_custkey"], "o_orderdate")


@register("missing_steps_nulls", """WITH d AS (SELECT DISTINCT CASE WHEN user_id % 10 <> 0 THEN user_id END AS device, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error'),
n AS (SELECT device, day, lead(day) OVER (PARTITION BY device ORDER BY day) AS nxt FROM d)
SELECT device, CAST(unnest(generate_series(day + 1, nxt - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM n WHERE nxt > day + 1""")
def q_missing_steps_nulls(spark, sf):
    """L13 where some readings have no device: those are one spine of their own."""
    t = table(spark, sf, "events").where("event_type = 'error'").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("device"), F.col("ts").alias("time"))
    return TS.time_spine_gaps(t)


@register("apply_bounds_nulls", """WITH r AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN CAST('NaN' AS DOUBLE)
    WHEN event_id % 13 = 0 THEN value * 1e16 WHEN event_id % 17 = 0 THEN value * -1.013 ELSE value * 1.37 END AS v FROM events),
k AS (SELECT event_id, v, CASE WHEN v IS NULL THEN 'missing' WHEN isnan(v) THEN 'not a number' ELSE 'number' END AS kind FROM r)
SELECT event_id, kind,
  CASE WHEN kind = 'number' AND v < 0 THEN 0.0 WHEN kind = 'number' AND abs(v) < 1e12 THEN round(v, 2) WHEN kind = 'number' THEN v END AS floored,
  CASE WHEN kind = 'number' AND v > 90 THEN 90.0 WHEN kind = 'number' AND v < -5 THEN -5.0 WHEN kind = 'number' THEN round(v, 1) END AS clipped,
  CASE WHEN kind = 'number' THEN v END AS kept FROM k""")
def q_apply_bounds_nulls(spark, sf):
    """F6 on missing readings, NaN and values beyond 64-bit integers."""
    e = F.col("event_id")
    v = (F.when(e % 7 == 0, None).when(e % 11 == 0, float("nan")).when(e % 13 == 0, F.col("value") * 1e16)
         .when(e % 17 == 0, F.col("value") * -1.013).otherwise(F.col("value") * 1.37))
    raw = table(spark, sf, "events").select("event_id", v.alias("floored")).withColumns({"clipped": F.col("floored"), "kept": F.col("floored")})
    got = C.apply_bounds(raw, {"floored": (0.0, None, 2), "clipped": (-5.0, 90.0, 1), "kept": (None, None, None)})
    kind = F.when(F.col("kept").isNull(), "missing").when(F.isnan("kept"), "not a number").otherwise("number")
    number = {c: F.when(~F.isnan(c), F.col(c)) for c in ("floored", "clipped", "kept")}
    return got.withColumn("kind", kind).withColumns(number).select("event_id", "kind", "floored", "clipped", "kept")


@register("fault_types_known", "SELECT CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'error' AND value >= 150.0")
def q_fault_types_known(spark, sf):
    """Every fault type of the event table has an effect in the registry (an unknown one raises)."""
    ev = fault_events(spark, sf, FAULT_TYPES)
    OV.check_types(ev, "solar")
    return ev.agg(F.count(F.lit(1)).alias("n"))
