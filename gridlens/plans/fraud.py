"""Fraud / anomaly detector queries.

Mappings: ``events`` as card transactions (customer = user_id, merchant or
device = event_type, amount = value); ``orders`` x ``customer`` as
transactions with a profile (signup = first order, channel = status,
category = priority).  Thresholds are scaled to the test data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6, r6_sql as R
from gridlens.operators import fraud as A
from gridlens.operators.joins import attach_lookup
from gridlens.plans.joins import PRIORITY_MULT, accounts, ACCOUNTS_SQL
from gridlens.plans.registry import register, table

MULT_SQL = "m(k, v) AS (VALUES " + ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in PRIORITY_MULT.items()) + ")"


@register("velocity", """SELECT event_id, event_type, ts, n_in_window FROM (
  SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
    RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS n_in_window FROM events) WHERE n_in_window >= 25""")
def q_velocity(spark, sf):
    """A1: >= 25 transactions at one merchant within 6 hours (test-scaled 10 in 300 s)."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return A.velocity(ev, ["event_type"], "ts", n=25, secs=6 * 3600)


@register("velocity_ranked", """SELECT event_id, event_type, ts, n_in_window FROM (
  SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
    RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS n_in_window FROM events) WHERE n_in_window >= 40""")
def q_velocity_ranked(spark, sf):
    """A1 by rank difference: >= 40 transactions at one merchant within a day, at any density of the merchant."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return A.velocity(ev, ["event_type"], "ts", n=40, secs=24 * 3600, by_rank=True)


@register("ping", f"""WITH t AS (SELECT user_id, ts, value, event_id FROM events WHERE value < 5.0),
l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM t),
s AS (SELECT *, max(CASE WHEN p IS NULL OR epoch_us(ts) / 1e6 - epoch_us(p) / 1e6 > 43200.0 THEN ts END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start FROM l)
SELECT user_id, session_start, max(ts) AS session_end, count(*) AS n, {R('sum(value)')} AS total_amount,
       CAST(hour(session_start) < 5 AS INTEGER) AS late_night
FROM s GROUP BY user_id, session_start HAVING count(*) BETWEEN 3 AND 5""")
def q_ping(spark, sf):
    """A2: bursts of 3-5 tiny payments per customer (test-scaled: < 5.0, 12 h gap)."""
    ev = table(spark, sf, "events").select("user_id", "ts", "value", "event_id")
    p = A.ping(ev, ["user_id"], "ts", "value", max_amount=5.0, gap_seconds=43200, tiebreak=["event_id"])
    return p.select("user_id", "session_start", "session_end", "n", r6("total_amount").alias("total_amount"), "late_night")


RISKY = ["1-URGENT", "2-HIGH"]


@register("high_value", f"""SELECT o_orderkey, o_totalprice, o_orderpriority, {R('(SELECT quantile_cont(o_totalprice, 0.99) FROM orders)')} AS threshold
FROM orders WHERE o_totalprice > (SELECT quantile_cont(o_totalprice, 0.99) FROM orders) AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_high_value(spark, sf):
    """A3: amount above the 99 % quantile at a high-risk category."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return A.high_value(o, "o_totalprice", "o_orderpriority", RISKY).withColumn("threshold", r6("threshold"))


def _orders_profile(spark, sf):
    o = table(spark, sf, "orders")
    return o.join(accounts(spark, sf), F.col("o_custkey") == F.col("c_custkey"))


@register("amount_residual", f"""WITH {MULT_SQL}
SELECT o_orderkey, {R('(ln(o_totalprice) - ln(28.0 * (greatest(c_acctbal, 100.0) / 100.0) * m.v)) / 0.75')} AS amount_z
FROM orders JOIN customer ON o_custkey = c_custkey JOIN m ON o_orderpriority = m.k""")
def q_amount_residual(spark, sf):
    """A4: log amount vs the customer's spend level x category multiplier."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = attach_lookup(o, "o_orderpriority", PRIORITY_MULT, "mult").withColumn(
        "spend", F.greatest(F.col("c_acctbal"), F.lit(100.0)) / 100.0)
    return A.amount_residual(o, "o_totalprice", "spend", "mult").select("o_orderkey", r6("amount_z").alias("amount_z"))


@register("distance_score", f"""WITH d AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000.0 AS dist,
  greatest(abs(c_acctbal) / 100.0, 1.0) AS radius FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, {R('dist / radius')} AS distance_ratio,
  CASE WHEN o_orderstatus IN ('O') THEN 0 WHEN dist / radius > 3.0 THEN 1 ELSE 0 END AS distance_flag FROM d""")
def q_distance_score(spark, sf):
    """A5: distance over usual radius, online channel exempt."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumn("dist", F.col("o_totalprice") / 1000.0).withColumn(
        "radius", F.greatest(F.abs(F.col("c_acctbal")) / 100.0, F.lit(1.0)))
    s = A.distance_score(o, "dist", "radius", "o_orderstatus", ["O"])
    return s.select("o_orderkey", r6("distance_ratio").alias("distance_ratio"), "distance_flag")


@register("device_switch", f"""WITH l AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pe FROM events)
SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN pe IS NOT NULL AND pe <> event_type THEN 1 ELSE 0 END) AS BIGINT) AS n_switch,
  {R('sum(CASE WHEN pe IS NOT NULL AND pe <> event_type THEN 1 ELSE 0 END) / count(*)')} AS switch_rate FROM l GROUP BY user_id""")
def q_device_switch(spark, sf):
    """Device (event_type) switch rate per customer via the previous row."""
    ev = table(spark, sf, "events").select("user_id", "ts", "event_type", "event_id")
    d = A.device_switch(ev, "user_id", "ts", "event_type", ["event_id"])
    return d.select("user_id", "n", "n_switch", r6("switch_rate").alias("switch_rate"))


@register("new_account", f"""WITH {ACCOUNTS_SQL},
a AS (SELECT o_orderkey, o_custkey, CAST(greatest(0, date_diff('day', CAST(signup AS DATE), CAST(o_orderdate AS DATE))) AS BIGINT) AS account_age_days
      FROM orders JOIN acc ON o_custkey = c_custkey)
SELECT * FROM a WHERE account_age_days < 15""")
def q_new_account(spark, sf):
    """Transactions within 15 days of the account's signup (first order)."""
    j = _orders_profile(spark, sf)
    age = F.greatest(F.lit(0), F.datediff(F.col("o_orderdate").cast("date"), F.col("signup").cast("date"))).cast("long")
    t = j.select("o_orderkey", "o_custkey", age.alias("account_age_days"))
    return A.new_account(t, "account_age_days", 15)


@register("late_night", f"""SELECT user_id, count(*) AS n, CAST(count_if(hour(ts) < 5) AS BIGINT) AS n_late,
  {R('count_if(hour(ts) < 5) / count(*)')} AS late_share FROM events GROUP BY user_id""")
def q_late_night(spark, sf):
    """Late-night share per customer (hour < 5)."""
    r = A.late_night(table(spark, sf, "events"), "user_id", "ts")
    return r.select("user_id", "n", "n_late", r6("late_share").alias("late_share"))


@register("recurring", """WITH l AS (SELECT o_custkey, o_orderdate, o_totalprice,
    lag(o_orderdate) OVER w AS pd, lag(o_totalprice) OVER w AS pa FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, count(*) AS n_links, min(o_orderdate) AS first_link_time, max(o_orderdate) AS last_link_time FROM l
WHERE date_diff('day', CAST(pd AS DATE), CAST(o_orderdate AS DATE)) BETWEEN 27 AND 32 AND abs(o_totalprice / pa - 1.0) <= 0.1
GROUP BY o_custkey""")
def q_recurring(spark, sf):
    """Monthly-spaced charges of similar amount per customer."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    return A.recurring(o, ["o_custkey"], "o_orderdate", "o_totalprice", tiebreak=["o_orderkey"])


# Additive expected cross-border rates: base + category extra + channel extra.
XB_BASE = 0.012
XB_CATEGORY = {"PROMO": 0.12, "LARGE": 0.025, "SMALL": 0.025}
XB_CHANNEL = {"1-URGENT": 0.055, "2-HIGH": 0.01}


def _map_sql(d, col):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v!r}" for k, v in d.items()) + " ELSE 0.0 END"


@register("cross_border_rates", f"""WITH x AS (SELECT o_orderpriority AS channel, p_type AS category,
    CAST(c_nationkey <> s_nationkey AS DOUBLE) AS xb
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
SELECT channel, category, count(*) AS n, {R('avg(xb)')} AS rate,
  {R(f"{XB_BASE!r} + {_map_sql(XB_CATEGORY, 'category')} + {_map_sql(XB_CHANNEL, 'channel')}")} AS expected,
  {R(f"avg(xb) - ({XB_BASE!r} + {_map_sql(XB_CATEGORY, 'category')} + {_map_sql(XB_CHANNEL, 'channel')})")} AS excess
FROM x GROUP BY channel, category""")
def q_cross_border_rates(spark, sf):
    """A10: cross-border rate by channel and category against additive base rates."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    j = (li.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(table(spark, sf, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")))
    x = j.select(F.col("o_orderpriority").alias("channel"), F.col("p_type").alias("category"),
                 (F.col("c_nationkey") != F.col("s_nationkey")).cast("double").alias("xb"))
    g = x.groupBy("channel", "category").agg(F.count(F.lit(1)).alias("n"), F.avg("xb").alias("rate"))
    g = attach_lookup(g, "category", XB_CATEGORY, "_ec", 0.0)
    g = attach_lookup(g, "channel", XB_CHANNEL, "_eh", 0.0)
    exp = F.lit(XB_BASE) + F.col("_ec") + F.col("_eh")
    return g.select("channel", "category", "n", r6("rate").alias("rate"), r6(exp).alias("expected"),
                    r6(F.col("rate") - exp).alias("excess"))


MIX_WEIGHTS = {"view": 0.3, "click": 0.25, "purchase": 0.15, "signup": 0.1, "error": 0.2}


@register("mix_audit", f"""WITH w(value, expected_share) AS (VALUES {', '.join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in MIX_WEIGHTS.items())}),
o AS (SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1),
t AS (SELECT count(*) AS tot FROM events WHERE event_type IS NOT NULL),
j AS (SELECT coalesce(o.n, 0) AS n, coalesce(w.expected_share, 0.0) AS e FROM o FULL OUTER JOIN w ON o.value = w.value)
SELECT (SELECT tot FROM t) AS n,
  {R('sum(CASE WHEN e > 0 THEN pow(n - e * (SELECT tot FROM t), 2) / (e * (SELECT tot FROM t)) END)')} AS chi2,
  {R('sum(CASE WHEN e > 0 AND n > 0 THEN (n / (SELECT tot FROM t) - e) * ln((n / (SELECT tot FROM t)) / e) END)')} AS psi,
  CAST(count_if(e = 0) AS BIGINT) AS n_unexpected, CAST(count_if(n = 0) AS BIGINT) AS n_missing FROM j""")
def q_mix_audit(spark, sf):
    """Event-type mix vs expected weights: chi-square and PSI."""
    m = A.mix_audit(table(spark, sf, "events"), "event_type", MIX_WEIGHTS)
    return m.select("n", r6("chi2").alias("chi2"), r6("psi").alias("psi"), "n_unexpected", "n_missing")


@register("dist_audit", f"""WITH st AS (SELECT count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, max(value) AS mx FROM events WHERE value IS NOT NULL),
w AS (SELECT n, mean, std, CASE WHEN mx > 0 THEN mx / 1000 ELSE 1.0 END AS w FROM st),
c AS (SELECT CAST(least(floor(value / w.w), 999) AS BIGINT) AS bin, count(*) AS c FROM events, w WHERE value IS NOT NULL GROUP BY 1),
cu AS (SELECT bin, sum(c) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM c)
SELECT w.n, {R('w.mean')} AS mean, {R('w.std')} AS std, {R('w.std / w.mean')} AS cv,
  {R('max(abs(cum / w.n - (1.0 - exp(-((bin + 1) * w.w) / w.mean))))')} AS ks
FROM cu, w GROUP BY w.n, w.mean, w.std, w.w""")
def q_dist_audit(spark, sf):
    """Exponential fit of the amounts and KS distance on a binned CDF."""
    d = A.dist_audit(table(spark, sf, "events"), "value", "exponential", 1000)
    return d.select("n", r6("mean").alias("mean"), r6("std").alias("std"), r6("cv").alias("cv"), r6("ks").alias("ks"))


@register("detector_report", f"""WITH j AS (SELECT source, CAST(quality = 0 AS INTEGER) AS p, toxic AS t FROM labels JOIN documents USING (doc_id)),
g AS (SELECT source, CAST(count_if(p = 1 AND t = 1) AS BIGINT) AS tp, CAST(count_if(p = 1 AND t = 0) AS BIGINT) AS fp,
  CAST(count_if(p = 0 AND t = 1) AS BIGINT) AS fn, CAST(count_if(p = 0 AND t = 0) AS BIGINT) AS tn FROM j GROUP BY source)
SELECT source, tp, fp, fn, tn, {R('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END')} AS precision,
  {R('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END')} AS recall,
  {R('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END')} AS f1 FROM g""", digits=6)
def q_detector_report(spark, sf):
    """Precision / recall / F1 of a detector (low quality -> toxic) per source."""
    truth = _labels_with_source(spark, sf)
    pred = truth.select("doc_id", (F.col("quality") == 0).cast("int").alias("pred"))
    return A.detector_report(pred, truth, "doc_id", "pred", "toxic", by=["source"]).drop("n_no_truth")


def _labels_with_source(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


@register("detector_report_flagged", f"""WITH j AS (SELECT source, CAST(quality = 0 AND doc_id % 3 > 0 AS INTEGER) AS p, toxic AS t
  FROM labels JOIN documents USING (doc_id)),
g AS (SELECT source, CAST(count_if(p = 1 AND t = 1) AS BIGINT) AS tp, CAST(count_if(p = 1 AND t = 0) AS BIGINT) AS fp,
  CAST(count_if(p = 0 AND t = 1) AS BIGINT) AS fn, CAST(count_if(p = 0 AND t = 0) AS BIGINT) AS tn FROM j GROUP BY source)
SELECT source, tp, fp, fn, tn, CAST(0 AS BIGINT) AS n_no_truth, {R('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END')} AS precision,
  {R('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END')} AS recall,
  {R('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END')} AS f1 FROM g""", digits=6)
def q_detector_report_flagged(spark, sf):
    """A13 on a prediction that holds flagged rows only: what it misses counts against its recall."""
    truth = _labels_with_source(spark, sf)
    pred = truth.where((F.col("quality") == 0) & (F.col("doc_id") % 3 > 0)).select("doc_id", F.lit(1).alias("pred"))
    return A.detector_report(pred, truth, "doc_id", "pred", "toxic", by=["source"])


@register("volume_audit", f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT month(month) AS moy, avg(n) AS mu, stddev_samp(n) AS sd FROM m GROUP BY 1)
SELECT month, n, {R('mu')} AS expected_mean, {R('sd')} AS expected_sd, {R('CASE WHEN sd > 0 THEN (n - mu) / sd END')} AS z
FROM m JOIN e ON month(month) = e.moy""")
def q_volume_audit(spark, sf):
    """Monthly volume vs the level expected for that calendar month (z-score)."""
    from gridlens.operators.profile import monthly_counts
    m = monthly_counts(table(spark, sf, "orders"), "o_orderdate").drop("month_name")
    e = m.groupBy(F.month("month").alias("_moy")).agg(F.avg("n").alias("mu"), F.stddev_samp("n").alias("sd"))
    j = m.join(F.broadcast(e), F.month("month") == F.col("_moy"))
    return j.select("month", "n", r6("mu").alias("expected_mean"), r6("sd").alias("expected_sd"),
                    r6(F.try_divide(F.col("n") - F.col("mu"), F.col("sd"))).alias("z"))


@register("velocity_bursts", """WITH f AS (
  SELECT event_id, event_type, ts, n_in_window FROM (
    SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
      RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS n_in_window FROM events) WHERE n_in_window >= 25),
l AS (SELECT *, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM f),
s AS (SELECT *, max(CASE WHEN p IS NULL OR epoch_us(ts) / 1e6 - epoch_us(p) / 1e6 > 21600.0 THEN ts END)
        OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst_start FROM l)
SELECT event_type, burst_start, max(ts) AS burst_end, count(*) AS n_flagged, max(n_in_window) AS peak
FROM s GROUP BY event_type, burst_start""")
def q_velocity_bursts(spark, sf):
    """A1 report: velocity hits merged into bursts per merchant."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return A.velocity_bursts(ev, ["event_type"], "ts", n=25, secs=6 * 3600, tiebreak=["event_id"])



def _dist_sql(dist, src_sql):
    from gridlens.operators.fraud import cdf_sql
    edge = "((bin + 1) * w.w)"
    model = cdf_sql(dist, edge, "w.mean", "w.mu", "w.sigma")
    return f"""WITH v AS ({src_sql}),
st AS (SELECT count(*) AS n, avg(x) AS mean, stddev_samp(x) AS std, max(x) AS mx,
         avg(ln(CASE WHEN x > 0 THEN x END)) AS mu, stddev_samp(ln(CASE WHEN x > 0 THEN x END)) AS sigma FROM v),
w AS (SELECT n, mean, std, coalesce(mu, 0.0) AS mu, coalesce(sigma, 1.0) AS sigma,
        CASE WHEN mx > 0 THEN mx / 1000 ELSE 1.0 END AS w FROM st),
c AS (SELECT CAST(least(floor(x / w.w), 999) AS BIGINT) AS bin, count(*) AS c FROM v, w GROUP BY 1),
cu AS (SELECT bin, sum(c) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM c)
SELECT '{dist}' AS dist, w.n, {R('w.mean')} AS mean, {R('w.std')} AS std, {R('w.std / w.mean')} AS cv,
  {R(f'max(abs(cum / w.n - {model}))')} AS ks
FROM cu, w GROUP BY w.n, w.mean, w.std, w.w, w.mu, w.sigma"""


def _dist_query(dist, tbl, col):
    def q(spark, sf):
        d = A.dist_audit(table(spark, sf, tbl), col, dist)
        return d.select("dist", "n", r6("mean").alias("mean"), r6("std").alias("std"), r6("cv").alias("cv"),
                        r6("ks").alias("ks"))
    q.__doc__ = f"A12: {dist} fit of {tbl}.{col} and KS distance on a binned CDF."
    return q


for _key, _dist, _tbl, _col in [("dist_audit_gamma2", "gamma2", "events", "value"),
                                 ("dist_audit_lognormal", "lognormal", "orders", "o_totalprice"),
                                 ("dist_audit_geometric", "geometric", "lineitem", "l_quantity")]:
    register(_key, _dist_sql(_dist, f"SELECT CAST({_col} AS DOUBLE) AS x FROM {_tbl} WHERE {_col} IS NOT NULL"))(
        _dist_query(_dist, _tbl, _col))
