"""Profiling queries (P1-P23) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6_sql as R
from gridlens.operators import profile as P
from gridlens.plans.registry import register, table


# Tables with some nulls made by nullif (the test tables hold none).
def customer_n(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.expr("nullif(c_nationkey, 0)").alias("c_nationkey"), "c_acctbal",
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"))


CUSTOMER_N = ("(SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS c_nationkey, c_acctbal, "
              "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)")


def orders_n(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"), "o_totalprice",
        "o_orderdate", F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"))


ORDERS_N = ("(SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, "
            "o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)")

CUST_COLS = [("c_custkey", "int"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "float"),
             ("c_mktsegment", "string")]
ORDER_COLS = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "string"), ("o_totalprice", "float"),
              ("o_orderdate", "datetime"), ("o_orderpriority", "string")]


def _overview_sql(src, cols, n_num):
    nulls = " + ".join(f"count_if({c} IS NULL)" for c, _ in cols)
    return (f"SELECT count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols, CAST({n_num} AS BIGINT) AS n_numeric, "
            f"{R(f'CASE WHEN count(*) > 0 THEN ({nulls}) / count(*) / {len(cols)} * 100.0 ELSE 0.0 END')} AS null_pct "
            f"FROM {src} t")


def _profile_sql(src, cols):
    parts = [f"SELECT '{c}' AS column_name, '{k}' AS kind, CAST(count_if({c} IS NULL) AS BIGINT) AS n_nulls, "
             f"{R(f'CASE WHEN count(*) > 0 THEN count_if({c} IS NULL) / count(*) * 100.0 ELSE 0.0 END')} AS null_pct, "
             f"count(DISTINCT {c}) AS n_distinct FROM {src} t" for c, k in cols]
    return "\nUNION ALL\n".join(parts)


@register("overview", _overview_sql(CUSTOMER_N, CUST_COLS, 3), digits=6)
def q_overview(spark, sf):
    return P.overview(customer_n(spark, sf))


@register("profile_columns", _profile_sql(CUSTOMER_N, CUST_COLS), digits=6)
def q_profile_columns(spark, sf):
    return P.profile_columns(customer_n(spark, sf))


EVENT_COLS = ["event_id", "event_type", "user_id", "value"]


@register("profile_merged", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, true AS within_error FROM events" for c in EVENT_COLS))
def q_profile_merged(spark, sf):
    """Distinct sketches of each day, merged; every estimate within four standard errors of the exact count."""
    ev = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), *EVENT_COLS)
    merged = P.merge_sketches(P.column_sketches(ev, ["day"]))
    exact = P.profile_columns(ev.select(*EVENT_COLS)).select("column_name", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) / F.greatest("exact", F.lit(1))
    return merged.join(exact, "column_name").select("column_name", "n_rows", "n_nulls", (off <= 4 * 0.0081).alias("within_error"))


@register("null_report", f"SELECT column_name, n_nulls, null_pct FROM ({_profile_sql(ORDERS_N, ORDER_COLS)}) x WHERE n_nulls > 0", digits=6)
def q_null_report(spark, sf):
    return P.null_report(orders_n(spark, sf))


@register("value_counts", "SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def q_value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "events"), "event_type")


@register("value_shares", f"""SELECT event_type AS value, count(*) AS n,
  {R('count(*) / (SELECT count(*) FROM events WHERE event_type IS NOT NULL)')} AS share
FROM events WHERE event_type IS NOT NULL GROUP BY 1""", digits=6)
def q_value_shares(spark, sf):
    return P.value_shares(table(spark, sf, "events"), "event_type")


@register("histogram", f"""WITH mm AS (SELECT CAST(min(l_extendedprice) AS DOUBLE) AS lo, CAST(max(l_extendedprice) AS DOUBLE) AS hi FROM lineitem),
w AS (SELECT lo, CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END AS w FROM mm),
c AS (SELECT CAST(least(floor((CAST(l_extendedprice AS DOUBLE) - lo) / w * 50.0) + 1, 50) AS BIGINT) AS bin, count(*) AS n
      FROM lineitem, w WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT b.bin, {R('w.lo + (b.bin - 1) * w.w / 50.0')} AS lo, {R('w.lo + (b.bin + 1 - 1) * w.w / 50.0')} AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(1, 51) b(bin) CROSS JOIN w LEFT JOIN c ON c.bin = b.bin""", digits=6)
def q_histogram(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50)


DESC_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _desc_sql(c, src="lineitem"):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, count({x}) AS n, {R(f'avg({x})')} AS mean, {R(f'stddev_samp({x})')} AS std, "
            f"{R(f'min({x})')} AS min, {R(f'quantile_cont({x}, 0.25)')} AS p25, {R(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{R(f'quantile_cont({x}, 0.75)')} AS p75, {R(f'max({x})')} AS max FROM {src}")


@register("describe_num", "\nUNION ALL\n".join(_desc_sql(c) for c in DESC_COLS), digits=6)
def q_describe_num(spark, sf):
    return P.describe_num(table(spark, sf, "lineitem", spread=True), DESC_COLS)


@register("describe_all", """WITH p AS (SELECT 'c_name' AS column_name, c_name AS value FROM customer
                UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer),
vc AS (SELECT column_name, value, count(*) AS n FROM p WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rk FROM vc)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique, max(CASE WHEN rk = 1 THEN value END) AS top,
       max(n) AS freq FROM r GROUP BY column_name""")
def q_describe_all(spark, sf):
    return P.describe_all(table(spark, sf, "customer"))


@register("describe_by", f"""SELECT event_type, count(value) AS n, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS std,
  {R('min(value)')} AS min, {R('quantile_cont(value, 0.25)')} AS p25, {R('quantile_cont(value, 0.5)')} AS p50,
  {R('quantile_cont(value, 0.75)')} AS p75, {R('max(value)')} AS max FROM events GROUP BY event_type""", digits=6)
def q_describe_by(spark, sf):
    return P.describe_by(table(spark, sf, "events"), ["event_type"], "value")


@register("rates_by", f"""SELECT l_returnflag, count(*) AS n, {R('avg(CAST(l_discount AS DOUBLE))')} AS mean_l_discount,
  {R('avg(CAST(l_tax AS DOUBLE))')} AS mean_l_tax, {R('avg(CAST((l_quantity > 25) AS DOUBLE))')} AS mean_is_big
FROM lineitem GROUP BY l_returnflag""", digits=6)
def q_rates_by(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("is_big", F.col("l_quantity") > 25)
    return P.rates_by(li, ["l_returnflag"], ["l_discount", "l_tax", "is_big"])


@register("device_severity_mean", f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {R('avg(CAST(l_quantity AS DOUBLE))')} AS mean_l_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus""", digits=6)
def q_device_severity_mean(spark, sf):
    return P.rates_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"])


@register("device_severity_rollup", f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {R('avg(CAST(l_quantity AS DOUBLE))')} AS mean_l_quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""", digits=6)
def q_device_severity_rollup(spark, sf):
    return P.rates_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"], rollup=True)


@register("agg_named", f"""SELECT l_linestatus, {R('avg(CAST(l_extendedprice AS DOUBLE))')} AS mean,
  {R('quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5)')} AS median, {R('stddev_samp(CAST(l_extendedprice AS DOUBLE))')} AS std
FROM lineitem GROUP BY l_linestatus""", digits=6)
def q_agg_named(spark, sf):
    return P.agg_named(table(spark, sf, "lineitem"), ["l_linestatus"], "l_extendedprice")


@register("top_products", f"""SELECT p_name, count(*) AS n, {R('avg(CAST(l_extendedprice AS DOUBLE))')} AS mean,
  {R('max(CAST(l_extendedprice AS DOUBLE))')} AS max
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name ORDER BY n DESC, p_name LIMIT 10""", digits=6)
def q_top_products(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return P.top_n_by(li, "p_name", "l_extendedprice", 10)


def _corr_sql(cols, src="lineitem"):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            xa, xb = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            den = f"(stddev_pop(CASE WHEN {both} THEN {xa} END) * stddev_pop(CASE WHEN {both} THEN {xb} END))"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                         f"{R(f'CASE WHEN {den} > 0 THEN covar_pop({xa}, {xb}) / {den} END')} AS corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql(DESC_COLS), digits=6)
def q_corr_matrix(spark, sf):
    return P.corr_matrix(table(spark, sf, "lineitem"), DESC_COLS)


@register("quantile99", f"SELECT {R('quantile_cont(o_totalprice, 0.99)')} AS q99, count(*) AS n FROM orders")
def q_quantile99(spark, sf):
    """Exact 99 % quantile of order value."""
    from gridlens.operators.quantiles import exact_quantiles
    o = table(spark, sf, "orders")
    q = exact_quantiles(o, "o_totalprice", [0.99]).first()["value"]   # one scalar
    return o.agg(F.count(F.lit(1)).alias("n")).select(F.expr(R(f"CAST({q!r} AS DOUBLE)")).alias("q99"), "n")


@register("class_balance", f"""SELECT count(*) AS n_rows, CAST(count_if(toxic = 1) AS BIGINT) AS n_pos, CAST(count_if(toxic = 0) AS BIGINT) AS n_neg,
  {R('count_if(toxic = 1) / count(*)')} AS pos_rate, CAST(floor(count_if(toxic = 0) * 0.01 / 0.99 + 0.5) AS BIGINT) AS pos_needed
FROM labels""", digits=6)
def q_class_balance(spark, sf):
    return P.class_balance(table(spark, sf, "labels"), "toxic", 0.01)


@register("monthly_counts", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, monthname(o_orderdate) AS month_name,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def q_monthly_counts(spark, sf):
    return P.monthly_counts(table(spark, sf, "orders"), "o_orderdate")


CITY_RE = ", ([A-Za-z ]+), [A-Z]{2}"


@register("city_counts", f"""WITH a AS (
  SELECT concat('1 Main St, ', r_name, ', CA 94016') AS addr FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT nullif(regexp_extract(addr, '{CITY_RE}', 1), '') AS city, count(*) AS n FROM a GROUP BY 1""")
def q_city_counts(spark, sf):
    """Orders per city extracted from a purchase address."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    addr = F.concat(F.lit("1 Main St, "), F.col("r_name"), F.lit(", CA 94016"))
    city = F.expr(f"nullif(regexp_extract(addr, '{CITY_RE}', 1), '')")
    return o.select(addr.alias("addr")).groupBy(city.alias("city")).agg(F.count(F.lit(1)).alias("n"))


@register("distinct_values", "SELECT DISTINCT p_type AS value FROM part WHERE p_type IS NOT NULL")
def q_distinct_values(spark, sf):
    return P.distinct_values(table(spark, sf, "part"), "p_type")


@register("hourly_profile", f"""SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
  {R('count(*) / (SELECT count(*) FROM events)')} AS share FROM events GROUP BY 1""", digits=6)
def q_hourly_profile(spark, sf):
    return P.hourly_profile(table(spark, sf, "events"), "ts")


def _bin_sql(c, bins=50):
    return (f"CAST(least(floor((CAST({c} AS DOUBLE) - mm.lo_{c}) / mm.w_{c} * {float(bins)}) + 1, {bins}) AS BIGINT)")


@register("density2d", f"""WITH m0 AS (SELECT CAST(min(l_quantity) AS DOUBLE) AS a, CAST(max(l_quantity) AS DOUBLE) AS b,
    CAST(min(l_discount) AS DOUBLE) AS c, CAST(max(l_discount) AS DOUBLE) AS d FROM lineitem),
mm AS (SELECT a AS lo_l_quantity, CASE WHEN b > a THEN b - a ELSE 1.0 END AS w_l_quantity,
              c AS lo_l_discount, CASE WHEN d > c THEN d - c ELSE 1.0 END AS w_l_discount FROM m0)
SELECT {_bin_sql('l_quantity')} AS bin_x, {_bin_sql('l_discount')} AS bin_y, l_returnflag, count(*) AS n
FROM lineitem, mm WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL GROUP BY 1, 2, 3""", digits=6)
def q_density2d(spark, sf):
    return P.density2d(table(spark, sf, "lineitem"), "l_quantity", "l_discount", "l_returnflag")


# Column lists of the driver tables (for the oracle text of the manifest).
TABLE_COLS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _manifest_sql():
    parts = []
    for t, cols in TABLE_COLS.items():
        nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
        parts.append(f"SELECT '{t}' AS dataset, count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols, "
                     f"{R(f'CASE WHEN count(*) > 0 THEN ({nulls}) / count(*) / {len(cols)} * 100.0 ELSE 0.0 END')} AS null_pct FROM {t}")
    return "\nUNION ALL\n".join(parts)


@register("dataset_manifest", _manifest_sql(), digits=6)
def q_dataset_manifest(spark, sf):
    """All tables loaded lazily, sized up in one union of aggregates."""
    tabs = {t: table(spark, sf, t) for t in TABLE_COLS}
    return P.manifest(tabs).drop("schema_kinds")
