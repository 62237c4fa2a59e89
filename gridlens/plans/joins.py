"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.exprs import r6, r6_sql as R
from gridlens.operators import joins as J
from gridlens.plans.registry import register, table


@register("attach_device", f"""SELECT l_orderkey, l_linenumber, l_partkey, p_type, p_size,
  {R('coalesce(CASE WHEN p_size > 45 THEN p_retailprice * 0.9 END, p_retailprice)')} AS p_retailprice
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def q_attach_device(spark, sf):
    """Lines x product metadata with a per-device override (large sizes derated)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    j = J.attach_device(li, part, F.col("l_partkey") == F.col("p_partkey"),
                        {"p_retailprice": F.when(F.col("p_size") > 45, F.col("p_retailprice") * 0.9)})
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "p_type", "p_size",
                    r6("p_retailprice").alias("p_retailprice"))


@register("attach_site", f"""WITH s AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS site_time, avg(value) AS site_mean FROM events GROUP BY 1)
SELECT event_id, site_time, {R('site_mean')} AS site_mean, {R('value - site_mean')} AS rel_value
FROM events JOIN s ON time_bucket(INTERVAL 1 HOUR, ts) = s.site_time""")
def q_attach_site(spark, sf):
    """Per-time shared conditions (hourly fleet mean) joined onto every row."""
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    site = ev.groupBy(F.window("ts", "1 hour").start.alias("site_time")).agg(F.avg("value").alias("site_mean"))
    j = J.attach_site(ev, site, "ts", "1 hour")
    return j.select("event_id", "site_time", r6("site_mean").alias("site_mean"),
                    r6(F.col("value") - F.col("site_mean")).alias("rel_value"))


def accounts(spark, sf):
    """Customers with a signup date = their first order (derived)."""
    o = table(spark, sf, "orders")
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("signup"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(first, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


ACCOUNTS_SQL = """acc AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, signup FROM customer
  JOIN (SELECT o_custkey, min(o_orderdate) AS signup FROM orders GROUP BY o_custkey) f ON c_custkey = f.o_custkey)"""


@register("account_age", f"""WITH {ACCOUNTS_SQL}
SELECT o_orderkey, o_custkey, c_nationkey, CAST(greatest(0, date_diff('day', CAST(signup AS DATE), CAST(o_orderdate AS DATE))) AS BIGINT) AS account_age_days
FROM orders JOIN acc ON o_custkey = c_custkey""")
def q_account_age(spark, sf):
    """Transaction x customer profile: home nation and account age (never negative)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = o.join(accounts(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    age = F.greatest(F.lit(0), F.datediff(F.col("o_orderdate").cast("date"), F.col("signup").cast("date"))).cast("long")
    return j.select("o_orderkey", "o_custkey", "c_nationkey", age.alias("account_age_days"))


PRIORITY_MULT = {"1-URGENT": 1.8, "2-HIGH": 1.4, "3-MEDIUM": 1.0, "4-NOT SPECIFIED": 0.9, "5-LOW": 0.7}


@register("category_lookup", f"""WITH m(k, v) AS (VALUES {', '.join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in PRIORITY_MULT.items())})
SELECT o_orderkey, o_orderpriority, m.v AS multiplier, {R('o_totalprice * m.v')} AS scaled_amount
FROM orders LEFT JOIN m ON o_orderpriority = m.k""")
def q_category_lookup(spark, sf):
    """Category -> multiplier lookup from a literal map."""
    o = J.attach_lookup(table(spark, sf, "orders"), "o_orderpriority", PRIORITY_MULT, "multiplier")
    return o.select("o_orderkey", "o_orderpriority", "multiplier",
                    r6(F.col("o_totalprice") * F.col("multiplier")).alias("scaled_amount"))


LINE_TYPES_SQL = "lt AS (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _line_types(spark, sf):
    return table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")) \
        .select("l_orderkey", "p_type")


@register("basket_pairs", f"""WITH {LINE_TYPES_SQL}
SELECT a.p_type AS item_a, b.p_type AS item_b, count(*) AS n_orders
FROM lt a JOIN lt b ON a.l_orderkey = b.l_orderkey AND a.p_type < b.p_type GROUP BY 1, 2""")
def q_basket_pairs(spark, sf):
    """Product-type pairs bought together (pairs formed inside each order's type set)."""
    return J.basket_pairs(_line_types(spark, sf), "l_orderkey", "p_type")


@register("product_pairs", """WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
n AS (SELECT l_partkey, count(*) AS n FROM b GROUP BY l_partkey),
p AS (SELECT x.l_partkey AS item_a, y.l_partkey AS item_b, count(*) AS n_orders FROM b x JOIN b y
  ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT item_a, item_b, n_orders, na.n AS n_a, nb.n AS n_b FROM p JOIN n na ON na.l_partkey = item_a JOIN n nb ON nb.l_partkey = item_b""")
def q_product_pairs(spark, sf):
    """L10 over products: parts that three orders or more hold together."""
    return J.frequent_pairs(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", 3)


ANCHORS = ["PROMO", "STANDARD"]


@register("attach_rate", f"""WITH {LINE_TYPES_SQL},
an AS (SELECT l_orderkey, p_type AS anchor FROM lt WHERE p_type IN ({', '.join(f"'{a}'" for a in ANCHORS)})),
base AS (SELECT anchor, count(*) AS n_anchor FROM an GROUP BY anchor),
co AS (SELECT an.anchor, lt.p_type AS item, count(*) AS n_both FROM an JOIN lt USING (l_orderkey) WHERE lt.p_type <> an.anchor GROUP BY 1, 2)
SELECT anchor, item, n_both, n_anchor, {R('n_both / n_anchor')} AS attach_rate FROM co JOIN base USING (anchor)""")
def q_attach_rate(spark, sf):
    r = J.attach_rate(_line_types(spark, sf), "l_orderkey", "p_type", ANCHORS)
    return r.select("anchor", "item", "n_both", "n_anchor", r6("attach_rate").alias("attach_rate"))


@register("established_customers", """SELECT c_custkey, c_acctbal FROM customer
WHERE c_acctbal < (SELECT quantile_cont(c_acctbal, 0.65) FROM customer)""")
def q_established_customers(spark, sf):
    """Customers below the 65 % quantile (strict)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return J.older_than_quantile(c, "c_acctbal", 0.65)


@register("missing_charges", """WITH h AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
s AS (SELECT o_custkey, min(month) AS a, max(month) AS z FROM h GROUP BY o_custkey),
sp AS (SELECT o_custkey, CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS month FROM s)
SELECT o_custkey, month FROM sp WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.o_custkey = sp.o_custkey AND h.month = sp.month)""")
def q_missing_charges(spark, sf):
    """Monthly charge calendar per customer anti-joined with actual charges."""
    return J.missing_charges(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


@register("cross_border", """SELECT l_orderkey, l_linenumber, c_nationkey, s_nationkey, c_nationkey <> s_nationkey AS is_cross_border
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""")
def q_cross_border(spark, sf):
    """Home (customer nation) vs merchant (supplier nation)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey",
                    (F.col("c_nationkey") != F.col("s_nationkey")).alias("is_cross_border"))
