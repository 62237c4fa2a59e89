"""Keyed sampling queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridlens.functions.draws import keyed_uniform, keyed_uniform_sql as KU, normal_from, expo_from, TINY, weighted_choice_sql
from gridlens.functions.exprs import r6, r6_sql as R
from gridlens.operators import sampling as J
from gridlens.plans.registry import register, table

SEED = 42
DEVICE_MIX = [("mobile", 0.55), ("desktop", 0.3), ("tablet", 0.15)]
SPLITS = [("train", 0.7), ("valid", 0.2), ("test", 0.1)]
CATEGORIES = ["Grocery", "Digital Goods", "Travel", "Luxury Retail"]


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


@register("keyed_uniform", f"""SELECT event_id, u, CAST(floor(1.0 + u * 6.0) AS BIGINT) AS die
FROM (SELECT event_id, {KU(SEED, 'u', 'event_id')} AS u FROM events)""")
def q_keyed_uniform(spark, sf):
    """Uniform and integer (die) columns keyed by event_id."""
    ev = table(spark, sf, "events").select("event_id").withColumn("u", keyed_uniform(SEED, "u", "event_id"))
    return ev.withColumn("die", F.floor(F.lit(1.0) + F.col("u") * F.lit(6.0)))


@register("weighted_choice", f"""SELECT c_custkey, {weighted_choice_sql(KU(SEED, 'device', 'c_custkey'), DEVICE_MIX)} AS device_type FROM customer""")
def q_weighted_choice(spark, sf):
    """Weighted categorical column (primary device per customer)."""
    c = table(spark, sf, "customer").select("c_custkey")
    return c.withColumn("device_type", J.choice(keyed_uniform(SEED, "device", "c_custkey"), DEVICE_MIX))


def _normal_sql(u1, u2):
    return f"sqrt(-2.0 * ln(greatest({u1}, {TINY!r}))) * cos({2 * math.pi!r} * {u2})"


@register("keyed_normal", f"""SELECT event_id, {R(_normal_sql(KU(SEED, 'n1', 'event_id'), KU(SEED, 'n2', 'event_id')))} AS z,
  {R(f"value * exp(0.1 * {_normal_sql(KU(SEED, 'n1', 'event_id'), KU(SEED, 'n2', 'event_id'))})")} AS noisy_value FROM events""")
def q_keyed_normal(spark, sf):
    """Box-Muller normal noise and log-normal multiplicative noise on a column."""
    ev = table(spark, sf, "events").select("event_id", "value")
    z = normal_from(keyed_uniform(SEED, "n1", "event_id"), keyed_uniform(SEED, "n2", "event_id"))
    return ev.select("event_id", r6(z).alias("z"), r6(F.col("value") * F.exp(F.lit(0.1) * z)).alias("noisy_value"))


def _expo_sql(u, scale="1.0"):
    return f"(-{scale} * ln(greatest({u}, {TINY!r})))"


@register("keyed_expo", f"""SELECT event_id, {R(_expo_sql(KU(SEED, 'e', 'event_id'), 'value'))} AS expo,
  {R(f"{_expo_sql(KU(SEED, 'g1', 'event_id'))} + {_expo_sql(KU(SEED, 'g2', 'event_id'))}")} AS gamma2,
  CAST(greatest(1, ceil(ln(1.0 - {KU(SEED, 'geo', 'event_id')}) / ln(1.0 - 0.3))) AS BIGINT) AS geom FROM events""")
def q_keyed_expo(spark, sf):
    """Exponential (scale = value), gamma(2) and geometric(p=0.3) columns."""
    ev = table(spark, sf, "events").select("event_id", "value")
    e = F.lit(-1.0) * F.col("value") * F.log(F.greatest(keyed_uniform(SEED, "e", "event_id"), F.lit(TINY)))
    g2 = expo_from(keyed_uniform(SEED, "g1", "event_id")) + expo_from(keyed_uniform(SEED, "g2", "event_id"))
    geo = F.greatest(F.lit(1), F.ceil(F.log(F.lit(1.0) - keyed_uniform(SEED, "geo", "event_id")) / F.log(F.lit(1.0) - F.lit(0.3))))
    return ev.select("event_id", r6(e).alias("expo"), r6(g2).alias("gamma2"), geo.cast("long").alias("geom"))


N_DRAWS = 2000


@register("sample_weighted", f"""WITH w AS (SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) + 1001 AS _w FROM customer),
c AS (SELECT c_custkey, _w, sum(_w) OVER (ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM w WHERE _w > 0),
t AS (SELECT CAST(sum(_w) AS DOUBLE) AS total FROM w WHERE _w > 0),
d AS (SELECT range AS draw, {KU(SEED, 'weighted', 'range')} * (SELECT total FROM t) AS x FROM range({N_DRAWS}))
SELECT draw, c_custkey FROM d JOIN c ON x >= hi - _w AND x < hi""")
def q_sample_weighted(spark, sf):
    """2000 draws with replacement, customers weighted by balance level."""
    c = table(spark, sf, "customer").select("c_custkey", (F.floor("c_acctbal") + 1001).alias("w"))
    return J.sample_weighted(c, "c_custkey", "w", N_DRAWS, SEED, bucket_width=256.0)


@register("choose_k", f"""SELECT c_nationkey, c_custkey, rank FROM (
  SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY {KU(SEED, 'choose', 'c_nationkey', 'c_custkey')}, c_custkey) AS rank
  FROM customer) WHERE rank <= 3""")
def q_choose_k(spark, sf):
    """3 customers per nation without replacement."""
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey")
    return J.choose_k(c, ["c_nationkey"], "c_custkey", 3, SEED)


def _split_sql():
    acc, parts = 0.0, []
    for name, s in SPLITS[:-1]:
        acc += s
        parts.append(f"WHEN pos <= floor(n * {_dbl(acc)}) THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{SPLITS[-1][0]}' END"


@register("split_by_share", f"""SELECT event_id, event_type, {_split_sql()} AS split FROM (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {KU(SEED, 'split', 'event_id')}, event_id) AS pos,
         count(*) OVER (PARTITION BY event_type) AS n FROM events)""")
def q_split_by_share(spark, sf):
    """70/20/10 split with exact proportions inside each event type."""
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return J.split_by_share(ev, ["event_type"], "event_id", SPLITS, SEED)


REBALANCE_RATE = 0.3


@register("rebalance", f"""WITH p AS (SELECT count(*) AS n_pos FROM labels WHERE toxic = 1),
k AS (SELECT CAST(floor(CAST(n_pos AS DOUBLE) * {_dbl(1 - REBALANCE_RATE)} / {_dbl(REBALANCE_RATE)} + 0.5) AS BIGINT) AS keep FROM p),
neg AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY {KU(SEED, 'rebalance', 'doc_id')}, doc_id) AS pos FROM labels WHERE toxic <> 1)
SELECT doc_id, toxic FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, toxic FROM neg WHERE pos <= (SELECT keep FROM k)""")
def q_rebalance(spark, sf):
    """Down-sample negatives so positives are 30 % of the result."""
    lab = table(spark, sf, "labels").select("doc_id", "toxic")
    return J.rebalance(lab, "toxic", "doc_id", REBALANCE_RATE, SEED)


def _uuid_sql(name):
    h = f"sha1(unhex('{J.UUID_NS_HEX}') || encode({name}))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"list_extract(['8', '9', 'a', 'b'], (CAST(('0x' || substr({h}, 17, 1)) AS INTEGER) & 3) + 1) || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


_UUID_NAME = "'order-' || CAST(o_orderkey AS VARCHAR)"


@register("row_uuid", f"SELECT o_orderkey, {_uuid_sql(_UUID_NAME)} AS row_uuid FROM orders")
def q_row_uuid(spark, sf):
    """Deterministic uuid5 row ids."""
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.withColumn("row_uuid", J.row_uuid(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))))


@register("merchant_id", f"""SELECT s_suppkey, concat_ws('_', upper(n_name),
  upper(replace(list_extract([{', '.join(f"'{c}'" for c in CATEGORIES)}], CAST(((s_suppkey % 4) + 4) % 4 AS INTEGER) + 1), ' ', '_')),
  lpad(CAST(((s_suppkey % 1000) + 1000) % 1000 AS VARCHAR), 3, '0')) AS merchant_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def q_merchant_id(spark, sf):
    """Composite merchant ids COUNTRY_CATEGORY_NNN."""
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.pmod(F.col("s_suppkey"), F.lit(4)) + 1).cast("int"))
    return s.select("s_suppkey", J.merchant_id(F.col("n_name"), cat, F.pmod(F.col("s_suppkey"), F.lit(1000))).alias("merchant_id"))
