"""Scans, sinks, filters, cleansing, sorts and unions (S*, F*, O*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.draws import keyed_uniform, keyed_uniform_sql
from gridlens.operators import clean as C
from gridlens.operators.windows import positions_by_uniform
from gridlens.plans.registry import register, table
from gridlens.session import scratch_path
from gridlens import sources as S

SEED = 42


@register("scan_time_range", """SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")
def q_scan_time_range(spark, sf):
    return S.load(spark, f"{sf}/events.parquet", None, "2024-01-05 00:00:00", "2024-01-12 00:00:00")


@register("time_bounds", "SELECT min(ts) AS min_time, max(ts) AS max_time FROM events")
def q_time_bounds(spark, sf):
    return S.time_bounds(table(spark, sf, "events"))


@register("catalogue")
def q_catalogue(spark, sf):
    """Rows-only: file listing of the data folder."""
    return S.catalogue(spark, sf)


@register("sink_roundtrip", "SELECT *, CAST(ts AS DATE) AS day FROM events")
def q_sink_roundtrip(spark, sf):
    """Write events partitioned by day (sorted by time inside files) to the
    shared checkpoint folder, read them back."""
    path = scratch_path(spark, "sink_roundtrip")
    ev = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    S.write_dataset(ev, path, partition_by=["day"], sort_by=["ts", "user_id"])
    back = spark.read.parquet(path)
    return back.select(*[c for c in back.columns if c != "day"], F.col("day").cast("date").alias("day"))


@register("nanosecond_ingest", "SELECT event_id, ts, user_id, value FROM events")
def q_nanosecond_ingest(spark, sf):
    """Events written with nanosecond timestamps, as pandas does, and read back."""
    path = scratch_path(spark, "nanoseconds")
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    S.write_nanoseconds(ev, path, ["ts"]).agg({"n_rows": "sum"}).write.format("noop").mode("overwrite").save()
    return S.read_pandas_parquet(spark, path, ["ts"])


@register("month_rewrite", """SELECT event_id, ts, user_id, CASE WHEN day(ts) BETWEEN 8 AND 14 THEN value * 2 ELSE value END AS value,
  CAST(((day(ts) - 1) // 7) AS INTEGER) AS week FROM events""")
def q_month_rewrite(spark, sf):
    """Events stored by week of the month, then one week written again with its values doubled."""
    path = scratch_path(spark, "weeks")
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "value", F.floor((F.dayofmonth("ts") - 1) / 7).cast("int").alias("week"))
    S.write_dataset(ev, path, partition_by=["week"])
    S.replace_partitions(ev.where("week = 1").withColumn("value", F.col("value") * 2), path, ["week"])
    return spark.read.schema(ev.schema).parquet(path)


def bucketed_telemetry(spark, sf, buckets: int = 16):
    """Events and orders as tables bucketed by customer."""
    name = scratch_path(spark, "bucketed")
    ev = table(spark, sf, "events").select(F.col("user_id").alias("device"), "ts", "value")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("device"), "o_orderdate", "o_totalprice")
    tag = name.rsplit("-", 1)[-1]
    return (S.write_bucketed(ev, f"events_{tag}", f"{name}/events", ["device"], buckets, ["device", "ts"]),
            S.write_bucketed(orders, f"orders_{tag}", f"{name}/orders", ["device"], buckets))


@register("bucketed_join", """SELECT user_id AS device, count(*) AS n, count(DISTINCT ts) AS n_times, max(o_totalprice) AS top_price
FROM events JOIN orders ON user_id = o_custkey GROUP BY 1""")
def q_bucketed_join(spark, sf):
    """Events meet the orders of their customer; two tables in the same buckets, so the join and its groups shuffle nothing."""
    ev, orders = bucketed_telemetry(spark, sf)
    j = ev.hint("merge").join(orders, "device")
    return (j.groupBy("device", "ts").agg(F.count(F.lit(1)).alias("k"), F.max("o_totalprice").alias("p"))
            .groupBy("device").agg(F.sum("k").alias("n"), F.count("ts").alias("n_times"), F.max("p").alias("top_price")))


@register("publish_view", """SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  o_orderpriority FROM orders""")
def q_publish_view(spark, sf):
    """Row id first, customer id dropped (leaks identity), dates as text, target last."""
    o = table(spark, sf, "orders")
    v = S.publish_view(o, target="o_orderpriority", row_id="o_orderkey", ignore=["o_custkey"])
    return v


@register("filter_in", "SELECT * FROM events WHERE event_type IN ('click', 'purchase')")
def q_filter_in(spark, sf):
    return C.filter_in(table(spark, sf, "events"), "event_type", ["click", "purchase"])


@register("filter_flag", "SELECT * FROM events WHERE value > 100")
def q_filter_flag(spark, sf):
    return table(spark, sf, "events").where(F.col("value") > 100)


@register("sample_n", f"""SELECT event_id, user_id, ts, value FROM events
ORDER BY md5(concat_ws('|', '{SEED}', 'sample', CAST(event_id AS VARCHAR))) LIMIT 100""")
def q_sample_n(spark, sf):
    """seeded sample of n rows = top n by a keyed hash (no full sort)."""
    ev = table(spark, sf, "events")
    h = F.md5(F.concat_ws("|", F.lit(str(SEED)), F.lit("sample"), F.col("event_id").cast("string")))
    return ev.orderBy(h).limit(100).select("event_id", "user_id", "ts", "value")


@register("sorted_head", "SELECT event_id, ts, user_id, value FROM events ORDER BY ts, user_id, event_id LIMIT 20")
def q_sorted_head(spark, sf):
    """O1/O2: sort by (time, device) and take the head (TakeOrderedAndProject)."""
    return (table(spark, sf, "events").orderBy("ts", "user_id", "event_id").limit(20)
            .select("event_id", "ts", "user_id", "value"))


@register("shuffle_rank", f"""SELECT event_id, row_number() OVER (ORDER BY {keyed_uniform_sql(SEED, 'shuffle', 'event_id')}, event_id) AS pos
FROM events""")
def q_shuffle_rank(spark, sf):
    """O3: seeded shuffle as a position per row, independent of partitioning."""
    ev = table(spark, sf, "events").select("event_id").withColumn("_u", keyed_uniform(SEED, "shuffle", "event_id"))
    return positions_by_uniform(ev, "_u", ["event_id"]).select("event_id", "pos")


@register("union_sources", """SELECT o_orderkey, o_totalprice, NULL::TIMESTAMP AS o_orderdate, NULL::BIGINT AS o_custkey, 'finished' AS source FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL::DOUBLE, o_orderdate, NULL::BIGINT, 'open' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, NULL::DOUBLE, NULL::TIMESTAMP, o_custkey, 'pending' FROM orders WHERE o_orderstatus = 'P'""")
def q_union_sources(spark, sf):
    """Union of differently shaped parts with a source column."""
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", F.lit("finished").alias("source"))
    b = o.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderdate", F.lit("open").alias("source"))
    c = o.where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey", F.lit("pending").alias("source"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


# Bounds used on lineitem: column -> (low, high, decimals).
LI_BOUNDS = {"l_quantity": (1.0, 40.0, 0), "l_discount": (0.0, 0.08, 2), "l_tax": (0.01, 0.05, 2),
             "l_extendedprice": (1000.0, 90000.0, 2)}


def _bound_sql(c, lo, hi, dec):
    s = f"{float(10 ** dec):.1f}"
    return f"CAST(floor(least({hi!r}, greatest({lo!r}, CAST({c} AS DOUBLE))) * {s} + 0.5) / {s} AS DOUBLE) AS {c}"


@register("apply_bounds", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    _bound_sql(c, *b) for c, b in LI_BOUNDS.items()) + " FROM lineitem")
def q_apply_bounds(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_BOUNDS)
    return C.apply_bounds(li, LI_BOUNDS)


@register("bounds_report", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} < {lo!r}) AS BIGINT) AS n_below, "
    f"CAST(count_if({c} > {hi!r}) AS BIGINT) AS n_above, count({c}) AS n_rows FROM lineitem"
    for c, (lo, hi, _d) in LI_BOUNDS.items()))
def q_bounds_report(spark, sf):
    return C.bounds_report(table(spark, sf, "lineitem"), LI_BOUNDS)


@register("mask_when", """SELECT event_id, ts, CASE WHEN hour(ts) < 6 OR hour(ts) >= 20 THEN 0.0 ELSE value END AS value FROM events""")
def q_mask_when(spark, sf):
    """F8: night mask (zero the signal outside 06:00-20:00)."""
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    return C.mask_when(ev, (F.hour("ts") < 6) | (F.hour("ts") >= 20), ["value"])
