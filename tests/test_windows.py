"""The skew-safe window helpers must equal the plain single-window forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlens.operators import windows as W
from gridlens.operators.timeseries import rows_agg


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(1, 6)   # one hot key
        secs = rnd.randrange(0, 5 * 86400)
        rows.append((i, key, secs, rnd.random() * 100))
    df = spark.createDataFrame(rows, "id long, k long, secs long, v double")
    return df.withColumn("ts", F.expr("timestampadd(SECOND, secs, TIMESTAMP_NTZ'2024-01-01 00:00:00')")).drop("secs").cache()


def test_global_row_number(data):
    plain = data.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    ours = W.global_row_number(data, ["k"], "ts", ["id"], bucket_seconds=3600)
    assert sorted(plain.select("id", "rn").collect()) == sorted(ours.select("id", "rn").collect())


def test_prev_row(data):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = data.select("id", F.lag("v").over(w).alias("pv"), F.lag("ts").over(w).alias("pt"))
    ours = W.prev_row(data, ["k"], "ts", ["v"], ["id"], bucket_seconds=7200).select(
        "id", F.col("prev_v").alias("pv"), F.col("prev_ts").alias("pt"))
    assert sorted(plain.collect()) == sorted(ours.collect())


def test_range_count(data):
    e = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    plain = data.withColumn("_e", e).select(
        "id", F.count(F.lit(1)).over(Window.partitionBy("k").orderBy("_e").rangeBetween(-1800 * 10**6, 0)).alias("n"))
    ours = W.range_count(data, ["k"], "ts", 1800, out="n", bucket_seconds=3600).select("id", "n")
    assert sorted(plain.collect()) == sorted(ours.collect())


def test_sessionize(data):
    w = Window.partitionBy("k").orderBy("ts", "id")
    gap = 600
    p = data.withColumn("_p", F.lag("ts").over(w))
    opens = F.col("_p").isNull() | (F.expr("timestampdiff(SECOND, _p, ts)") > gap)
    plain = p.withColumn("s", F.max(F.when(opens, F.col("ts"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ours = W.sessionize(data, ["k"], "ts", gap, ["id"], bucket_seconds=3600)
    assert sorted(plain.select("id", "s").collect()) == sorted(ours.select("id", F.col("session_start").alias("s")).collect())


def test_top_k(data):
    plain = data.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id"))).where("rank <= 4")
    ours = W.top_k_per(data, ["k"], [F.desc("v"), F.col("id")], 4, salt_col="id")
    assert sorted(plain.select("id", "rank").collect()) == sorted(ours.select("id", F.col("rank").cast("int")).collect())


def test_rows_agg(data):
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(-5, -1)
    plain = data.select("id", F.avg("v").over(w).alias("m"))
    ours = rows_agg(data, ["k"], "ts", ["id"], 5, {"m": F.avg("v")}, rows_per_bucket=37).select("id", "m")
    a = {r["id"]: r["m"] for r in plain.collect()}
    b = {r["id"]: r["m"] for r in ours.collect()}
    assert a.keys() == b.keys()
    assert all((a[i] is None and b[i] is None) or abs(a[i] - b[i]) < 1e-9 for i in a)


def test_positions_and_prefix_sum(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("w"),
                                  F.expr("rand(3)").alias("u"))
    pos = W.positions_by_uniform(df, "u", ["k"], n_buckets=16)
    plain = df.withColumn("pos", F.row_number().over(Window.orderBy("u", "k")))
    assert sorted(pos.select("k", "pos").collect()) == sorted(plain.select("k", F.col("pos").cast("long")).collect())
    ps = W.prefix_sum(df, "k", "w", 100.0)
    plain2 = df.withColumn("cum_hi", F.sum("w").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(ps.select("k", "cum_hi").collect()) == sorted(plain2.select("k", "cum_hi").collect())


def test_auto_bucket_splits_hot_key(data):
    wide = W.auto_bucket_seconds(data, ["k"], "ts")
    narrow = W.auto_bucket_seconds(data, ["k"], "ts", target_rows=50)
    assert wide == 86400 and narrow < 86400
    plain = data.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    ours = W.global_row_number(data, ["k"], "ts", ["id"], bucket_seconds=narrow)
    assert sorted(plain.select("id", "rn").collect()) == sorted(ours.select("id", "rn").collect())
    ranged = W.auto_bucket_seconds(data, ["k"], "ts", min_seconds=3600, target_rows=50)
    assert ranged >= 3600


def test_sequential_ids_with_ties(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("day"))  # heavy ties
    ours = W.sequential_ids(df.repartition(7), ["day", "k"], start=100, n_parts=5)
    plain = df.withColumn("seq_id", F.row_number().over(Window.orderBy("day", "k")) + 99)
    assert sorted(ours.select("k", "seq_id").collect()) == sorted(plain.select("k", F.col("seq_id").cast("long")).collect())


def _plain_range_count(df, keys, span):
    e = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    w = Window.partitionBy(*keys).orderBy("_e").rangeBetween(-span * 10**6, 0)
    return sorted(df.withColumn("_e", e).select("id", F.count(F.lit(1)).over(w).alias("n")).collect())


def test_range_count_by_rank(data):
    odd = data.limit(40).select((F.col("id") + 10_000).alias("id"), F.lit(None).cast("long").alias("k"), "v", "ts")
    timeless = data.limit(3).select((F.col("id") + 20_000).alias("id"), "k", "v", F.lit(None).cast("timestamp_ntz").alias("ts"))
    tied = data.limit(50).select((F.col("id") + 30_000).alias("id"), F.lit(0).cast("long").alias("k"), "v",
                                 F.expr("TIMESTAMP_NTZ'2024-01-02 00:00:00'").alias("ts"))
    rows = data.unionByName(odd).unionByName(timeless).unionByName(tied)
    for span in (1, 1800, 10 * 86400):
        ours = W.range_count_by_rank(rows, ["k"], "ts", span, out="n", n_parts=5).select("id", "n")
        assert sorted(ours.collect()) == _plain_range_count(rows, ["k"], span)
    assert W.range_count_by_rank(rows.limit(0), ["k"], "ts", 60).count() == 0


def test_range_count_by_rank_by_hand(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, "a", 60), (3, "a", 60), (4, "a", 121), (5, "b", 60)], "id long, k string, s long")
    rows = rows.withColumn("ts", F.expr("timestampadd(SECOND, s, TIMESTAMP_NTZ'2024-01-01 00:00:00')"))
    got = {r["id"]: r["n"] for r in W.range_count_by_rank(rows, ["k"], "ts", 60, out="n").collect()}
    assert got == {1: 1, 2: 3, 3: 3, 4: 1, 5: 1}


def test_a_key_denser_than_its_span_is_split(spark):
    """One merchant, all rows within one span: the count takes the rank path and no part holds 5 % of the rows."""
    rows = spark.range(40_000).select("id", F.lit("m").alias("k"), F.expr(
        "timestampadd(MILLISECOND, id * 7 % 3000000, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"))
    parts = [r["count"] for r in W.rank_entries(rows, ["k"], "ts", 3600, n_parts=64).groupBy("_p").count().collect()]
    assert sum(parts) == 80_000 and max(parts) < 0.05 * 80_000
    spark.conf.set("spark.gridlens.bucketTargetRows", "500")
    try:
        ours = W.range_count(rows, ["k"], "ts", 3600, out="n")
        assert "_kind" in ours._jdf.queryExecution().analyzed().toString()
        assert sorted(ours.select("id", "n").collect()) == _plain_range_count(rows, ["k"], 3600)
    finally:
        spark.conf.unset("spark.gridlens.bucketTargetRows")


def test_a_dense_day_takes_no_sliding_frame(spark):
    """A few thousand rows of a key in a day are counted by ranks: a sliding frame adds up its rows anew for every row."""
    rows = spark.range(3 * W.FRAME_ROWS).select("id", F.lit("m").alias("k"), F.expr(
        "timestampadd(SECOND, id * 7 % 20000, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"))
    ours = W.range_count(rows, ["k"], "ts", 6 * 3600, out="n")
    assert "_kind" in ours._jdf.queryExecution().analyzed().toString()
    assert sorted(ours.select("id", "n").collect()) == _plain_range_count(rows, ["k"], 6 * 3600)
    few = W.range_count(rows.limit(W.FRAME_ROWS // 2), ["k"], "ts", 6 * 3600, out="n")
    assert "_kind" not in few._jdf.queryExecution().analyzed().toString()
