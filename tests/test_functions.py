"""Fixtures for scalar helpers, profiles, parsing and keyed draws."""

import uuid

import pytest
from pyspark.sql import functions as F

from gridlens.functions import physics as PH
from gridlens.functions.draws import keyed_uniform
from gridlens.functions.exprs import angle_diff, rk
from gridlens.operators import profile as P
from gridlens.operators import sampling as J
from gridlens.operators.scoring import interp_curve
from gridlens.operators.sales import parse_sales


def test_angle_diff(spark):
    df = spark.createDataFrame([(10.0, 350.0), (350.0, 10.0), (180.0, 0.0)], "t double, s double")
    assert [r[0] for r in df.select(angle_diff(F.col("t"), F.col("s"))).collect()] == [20.0, -20.0, -180.0]


def test_wind_curve(spark):
    xs = [-1.0, 8.0, 8.25, 31.0, 22.75, 30.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r["y"] for r in interp_curve(df, "x", PH.WIND_CURVE, "y").orderBy("i").collect()]
    assert got == pytest.approx([0.0, 1008.0, 1129.0, 0.0, 895.0, 0.0])


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(0.125,), (1.005,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(rk("x", 2)).collect()][0] == 0.13


def test_uuid5_matches_python(spark):
    df = spark.createDataFrame([(f"order-{i}",) for i in range(50)], "name string")
    got = [r[0] for r in df.select(J.row_uuid(F.col("name"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"order-{i}")) for i in range(50)]


def test_keyed_draws_partition_independent(spark):
    base = spark.range(5000).withColumnRenamed("id", "k")
    a = base.repartition(1).select("k", keyed_uniform(7, "s", "k").alias("u")).orderBy("k").collect()
    b = base.repartition(17).select("k", keyed_uniform(7, "s", "k").alias("u")).orderBy("k").collect()
    assert a == b
    us = [r["u"] for r in a]
    assert 0.0 <= min(us) and max(us) < 1.0 and abs(sum(us) / len(us) - 0.5) < 0.02


def test_split_exact_and_stable(spark):
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    s1 = J.split_by_share(base.repartition(3), ["g"], "k", [("a", 0.7), ("b", 0.3)], 1)
    s2 = J.split_by_share(base.repartition(11), ["g"], "k", [("a", 0.7), ("b", 0.3)], 1)
    assert sorted(s1.collect()) == sorted(s2.collect())
    counts = {(r["g"], r["split"]): r["count"] for r in s1.groupBy("g", "split").count().collect()}
    assert counts[(0, "a")] == int(334 * 0.7) and counts[(1, "a")] == int(333 * 0.7)


def test_rebalance_rate(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(1000)], "k long, y int")
    r = J.rebalance(df, "y", "k", 0.25, 3)
    assert r.count() == 40 and r.where("y = 1").count() == 10


def test_null_profile_and_constant_corr(spark):
    df = spark.createDataFrame([(1.0, 5.0, "a"), (2.0, 5.0, None), (3.0, 5.0, "b"), (4.0, 5.0, "a")],
                               "x double, c double, s string")
    prof = {r["column_name"]: r for r in P.profile_columns(df).collect()}
    assert prof["s"]["n_nulls"] == 1 and prof["s"]["null_pct"] == 25.0 and prof["s"]["n_distinct"] == 2
    corr = P.corr_matrix(df, ["x", "c"]).collect()
    assert corr[0]["corr"] is None


def test_class_balance(spark):
    df = spark.createDataFrame([(0,)] * 99, "y int")
    assert P.class_balance(df, "y", 0.01).first()["pos_needed"] == 1


def test_parse_sales_address(spark):
    df = spark.createDataFrame([(1, "04/19/19 08:46", "917 1st St, Dallas, TX 75001"),
                                (2, "04/19/19 08:46", "no comma here"),
                                (3, "12/01/19 10:00", "1 Oak St, Portland, OR 97035"),
                                (4, "12/01/19 10:00", "2 Elm St, Portland, ME 04101")],
                               "k int, d string, a string")
    p = {r["k"]: r for r in parse_sales(df, "d", "a", "k").collect()}
    assert p[1]["city"] == "Dallas" and p[1]["state"] == "TX" and p[1]["zip"] == "75001"
    assert p[1]["order_time"].year == 2019 and p[1]["order_time"].hour == 8
    assert p[2]["city"] is None
    assert p[3]["city"] == p[4]["city"] == "Portland" and p[3]["state"] != p[4]["state"]


def test_nanosecond_parquet(spark, tmp_path):
    import pandas as pd
    from gridlens.sources import read_pandas_parquet
    pdf = pd.DataFrame({"time": pd.to_datetime(["2024-01-01 00:00:00.123456789", "2024-01-02 12:00:00.000000000"], format="ISO8601"),
                        "v": [1.0, 2.0]})
    path = str(tmp_path / "ns.parquet")
    pdf.to_parquet(path, coerce_timestamps=None, allow_truncated_timestamps=False)
    df = read_pandas_parquet(spark, path, ["time"])
    rows = df.orderBy("v").collect()
    assert str(df.schema["time"].dataType) == "TimestampNTZType()"
    assert rows[0]["time"].microsecond == 123456 and rows[1]["time"].hour == 12


def test_exact_quantiles_match_percentile(spark):
    import random
    from gridlens.operators.quantiles import exact_quantiles
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1.0, 2.0, rnd.random(), rnd.gauss(0, 1e6)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, x double")
    qs = [0.0, 0.1, 0.5, 0.99, 1.0]
    want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("x", qs).alias("p")).collect()}
    sizes = sorted(r["count"] for r in df.where(F.col("x").isNotNull()).groupBy("k").count().collect())
    assert sizes[0] < sizes[-1]
    # hot_rows=0: every group refined; between the sizes: big groups refined, the rest aggregated
    for hot in (0, sizes[0]):
        res = exact_quantiles(df, "x", qs, ["k"], hot_rows=hot).collect()
        ours = {(r["k"], r["q"]): r["value"] for r in res}
        assert len(res) == len(want) * len(qs)
        for k, p in want.items():
            for q, v in zip(qs, p):
                assert ours[(k, q)] == pytest.approx(v, rel=1e-12, abs=1e-9)
    glob = exact_quantiles(df, "x", [0.5], hot_rows=0).first()["value"]
    assert glob == pytest.approx(df.agg(F.percentile("x", 0.5)).first()[0], rel=1e-12)


def test_manifest_with_samples(spark):
    from conftest import SF_SMALL
    tabs = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("region", "nation")}
    rows = {r["dataset"]: r for r in P.manifest(tabs, with_samples=True).collect()}
    assert rows["region"]["n_rows"] == 5 and rows["region"]["schema_kinds"] == "r_regionkey:int,r_name:string"
    import json
    assert len(json.loads(rows["nation"]["sample_rows"])) == 3


def test_describe_keeps_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None)], "x double, y double")
    rows = {r["column_name"]: r for r in P.describe_num(df, ["x", "y"]).collect()}
    assert rows["x"]["p50"] == 2.0 and rows["y"]["n"] == 0 and rows["y"]["p50"] is None


def test_erf_approximation(spark):
    import math
    from gridlens.operators.fraud import erf_sql
    zs = [i / 10 for i in range(-40, 41)]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(F.expr(erf_sql("z"))).collect()]
    assert max(abs(g - math.erf(z)) for g, z in zip(got, zs)) < 2e-7


def test_shuffle_positions_are_a_permutation(spark):
    from gridlens.operators.windows import positions_by_uniform
    df = spark.range(3000).select(F.col("id").alias("k")).withColumn("u", keyed_uniform(5, "p", "k"))
    pos = sorted(r["pos"] for r in positions_by_uniform(df, "u", ["k"], n_buckets=7).collect())
    assert pos == list(range(1, 3001))


def test_weighted_draws_follow_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 50 else 20) for i in range(100)], "k long, w long")
    d = J.sample_weighted(df, "k", "w", 20000, 9, bucket_width=16.0)
    got = {r["k"]: r["count"] for r in d.groupBy("k").count().collect()}
    assert sum(got.values()) == 20000
    light = sum(got.get(i, 0) for i in range(50)) / 50
    heavy = sum(got.get(i, 0) for i in range(50, 100)) / 50
    assert 15 < heavy / light < 27      # expected ratio 20


def test_exact_quantiles_of_infinite_and_nan_values(spark):
    """The ranked path orders and interpolates like ``percentile``, with as many hot groups as there are keys."""
    from gridlens.operators.quantiles import exact_quantiles
    inf, nan = float("inf"), float("nan")
    rows = [(g, v) for g in range(40) for v in (1.0, 2.5, float(g), -inf, inf, 7.0)] + [(40, nan), (40, 1.0), (40, inf), (None, 3.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "k long, x double").repartition(5)
    qs = [0.0, 0.25, 0.4, 0.5, 1.0]
    key = lambda r: (r["k"] is not None, r["k"] or 0, r["q"])
    a = sorted(exact_quantiles(df, "x", qs, ["k"], hot_rows=10 ** 9).collect(), key=key)
    b = sorted(exact_quantiles(df, "x", qs, ["k"], hot_rows=0).collect(), key=key)
    assert [(r["k"], r["q"], repr(r["value"])) for r in a] == [(r["k"], r["q"], repr(r["value"])) for r in b]
    one = exact_quantiles(df.where("k = 3"), "x", [0.5], hot_rows=0).first()["value"]
    assert one == exact_quantiles(df.where("k = 3"), "x", [0.5], hot_rows=100).first()["value"]
    assert exact_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_rounding_stays_a_double(spark):
    from gridlens.functions.exprs import r6, r6_sql
    row = spark.createDataFrame([(2e13, 1e-5, -2.5e15, 1.23456749)], "a double, b double, c double, d double").select(
        *[r6(c).alias(c) for c in "abcd"], F.expr(r6_sql("a")).alias("e")).first()
    assert tuple(row) == (2e13, 1e-5, -2.5e15, 1.234567, 2e13)


def test_refined_quantiles_match_percentile(spark):
    """Ties, infinities, NaN, a column of nulls, skewed values: gathered at once, after one sketch, after many."""
    import math
    import random

    from gridlens.operators.quantiles import refined_quantiles
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1.0, 2.0, 2.0, math.inf]), rnd.gauss(0, 1) if rnd.random() < .9 else math.nan,
             float(rnd.randrange(50)), None, rnd.random() ** 9 * 1e9) for _ in range(8000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").cache()
    qs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]

    def same(x, y):
        if x is None or y is None:
            return x is y
        return x == y or (math.isnan(x) and math.isnan(y)) or abs(x - y) <= 1e-12 * max(1, abs(x))

    want = df.agg(*[F.percentile(c, qs).alias(c) for c in df.columns]).first()
    for gather in (10 ** 6, 500, 20):
        _, got = refined_quantiles(df, df.columns, qs, gather_rows=gather)
        for c in df.columns:
            assert all(same(x, y) for x, y in zip(got[c], want[c] or [None] * len(qs))), (gather, c)
    row, got = refined_quantiles(df.limit(0), ["a"], [0.5], [F.count("a").alias("n")])
    assert row["n"] == 0 and got == {"a": [None]}


def test_refined_quantiles_survive_a_sketch_that_misses(spark, monkeypatch):
    """Counts decide: with no margin at all the brackets miss and the values stay exact."""
    from gridlens.operators import quantiles as Q
    monkeypatch.setattr(Q, "SKETCH_MARGIN", -0.02)
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).cast("double").alias("x"))
    _, got = Q.refined_quantiles(df, ["x"], [0.25, 0.5, 0.9], gather_rows=10)
    assert got["x"] == df.agg(F.percentile("x", [0.25, 0.5, 0.9])).first()[0]


def test_profiles_copy_no_rows_and_sketches_merge(spark):
    """Exact profile without an Expand, of nulls, NaN, signed zeros and an empty table; merged sketches near the exact counts."""
    from gridlens.operators import profile as P
    rows = [(i, None if i % 7 == 0 else f"v{i % 5000}", [0.0, -0.0, float("nan"), float("nan"), 1.5][i % 5], i % 9) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, `a name` string, x double, day int")
    exact = P.profile_columns(df)
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    got = {r.column_name: (r.n_nulls, r.n_distinct) for r in exact.collect()}
    assert got == {"id": (0, 20000), "a name": (2858, 5000), "x": (0, 3), "day": (0, 9)}
    assert {r.column_name: (r.n_nulls, r.null_pct, r.n_distinct) for r in P.profile_columns(df.limit(0)).collect()} == {c: (0, 0.0, 0) for c in df.columns}
    near = {r.column_name: r.n_distinct for r in P.profile_columns(df, approx=True).collect()}
    assert abs(near["id"] - 20000) < 0.15 * 20000
    days = P.column_sketches(df, ["day"])
    assert days.count() == 9 * 3
    merged = {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct) for r in P.merge_sketches(days).collect()}
    assert merged["a name"][:2] == (20000, 2858) and merged["x"][2] in (3, 4)
    assert abs(merged["id"][2] - 20000) < 4 * 0.0081 * 20000 and abs(merged["a name"][2] - 5000) < 4 * 0.0081 * 5000
