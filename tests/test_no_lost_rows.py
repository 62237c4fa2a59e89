"""Null keys, equal rows, open faults and both stream layouts: no row is lost, whatever the path."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from gridlens import streaming as ST
from gridlens.operators import faults as fo
from gridlens.operators import fraud as A
from gridlens.operators import timeseries as TS
from gridlens.operators import windows as W
from gridlens.operators.sampling import split_by_share

T0 = dt.datetime(2024, 1, 1)


def telemetry(spark, n=40):
    rows = [(i, None if i % 2 else "d", T0 + dt.timedelta(minutes=7 * i), float(i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, device string, time timestamp_ntz, value double")


def test_row_windows_keep_null_keys(spark):
    tel = telemetry(spark)
    got = TS.spike_windows(tel, "value", width=3, tiebreak=["id"])
    w = Window.partitionBy("device").orderBy("time").rowsBetween(-3, -1)
    want = tel.withColumn("roll_mean", F.avg("value").over(w))
    assert sorted(got.select("id", "roll_mean").collect()) == sorted(want.select("id", "roll_mean").collect())


def test_step_audit_and_ar1_keep_the_null_group(spark):
    tel = telemetry(spark)
    assert {r["device"]: r["n_steps"] for r in TS.step_audit(tel, tiebreak=["id"]).collect()} == {None: 19, "d": 19}
    assert {r["device"] for r in TS.ar1_fit(tel, "value", tiebreak=["id"]).collect()} == {None, "d"}


def test_split_keeps_the_null_stratum(spark):
    tel = telemetry(spark)
    got = split_by_share(tel, ["device"], "id", [("train", 0.8), ("test", 0.2)], seed=3)
    assert {(r["device"], r["split"]): r["count"] for r in got.groupBy("device", "split").count().collect()} == {
        (None, "train"): 16, (None, "test"): 4, ("d", "train"): 16, ("d", "test"): 4}


@pytest.mark.parametrize("bucket", [60, 600, 86400])
def test_ranges_longer_than_a_bucket(spark, bucket):
    tel = telemetry(spark)
    got = W.range_count(tel, ["device"], "time", 3600, bucket_seconds=bucket)
    sec = F.unix_timestamp(F.col("time").cast("timestamp"))
    want = tel.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("device").orderBy(sec).rangeBetween(-3600, 0)))
    assert sorted(got.select("id", "n_in_range").collect()) == sorted(want.select("id", "n").collect())


def test_row_windows_longer_than_a_block(spark):
    tel = telemetry(spark).where("device = 'd'")
    got = TS.rows_agg(tel, ["device"], "time", ["id"], 9, {"s": F.sum("value")}, rows_per_bucket=4)
    w = Window.partitionBy("device").orderBy("time").rowsBetween(-9, -1)
    assert sorted(got.select("id", "s").collect()) == sorted(tel.withColumn("s", F.sum("value").over(w)).select("id", "s").collect())


def test_prefix_sum_over_many_buckets(spark):
    df = spark.range(300).withColumn("v", F.col("id") % 7)
    got = W.prefix_sum(df, "id", "v", bucket_width=2, fan=5).orderBy("id").collect()
    run = 0
    for r in got:
        assert r["cum_lo"] == run
        run += r["v"]
        assert r["cum_hi"] == run


def events(spark):
    rows = [("a", "x", ts("2024-01-01"), None, "abrupt", 1.0, None, 0.0, 0), ("a", "y", ts("2024-01-02"), ts("2024-01-05"), "abrupt", 0.5, None, 0.0, 1),
            ("b", "x", ts("2024-01-03"), ts("2024-01-03"), "abrupt", 1.0, None, 0.0, 0)]
    return spark.createDataFrame(rows, fo.EVENT_SCHEMA)


@pytest.mark.parametrize("force", ["broadcast", "bucketed", "sweep"])
def test_open_faults_hold_for_ever(spark, force):
    tel = spark.createDataFrame([("a", ts("2023-12-31")), ("a", ts("2024-01-04")), ("a", ts("2026-09-27")), ("b", ts("2024-01-03")), (None, ts("2024-01-04"))],
                                "device string, time timestamp_ntz")
    got = fo.attach_faults(tel, events(spark), how="left", force=force)
    assert sorted((str(r["device"]), str(r["time"].date()), str(r["event_type"])) for r in got.collect()) == [
        ("None", "2024-01-04", "None"), ("a", "2023-12-31", "None"), ("a", "2024-01-04", "x"), ("a", "2024-01-04", "y"),
        ("a", "2026-09-27", "x"), ("b", "2024-01-03", "None")]
    assert fo.attach_faults(tel, events(spark), how="left_semi", force=force).count() == 2
    assert fo.attach_faults(tel, events(spark), how="left_anti", force=force).count() == 3


@pytest.mark.parametrize("force", ["broadcast", "bucketed", "sweep"])
def test_labels_are_one_row_per_row(spark, force):
    tel = spark.createDataFrame([("a", ts("2024-01-04"))] * 3 + [("a", ts("2023-01-01"))] * 2, "device string, time timestamp_ntz")
    got = fo.label_telemetry(tel, events(spark), ["x", "y"], force=force).collect()
    assert sorted(r["fault_labels"] for r in got) == ["healthy"] * 2 + ["x|y"] * 3
    zero = events(spark).withColumn("max_severity", F.lit(0.0))
    assert {r["severity"] for r in fo.label_telemetry(tel, zero, ["x"], normalise=True, force=force).collect()} == {0.0}


def test_missed_positives_count_against_recall(spark):
    truth = spark.createDataFrame([(i, 1 if i < 50 else 0) for i in range(100)], "k long, t int")
    pred = spark.createDataFrame([(i, 1) for i in [*range(5), 60, 500]], "k long, p int")
    r = A.detector_report(pred, truth, "k", "p", "t").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["n_no_truth"]) == (5, 1, 45, 49, 1)
    assert r["recall"] == pytest.approx(0.1) and r["precision"] == pytest.approx(5 / 6)


def test_audits_of_odd_tables(spark):
    neg = spark.createDataFrame([(float(-i),) for i in range(50)], "x double")
    assert 0 <= A.dist_audit(neg.unionAll(spark.createDataFrame([(5.0,)], "x double")), "x").first()["ks"] <= 1
    assert A.dist_audit(neg.limit(0), "x").first()["n"] == 0
    tx = spark.createDataFrame([], "amount double, category string")
    assert A.high_value(tx, "amount", "category", ["c"]).count() == 0


def test_streams_read_files_and_folders(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (SF_SMALL, str(tmp_path)):
        s = ST.stream_copy(ST.file_stream(spark, folder, "events.parquet"))
        assert ST.run_available_now(s, "layout").count() == ev.count()


def test_overheat_rule_by_hand(spark):
    """Steps count from the start; the temperature and irradiance limits belong to the rule, both inclusive."""
    from gridlens.operators.scoring import with_exprs
    from gridlens.plans.scoring import overheat_exprs
    rows = [(ts("2024-01-01 11:00"), 195.0), (ts("2024-01-01 11:10"), 194.0), (ts("2024-01-01 10:50"), 400.0), (ts("2024-01-01 16:30"), 400.0),
            (ts("2024-01-01 16:40"), 400.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, value double")
    ex = overheat_exprs("(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', time) / 1e6)", 1704067200.0, temp_min=39.5, irr_min=780.0)
    got = {r["time"].strftime("%H:%M"): r for r in with_exprs(df, ex).collect()}
    assert [got[k]["hot"] for k in ("11:00", "11:10", "10:50", "16:30", "16:40")] == [True, False, False, True, False]
    import math
    step = 66  # 11:00 is 66 steps of ten minutes from midnight
    assert got["11:00"]["step"] == step
    want = 0.45 * 0.0 + 0.55 * (1.0 if math.sin(step / 2.3) > 0.15 else 0.0)
    assert got["11:00"]["severity"] == pytest.approx(want)


def test_solar_curve_is_linear_between_knots(spark):
    from gridlens.functions.physics import SOLAR_CURVE, for_spark
    import numpy as np
    xs = [-5.0, 0.0, 3.3, 10.0, 455.5, 1199.0, 1250.0, 2000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(F.expr(for_spark("solar_curve(x)")).alias("p"))
    kx, ky = zip(*SOLAR_CURVE)
    assert [r["p"] for r in df.collect()] == pytest.approx(np.interp(xs, kx, ky).tolist(), rel=1e-12)


def test_bounds_keep_missing_and_large_values(spark):
    from gridlens.operators.clean import apply_bounds
    rows = [(None,), (float("nan"),), (1e18,), (float("inf"),), (-3.0,), (2.345,), (-1e18,)]
    df = spark.createDataFrame(rows, "a double").withColumns({c: F.col("a") for c in ("b", "c")})
    got = apply_bounds(df, {"a": (0.0, None, 2), "b": (-5.0, 10.0, 1), "c": (None, None, 2)}).collect()
    assert got[0]["a"] is None and got[0]["b"] is None
    assert got[1]["a"] != got[1]["a"] and got[1]["b"] != got[1]["b"]
    assert got[2]["a"] == 1e18 and got[2]["b"] == 10.0 and got[3]["a"] == float("inf") and got[6]["c"] == -1e18
    assert got[4]["a"] == 0.0 and got[4]["b"] == -3.0 and got[5]["a"] == 2.35 and got[5]["b"] == 2.3


def test_null_keys_have_their_own_calendar(spark):
    from gridlens.operators.joins import missing_charges
    from gridlens.operators.timeseries import time_spine_gaps
    rows = [(None, ts(f"2024-0{m}-10")) for m in (1, 2, 4)] + [("c", ts("2024-01-01"))]
    df = spark.createDataFrame(rows, "device string, time timestamp_ntz")
    assert [(r[0], str(r[1])) for r in missing_charges(df, ["device"], "time").collect()] == [(None, "2024-03-01")]
    days = spark.createDataFrame([(None, ts("2024-01-01")), (None, ts("2024-01-03"))], "device string, time timestamp_ntz")
    assert [(r[0], str(r[1])) for r in time_spine_gaps(days).collect()] == [(None, "2024-01-02")]


def test_correlations_with_nulls_offsets_and_constants(spark):
    import numpy as np
    from gridlens.operators.profile import corr_matrix
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = 0.6 * x + rng.normal(size=400)
    rows = [(float(1e9 + a), float(b) if i % 3 else None, 7.0, float(a * b), None) for i, (a, b) in enumerate(zip(x, y))]
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in corr_matrix(spark.createDataFrame(rows, "x double, y double, k double, p double, n double")).collect()}
    keep = np.array([i % 3 != 0 for i in range(400)])
    xs = np.array([r[0] for r in rows]) - 1e9
    assert abs(got["x", "y"] - np.corrcoef(xs[keep], y[keep])[0, 1]) < 1e-9
    assert abs(got["x", "p"] - np.corrcoef(xs, x * y)[0, 1]) < 1e-6
    assert got["x", "k"] is None and got["k", "p"] is None and got["x", "n"] is None and len(got) == 10
    assert [r["corr"] for r in corr_matrix(spark.createDataFrame([], "a double, b double")).collect()] == [None]


def test_frequent_pairs_against_counting(spark):
    """One order with a third of all lines (dealt into blocks), repeated lines, null keys; few buckets lose nothing."""
    import itertools
    import random

    from gridlens.operators.joins import frequent_pairs
    rnd = random.Random(3)
    lines = [(o, rnd.randrange(40)) for o in range(60) for _ in range(rnd.randrange(1, 7))]
    lines += [(1000, i) for i in range(0, 90)] + [(1, 5), (1, 5), (None, 3), (None, 4), (2, None)]
    orders, together = {}, {}
    for o, i in lines:
        if o is not None and i is not None:
            orders.setdefault(o, set()).add(i)
    alone = {}
    for items in orders.values():
        for i in items:
            alone[i] = alone.get(i, 0) + 1
        for p in itertools.combinations(sorted(items), 2):
            together[p] = together.get(p, 0) + 1
    want = sorted((a, b, n, alone[a], alone[b]) for (a, b), n in together.items() if n >= 3)
    df = spark.createDataFrame(lines, "o long, i long")
    for buckets, block in ((1 << 20, 1024), (7, 16)):
        assert want and sorted(map(tuple, frequent_pairs(df, "o", "i", 3, buckets, block).collect())) == want
    assert frequent_pairs(df.limit(0), "o", "i", 1).count() == 0


def test_frequent_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Lines and pairs are grouped in as many tasks as their numbers ask for; the pairs stay those of counting."""
    from collections import Counter
    from itertools import combinations

    from gridlens.operators import joins as J
    orders = {o: sorted({(o * 7 + j * j) % 23 for j in range(o % 9)}) for o in range(200)}
    df = spark.createDataFrame([(o, i) for o, s in orders.items() for i in s], "o long, i long")
    n = Counter(p for s in orders.values() for p in combinations(s, 2))
    items = Counter(i for s in orders.values() for i in s)
    want = sorted((a, b, c, items[a], items[b]) for (a, b), c in n.items() if c >= 5)
    monkeypatch.setattr(J, "LINES_PER_TASK", 40)
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 150)
    got = J.frequent_pairs(df, "o", "i", 5)
    assert want and sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert f"], {-(-sum(n.values()) // 150)}" in plan and "RepartitionByExpression [item_a" in plan
