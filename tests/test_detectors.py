"""Detector fixtures: velocity, ping, recurring / missing charges, account age."""

import datetime as dt

from pyspark.sql import functions as F

from gridlens.operators import fraud as A
from gridlens.operators.joins import missing_charges
from conftest import ts


def _burst(spark, cust, start, n, span_s):
    t0 = ts(start)
    step = span_s / (n - 1)
    return [(cust, "m1", t0 + dt.timedelta(seconds=step * i)) for i in range(n)]


def test_velocity(spark):
    rows = (_burst(spark, "hit", "2024-01-01 10:00:00", 10, 299) + _burst(spark, "miss", "2024-01-01 10:00:00", 10, 301)
            + _burst(spark, "nine", "2024-01-01 10:00:00", 9, 10))
    tx = spark.createDataFrame(rows, "customer string, merchant string, ts timestamp_ntz")
    hits = {r["customer"] for r in A.velocity(tx, ["customer", "merchant"], "ts", 10, 300).collect()}
    assert hits == {"hit"}


def test_velocity_across_midnight(spark):
    tx = spark.createDataFrame(_burst(spark, "c", "2024-01-01 23:58:00", 10, 200),
                               "customer string, merchant string, ts timestamp_ntz")
    assert A.velocity(tx, ["customer"], "ts", 10, 300).count() == 1


def test_ping(spark):
    t0 = ts("2024-01-01 02:00:00")
    four = [("c1", "m", t0 + dt.timedelta(seconds=170 * i), 1.5, i) for i in range(4)]
    six = [("c2", "m", t0 + dt.timedelta(seconds=170 * i), 1.5, 10 + i) for i in range(6)]
    big = [("c3", "m", t0 + dt.timedelta(seconds=170 * i), 50.0, 20 + i) for i in range(4)]
    tx = spark.createDataFrame(four + six + big, "customer string, merchant string, ts timestamp_ntz, amount double, id int")
    p = A.ping(tx, ["customer", "merchant"], "ts", "amount", tiebreak=["id"]).collect()
    assert [(r["customer"], r["n"], r["late_night"]) for r in p] == [("c1", 4, 1)]


def test_recurring_and_missing(spark):
    rows = [("c", "netflix", ts("2024-01-05 00:00:00"), 10.0), ("c", "netflix", ts("2024-02-04 00:00:00"), 10.2),
            ("c", "netflix", ts("2024-03-05 00:00:00"), 9.9), ("c", "netflix", ts("2024-05-05 00:00:00"), 10.0)]
    tx = spark.createDataFrame(rows, "customer string, merchant string, ts timestamp_ntz, amount double")
    rec = A.recurring(tx, ["customer", "merchant"], "ts", "amount").first()
    assert rec["n_links"] == 2
    miss = missing_charges(tx, ["customer", "merchant"], "ts").collect()
    assert [r["month"] for r in miss] == [dt.date(2024, 4, 1)]


def test_account_age_never_negative(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"), ts("2024-01-10 00:00:00"))], "t timestamp_ntz, signup timestamp_ntz")
    age = df.select(F.greatest(F.lit(0), F.datediff(F.col("t").cast("date"), F.col("signup").cast("date"))).alias("a"))
    assert age.first()["a"] == 0


def test_detector_report(spark):
    pred = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 0)], "k int, p int")
    truth = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "k int, t int")
    r = A.detector_report(pred, truth, "k", "p", "t").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 1, 1, 1) and r["precision"] == 0.5 and r["f1"] == 0.5


def test_velocity_bursts_of_a_dense_merchant(spark):
    """Two runs of 1,500 rows a second apart, ten hours between them: two bursts, and the flagged rows are computed once."""
    rows = spark.range(3000).select("id", F.lit("m").alias("merchant"), F.expr(
        "timestampadd(SECOND, IF(id < 1500, id, id + 36000), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"))
    bursts = A.velocity_bursts(rows, ["merchant"], "ts", 10, 300, ["id"])
    assert sorted((r["n_flagged"], r["peak"]) for r in bursts.collect()) == [(1491, 301), (1491, 301)]
    plan = bursts._jdf.queryExecution().analyzed().toString()
    assert "n_in_window" in plan and "_kind" not in plan and "_halo" not in plan
