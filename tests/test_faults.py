"""Hand fixtures for fault windows, severity profiles and labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens.operators import faults as fo
from gridlens.operators.clean import apply_outages
from conftest import ts

EV_COLS = "device string, event_type string, start_time timestamp_ntz, end_time timestamp_ntz, shape string, " \
          "max_severity double, ramp_seconds double, ramp_down_seconds double, ord int"


def tel(spark, device, start, n, step_min=10):
    t0 = ts(start)
    rows = [(device, t0 + dt.timedelta(minutes=step_min * i)) for i in range(n)]
    return spark.createDataFrame(rows, "device string, time timestamp_ntz")


def ev(spark, rows):
    return spark.createDataFrame(rows, EV_COLS)


def sev_by_time(df):
    return {r["time"].strftime("%H:%M"): r for r in df.collect()}


def test_half_open_abrupt(spark):
    t = spark.createDataFrame([("d", ts(f"2024-01-01 {h}")) for h in ("09:50", "10:00", "10:50", "11:00")],
                              "device string, time timestamp_ntz")
    e = ev(spark, [("d", "soiling", ts("2024-01-01 10:00"), ts("2024-01-01 11:00"), "abrupt", 1.0, None, 0.0, 0)])
    L = sev_by_time(fo.label_telemetry(t, e, ["soiling"]))
    assert [L[h]["fault_soiling"] for h in ("09:50", "10:00", "10:50", "11:00")] == [0, 1, 1, 0]


@pytest.mark.parametrize("force", ["broadcast", "bucketed", "sweep"])
def test_linear_first_step_not_flagged(spark, force):
    t = tel(spark, "d", "2024-01-01 10:00", 8)
    e = ev(spark, [("d", "soiling", ts("2024-01-01 10:00"), None, "linear", 1.0, 3600.0, 0.0, 0)])
    L = sev_by_time(fo.label_telemetry(t, e, ["soiling"], force=force))
    assert L["10:00"]["fault_labels"] == "healthy" and L["10:00"]["severity"] == 0.0
    assert L["10:10"]["severity"] == pytest.approx(1 / 6)
    assert L["10:20"]["severity"] == pytest.approx(2 / 6)
    assert L["11:00"]["severity"] == pytest.approx(1.0)
    assert L["11:10"]["is_faulted"] == 1  # open end: faulted to the last row


def test_ramp_down(spark):
    t = tel(spark, "d", "2024-01-01 11:00", 8)
    e = ev(spark, [("d", "temperature", ts("2024-01-01 10:00"), ts("2024-01-01 12:00"), "linear", 1.0, 600.0, 1800.0, 0)])
    L = sev_by_time(fo.label_telemetry(t, e, ["temperature"]))
    assert L["11:20"]["severity"] == pytest.approx(1.0)
    assert L["11:30"]["severity"] == pytest.approx(1.0)
    assert L["11:40"]["severity"] == pytest.approx(2 / 3)
    assert L["11:50"]["severity"] == pytest.approx(1 / 3)
    assert L["12:00"]["severity"] == 0.0


def test_intermittent(spark):
    start = ts("2024-01-01 00:00")
    rows = [("d", start + dt.timedelta(minutes=10 * k)) for k in (6, 6 + 108, 6 + 324)]
    t = spark.createDataFrame(rows, "device string, time timestamp_ntz")
    e = ev(spark, [("d", "pitch", start, None, "intermittent", 2.0, 3600.0, 0.0, 0)])
    s = sorted((r["time"], r["severity"]) for r in fo.label_telemetry(t, e, ["pitch"]).collect())
    assert [v for _, v in s] == pytest.approx([0.675 * 2, 1.0 * 2, 0.35 * 2])


def test_two_faults_same_type_twice_and_downtime(spark):
    t = tel(spark, "d", "2024-01-01 10:00", 6)
    e = ev(spark, [
        ("d", "soiling", ts("2024-01-01 09:00"), None, "abrupt", 0.4, None, 0.0, 0),
        ("d", "tracker_stuck", ts("2024-01-01 10:00"), None, "abrupt", 0.7, None, 0.0, 2),
        ("d", "soiling", ts("2024-01-01 10:20"), None, "abrupt", 0.5, None, 0.0, 0),
        ("d", "downtime", ts("2024-01-01 10:40"), ts("2024-01-01 10:50"), "abrupt", 1.0, None, 0.0, 1 << 30),
    ])
    L = sev_by_time(fo.label_telemetry(t, e, ["soiling", "tracker_stuck"]))
    assert L["10:00"]["fault_labels"] == "soiling|tracker_stuck"
    assert L["10:00"]["severity"] == pytest.approx(0.7)
    assert L["10:30"]["fault_labels"] == "soiling|tracker_stuck"  # same type twice: one token
    assert L["10:40"]["fault_labels"] == "soiling|tracker_stuck|downtime"
    assert L["10:40"]["fault_downtime"] == 1 and L["10:50"]["fault_downtime"] == 0
    assert L["10:00"]["fault_start_time"] == ts("2024-01-01 10:00")
    assert L["10:00"]["fault_severity"] == "high"


def test_outage_mask_zeroes_power(spark):
    t = tel(spark, "d", "2024-01-01 10:00", 4).withColumn("power", F.lit(5.0))
    e = ev(spark, [("d", "downtime", ts("2024-01-01 10:10"), ts("2024-01-01 10:30"), "abrupt", 1.0, None, 0.0, 9)])
    out = {r["time"].strftime("%H:%M"): r for r in apply_outages(t, e, ["power"]).collect()}
    assert [out[h]["power"] for h in ("10:00", "10:10", "10:20", "10:30")] == [5.0, 0.0, 0.0, 5.0]


def test_severity_class_edges(spark):
    from gridlens.functions.exprs import severity_class
    df = spark.createDataFrame([(0.0,), (0.3299,), (0.33,), (0.66,)], "s double")
    assert [r[0] for r in df.select(severity_class(F.col("s"))).collect()] == ["none", "low", "medium", "high"]


def test_outage_length_wall_clock(spark):
    faults = spark.createDataFrame([], "device string, event_type string, start_day double, end_day double, shape string, "
                                       "max_severity double, ramp_days double, ramp_down_days double, ord int")
    outages = spark.createDataFrame([("d", 1.0, 3.0, 1.0)], "device string, start_day double, hours double, severity double")
    e = fo.normalise_events(faults, "2024-01-01 00:00:00", outages)
    t = tel(spark, "d", "2024-01-02 00:00", 60, step_min=5)
    L = fo.label_telemetry(t, e, [])
    assert L.where("fault_downtime = 1").count() == 36


def test_episodes_invert_labels(spark):
    t = tel(spark, "d", "2024-01-01 00:00", 300)
    e = ev(spark, [("d", "x", ts("2024-01-01 01:00"), ts("2024-01-01 03:00"), "abrupt", 1.0, None, 0.0, 0),
                   ("d", "x", ts("2024-01-01 20:00"), ts("2024-01-02 02:00"), "abrupt", 1.0, None, 0.0, 0)])
    L = fo.label_telemetry(t, e, ["x"])
    ep = sorted((r["start_time"], r["end_time"], r["n_rows"]) for r in fo.episodes(L, "is_faulted", bucket_seconds=3600).collect())
    assert ep == [(ts("2024-01-01 01:00"), ts("2024-01-01 02:50"), 12), (ts("2024-01-01 20:00"), ts("2024-01-02 01:50"), 36)]


def test_bucketed_equals_broadcast(spark):
    t = tel(spark, "d", "2024-01-01 00:00", 500)
    e = ev(spark, [("d", "x", ts("2024-01-01 05:00"), ts("2024-01-03 01:00"), "linear", 1.0, 7200.0, 3600.0, 0),
                   ("d", "y", ts("2024-01-02 05:00"), None, "intermittent", 1.0, 600.0, 0.0, 1)])
    a = fo.label_telemetry(t, e, ["x", "y"], force="broadcast").orderBy("time").collect()
    b = fo.label_telemetry(t, e, ["x", "y"], force="bucketed").orderBy("time").collect()
    assert a == b


def test_unknown_shape_raises(spark):
    t = tel(spark, "d", "2024-01-01 10:00", 2)
    e = ev(spark, [("d", "x", ts("2024-01-01 10:00"), None, "wobbly", 1.0, None, 0.0, 0)])
    with pytest.raises(Exception):
        fo.label_telemetry(t, e, ["x"]).collect()


def test_normalised_severity_class(spark):
    t = tel(spark, "d", "2024-01-01 10:00", 3)
    e = ev(spark, [("d", "pitch", ts("2024-01-01 10:00"), None, "abrupt", 10.0, None, 0.0, 0)])
    raw = fo.label_telemetry(t, e, ["pitch"]).first()
    norm = fo.label_telemetry(t, e, ["pitch"], normalise=True).first()
    assert raw["severity"] == 10.0 and raw["fault_severity"] == "high"
    assert norm["severity"] == 1.0 and norm["fault_severity"] == "high" and norm["fault_pitch"] == 1


def test_broadcast_limit_from_session_conf(spark):
    e = ev(spark, [("d", "x", ts("2024-01-01 10:00"), None, "abrupt", 1.0, None, 0.0, 0),
                   ("e", "x", ts("2024-01-01 11:00"), None, "abrupt", 1.0, None, 0.0, 0)])
    assert fo.join_strategy(e) == "broadcast"
    spark.conf.set("spark.gridlens.broadcastLimitBytes", "1")
    try:
        assert fo.join_strategy(e) == "bucketed"
    finally:
        spark.conf.unset("spark.gridlens.broadcastLimitBytes")
