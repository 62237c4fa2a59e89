"""Invariants on any input and a brute-force severity check."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridlens.operators import faults as fo
from gridlens.plans.registry import load_all

Q = load_all()[0]


@pytest.fixture(scope="module")
def labelled(spark):
    return Q["label_telemetry"](spark, SF_SMALL).cache()


def test_healthy_iff_not_faulted(labelled):
    assert labelled.where((F.col("is_faulted") == 0) != (F.col("fault_labels") == "healthy")).count() == 0


def test_flags_match_label_tokens(labelled):
    from gridlens.plans.faults import TYPE_NAMES
    for t in TYPE_NAMES + ["downtime"]:
        has = F.array_contains(F.split("fault_labels", r"\|"), t)
        assert labelled.where((F.col(f"fault_{t}") == 1) != has).count() == 0, t


def test_severity_class_consistent(labelled):
    bad = labelled.where(
        ((F.col("severity") <= 0) & (F.col("fault_severity") != "none")) |
        ((F.col("severity") >= 0.66) & (F.col("fault_severity") != "high")) |
        ((F.col("severity") > 0) & (F.col("severity") < 0.33) & (F.col("fault_severity") != "low")))
    assert bad.count() == 0


def test_fault_start_before_or_at_faulted_rows(labelled):
    assert labelled.where((F.col("is_faulted") == 1) & (F.col("time") < F.col("fault_start_time"))).count() == 0


def test_outage_rows_are_zeroed(spark):
    m = Q["outage_mask"](spark, SF_SMALL)
    assert m.where((F.col("in_outage") == 1) & (F.col("value") != 0)).count() == 0
    assert m.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def _severity_py(dt, dur, shape, mx, ramp, ramp_down, period=fo.INTERMITTENT_PERIOD_S):
    rl = min(ramp or 0.0, dur if dur is not None else (ramp or 0.0))
    if shape == "abrupt":
        return mx
    if rl > 0 and dt < rl:
        return mx * dt / rl
    if shape == "linear":
        if (ramp_down or 0) > 0 and dur is not None:
            rd = max(rl, dur - ramp_down)
            if dt >= rd:
                return mx * (dur - dt) / (dur - rd)
        return mx
    return mx * (0.35 + 0.65 * 0.5 * (1 + math.sin(2 * math.pi * (dt - max(rl, 0.0)) / period)))


def test_severity_expression_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(2000):
        dur = None if rnd.random() < 0.3 else rnd.uniform(60, 10 * 86400)
        dt = rnd.uniform(0, dur if dur is not None else 10 * 86400)
        if dur is not None and dt >= dur:
            dt = dur * 0.999
        rows.append((i, dt, dur, rnd.choice(["abrupt", "linear", "intermittent"]), rnd.uniform(0.1, 18),
                     rnd.choice([None, 0.0, rnd.uniform(60, 86400)]), rnd.choice([0.0, rnd.uniform(60, 86400)])))
    df = spark.createDataFrame(rows, "i int, _dt double, _dur double, shape string, max_severity double, "
                                     "ramp_seconds double, ramp_down_seconds double")
    got = {r["i"]: r["s"] for r in df.select("i", F.expr(fo.severity_sql()).alias("s")).collect()}
    for i, dt, dur, shape, mx, ramp, rd in rows:
        assert got[i] == pytest.approx(_severity_py(dt, dur, shape, mx, ramp, rd), rel=1e-9, abs=1e-12), (shape, dt, dur)


def test_labels_independent_of_partitioning(spark):
    from gridlens.plans.faults import telemetry, fault_events, TYPE_NAMES
    tel = telemetry(spark, SF_SMALL)
    ev = fault_events(spark, SF_SMALL)
    a = fo.label_telemetry(tel.repartition(1), ev.repartition(1), TYPE_NAMES, keep=["event_id"])
    b = fo.label_telemetry(tel.repartition(13, "time"), ev.repartition(3), TYPE_NAMES, keep=["event_id"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_ensure_parallel_only_when_needed(spark):
    from gridlens.sources.files import ensure_parallel
    one = spark.range(1000).coalesce(1)
    many = spark.range(1000).repartition(16)
    assert ensure_parallel(one, 4).rdd.getNumPartitions() == 4
    assert ensure_parallel(many, 4).rdd.getNumPartitions() == 16   # already spread: no extra shuffle
