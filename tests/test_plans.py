"""Plan checks: pushdown, pruning, broadcast joins, no Python UDFs."""

import pytest

from conftest import SF_SMALL
from gridlens.plans.registry import load_all


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def Q():
    return load_all()[0]


def test_time_filter_pushed_down(spark, Q):
    p = plan(Q["scan_time_range"](spark, SF_SMALL))
    assert "PushedFilters" in p and "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p


def test_time_bounds_reads_one_column(spark, Q):
    p = plan(Q["time_bounds"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_interval_join_is_broadcast(spark, Q):
    assert "BroadcastHashJoin" in plan(Q["fault_interval_join"](spark, SF_SMALL))


def test_curve_lookup_is_hash_join(spark, Q):
    p = plan(Q["power_residual"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "NestedLoop" not in p


@pytest.mark.parametrize("key", ["label_telemetry", "velocity", "ping", "step_audit", "spike_windows", "overlay_solar",
                                 "sample_weighted", "split_by_share", "corr_matrix", "basket_pairs"])
def test_no_python_udf(spark, Q, key):
    p = plan(Q[key](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("key", ["velocity", "step_audit", "fault_episodes", "device_switch", "recurring"])
@pytest.mark.parametrize("full", [False, True])
def test_per_key_windows(spark, Q, key, full):
    """Where a key is full, ordered per-key windows are partitioned by (key, time bucket); else one sort per key does.
    Trailing counts have buckets as long as nothing is full, and then subtract ranks inside range parts of the whole order."""
    if full:
        spark.conf.set("spark.gridlens.bucketTargetRows", "5")
    try:
        p = plan(Q[key](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.gridlens.bucketTargetRows")
    assert "Window [" in p
    if key == "velocity":
        assert ("_b#" in p, "windowspecdefinition(_p#" in p) == (not full, full)
    else:
        assert ("_b#" in p) == full
