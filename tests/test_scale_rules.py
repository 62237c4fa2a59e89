"""Scale rules: plan scan of every batch query and a source scan."""

import ast
import os

import pytest

from conftest import ROOT, SF_SMALL
from gridlens.plans.registry import load_all

Q = load_all()[0]
BATCH = sorted(k for k in Q if not k.startswith("stream_") and k not in ("sink_roundtrip",))
SRC = os.path.join(ROOT, "gridlens")

# Functions allowed to call .collect()/.first() - each brings back a bounded
# result (scalars, distinct fault types, histograms of <= targets x buckets,
# quantile remainders of <= max_final values, one-row size probes).
COLLECT_OK = {"exact_quantiles", "by_percentile", "check_types", "histogram", "density2d", "value_shares", "hourly_profile",
              "mix_audit", "dist_audit", "high_value", "older_than_quantile", "attach_faults", "join_strategy", "_scalars", "chunks",
              "auto_bucket_seconds", "_offsets", "one_sort_per_key", "fits", "sample_weighted", "rebalance", "stream_label", "q_quantile99",
              # a row of counts and fixed sketch steps; a row per cell between the ends of the brackets
              "refined_quantiles", "_narrow_all"}
# Functions allowed an unpartitioned window: they run it on a table whose size is bounded by a
# parameter (bucket offsets, <= 1000 histogram bins, <= n_parts partition offsets).
GLOBAL_WINDOW_OK = {"positions_by_uniform", "dist_audit", "sequential_ids", "range_count_by_rank"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_plan_has_no_python_or_cartesian(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{key}: {bad}"


def _functions():
    for dirpath, dirs, files in os.walk(SRC):
        dirs[:] = [d for d in dirs if d != "llm"]  # has rules of its own, beside its tests
        for f in files:
            if f.endswith(".py"):
                path = os.path.join(dirpath, f)
                tree = ast.parse(open(path).read())
                for node in ast.walk(tree):
                    if isinstance(node, ast.FunctionDef):
                        yield path, node


def _calls(fn, attr):
    """Method calls ``<obj>.attr(...)``, not the functions module (``F.first`` is an aggregate)."""
    return [n for n in ast.walk(fn) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)
            and n.func.attr == attr and not (isinstance(n.func.value, ast.Name) and n.func.value.id == "F")]


def test_no_cross_join_or_local_checkpoint():
    """(Oracle SQL strings may use CROSS JOIN on one-row CTEs; Spark code may not cross join.)"""
    for path, fn in _functions():
        assert not _calls(fn, "crossJoin") and not _calls(fn, "localCheckpoint"), f"{path}:{fn.name}"


def test_collect_only_where_bounded():
    offenders = []
    for path, fn in _functions():
        if (_calls(fn, "collect") or _calls(fn, "first")) and fn.name not in COLLECT_OK:
            offenders.append(f"{os.path.relpath(path, ROOT)}:{fn.name}")
    assert not offenders, offenders


def test_unpartitioned_windows_only_on_bounded_tables():
    offenders = []
    for path, fn in _functions():
        for c in _calls(fn, "orderBy"):
            if isinstance(c.func.value, ast.Name) and c.func.value.id == "Window" and fn.name not in GLOBAL_WINDOW_OK:
                offenders.append(f"{os.path.relpath(path, ROOT)}:{fn.name}")
    assert not offenders, offenders


def test_windows_over_optional_keys_are_two_level():
    """``Window.partitionBy(*keys)`` is one task when ``keys`` may be empty: only over tables of bounded size."""
    ok = {"positions_by_uniform"}  # n_buckets rows
    for path, fn in _functions():
        optional = {a.arg for a, d in zip(fn.args.args[::-1], fn.args.defaults[::-1]) if isinstance(d, ast.Constant) and d.value is None}
        for c in _calls(fn, "partitionBy"):
            if isinstance(c.func.value, ast.Name) and c.func.value.id == "Window" and len(c.args) == 1 and isinstance(c.args[0], ast.Starred):
                assert not (c.args[0].value.id in optional and fn.name not in ok), f"{path}:{fn.name}"


def test_rdd_only_for_partition_count():
    for path, fn in _functions():
        for n in ast.walk(fn):
            if isinstance(n, ast.Attribute) and n.attr == "rdd":
                assert fn.name == "ensure_parallel", f"{path}:{fn.name}"
