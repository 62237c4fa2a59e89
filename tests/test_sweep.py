"""The sweep over fault bounds against the plain join, on dense random faults."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import ts
from gridlens.operators import faults as fo
from gridlens.operators import sweep
from gridlens.operators.clean import apply_outages

T0 = ts("2024-01-01")


def random_faults(spark, n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = T0 + dt.timedelta(seconds=rng.choice([rng.randrange(0, 20 * 86400), 600 * rng.randrange(0, 200)]), microseconds=rng.choice([0, rng.randrange(10 ** 6)]))
        end = rng.choice([None, start + dt.timedelta(seconds=rng.choice([0, 60, 7200, 86400, rng.randrange(1, 10 * 86400)]))])
        shape = rng.choice(["abrupt", "linear", "linear", "intermittent"])
        kind = {"abrupt": "x", "linear": "y", "intermittent": "z"}[shape] if rng.random() < 0.8 else "downtime"
        rows.append((rng.choice(["a", "a", "a", "b", None]), kind, start, end, shape, rng.choice([1.0, 0.5, 0.3, 0.0]),
                     rng.choice([None, 0.0, 600.0, 86400.0, 1234.5]), rng.choice([None, 0.0, 3600.0]), "xyz".find(kind)))
    rows += rows[:5]
    return spark.createDataFrame(rows, fo.EVENT_SCHEMA), rows


@pytest.fixture(scope="module")
def case(spark):
    events, rows = random_faults(spark, 260)
    rng = random.Random(2)
    times = [T0 + dt.timedelta(seconds=rng.randrange(-86400, 40 * 86400)) for _ in range(300)]
    times += [r[2] for r in rows[:40]] + [r[3] for r in rows[:40]] + [ts("2031-01-01"), None]
    tel = spark.createDataFrame([(i, rng.choice(["a", "a", "b", "c", None]), t, 5.0) for i, t in enumerate(times)],
                                "id long, device string, time timestamp_ntz, value double")
    spark.conf.set("spark.gridlens.boundsPerChunk", "5")
    yield tel.cache(), events.cache()
    spark.conf.unset("spark.gridlens.boundsPerChunk")


def plain(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 7) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("normalise", [False, True])
def test_labels_equal_those_of_the_plain_join(case, normalise):
    tel, events = case
    a, b = (plain(fo.label_telemetry(tel, events, ["x", "y", "z"], keep=["id"], normalise=normalise, force=f).collect()) for f in ("broadcast", "sweep"))
    assert a == b


def test_every_pair_is_found_once(case):
    tel, events = case
    a, b = (plain(fo.with_severity(fo.attach_faults(tel, events, force=f)).collect()) for f in ("broadcast", "sweep"))
    assert a == b
    for how in ("left_semi", "left_anti"):
        a, b = (plain(fo.attach_faults(tel, events, how=how, force=f).collect()) for f in ("broadcast", "sweep"))
        assert a == b
    a, b = (plain(fo.fault_progress(tel, events, force=f).collect()) for f in ("bucketed", "sweep"))
    assert a == b
    a, b = (plain(apply_outages(tel, events, ["value"], key="id", force=f).collect()) for f in ("bucketed", "sweep"))
    assert a == b


def test_a_chunk_lists_few_faults_however_many_are_open(spark):
    rows = [("d", "x", T0 + dt.timedelta(minutes=i), None, "abrupt", 1.0 - i / 9000, None, 0.0, 0) for i in range(1500)]
    rows += [("d", "y", T0 + dt.timedelta(minutes=i), None, "linear", 1.0, 3600.0, 0.0, 1) for i in range(1500)]
    events = spark.createDataFrame(rows, fo.EVENT_SCHEMA)
    got = sweep.chunks(events, fo.EVENT_FIELDS, "labels", fo.INTERMITTENT_PERIOD_S)
    top = got.agg(F.max(F.size("_faults")), F.count("*")).first()
    assert top[0] <= 3 * sweep.PER_CHUNK and top[1] > 90
    assert fo.join_strategy(events) == "sweep" and fo.join_strategy(events.limit(20)) == "broadcast"


def test_tree_nodes_cover_a_range_exactly(spark):
    df = spark.createDataFrame([(low, high) for low in range(12) for high in range(low - 1, 14)], "low long, high long")
    nodes = df.select("low", "high", F.explode_outer(F.expr(sweep._cover("low", "high", 5))).alias("n")).select("low", "high", "n.level", "n.idx").collect()
    got = {}
    for r in nodes:
        got.setdefault((r["low"], r["high"]), []).extend(range(r["idx"] << r["level"], (r["idx"] + 1) << r["level"]) if r["level"] is not None else [])
    assert all(sorted(v) == list(range(low, high + 1)) for (low, high), v in got.items())
