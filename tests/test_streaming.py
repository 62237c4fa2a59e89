"""Streaming twins equal their batch operators (closed windows / exact state)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from gridlens import streaming as ST
from gridlens.operators import fraud as A


def _split_by_day(spark, tmp_path):
    """events of the small table written as time-ordered files, one per 10 days."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    d = str(tmp_path / "ev")
    for i, (a, b) in enumerate([("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]):
        part = ev.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(d, f"p{i}"))
    return ev, d


def _closed(df, last, delay="10 minutes", slice_s=6 * 3600):
    end = (F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / slice_s) + 1) * slice_s
    limit = F.unix_timestamp((F.lit(last) - F.expr(f"INTERVAL {delay}")).cast("timestamp"))
    return df.where(end < limit)


def test_exact_velocity_state_across_batches(spark, tmp_path):
    ev, d = _split_by_day(spark, tmp_path)
    s = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(d))
    got = ST.run_available_now(ST.stream_velocity_exact(s, "ts", ["event_type"], "event_id", 3, 6 * 3600), "t_vel")
    want = A.velocity(ev.select("event_id", "event_type", "ts"), ["event_type"], "ts", n=3, secs=6 * 3600)
    want = _closed(want, ev.agg(F.max("ts")).first()[0])
    assert sorted(got.select("event_id", "n_in_window").collect()) == sorted(want.select("event_id", "n_in_window").collect())
    assert got.count() > 0


def test_exact_velocity_of_files_out_of_order(spark, tmp_path):
    """Files that overlap in time, every row inside the watermark delay: the counts are those of the whole table."""
    import time as _time
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    d = str(tmp_path / "mix")
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    for i, part in enumerate((early & (F.col("event_id") % 2 == 1), early & (F.col("event_id") % 2 == 0), ~early)):
        ev.where(part).coalesce(1).write.parquet(f"{d}/p{i}")
        _time.sleep(1.1)
    s = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(d))
    q = ST.stream_velocity_exact(s, "ts", ["event_type"], "event_id", 3, 6 * 3600, slice_seconds=2 * 3600, delay="12 days")
    got = ST.run_available_now(q, "t_mix")
    want = A.velocity(ev.select("event_id", "event_type", "ts"), ["event_type"], "ts", n=3, secs=6 * 3600)
    want = _closed(want, ev.agg(F.max("ts")).first()[0], "12 days", 2 * 3600)
    assert sorted(got.select("event_id", "n_in_window").collect()) == sorted(want.select("event_id", "n_in_window").collect())
    assert want.where(early).count() > 0


def test_exact_velocity_carries_counts_between_sub_slices(spark, tmp_path):
    """One hot merchant, a null one, ties on slice borders; any number of sub-slices gives the batch counts, and the state stays bounded."""
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "hot", start + dt.timedelta(seconds=37 * (i // 2))) for i in range(4000)]
    rows += [(5000 + i, None, start + dt.timedelta(minutes=15 * i)) for i in range(80)] + [(9000, "hot", None)]
    ev = spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz")
    for lo, hi in ((0, 5), (5, 11), (11, 30)):  # files in the order of time
        hours = [(start + dt.timedelta(hours=h)) for h in (lo, hi)]
        ev.where(F.col("ts").isNull() | F.col("ts").between(hours[0], hours[1] - dt.timedelta(microseconds=1))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/hot")
    last = max(r[2] for r in rows if r[2])
    want = _closed(A.velocity(ev.where("ts IS NOT NULL"), ["event_type"], "ts", n=3, secs=3600), last, slice_s=3600)
    want = sorted(map(tuple, want.select("event_id", "n_in_window").collect()))
    assert len(want) > 3500
    for parts in (1, 4):
        s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/hot")
        metrics = {}
        got = ST.run_available_now(ST.stream_velocity_exact(s, "ts", ["event_type"], "event_id", 3, 3600, parts=parts), f"t_hot{parts}", metrics=metrics)
        assert sorted(map(tuple, got.select("event_id", "n_in_window").collect())) == want
        assert 0 < metrics["state_rows"] < len(rows)


def test_stream_resample_closed_windows(spark):
    s = ST.stream_resample(ST.file_stream(spark, SF_SMALL, "events.parquet"), "ts", ["event_type"], "value", "1 day")
    got = ST.run_available_now(s, "t_res")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    last = ev.agg(F.max("ts")).first()[0]
    want = (ev.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("w.end") <= F.lit(last) - F.expr("INTERVAL 10 MINUTES")))
    assert sorted((r["event_type"], r["n"]) for r in got.collect()) == sorted((r["event_type"], r["n"]) for r in want.collect())


def test_stream_dedup_removes_copies(spark):
    a = ST.file_stream(spark, SF_SMALL, "events.parquet")
    b = ST.file_stream(spark, SF_SMALL, "events.parquet")
    got = ST.run_available_now(ST.stream_dedup(a.unionByName(b), "ts", ["user_id"]), "t_dedup")
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_stream_label_bucketed_path(spark):
    from gridlens.operators.faults import BROADCAST_LIMIT  # noqa: F401
    from gridlens.plans.faults import fault_events
    import gridlens.operators.faults as fo
    ev = ST.file_stream(spark, SF_SMALL, "events.parquet").select(
        "event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"))
    static = fault_events(spark, SF_SMALL)
    old = fo.BROADCAST_LIMIT
    try:
        fo.BROADCAST_LIMIT = 1     # force the size check to fail -> (device, day) equi-join
        assert fo.join_strategy(static) == "bucketed"
        s = ST.stream_label(ev, static, "device", "time").select("event_id", "event_type")
        got = ST.run_available_now(s, "t_label_b")
    finally:
        fo.BROADCAST_LIMIT = old
    batch = fo.attach_faults(spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        "event_id", F.col("user_id").alias("device"), F.col("ts").alias("time")), static, how="inner")
    assert sorted(got.collect()) == sorted(batch.select("event_id", "event_type").collect())


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    """Late-row filtering uses the watermark of the previous micro-batch, so
    the late file comes third: early rows, rows that advance time, late rows."""
    import datetime as dt
    import time as _time
    d = str(tmp_path / "late")
    schema = "user_id long, ts timestamp_ntz, v double"
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    files = [[(1, t0 + dt.timedelta(minutes=i), 1.0) for i in range(50)],
             [(1, t0 + dt.timedelta(minutes=60 + i), 1.0) for i in range(10)],
             [(1, t0 - dt.timedelta(hours=1), 2.0), (1, t0 + dt.timedelta(minutes=65), 3.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/f{i}")
        _time.sleep(1.1)   # file sources take files in modification-time order
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
         .parquet(d))
    m = {}
    out = ST.run_available_now(ST.stream_dedup(s, "ts", ["user_id"]), "t_late", metrics=m)
    assert m["late_rows_dropped"] >= 1
    assert out.count() == 60   # the late row is dropped, the 11:05 duplicate is removed


def test_faults_that_arrive_after_the_telemetry(spark, tmp_path):
    """Readings wait in the state for faults of a later micro-batch; late and early ones give the batch join."""
    from gridlens.operators import faults as fo
    from gridlens import streaming as ST
    tel = spark.createDataFrame([("a", ts(f"2024-01-{d:02d}")) for d in range(1, 21)] + [("b", ts("2024-01-05")), (None, ts("2024-01-05"))] + [("a", ts("2024-01-04"))],
                                "device string, time timestamp_ntz")
    early = [("a", "x", ts("2024-01-03"), ts("2024-01-06"), "abrupt", 1.0, None, 0.0, 0)]
    late = [("a", "y", ts("2024-01-05"), None, "linear", 1.0, 60.0, 0.0, 1), ("b", "x", ts("2024-01-05"), ts("2024-01-05 00:00:01"), "abrupt", 1.0, None, 0.0, 0)]
    tel.coalesce(1).write.parquet(f"{tmp_path}/tel")
    for part in (early, late):
        spark.createDataFrame(part, fo.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/faults")
    metrics = {}
    s = ST.stream_label_late(ST.file_stream(spark, f"{tmp_path}/tel"), ST.file_stream(spark, f"{tmp_path}/faults", max_files_per_trigger=1), "device", "time", "400 days")
    got = ST.run_available_now(s, "late", metrics=metrics).collect()
    both = spark.createDataFrame(early + late, fo.EVENT_SCHEMA)
    want = fo.attach_faults(tel, both, how="inner").collect()
    pick = lambda rows: sorted((r["device"], str(r["time"]), r["event_type"], str(r["end_time"])) for r in rows)
    assert pick(got) == pick(want) and len(got) > 15 and metrics["batches"] >= 2


def test_late_fault_files_make_two_batches(spark, tmp_path, monkeypatch):
    """The halves of the faults are two micro-batches, however many tasks write them; the rows are those of the batch join."""
    from gridlens.plans import faults as PF
    from gridlens.plans import stream_twins as PS
    ev = spark.range(240).select(F.col("id").alias("event_id"), F.expr("timestampadd(SECOND, id * 601, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"),
                                 (F.col("id") % 5).alias("user_id"), F.lit("error").alias("event_type"),
                                 (F.col("id") % 7 * 50.0 + 20.0).alias("value"), F.lit("").alias("props"))
    ev.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    metrics, run = {}, ST.run_available_now
    monkeypatch.setattr(ST, "run_available_now", lambda s, name: run(s, name, metrics=metrics))
    got = PS.q_stream_label_refresh(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, PF.q_fault_interval_join(spark, str(tmp_path)).collect()))
    assert got.count() > 100 and 2 <= metrics["batches"] <= 4
