"""Streaming twins: the same operators over a file stream.

Each twin builds a streaming DataFrame (``readStream`` over Parquet files),
applies watermarked, windowed or stateless operators, and writes to a
Parquet sink with its checkpoint in the shared checkpoint folder.  In tests
and registered queries the stream runs with ``trigger(availableNow=True)``
(every file present is processed, then the query stops), so results equal
the batch operator on *closed* windows.  No server or port is involved.

Event times in the tables are zone-less (``timestamp_ntz``); watermarks
need ``timestamp``.  :func:`to_instant` maps the wall clock to the same UTC
instant and :func:`to_ntz` maps back, so windows align the same way in any
session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def to_instant(ts) -> F.Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c))


def to_ntz(ts) -> F.Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH))


def file_stream(spark: SparkSession, directory: str, file_glob: str = "*.parquet", schema: T.StructType | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of what in ``directory`` matches ``file_glob``: Parquet
    files, or folders of part files; new files arriving there are picked up by
    later triggers.  The schema comes from the batch footer when not given
    (file streams need a fixed schema)."""
    if not any(c in file_glob for c in "*?[{"):
        file_glob = f"{file_glob[:-1]}[{file_glob[-1]}]"  # a stream takes a single file as a pattern only
    path = f"{directory.rstrip('/')}/{file_glob}"
    schema = schema or spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def _state(progress, name: str) -> int:
    """A number of a progress report, over all its stateful operators."""
    ops = progress.get("stateOperators", []) if isinstance(progress, dict) else getattr(progress, "stateOperators", [])
    return sum(int((op.get(name, 0) if isinstance(op, dict) else getattr(op, name, 0)) or 0) for op in ops)


def _dropped(progress) -> int:
    return _state(progress, "numRowsDroppedByWatermark")


def _held(progress) -> int:
    return _state(progress, "numRowsTotal")


def run_available_now(sdf: DataFrame, name: str, output_mode: str = "append",
                      partition_by: list[str] | None = None, metrics: dict | None = None) -> DataFrame:
    """Run a streaming query to completion over all available input and
    return its Parquet sink as a batch DataFrame.  ``metrics`` (a dict), when
    given, receives the number of batches, of late rows dropped by watermarks
    and the most rows of state held at once, gathered while the query runs (a
    query keeps its last 100 progress reports only).  State lives in RocksDB,
    outside the JVM heap."""
    spark = sdf.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    w = (sdf.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)  # a query copies the settings when it starts
    try:
        q = w.start()
    finally:
        spark.conf.set(provider, before)
    seen, held = {}, 0
    while True:
        ended = q.awaitTermination(0.5 if metrics is not None else 3600)
        for p in q.recentProgress if metrics is not None else []:
            seen[p["batchId"] if isinstance(p, dict) else p.batchId] = _dropped(p)
            held = max(held, _held(p))
        if ended:
            break
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if metrics is not None:
        metrics["late_rows_dropped"] = sum(seen.values())
        metrics["batches"] = len(seen)
        metrics["state_rows"] = held
    return spark.read.schema(sdf.schema).parquet(out + "/data")


def stream_resample(ev: DataFrame, ts: str, group: list[str], value: str, width: str = "1 day",
                    delay: str = "10 minutes") -> DataFrame:
    """T1 (twin of W9): tumbling-window count and mean per group; a window is
    emitted once the watermark (max event time - delay) passes its end."""
    s = ev.withColumn("_t", to_instant(ts)).withWatermark("_t", delay)
    g = s.groupBy(F.window("_t", width).alias("w"), *group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"))
    return g.select(to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"), *group,
                    "n", "sum_value")


def stream_velocity(ev: DataFrame, ts: str, keys: list[str], n: int, width: str, slide: str,
                    delay: str = "10 minutes") -> DataFrame:
    """T2 (twin of A1): sliding windows with at least n events per key.
    Sliding buckets approximate the exact trailing range of the batch form."""
    s = ev.withColumn("_t", to_instant(ts)).withWatermark("_t", delay)
    g = s.groupBy(F.window("_t", width, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.where(F.col("n") >= n).select(to_ntz("w.start").alias("window_start"), *keys, "n")


def stream_ping(ev: DataFrame, ts: str, keys: list[str], amount: str, max_amount: float, gap: str,
                min_n: int, max_n: int, delay: str = "10 minutes") -> DataFrame:
    """T3 (twin of A2): session windows of tiny payments; closed sessions of
    min_n..max_n events."""
    s = ev.withColumn("_t", to_instant(ts)).withWatermark("_t", delay).where(F.col(amount) < max_amount)
    g = s.groupBy(F.session_window("_t", gap).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("session_start"), F.max(ts).alias("session_end"))
    return g.where(F.col("n").between(min_n, max_n)).select(*keys, "session_start", "session_end", "n")


def stream_episodes(ev: DataFrame, ts: str, keys: list[str], flagged, gap: str, delay: str = "10 minutes") -> DataFrame:
    """T3 (twin of W2): runs of flagged readings of a key no more than ``gap``
    apart (the sampling step and its slack), emitted once closed.  A stream
    can't see that a reading is missing, so a run ends by time, not by an
    unflagged reading."""
    s = ev.withColumn("_t", to_instant(ts)).withWatermark("_t", delay).where(flagged)
    g = s.groupBy(F.session_window("_t", gap).alias("w"), *keys).agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), F.count(F.lit(1)).alias("n_rows"))
    return g.select(*keys, "start_time", "end_time", "n_rows")


def stream_label(ev: DataFrame, events_static: DataFrame, device: str, time: str) -> DataFrame:
    """T4 (twin of L1): stream x static fault windows - stateless.  The static
    side gets the same size check as the batch join, and open faults hold for
    any later row on either path.  The fault table is the one given when the
    query starts; for faults that arrive later see :func:`stream_label_late`."""
    from gridlens.operators.faults import attach_faults
    return attach_faults(ev, events_static, device, time, how="inner")


def stream_label_late(tel: DataFrame, faults: DataFrame, device: str, time: str, delay: str) -> DataFrame:
    """T4 with faults that arrive while the stream runs (twin of L1): an inner
    stream-stream interval join of telemetry and fault windows, both as streams.

    A reading and a fault meet whichever of them comes first.  Both sides carry
    a watermark of ``delay``: a reading waits in the state until no fault that
    began by its time can still arrive, then it is dropped; faults stay, as an
    open one may hold for any later reading.  A null end never ends; rows
    without device or time match nothing; equal rows are kept.  Columns: those
    of ``tel``, then those of the fault but its device.
    """
    fields = [c for c in faults.columns if c != "device"]
    t = tel.withColumn("_t", to_instant(time)).withWatermark("_t", delay)
    f = faults.select(F.col("device").alias("_fd"), *fields).withColumn("_s", to_instant("start_time")).withWatermark("_s", delay)
    on = (F.col(device) == F.col("_fd")) & (F.col("_t") >= F.col("_s")) & (F.col("end_time").isNull() | (F.col(time) < F.col("end_time")))
    return t.join(f, on, "inner").drop("_t", "_s", "_fd")


def stream_dedup(ev: DataFrame, ts: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """T5: drop repeated (keys, time) rows arriving within the watermark delay.
    Rows older than the watermark are dropped as late; Spark filters late rows
    with the previous micro-batch's watermark, and :func:`run_available_now`
    reports their number (``metrics['late_rows_dropped']``)."""
    s = ev.withColumn("_t", to_instant(ts)).withWatermark("_t", delay)
    return s.dropDuplicatesWithinWatermark([*keys, ts]).drop("_t")


def stream_copy(ev: DataFrame) -> DataFrame:
    """Source -> sink round trip."""
    return ev
