"""Time-series operators on (device, time) tables.

Ordered per-device work goes through the skew-safe helpers in
:mod:`gridlens.operators.windows` (windows partitioned by device and time
bucket, repaired across bucket borders with small summary tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.exprs import epoch_s
from gridlens.operators.windows import global_row_number, null_safe_join, prev_row


def step_audit(tel: DataFrame, device: str = "device", time: str = "time", tiebreak: list[str] | None = None,
               bucket_seconds: int | None = None) -> DataFrame:
    """Measured sampling interval per device: step statistics, the modal
    step in whole minutes (ties to the smaller) and steps that differ from it."""
    p = prev_row(tel.select(device, time, *(tiebreak or [])), [device], time, [], tiebreak, bucket_seconds)
    d = p.where(F.col("prev_" + time).isNotNull()).withColumn(
        "_s", epoch_s(F.col(time)) - epoch_s(F.col("prev_" + time)))
    d = d.withColumn("_m", F.floor(F.col("_s") / 60.0).cast("long"))
    per = d.groupBy(device).agg(F.count(F.lit(1)).alias("n_steps"), F.min("_s").alias("min_step_s"),
                                F.max("_s").alias("max_step_s"), F.avg("_s").alias("mean_step_s"))
    modes = (d.groupBy(device, "_m").agg(F.count(F.lit(1)).alias("_n"))
             .groupBy(device).agg(F.min_by("_m", F.struct(-F.col("_n"), F.col("_m"))).alias("mode_step_min"),
                                  F.max("_n").alias("_nm")))
    return null_safe_join(per, modes, [device]).select(device, "n_steps", "min_step_s", "max_step_s", "mean_step_s",
                                          "mode_step_min", (F.col("n_steps") - F.col("_nm")).alias("n_irregular"))


def assign_ids(df: DataFrame, order: str, tiebreak: list[str], start: int = 1, out: str = "seq_id",
               keys: list[str] | None = None) -> DataFrame:
    """Consecutive ids in (order, tiebreak) order starting at ``start``.
    Without keys: sampled range partitions + per-partition offsets (ties in
    ``order`` still spread evenly); with keys: numbering restarts per key via
    the time-bucketed row number.  Never a single-partition window."""
    if keys:
        n = global_row_number(df, keys, order, tiebreak, out="_rn")
        return n.withColumn(out, F.col("_rn") + F.lit(start - 1)).drop("_rn")
    from gridlens.operators.windows import sequential_ids
    return sequential_ids(df, [order, *tiebreak], start, out)


def ar1_fit(tel: DataFrame, col: str, device: str = "device", time: str = "time",
            tiebreak: list[str] | None = None) -> DataFrame:
    """Lag-1 regression per device: slope, intercept, innovation std."""
    p = prev_row(tel.select(device, time, col, *(tiebreak or [])), [device], time, [col], tiebreak)
    pairs = p.where(F.col("prev_" + col).isNotNull())
    fit = pairs.groupBy(device).agg(F.regr_slope(F.col(col), F.col("prev_" + col)).alias("slope"),
                                    F.regr_intercept(F.col(col), F.col("prev_" + col)).alias("intercept"),
                                    F.count(F.lit(1)).alias("n_pairs"))
    res = null_safe_join(pairs, fit, [device]).withColumn(
        "_e", F.col(col) - (F.col("intercept") + F.col("slope") * F.col("prev_" + col)))
    return res.groupBy(device, "slope", "intercept", "n_pairs").agg(F.stddev_samp("_e").alias("innovation_std")).select(
        device, "n_pairs", "slope", "intercept", "innovation_std")


def seasonal_residual(tel: DataFrame, col: str, time: str = "time", keys: list[str] | None = None) -> DataFrame:
    """baseline = mean by (day of week, hour of day); residual per row.
    The baseline has at most 168 rows per key set -> joined back by broadcast."""
    keys = keys or []
    t = tel.withColumn("_dow", F.dayofweek(time)).withColumn("_hr", F.hour(time))
    base = t.groupBy(*keys, "_dow", "_hr").agg(F.avg(F.col(col)).alias("baseline"))
    j = null_safe_join(t, F.broadcast(base) if not keys else base, [*keys, "_dow", "_hr"])
    return j.withColumn("residual", F.col(col) - F.col("baseline")).drop("_dow", "_hr")


def rows_agg(df: DataFrame, keys: list[str], order: str, tiebreak: list[str], w: int, aggs: dict,
             include_current: bool = False, rows_per_bucket: int = 50000) -> DataFrame:
    """Aggregates over the ``w`` preceding rows per key (optionally + current).

    Rows get a per-key row number (skew-safe), are cut into blocks of
    ``rows_per_bucket`` rows and each block also receives the ``w`` rows before
    it, from as many blocks as they span, so frames are complete without a
    per-key sort.
    """
    n = global_row_number(df, keys, order, tiebreak, out="_rn")
    B = max(int(rows_per_bucket), int(w))  # a longer window gets longer blocks
    own = F.floor((F.col("_rn") - 1) / F.lit(B)).cast("long")
    h = (n.withColumn("_own", own)
         .withColumn("_blk", F.explode(F.sequence(F.col("_own"), F.floor((F.col("_rn") - 1 + w) / F.lit(B)).cast("long"))))
         .withColumn("_k", (F.col("_blk") > F.col("_own")).cast("int")))
    frame = Window.partitionBy(*keys, "_blk").orderBy("_rn").rowsBetween(-w, 0 if include_current else -1)
    for name, agg in aggs.items():
        h = h.withColumn(name, agg.over(frame))
    return h.where(F.col("_k") == 0).drop("_own", "_k", "_blk")


def spike_windows(tel: DataFrame, col: str, width: int = 5, k: float = 2.0, device: str = "device",
                  time: str = "time", tiebreak: list[str] | None = None) -> DataFrame:
    """Rolling mean/std of the ``width`` previous readings; spike when the
    reading exceeds mean + k*std.  Episodes of spikes via W2."""
    r = rows_agg(tel, [device], time, tiebreak or [], width,
                 {"roll_mean": F.avg(F.col(col)), "roll_std": F.stddev_samp(F.col(col))})
    spike = F.coalesce((F.col(col) > F.col("roll_mean") + F.lit(k) * F.col("roll_std")).cast("int"), F.lit(0))
    return r.withColumn("is_spike", spike)


def yearly_residual(tel: DataFrame, col: str, time: str = "time", keys: list[str] | None = None) -> DataFrame:
    """W5 with the season: baseline = mean by (day of year, hour); residual per
    row.  The baseline has at most 8,784 rows per key set."""
    keys = keys or []
    t = tel.withColumn("_doy", F.dayofyear(time)).withColumn("_hr", F.hour(time))
    base = t.groupBy(*keys, "_doy", "_hr").agg(F.avg(F.col(col)).alias("baseline"))
    j = null_safe_join(t, F.broadcast(base) if not keys else base, [*keys, "_doy", "_hr"])
    return j.withColumn("residual", F.col(col) - F.col("baseline")).drop("_doy", "_hr")


def resample(tel: DataFrame, step: str, time: str, group: list[str], y: list[str]) -> DataFrame:
    """Mean of the signals per (time bucket, group)."""
    return (tel.groupBy(F.window(time, step).start.alias("window_start"), *group)
            .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in y]))


def time_spine_gaps(tel: DataFrame, device: str = "device", time: str = "time") -> DataFrame:
    """Full daily spine per device between its first and last day, minus
    the days that have data (anti join) = missing days."""
    days = tel.select(device, F.col(time).cast("date").alias("day")).distinct()
    spine = (days.groupBy(device).agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
             .select(device, F.explode(F.sequence("_a", "_b")).alias("day")))
    return null_safe_join(spine, days, [device, "day"], "left_anti")


def spine_gaps(tel: DataFrame, step_seconds: int, start: str, end: str, device: str = "device", time: str = "time") -> DataFrame:
    """L13 for any step: every step of [start, end) that a device has no reading
    in.  Each device gets its steps of each day from a row per (device, day), so
    the spine is made in parallel."""
    us = step_seconds * 1_000_000
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    a, b = (F.expr(f"timestampdiff(MICROSECOND, {epoch}, TIMESTAMP_NTZ'{x}')") for x in (start, end))
    step = F.floor((F.timestamp_diff("MICROSECOND", F.expr(epoch), F.col(time)) - a) / F.lit(us)).cast("long")
    have = tel.select(device, step.alias("_step")).where((F.col("_step") >= 0) & (F.col("_step") < F.ceil((b - a) / F.lit(us)))).distinct()
    last = (F.ceil((b - a) / F.lit(us)) - 1).cast("long")
    per_chunk = 10_000
    chunks = tel.select(device).distinct().withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / per_chunk).cast("long"))))
    spine = chunks.withColumn("_step", F.explode(F.sequence(F.col("_c") * per_chunk, F.least((F.col("_c") + 1) * per_chunk - 1, last)))).drop("_c")
    gone = spine.join(have.withColumnRenamed(device, "_d").withColumnRenamed("_step", "_s"),
                      F.col(device).eqNullSafe(F.col("_d")) & (F.col("_step") == F.col("_s")), "left_anti")
    return gone.select(device, F.timestamp_add("MICROSECOND", F.col("_step") * us, F.expr(f"TIMESTAMP_NTZ'{start}'")).alias(time))
