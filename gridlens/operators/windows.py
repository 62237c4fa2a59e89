"""Skew-safe building blocks for per-key ordered windows.

A plain ``Window.partitionBy(device).orderBy(time)`` sorts all rows of a
device in one task: if one device holds a third of the table, that task
holds a third of the table.  These helpers partition the window by
(key, time bucket) instead, and repair what crosses bucket borders with
small per-bucket summary tables (one row per key and bucket):

* :func:`global_row_number` - row number per key = bucket offset (prefix sum
  of bucket counts) + row number inside the bucket.
* :func:`prev_row` - previous row per key (``lag``), the first row of a
  bucket takes the last row of the nearest earlier non-empty bucket.
* :func:`range_count` / :func:`range_agg` - aggregates over a trailing time
  range; rows are copied into every later bucket their range reaches ("halo"),
  so the frame is complete for any span and bucket width.
* :func:`range_count_by_rank` - a trailing count as the difference of two
  ranks in one global order: no frame, no halo, and a key whose rows all lie
  within one span still splits.
* :func:`top_k_per` - two-phase top-k per key with salted first phase.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.exprs import epoch_s

DAY = 86400


# Target rows per (key, time bucket) window partition when widths are chosen
# from the data (bucket_seconds=None).
TARGET_BUCKET_ROWS = 2_000_000

# Most rows of a (key, time bucket) whose trailing ranges go through a sliding
# frame, which adds up its rows anew for every row: rows times frame.
FRAME_ROWS = 1_000


def _bucket(ts: str, seconds: int):
    return F.floor(epoch_s(F.col(ts)) / F.lit(float(seconds))).cast("long")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null, with one copy of the key columns (any ``how`` that keeps the left side's)."""
    side = right.select(*[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        eq = left[k].eqNullSafe(side[f"_j_{k}"])
        cond = eq if cond is None else cond & eq
    return left.join(side, cond, how).drop(*[f"_j_{k}" for k in keys])


def auto_bucket_seconds(df: DataFrame, keys: list[str], ts: str, min_seconds: float = 1.0,
                        target_rows: int | None = None, start: int = DAY) -> int:
    """Bucket width (seconds) so that no (key, bucket) holds more than about
    ``target_rows`` rows: one map-side-combined count per (key, day) gives the
    fullest day, then the width is halved as often as needed (never below
    ``min_seconds``, e.g. the span of a range frame).  Rows sharing one
    timestamp cannot be split further."""
    from gridlens.session import setting
    target_rows = target_rows or setting(df.sparkSession, "bucketTargetRows", TARGET_BUCKET_ROWS)
    mx = (df.groupBy(*keys, _bucket(ts, start).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
          .agg(F.max("_n")).first()[0]) or 0
    width = start
    while mx > target_rows and width / 2 >= max(min_seconds, 1):
        width //= 2
        mx = (mx + 1) // 2
    return int(width)


def one_sort_per_key(df: DataFrame, keys: list[str]) -> bool:
    """Whether the fullest key is small enough for a plain window over the key
    (one map-side-combined count per key)."""
    from gridlens.session import setting
    target = setting(df.sparkSession, "bucketTargetRows", TARGET_BUCKET_ROWS)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (n or 0) <= target


def global_row_number(df: DataFrame, keys: list[str], order: str, tiebreak: list[str] | None = None,
                      bucket_seconds: int | None = None, out: str = "rn") -> DataFrame:
    """Row number per key: one sort per key where every key is small, else by time buckets."""
    tiebreak = tiebreak or []
    if bucket_seconds is None and one_sort_per_key(df, keys):
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order, *tiebreak)).cast("long"))
    bucket_seconds = bucket_seconds or auto_bucket_seconds(df, keys, order)
    b = df.withColumn("_b", _bucket(order, bucket_seconds))
    w = Window.partitionBy(*keys, "_b").orderBy(order, *tiebreak)
    b = b.withColumn("_lrn", F.row_number().over(w))
    counts = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wk), F.lit(0))).drop("_n")
    return (null_safe_join(b, offs, [*keys, "_b"]).withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_b", "_lrn", "_off"))


def prev_row(df: DataFrame, keys: list[str], order: str, cols: list[str], tiebreak: list[str] | None = None,
             bucket_seconds: int | None = None, prefix: str = "prev_") -> DataFrame:
    """Adds ``prev_<c>`` for c in [order] + cols: the previous row of the same key
    (one sort per key where every key is small, else by time buckets)."""
    tiebreak = tiebreak or []
    if bucket_seconds is None and one_sort_per_key(df, keys):
        w = Window.partitionBy(*keys).orderBy(order, *tiebreak)
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in [order, *(c for c in cols if c != order)]})
    bucket_seconds = bucket_seconds or auto_bucket_seconds(df, keys, order)
    carry = [order] + [c for c in cols if c != order]
    b = df.withColumn("_b", _bucket(order, bucket_seconds))
    w = Window.partitionBy(*keys, "_b").orderBy(order, *tiebreak)
    for c in carry:
        b = b.withColumn(prefix + c, F.lag(c).over(w))
    b = b.withColumn("_first", F.row_number().over(w) == 1)
    last = (b.groupBy(*keys, "_b")
            .agg(F.max_by(F.struct(*[F.col(c).alias(c) for c in carry]),
                          F.struct(F.col(order), *[F.col(t) for t in tiebreak])).alias("_last")))
    wk = Window.partitionBy(*keys).orderBy("_b")
    prevb = last.withColumn("_pl", F.lag("_last").over(wk)).select(*keys, "_b", "_pl")
    j = null_safe_join(b, prevb, [*keys, "_b"], "left")
    for c in carry:
        j = j.withColumn(prefix + c, F.when(F.col("_first"), F.col(f"_pl.{c}")).otherwise(F.col(prefix + c)))
    return j.drop("_b", "_first", "_pl")


def with_halo(df: DataFrame, ts: str, span_seconds: float, bucket_seconds: int = DAY) -> DataFrame:
    """Each row in its own bucket (``_halo`` false), and a copy in every later
    bucket that begins within ``span_seconds`` of it."""
    # exact integer microseconds, so range frames have integral bounds
    e = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    bus = F.lit(int(bucket_seconds) * 1_000_000)
    span = F.lit(int(round(span_seconds * 1_000_000)))
    return (df.withColumn("_e", e).withColumn("_own", F.floor(e / bus).cast("long"))
            # a row without a time is in no range, but stays
            .withColumn("_b", F.explode_outer(F.sequence("_own", F.floor((F.col("_e") + span) / bus).cast("long"))))
            .withColumn("_halo", F.coalesce(F.col("_b") > F.col("_own"), F.lit(False))).drop("_own"))


def range_agg(df: DataFrame, keys: list[str], ts: str, span_seconds: float, aggs: dict,
              bucket_seconds: int | None = None) -> DataFrame:
    """Trailing-range aggregates over [ts - span, ts] per key.

    ``aggs`` maps output name -> aggregate Column (e.g. F.count(F.lit(1))).
    A dense key gets buckets narrower than the span, down to an eighth of it
    (then a row is copied into up to nine buckets).
    """
    if bucket_seconds is None:
        bucket_seconds = auto_bucket_seconds(df, keys, ts, min_seconds=span_seconds / 8,
                                             start=max(DAY, int(math.ceil(span_seconds))))
    h = with_halo(df, ts, span_seconds, bucket_seconds)
    w = Window.partitionBy(*keys, "_b").orderBy("_e").rangeBetween(-int(round(span_seconds * 1_000_000)), 0)
    for name, agg in aggs.items():
        h = h.withColumn(name, agg.over(w))
    return h.where(~F.col("_halo")).drop("_b", "_halo", "_e")


def range_count(df: DataFrame, keys: list[str], ts: str, span_seconds: float, out: str = "n_in_range",
                bucket_seconds: int | None = None) -> DataFrame:
    """Rows of the same keys in [ts - span, ts].  Where a (key, day) - or span, if that is
    longer - holds more than ``FRAME_ROWS`` rows, ranks are subtracted instead
    (:func:`range_count_by_rank`), whose work does not grow with the rows of a span."""
    if bucket_seconds is None:
        from gridlens.session import setting
        bucket_seconds = max(DAY, int(math.ceil(span_seconds)))
        most = min(FRAME_ROWS, setting(df.sparkSession, "bucketTargetRows", TARGET_BUCKET_ROWS))
        if auto_bucket_seconds(df, keys, ts, target_rows=most, start=bucket_seconds) < bucket_seconds:
            return range_count_by_rank(df, keys, ts, span_seconds, out)
    return range_agg(df, keys, ts, span_seconds, {out: F.count(F.lit(1))}, bucket_seconds)


def _micros(ts: str):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")


def rank_entries(df: DataFrame, keys: list[str], ts: str, span_seconds: float, n_parts: int | None = None) -> DataFrame:
    """The merged order behind :func:`range_count_by_rank`: per distinct (keys, time)
    one entry where its rows stand (``_add`` of them) and one where its range
    begins (``_add`` 0), dealt by ranges of the whole order into parts ``_p``.

    Rows of one instant are counted before anything is ordered, so an entry
    stands for any number of them, and ranges are cut on (keys, time, kind):
    no key and no instant can fill a part.  The checkpoint fixes the parts.
    """
    from gridlens.session import checkpoint_dir, default_parallelism
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = n_parts or max(8, 4 * default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    span = int(round(span_seconds * 1_000_000))
    at = df.groupBy(*keys, _micros(ts).alias("_e")).agg(F.count(F.lit(1)).alias("_n"))
    kinds = F.array(F.struct((F.col("_e") - span).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("add")),
                    F.struct(F.col("_e").alias("at"), F.lit(1).alias("kind"), F.col("_n").alias("add")))
    entries = at.select(*keys, "_e", F.explode(kinds).alias("_k")).select(
        *keys, "_e", F.col("_k.at").alias("_at"), F.col("_k.kind").alias("_kind"), F.col("_k.add").alias("_add"))
    dealt = entries.repartitionByRange(n_parts, *keys, "_at", "_kind")
    return dealt.withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)


def range_count_by_rank(df: DataFrame, keys: list[str], ts: str, span_seconds: float, out: str = "n_in_range",
                        n_parts: int | None = None) -> DataFrame:
    """Rows of the same keys in [ts - span, ts], as rank(ts) - rank(ts - span).

    Both ranks are running sums over one global order of :func:`rank_entries`
    (range beginnings before the rows of their instant), summed inside each
    part and shifted by the sums of the parts before it; what earlier keys
    add cancels out.  Rows without a time count those without one.
    """
    entries = rank_entries(df, keys, ts, span_seconds, n_parts)
    order = Window.partitionBy("_p").orderBy(*keys, "_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    inside = entries.withColumn("_in", F.sum("_add").over(order))
    sums = entries.groupBy("_p").agg(F.sum("_add").alias("_s"))  # one row a part
    before = F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = inside.join(F.broadcast(sums.select("_p", before.alias("_off"))), "_p")
    rank = F.col("_off") + F.col("_in")
    counted = ranked.groupBy(*keys, "_e").agg(F.sum(F.when(F.col("_kind") == 1, rank).otherwise(-rank)).alias(out))
    return null_safe_join(df.withColumn("_e", _micros(ts)), counted, [*keys, "_e"]).drop("_e")


def top_k_per(df: DataFrame, keys: list[str], order_cols: list, k: int, salt_buckets: int = 32,
              salt_col: str | None = None, out: str = "rank") -> DataFrame:
    """Top k rows per key by ``order_cols`` (Columns with direction, total order).

    Phase 1 keeps the top k inside (key, salt) — a hot key is split over
    ``salt_buckets`` tasks; phase 2 ranks the <= k*salt_buckets survivors.
    """
    salt = (F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salt_buckets)) if salt_col
            else F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets)))
    s = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order_cols)
    s = s.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order_cols)
    return s.withColumn(out, F.row_number().over(w2).cast("long")).where(F.col(out) <= k)


def positions_by_uniform(df: DataFrame, u: str, tiebreak: list[str], n_buckets: int | None = None,
                         out: str = "pos", keys: list[str] | None = None) -> DataFrame:
    """Global 1-based position in the order of a uniform [0,1) column ``u``.

    The uniform is cut into ``n_buckets`` equal ranges (equal expected size,
    so no skew); rows are numbered inside each range and shifted by the
    prefix sum of the range counts: a total order without a single-task sort.
    """
    keys = keys or []
    # equal-probability buckets: enough of them to keep every core busy
    from gridlens.session import default_parallelism
    n_buckets = n_buckets or max(64, 4 * default_parallelism(df.sparkSession))
    b = df.withColumn("_b", F.least(F.floor(F.col(u) * F.lit(float(n_buckets))), F.lit(n_buckets - 1)).cast("long"))
    w = Window.partitionBy(*keys, "_b").orderBy(u, *tiebreak)
    b = b.withColumn("_lrn", F.row_number().over(w))
    counts = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("_n")
    # ``offs`` has n_buckets rows per key: without keys it is size-bounded and broadcast.
    side = F.broadcast(offs) if not keys else offs
    return (null_safe_join(b, side, [*keys, "_b"]).withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_b", "_lrn", "_off"))


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_seconds: float, tiebreak: list[str] | None = None,
               bucket_seconds: int | None = None, out: str = "session_start") -> DataFrame:
    """Session (gap-based) start per row, skew-safe.

    A row opens a session when the previous row of its key is more than
    ``gap_seconds`` earlier.  The session start of a row is the latest
    opening at or before it: found inside its (key, bucket) window, or else
    carried over from earlier buckets through the per-bucket summary.
    """
    tiebreak = tiebreak or []
    opens = F.col("_p_" + ts).isNull() | ((epoch_s(F.col(ts)) - epoch_s(F.col("_p_" + ts))) > F.lit(float(gap_seconds)))
    if bucket_seconds is None and one_sort_per_key(df, keys):
        w = Window.partitionBy(*keys).orderBy(ts, *tiebreak)
        p = df.withColumn("_p_" + ts, F.lag(ts).over(w)).withColumn("_open", opens)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        return p.withColumn(out, F.max(F.when(F.col("_open"), F.col(ts))).over(upto)).drop("_p_" + ts, "_open")
    bucket_seconds = bucket_seconds or auto_bucket_seconds(df, keys, ts)
    p = prev_row(df, keys, ts, [], tiebreak, bucket_seconds, prefix="_p_")
    p = p.withColumn("_open", opens).withColumn("_b", _bucket(ts, bucket_seconds))
    w = Window.partitionBy(*keys, "_b").orderBy(ts, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_in", F.max(F.when(F.col("_open"), F.col(ts))).over(w))
    last = p.groupBy(*keys, "_b").agg(F.max(F.when(F.col("_open"), F.col(ts))).alias("_lb"))
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.withColumn("_carry", F.max("_lb").over(wk)).select(*keys, "_b", "_carry")
    j = null_safe_join(p, carry, [*keys, "_b"], "left")
    return (j.withColumn(out, F.coalesce(F.col("_in"), F.col("_carry")))
            .drop("_p_" + ts, "_open", "_b", "_in", "_carry"))


def prefix_sum(df: DataFrame, order: str, value: str, bucket_width: float, out: str = "cum",
               keys: list[str] | None = None, fan: int = 4096) -> DataFrame:
    """Running sum of ``value`` in ``order`` (a numeric key, unique per keys),
    exclusive (``out``_lo) and inclusive (``out``_hi).

    Rows are summed in buckets of the order key, buckets in groups of ``fan``,
    groups in groups again until one is left: no window holds more than
    ``fan`` sums, however many buckets there are."""
    keys = keys or []
    b = df.withColumn("_b", F.floor(F.col(order) / F.lit(float(bucket_width))).cast("long"))
    w = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_in", F.sum(value).over(w))
    sums = b.groupBy(*keys, "_b").agg(F.sum(value).alias("_s"))
    j = null_safe_join(b, _offsets(sums, keys, fan), [*keys, "_b"])
    return (j.withColumn(out + "_hi", F.col("_off") + F.col("_in"))
            .withColumn(out + "_lo", F.col(out + "_hi") - F.col(value)).drop("_b", "_in", "_off"))


def _offsets(sums: DataFrame, keys: list[str], fan: int) -> DataFrame:
    """(keys, _b, _off): sum of ``_s`` over the earlier ``_b`` of the same keys."""
    g = sums.withColumn("_g", F.floor(F.col("_b") / fan).cast("long"))
    ends = g.agg(F.min("_g"), F.max("_g")).first()
    before = Window.partitionBy(*keys, "_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    if ends[0] != ends[1]:
        up = g.groupBy(*keys, "_g").agg(F.sum("_s").alias("_s")).withColumnRenamed("_g", "_b")
        up = _offsets(up, keys, fan).select(*keys, F.col("_b").alias("_g"), F.col("_off").alias("_up"))
        g = null_safe_join(g, up, [*keys, "_g"]).withColumn("_off", F.col("_off") + F.col("_up"))
    return g.select(*keys, "_b", "_off")


def sequential_ids(df: DataFrame, order_cols: list[str], start: int = 1, out: str = "seq_id",
                   n_parts: int | None = None) -> DataFrame:
    """Consecutive ids in the total order ``order_cols`` (which must be unique).

    Rows are range-partitioned on the whole composite key (Spark samples
    it, so ties in the leading column still split evenly), sorted inside
    each partition and tagged with ``monotonically_increasing_id`` (partition
    index in the high bits, position in the low 33 bits).  An eager
    ``checkpoint`` into the shared checkpoint folder fixes the range
    boundaries, so ids and per-partition counts come from the same data; the
    offset of each partition is a prefix sum over <= n_parts rows.
    """
    from gridlens.session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    from gridlens.session import default_parallelism
    n_parts = n_parts or max(8, 4 * default_parallelism(spark))
    s = (df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    s = s.withColumn("_p", F.shiftright("_mid", 33)).withColumn("_i", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = s.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offs), "_p").withColumn(out, F.col("_off") + F.col("_i") + F.lit(start))
            .drop("_mid", "_p", "_i", "_off"))
