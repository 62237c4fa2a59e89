"""Thermal checks and drift of devices (D5, D15) as functions on a telemetry table.

The columns of the table are bound by name; what a healthy device would show
comes back as column expressions, so any residual, rate or profile can be
taken from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.operators.windows import auto_bucket_seconds, null_safe_join, one_sort_per_key

# Fixed values that must equal the reference, per part of a wind turbine:
# degrees above ambient, per kW, per rpm of the rotor, per rpm of the
# generator, per degree ** 1.7 of yaw error.
WIND_PARTS = {
    "gearbox_oil_temp": (17.0, 0.010, 0.10, 0.0, 0.0),
    "generator_temp": (20.0, 0.014, 0.0, 0.0008, 0.0),
    "bearing_temp": (12.0, 0.007, 0.06, 0.0, 0.015),
    "converter_temp": (14.0, 0.011, 0.0, 0.0, 0.0),
}
# Fixed values that must equal the reference: pump bearing, degrees above
# ambient, per kW of shaft power, per (distance from best point) ** 1.6.
PUMP_BEARING = (16.0, 0.55, 5.0)


def wind_thermal_expected(ambient: str, power: str, rotor: str, generator: str, yaw_error: str, bias: str | None = None) -> dict[str, Column]:
    """Expected temperature of gearbox, generator, bearing and converter."""
    extra = F.col(bias) if bias else F.lit(0.0)
    return {part: F.col(ambient) + above + kw * F.col(power) + rpm * F.col(rotor) + gen * F.col(generator)
            + yaw * F.pow(F.abs(F.col(yaw_error)), F.lit(1.7)) + extra
            for part, (above, kw, rpm, gen, yaw) in WIND_PARTS.items()}


def pump_bearing_expected(ambient: str, shaft_power: str, flow_ratio: str, bias: str | None = None) -> Column:
    """Expected bearing temperature of a pump at ``flow_ratio`` of its best-efficiency flow."""
    above, kw, off = PUMP_BEARING
    extra = F.col(bias) if bias else F.lit(0.0)
    return F.col(ambient) + above + kw * F.col(shaft_power) + off * F.pow(F.abs(F.col(flow_ratio) - 1.0), F.lit(1.6)) + extra


def residual_report(tel: DataFrame, expected: dict[str, Column], keys: list[str], limit: float = 10.0) -> DataFrame:
    """Per key and measured column of ``expected``: rows, mean and greatest residual, share above ``limit`` degrees."""
    named = [(c, F.col(c) - e) for c, e in expected.items()]
    aggs = []
    for c, r in named:
        aggs += [F.count(r).alias(f"{c}__n"), F.avg(r).alias(f"{c}__mean"), F.max(r).alias(f"{c}__max"),
                 F.avg(F.when(r.isNotNull(), (r > limit).cast("int"))).alias(f"{c}__over")]
    wide = tel.groupBy(*keys).agg(*aggs)
    parts = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__max`, `{c}__over`" for c, _ in named)
    return wide.select(*keys, F.expr(f"stack({len(named)}, {parts}) AS (part, n, mean_residual, max_residual, share_over)"))


def cusum(df: DataFrame, keys: list[str], time: str, value: str, tiebreak: list[str] | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """One-sided cumulative sum of ``value`` per key: columns ``cusum`` and ``since``.

    The sum never falls below zero: it is the running total less the lowest
    total before it, and ``since`` is the time of the first row after that
    lowest point.  Both are associative: a time bucket is summed up by its
    total and its lowest running total, so where a key is full its rows are
    scanned bucket by bucket and the buckets by those summaries.
    """
    tiebreak = tiebreak or []
    v = F.coalesce(F.col(value), F.lit(0))
    dense = bucket_seconds is not None or not one_sort_per_key(df, keys)
    if dense:
        bucket_seconds = bucket_seconds or auto_bucket_seconds(df, keys, time)
        b = df.withColumn("_b", F.floor(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time}`)") / F.lit(int(bucket_seconds) * 1_000_000)).cast("long"))
    else:
        b = df.withColumn("_b", F.lit(0).cast("long"))
    w = Window.partitionBy(*keys, "_b").orderBy(time, *tiebreak)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_p", F.sum(v).over(upto)).withColumn("_q", F.coalesce(F.sum(v).over(before), F.lit(0)))
    # a row's starting point is the total before it, and its own time
    b = b.withColumn("_low", F.min(F.struct(F.col("_q").alias("q"), F.col(time).alias("t"))).over(upto))
    if dense:
        sums = b.groupBy(*keys, "_b").agg(F.sum(v).alias("_s"), F.min(F.struct(F.col("_q").alias("q"), F.col(time).alias("t"))).alias("_l"))
        wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row per key and bucket
        sums = sums.withColumn("_off", F.coalesce(F.sum("_s").over(wk), F.lit(0)))
        sums = sums.withColumn("_before", F.min(F.struct((F.col("_off") + F.col("_l.q")).alias("q"), F.col("_l.t").alias("t"))).over(wk)).drop("_s", "_l")
        b = null_safe_join(b, sums, [*keys, "_b"])
        own = F.struct((F.col("_off") + F.col("_low.q")).alias("q"), F.col("_low.t").alias("t"))
        b = b.withColumn("_low", F.least(own, F.coalesce("_before", own))).withColumn("_p", F.col("_off") + F.col("_p")).drop("_off", "_before")
    return b.withColumn("cusum", F.greatest(F.col("_p") - F.col("_low.q"), F.lit(0))).withColumn("since", F.col("_low.t")).drop("_b", "_p", "_q", "_low")


def fleet_drift(df: DataFrame, keys: list[str], time: str, excess: str, threshold: float, tiebreak: list[str] | None = None,
                bucket_seconds: int | None = None) -> DataFrame:
    """D5 over time: per key the first time its cumulative excess over the fleet passes ``threshold``, and since when it drifts."""
    c = cusum(df, keys, time, excess, tiebreak, bucket_seconds).where(F.col("cusum") > threshold)
    first = F.min(F.struct(F.col(time), *[F.col(t) for t in tiebreak or []], F.col("since"), F.col("cusum")))
    return c.groupBy(*keys).agg(first.alias("_f")).select(*keys, F.col(f"_f.{time}").alias("alarm_time"), F.col("_f.since").alias("drift_start"),
                                                         F.col("_f.cusum").alias("cusum"))
