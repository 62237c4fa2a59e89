"""Transaction anomaly and fraud detectors.

The reference generates these patterns; here they are detectors over an
existing transaction table.  Per-customer ordered work uses the skew-safe
helpers (time-bucketed windows + summary repair); thresholds are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.operators.windows import null_safe_join, prev_row, range_count, range_count_by_rank, sessionize


def velocity(tx: DataFrame, keys: list[str], ts: str, n: int = 10, secs: float = 300,
             bucket_seconds: int | None = None, by_rank: bool = False) -> DataFrame:
    """A1: rows with >= n transactions of the same keys in [ts - secs, ts].
    The range window runs per (keys, time bucket) with a halo of the buckets
    before; a merchant too dense for that, or ``by_rank``, is counted by the
    difference of two global ranks, which splits any key."""
    if by_rank:
        r = range_count_by_rank(tx, keys, ts, secs, out="n_in_window")
    else:
        r = range_count(tx, keys, ts, secs, out="n_in_window", bucket_seconds=bucket_seconds)
    return r.where(F.col("n_in_window") >= n)


def ping(tx: DataFrame, keys: list[str], ts: str, amount: str, max_amount: float = 2.0,
         gap_seconds: float = 720, min_n: int = 3, max_n: int = 5, late_hour: int = 5,
         tiebreak: list[str] | None = None, channel: str | None = None, channels: list[str] | None = None) -> DataFrame:
    """A2: bursts of min_n..max_n tiny payments (amount < max_amount) with
    gaps <= gap_seconds per keys (customer and merchant); flags bursts that
    start before ``late_hour``.  With ``channel`` only payments of the listed
    channels (online card) count."""
    tiny = tx.where(F.col(amount) < max_amount)
    if channel:
        tiny = tiny.where(F.col(channel).isin(*(channels or [])))
    s = sessionize(tiny, keys, ts, gap_seconds, tiebreak)
    g = s.groupBy(*keys, "session_start").agg(F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n"),
                                              F.sum(amount).alias("total_amount"))
    return (g.where(F.col("n").between(min_n, max_n))
            .withColumn("late_night", (F.hour("session_start") < late_hour).cast("int")))


def high_value(tx: DataFrame, amount: str, category: str, risky: list[str], q: float = 0.99,
               normal: F.Column | None = None) -> DataFrame:
    """A3: amount above the q-quantile of normal rows at a high-risk category.
    The threshold is one scalar aggregate."""
    from gridlens.operators.quantiles import exact_quantiles
    base = tx.where(normal) if normal is not None else tx
    got = exact_quantiles(base, amount, [q]).first()
    thr = F.lit(got["value"] if got else None).cast("double")  # no normal row, no threshold, no row
    return tx.where((F.col(amount) > thr) & F.col(category).isin(risky)).withColumn("threshold", thr)


def amount_residual(tx: DataFrame, amount: str, spend: str, mult: str, sigma: float = 0.75,
                    base: float = 28.0) -> DataFrame:
    """A4: z = (ln amount - ln(base * spend * multiplier)) / sigma."""
    z = (F.log(F.col(amount)) - F.log(F.lit(base) * F.col(spend) * F.col(mult))) / F.lit(sigma)
    return tx.withColumn("amount_z", z)


def distance_score(tx: DataFrame, distance: str, radius: str, channel: str, online: list[str],
                   k: float = 3.0, cross_border: str | None = None) -> DataFrame:
    """A5: distance / usual radius; online channels are not scored, unless the
    row is cross-border (``cross_border``, boolean), which overrides the channel."""
    ratio = F.try_divide(F.col(distance), F.col(radius))
    abroad = F.coalesce(F.col(cross_border), F.lit(False)) if cross_border else F.lit(False)
    flag = F.when(F.col(channel).isin(online) & ~abroad, 0).when(ratio > k, 1).otherwise(0)
    return tx.withColumn("distance_ratio", ratio).withColumn("distance_flag", flag)


def device_switch(tx: DataFrame, key: str, ts: str, device: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Share of transactions on another device than the previous one."""
    p = prev_row(tx.select(key, ts, device, *(tiebreak or [])), [key], ts, [device], tiebreak)
    sw = (F.col("prev_" + device).isNotNull() & (F.col(device) != F.col("prev_" + device))).cast("int")
    return p.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(sw).cast("long").alias("n_switch")).withColumn(
        "switch_rate", F.col("n_switch") / F.col("n"))


def off_primary_device(tx: DataFrame, key: str, device: str, label: str) -> DataFrame:
    """Per class of ``label``, the share of transactions that are not on the
    customer's primary device (the most frequent, ties to the smaller name)."""
    used = tx.where(F.col(device).isNotNull()).groupBy(key, device).agg(F.count(F.lit(1)).alias("_n"))
    primary = used.groupBy(key).agg(F.min_by(device, F.struct(-F.col("_n"), F.col(device))).alias("primary_device"))
    j = null_safe_join(tx.select(key, device, label), primary, [key], "left")
    off = (F.col(device) != F.col("primary_device")).cast("int")
    return j.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(off).cast("long").alias("n_off")).withColumn(
        "off_rate", F.col("n_off") / F.col("n"))


def new_account(tx: DataFrame, age_col: str, max_days: int = 15) -> DataFrame:
    """Transactions of accounts younger than ``max_days``."""
    return tx.where(F.col(age_col) < max_days)


def late_night(tx: DataFrame, key: str, ts: str, hour: int = 5) -> DataFrame:
    """Late-night (hour < 5) share per key."""
    late = (F.hour(ts) < hour).cast("int")
    return tx.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(late).cast("long").alias("n_late")).withColumn(
        "late_share", F.col("n_late") / F.col("n"))


def recurring(tx: DataFrame, keys: list[str], ts: str, amount: str, min_days: int = 27, max_days: int = 32,
              tol: float = 0.10, tiebreak: list[str] | None = None, min_charges: int = 2) -> DataFrame:
    """Links between consecutive charges of the same keys (customer and
    merchant) that are about a month apart with an amount within +-tol; per key
    with ``min_charges`` charges or more: links and chain rows."""
    p = prev_row(tx.select(*keys, ts, amount, *(tiebreak or [])), keys, ts, [amount], tiebreak)
    gap = F.datediff(F.col(ts).cast("date"), F.col("prev_" + ts).cast("date"))
    ok = (gap.between(min_days, max_days) &
          (F.abs(F.try_divide(F.col(amount), F.col("prev_" + amount)) - 1.0) <= tol))
    links = p.where(ok)
    got = links.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_links"), F.min(ts).alias("first_link_time"),
                                   F.max(ts).alias("last_link_time"))
    return got.where(F.col("n_links") >= min_charges - 1)


def volume_against(monthly: DataFrame, expected: DataFrame) -> DataFrame:
    """Monthly volumes (month, n) against a given table (month_of_year,
    expected_mean, expected_sd) of at most twelve rows: z-score per month."""
    j = monthly.join(F.broadcast(expected), F.month("month") == F.col("month_of_year"), "left")
    return j.select("month", "n", "expected_mean", "expected_sd",
                    F.try_divide(F.col("n") - F.col("expected_mean"), F.col("expected_sd")).alias("z"))


def mix_audit(df: DataFrame, col: str, weights: dict) -> DataFrame:
    """Observed category shares vs expected weights: chi-square of
    counts and population stability index; categories missing on either side
    count with zero (full outer join with the weights table)."""
    spark = df.sparkSession
    tot_w = sum(weights.values())
    wdf = spark.createDataFrame([(k, float(v) / tot_w) for k, v in weights.items()], "value string, expected_share double")
    obs = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    n = df.where(F.col(col).isNotNull()).count()
    j = obs.join(F.broadcast(wdf), "value", "full_outer").fillna({"n": 0, "expected_share": 0.0})
    o = F.col("n") / F.lit(float(max(n, 1)))
    e = F.col("expected_share")
    chi = F.when(e > 0, F.pow(F.col("n") - e * F.lit(float(n)), 2) / (e * F.lit(float(n))))
    psi = F.when((e > 0) & (o > 0), (o - e) * F.log(o / e))
    return j.agg(F.lit(n).cast("long").alias("n"), F.sum(chi).alias("chi2"), F.sum(psi).alias("psi"),
                 F.count_if(e == 0).alias("n_unexpected"), F.count_if(F.col("n") == 0).alias("n_missing"))


# Abramowitz & Stegun 7.1.26 rational approximation of erf (|error| < 1.5e-7):
# neither Spark nor DuckDB has erf, and the formula is the same text for both.
_ERF_P = 0.3275911
_ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf_sql(z: str) -> str:
    t = f"(1e0 / (1e0 + {_ERF_P!r} * abs({z})))"
    a1, a2, a3, a4, a5 = _ERF_A
    poly = f"({a1!r} * {t} + {a2!r} * pow({t}, 2) + {a3!r} * pow({t}, 3) + {a4!r} * pow({t}, 4) + {a5!r} * pow({t}, 5))"
    return f"(CASE WHEN ({z}) < 0 THEN -1e0 ELSE 1e0 END * (1e0 - {poly} * exp(-(({z}) * ({z})))))"


def cdf_sql(dist: str, x: str, mean: str, mu: str = "0e0", sigma: str = "1e0") -> str:
    """Model CDF at ``x`` as SQL text; parameters by the method of moments
    (exponential/gamma(2)/geometric from the mean, log-normal from the mean
    and standard deviation of ln x)."""
    if dist == "exponential":
        return f"(1e0 - exp(-({x}) / ({mean})))"
    if dist == "gamma2":
        th = f"(({mean}) / 2e0)"
        return f"(1e0 - exp(-({x}) / {th}) * (1e0 + ({x}) / {th}))"
    if dist == "geometric":
        return f"(1e0 - pow(1e0 - 1e0 / ({mean}), floor({x})))"
    if dist == "lognormal":
        z = f"((ln({x}) - ({mu})) / ({sigma}) / sqrt(2e0))"
        return f"(5e-1 * (1e0 + {erf_sql(z)}))"
    raise ValueError(f"unknown distribution {dist}")


def dist_audit(df: DataFrame, col: str, dist: str = "exponential", bins: int = 1000) -> DataFrame:
    """Fit of a reference distribution and KS distance on a binned CDF.

    Values are counted in ``bins`` equal bins over [0, max] (negative ones in
    the first); an empty column gives one row with n = 0.  The empirical CDF at
    each bin edge (prefix sum over the small bin table) is compared
    with the model CDF.  No window over the rows themselves.
    """
    x = F.col(col).cast("double")
    d = df.where(x.isNotNull())
    st = d.agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
               F.max(x).alias("mx"), F.avg(F.log(F.when(x > 0, x))).alias("mu"),
               F.stddev_samp(F.log(F.when(x > 0, x))).alias("sigma")).first()
    n, mean, std, mx = st["n"], st["mean"], st["std"], st["mx"]
    if not n:
        none = F.lit(None).cast("double")
        return df.sparkSession.range(1).select(F.lit(dist).alias("dist"), F.lit(0).cast("long").alias("n"), none.alias("mean"),
                                               none.alias("std"), none.alias("cv"), none.alias("ks"))
    mu, sigma = st["mu"] or 0.0, st["sigma"] or 1.0
    w = mx / bins if mx and mx > 0 else 1.0
    b = F.greatest(F.least(F.floor(x / F.lit(w)), F.lit(bins - 1)), F.lit(0)).cast("long")
    counts = d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    from pyspark.sql import Window
    cum = counts.withColumn("cum", F.sum("c").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    edge = f"((bin + 1) * {w!r})"
    # a mean below zero fits none of the models; their formulas then leave [0, 1]
    model = F.least(F.greatest(F.expr(cdf_sql(dist, edge, repr(float(mean)), repr(float(mu)), repr(float(sigma)))), F.lit(0.0)), F.lit(1.0))
    ks = cum.agg(F.max(F.abs(F.col("cum") / F.lit(float(n)) - model)).alias("ks"))
    return ks.select(F.lit(dist).alias("dist"), F.lit(n).cast("long").alias("n"), F.lit(mean).alias("mean"),
                     F.lit(std).alias("std"), (F.lit(std) / F.lit(mean)).alias("cv"), "ks")


def detector_report(pred: DataFrame, truth: DataFrame, key: str, pred_col: str, truth_col: str,
                    by: list[str] | None = None) -> DataFrame:
    """Confusion counts, precision, recall, F1 per group.

    ``pred`` may hold the flagged rows only: a true row without a prediction
    counts as predicted 0.  Predictions without a true row are counted apart
    (``n_no_truth``).  ``by`` are columns of ``truth`` if it has them, else of
    ``pred`` (null for rows without a prediction).
    """
    by = by or []
    side = lambda df: [c for c in by if (c in truth.columns) == (df is truth)]
    p = pred.select(F.col(key).alias("_k"), *side(pred), F.col(pred_col).cast("int").alias("_p"))
    j = p.join(truth.select(key, *side(truth), F.col(truth_col).cast("int").alias("_t")), F.col("_k") == F.col(key), "full_outer")
    flag, true = F.coalesce("_p", F.lit(0)) == 1, F.col("_t") == 1
    g = j.groupBy(*by).agg(F.count_if(flag & true).alias("tp"), F.count_if(flag & (F.col("_t") == 0)).alias("fp"),
                           F.count_if(~flag & true).alias("fn"), F.count_if(~flag & (F.col("_t") == 0)).alias("tn"),
                           F.count_if(F.col("_t").isNull()).alias("n_no_truth"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return g.withColumn("precision", prec).withColumn("recall", rec).withColumn("f1", f1)


def velocity_bursts(tx: DataFrame, keys: list[str], ts: str, n: int = 10, secs: float = 300,
                    tiebreak: list[str] | None = None) -> DataFrame:
    """A1 report: flagged rows grouped into bursts - flagged rows of the same
    keys less than ``secs`` apart belong to one burst (skew-safe sessions).
    The flagged rows are written once, as the sessions read them several times."""
    from gridlens.session import materialised
    flagged = materialised(velocity(tx, keys, ts, n, secs), "velocity")
    s = sessionize(flagged, keys, ts, secs, tiebreak)
    return s.groupBy(*keys, F.col("session_start").alias("burst_start")).agg(
        F.max(ts).alias("burst_end"), F.count(F.lit(1)).alias("n_flagged"), F.max("n_in_window").alias("peak"))
