"""Keyed sampling and resampling of existing tables.

All randomness is a function of (seed, stream, row key) - see
:mod:`gridlens.functions.draws` - so results do not depend on partitioning,
executor count or task retries, and re-running a job gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.draws import keyed_uniform
from gridlens.operators.windows import null_safe_join, positions_by_uniform, prefix_sum, top_k_per


def choice(u, items: list[tuple[str, float]]):
    """Weighted choice column from a uniform (CASE over cumulative weights)."""
    tot = sum(w for _, w in items)
    acc, expr = 0.0, None
    for name, w in items[:-1]:
        acc += w / tot
        expr = F.when(u < F.lit(acc), F.lit(name)) if expr is None else expr.when(u < F.lit(acc), F.lit(name))
    last = F.lit(items[-1][0])
    return last if expr is None else expr.otherwise(last)


def sample_weighted(df: DataFrame, key: str, weight: str, n: int, seed: int, bucket_width: float,
                    rows_per_cell: int = 256) -> DataFrame:
    """N draws with replacement, P(row) proportional to ``weight``.

    Cumulative weights come from a bucketed prefix sum; draw i lands at
    u_i * total and finds its row through an equi-join on a grid cell of
    [0, total) (each row's interval is exploded to the cells it covers, so
    at most rows + cells entries) plus the [lo, hi) range as residual.
    """
    spark = df.sparkSession
    c = prefix_sum(df.select(key, F.col(weight).alias("_w")).where(F.col("_w") > 0), key, "_w", bucket_width)
    total, rows = c.agg(F.sum("_w"), F.count(F.lit(1))).first()
    if not total:
        return spark.createDataFrame([], f"draw long, {key} long")
    n_cells = max(4096, rows // rows_per_cell)  # a draw meets about rows_per_cell rows, whatever the table
    cw = float(total) / n_cells
    cells = c.withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("cum_lo") / F.lit(cw)).cast("long"),
        F.least(F.floor(F.col("cum_hi") / F.lit(cw)).cast("long"), F.lit(n_cells - 1)))))
    draws = (spark.range(n).withColumnRenamed("id", "draw")
             .withColumn("_x", keyed_uniform(seed, "weighted", "draw") * F.lit(float(total)))
             .withColumn("_cell", F.floor(F.col("_x") / F.lit(cw)).cast("long")))
    j = draws.join(cells, (draws["_cell"] == cells["_cell"]) & (F.col("_x") >= F.col("cum_lo")) &
                   (F.col("_x") < F.col("cum_hi")))
    return j.select("draw", key)


def choose_k(df: DataFrame, keys: list[str], item: str, k: int, seed: int) -> DataFrame:
    """K items per key without replacement (smallest keyed draws)."""
    u = keyed_uniform(seed, "choose", *keys, item)
    return top_k_per(df.withColumn("_u", u), keys, [F.col("_u"), F.col(item)], k, salt_col=item).drop("_u")


def split_by_share(df: DataFrame, strata: list[str], key: str, shares: list[tuple[str, float]], seed: int) -> DataFrame:
    """Exact-proportion split inside each stratum: rows ranked by a keyed
    draw, cut at floor(n * cumulative share)."""
    u = df.withColumn("_u", keyed_uniform(seed, "split", key))
    pos = positions_by_uniform(u, "_u", [key], keys=strata, out="_pos")
    n = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    j = null_safe_join(pos, n, strata)  # a null stratum is a stratum
    acc, expr = 0.0, None
    for name, s in shares[:-1]:
        acc += s
        cut = F.floor(F.col("_n") * F.lit(acc))
        expr = F.when(F.col("_pos") <= cut, name) if expr is None else expr.when(F.col("_pos") <= cut, name)
    lab = F.lit(shares[-1][0]) if expr is None else expr.otherwise(shares[-1][0])
    return j.withColumn("split", lab).drop("_u", "_pos", "_n")


def rebalance(df: DataFrame, label: str, key: str, rate: float, seed: int) -> DataFrame:
    """Keep all positives and the negatives with the smallest keyed draws,
    so that positives make ``rate`` of the result (round half up)."""
    n_pos = df.where(F.col(label) == 1).count()
    keep = int((n_pos * (1 - rate) / rate) + 0.5)
    neg = df.where(F.col(label) != 1).withColumn("_u", keyed_uniform(seed, "rebalance", key))
    negk = positions_by_uniform(neg, "_u", [key], out="_pos").where(F.col("_pos") <= keep).drop("_u", "_pos")
    return df.where(F.col(label) == 1).unionByName(negk)


# Namespace for deterministic row ids (the RFC 4122 URL namespace).
UUID_NS_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def row_uuid(name) -> F.Column:
    """RFC 4122 version-5 uuid of ``name`` in the URL namespace, built
    from sha1 and hex digits (no UDF)."""
    h = F.sha1(F.concat(F.unhex(F.lit(UUID_NS_HEX)), name.cast("binary")))
    var = F.element_at(F.array(*[F.lit(c) for c in "89ab"]),
                       (F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3) + 1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-"), var, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def merchant_id(country, category, n) -> F.Column:
    """Composite id like 'CC_CATEGORY_007'."""
    return F.concat_ws("_", F.upper(country), F.upper(F.regexp_replace(category, " ", "_")),
                       F.lpad(n.cast("string"), 3, "0"))
