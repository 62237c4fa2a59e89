"""Domain scoring jobs: expected-vs-actual from physical relations.

A job joins parameters, derives expected values with column expressions
(:mod:`gridlens.functions.physics`) and aggregates residuals per group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.physics import for_oracle, for_spark


def with_exprs(df: DataFrame, exprs) -> DataFrame:
    """Add or replace columns from SQL expression text, in order (later ones
    may use earlier).  ``exprs``: dict or list of (name, sql) pairs."""
    for name, e in (exprs.items() if isinstance(exprs, dict) else exprs):
        df = df.withColumn(name, F.expr(for_spark(e)))
    return df


def curve_segments(spark: SparkSession, knots: list[tuple[float, float]]) -> DataFrame:
    """Knot table -> segments (x0, y0, x1, y1) with the ``cell`` ids each covers."""
    ks = sorted(knots)
    segs = [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(ks, ks[1:]) if b[0] > a[0]]
    cell = min(s[2] - s[0] for s in segs)
    rows = []
    for x0, y0, x1, y1 in segs:
        for c in range(int(math.floor(x0 / cell)), int(math.floor(x1 / cell)) + 1):
            rows.append((c, x0, y0, x1, y1))
    return spark.createDataFrame(rows, "cell long, x0 double, y0 double, x1 double, y1 double"), cell


def interp_curve(df: DataFrame, x: str, knots: list[tuple[float, float]], out: str) -> DataFrame:
    """Piecewise-linear curve lookup, clamped at both ends (``np.interp``).

    The segment table is bounded by the curve definition (not by the data),
    so it is broadcast; rows find their segment by an equi-join on a grid
    cell of the smallest knot spacing plus the [x0, x1) range as residual.
    """
    spark = df.sparkSession
    segs, cell = curve_segments(spark, knots)
    xmin, xmax = min(k[0] for k in knots), max(k[0] for k in knots)
    ylast = [k[1] for k in sorted(knots)][-1]
    xc = F.least(F.greatest(F.col(x), F.lit(xmin)), F.lit(xmax))
    d = df.withColumn("_xc", xc).withColumn("_cell", F.floor(F.col("_xc") / F.lit(cell)).cast("long"))
    s = segs.withColumnRenamed("cell", "_scell")
    j = d.join(F.broadcast(s), (F.col("_cell") == F.col("_scell")) & (F.col("_xc") >= F.col("x0")) &
               (F.col("_xc") < F.col("x1")), "left")
    val = F.when(F.col("_xc") >= F.lit(xmax), F.lit(float(ylast))).otherwise(
        F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("_xc") - F.col("x0")) / (F.col("x1") - F.col("x0")))
    return j.withColumn(out, val).drop("_xc", "_cell", "_scell", "x0", "y0", "x1", "y1")


def curve_sql(x: str, knots: list[tuple[float, float]], alias: str = "seg") -> tuple[str, str, str]:
    """Oracle twin of :func:`interp_curve`: (CTE, join clause, value expression)."""
    ks = sorted(knots)
    vals = ", ".join(f"(CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE))" for a, b in ks)
    xmin, xmax, ylast = ks[0][0], ks[-1][0], ks[-1][1]
    cte = (f"{alias}_k(x, y) AS (VALUES {vals}),\n{alias} AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, "
           f"lead(y) OVER (ORDER BY x) AS y1 FROM {alias}_k)")
    xc = f"least(greatest({x}, {xmin!r}), {xmax!r})"
    join = f"LEFT JOIN {alias} ON {xc} >= {alias}.x0 AND {xc} < {alias}.x1"
    val = (f"CASE WHEN {xc} >= {xmax!r} THEN {ylast!r} ELSE {alias}.y0 + ({alias}.y1 - {alias}.y0) * "
           f"({xc} - {alias}.x0) / ({alias}.x1 - {alias}.x0) END")
    return cte, join, val


def chain_sql(base: str, exprs, prefix: str = "c", base_cols: list[str] | None = None) -> tuple[str, str]:
    """Oracle twin of :func:`with_exprs`: CTE chain adding (or, for names in
    ``base_cols`` or added before, replacing) one column per step.
    Returns (CTE text, name of the last CTE)."""
    items = list(exprs.items() if isinstance(exprs, dict) else exprs)
    known = set(base_cols or [])
    parts = [f"{prefix}0 AS ({base})"]
    for i, (name, e) in enumerate(items, 1):
        e = for_oracle(e)
        if name in known:
            parts.append(f"{prefix}{i} AS (SELECT * REPLACE ({e} AS {name}) FROM {prefix}{i - 1})")
        else:
            parts.append(f"{prefix}{i} AS (SELECT *, {e} AS {name} FROM {prefix}{i - 1})")
            known.add(name)
    return ",\n".join(parts), f"{prefix}{len(items)}"


def residual_summary(df: DataFrame, keys: list, expected: str, actual: str, under: float | None = None) -> DataFrame:
    """n, mean expected / actual / residual, residual std, and optionally the
    count of rows below ``under`` x expected, per group."""
    res = F.col(actual) - F.col(expected)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(expected).alias("mean_expected"), F.avg(actual).alias("mean_actual"),
            F.avg(res).alias("mean_residual"), F.stddev_samp(res).alias("std_residual")]
    if under is not None:
        aggs.append(F.count_if(F.col(actual) < F.lit(under) * F.col(expected)).alias("n_under"))
    return df.groupBy(*keys).agg(*aggs)
