"""Profiling and summary aggregations.

All are single- or two-pass aggregate jobs with map-side partial
aggregation.  Where a result needs a table-wide scalar (min/max for
histogram edges, a total for shares) it is computed as one small aggregate
first and passed on as a literal, instead of an unpartitioned window.
Exact percentiles are holistic: ``exact=False`` switches to
``percentile_approx`` for very large groups.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.operators.clean import cols_of_kind, kind_of
from gridlens.operators.quantiles import exact_quantiles, refined_quantiles
from gridlens.operators.windows import null_safe_join

QUARTILES = [0.25, 0.5, 0.75]




def quantile_columns(df: DataFrame, col: str, qs: list[float], names: list[str], keys: list[str] | None = None,
                     exact: bool = True) -> DataFrame:
    """One row per group with one column per quantile.  Exact quantiles come
    from :func:`exact_quantiles` (no group gathered in one task); otherwise
    ``percentile_approx``."""
    keys = keys or []
    if not exact:
        a = df.groupBy(*keys).agg(F.percentile_approx(F.col(col).cast("double"), qs, 10000).alias("_q"))
        return a.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    q = exact_quantiles(df, col, qs, keys)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == F.lit(float(v)), F.col("value"))).alias(n)
                                  for v, n in zip(qs, names)])


def _join_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join of two per-group tables (one row per key: AQE broadcasts a small one)."""
    return null_safe_join(a, b, keys, "left")


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric columns, mean per-column null rate (%)."""
    cols = df.columns
    n_num = len(cols_of_kind(df, "numeric"))
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    a = df.agg(*aggs)
    nulls = reduce(lambda x, y: x + y, [F.col(f"_n{i}") for i in range(len(cols))])
    rate = F.when(F.col("n_rows") > 0, nulls / F.col("n_rows") / F.lit(len(cols)) * 100.0).otherwise(0.0)
    return a.select("n_rows", F.lit(len(cols)).cast("long").alias("n_cols"),
                    F.lit(n_num).cast("long").alias("n_numeric"), rate.alias("null_pct"))


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column kind, nulls, null %, distinct non-null values (long form).

    Exact counts come from a count per value of each column, side by side: a
    branch scans its own column only, combines values before the shuffle and
    copies no row (``count_distinct`` of k columns would write k copies of every row).
    Over a costly plan give a stored table, as each branch reads it again.
    ``approx`` counts all columns in one pass over HyperLogLog registers.
    """
    kinds = {f.name: kind_of(f.dataType) for f in df.schema.fields}
    if approx:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(df.columns):
            aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_z{i}"), F.approx_count_distinct(F.col(f"`{c}`")).alias(f"_d{i}")]
        entry = lambda i, c: F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("kind"), F.col(f"_z{i}").alias("n_nulls"),
                                      F.col(f"_d{i}").alias("n_distinct"))
        long = df.agg(*aggs).select("_rows", F.explode(F.array(*[entry(i, c) for i, c in enumerate(df.columns)])).alias("_e")).select("_rows", "_e.*")
    else:
        one = lambda c: (df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
                         .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
                              F.count("v").alias("n_distinct"))
                         .select("_rows", F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("kind"), "n_nulls", "n_distinct"))
        long = reduce(DataFrame.union, [one(c) for c in df.columns])
    return long.select("column_name", "kind", F.col("n_nulls").cast("long").alias("n_nulls"),
                       (F.when(F.col("_rows") > 0, F.col("n_nulls") / F.col("_rows") * 100.0).otherwise(0.0)).alias("null_pct"),
                       F.col("n_distinct").cast("long").alias("n_distinct"))


#: log2 of the registers of a distinct sketch: a standard error of 0.8 % at 14.
SKETCH_BITS = 14


def column_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """P2, in parts: per group ``by`` (a day, a file) and column, rows, nulls and a distinct sketch, in one pass.

    Store it beside the data: a new day adds its rows, and :func:`merge_sketches` profiles any range of days without a
    scan.  A null in ``by`` is a group; an empty table has no row.
    """
    cols = [f for f in df.schema.fields if f.name not in by]
    numbers = ("tinyint", "smallint", "int", "bigint")

    def sketched(f):
        c = F.col(f"`{f.name}`")
        return c if f.dataType.simpleString() in (*numbers[2:], "string", "binary") else c.cast("int") if f.dataType.simpleString() in numbers else c.cast("string")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(cols):
        aggs += [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_z{i}"), F.hll_sketch_agg(sketched(f), SKETCH_BITS).alias(f"_s{i}")]
    entry = lambda i, f: F.struct(F.lit(f.name).alias("column_name"), F.lit(kind_of(f.dataType)).alias("kind"), F.col("_rows").alias("n_rows"),
                                  F.col(f"_z{i}").alias("n_nulls"), F.col(f"_s{i}").alias("sketch"))
    return df.groupBy(*by).agg(*aggs).select(*by, F.explode(F.array(*[entry(i, f) for i, f in enumerate(cols)])).alias("_e")).select(*by, "_e.*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One profile of many groups: column_name, kind, n_rows, n_nulls, null_pct, and n_distinct to within the sketch's error."""
    a = sketches.groupBy("column_name", "kind").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
                                                    F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    return a.select("column_name", "kind", "n_rows", "n_nulls", (F.col("n_nulls") / F.col("n_rows") * 100.0).alias("null_pct"), "n_distinct")


def null_report(df: DataFrame) -> DataFrame:
    """Only the columns that have nulls (one aggregate of counts)."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', _z{i}" for i, c in enumerate(cols))
    long = a.selectExpr("_rows", f"stack({len(cols)}, {parts}) AS (column_name, n_nulls)").where("n_nulls > 0")
    return long.select("column_name", "n_nulls", (F.col("n_nulls") / F.col("_rows") * 100.0).alias("null_pct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-null value, descending."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """P5: value counts normalised to shares of the non-null total."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.where(F.col(col).isNotNull()).count()
    return vc.select("value", "n", (F.col("n") / F.lit(float(max(total, 1)))).alias("share"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin;
    empty bins are kept (right join with the bin range)."""
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    spark = df.sparkSession
    ids = spark.range(1, bins + 1).select(F.col("id").alias("bin"))
    if lo is None:
        return ids.select("bin", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                          F.lit(0).cast("long").alias("n"))
    w = (hi - lo) if hi > lo else 1.0
    b = F.least(F.floor((F.col(col).cast("double") - F.lit(lo)) / F.lit(w) * F.lit(float(bins))) + 1, F.lit(bins))
    counts = df.where(F.col(col).isNotNull()).groupBy(b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    j = ids.join(F.broadcast(counts), "bin", "left")
    edge = lambda k: (F.lit(lo) + (k - 1) * F.lit(w) / F.lit(float(bins)))
    return j.select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def describe_num(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per numeric column.
    Exact quartiles come from sketched brackets (:func:`refined_quantiles`), the
    moments from its first scan; otherwise ``percentile_approx``."""
    cols = cols or cols_of_kind(df, "numeric")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, QUARTILES, 10000).alias(f"q{i}"))
    if exact:
        row, quartiles = refined_quantiles(df, cols, QUARTILES, aggs)
        rows = [(c, row[f"c{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], *quartiles[c], row[f"hi{i}"]) for i, c in enumerate(cols)]
        return df.sparkSession.createDataFrame(
            rows, "column_name string, n long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")
    parts = ", ".join(f"'{c}', c{i}, m{i}, s{i}, lo{i}, hi{i}, q{i}" for i, c in enumerate(cols))
    long = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, n, mean, std, min, max, _q)")
    return long.select("column_name", F.col("n").cast("long").alias("n"), "mean", "std", "min",
                       *[F.col("_q")[k].alias(n) for k, n in enumerate(["p25", "p50", "p75"])], "max")


def describe_all(df: DataFrame) -> DataFrame:
    """For string/bool columns: count (n), unique (n_unique), top (most frequent, ties to
    the smallest value) and freq.  Columns are stacked into (column, value)
    pairs and counted in one shuffle."""
    cols = cols_of_kind(df, "categorical")
    parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    pairs = df.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, value)").where(F.col("value").isNotNull())
    vc = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return (vc.groupBy("column_name")
            .agg(F.sum("n").cast("long").alias("n"), F.count(F.lit(1)).alias("n_unique"),
                 F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("top"),
                 F.max("n").alias("freq")))


def describe_by(df: DataFrame, keys: list[str], col: str, exact: bool = True) -> DataFrame:
    """Describe of one column per group."""
    x = F.col(col).cast("double")
    m = df.groupBy(*keys).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                              F.min(x).alias("min"), F.max(x).alias("max"))
    qs = quantile_columns(df, col, QUARTILES, ["p25", "p50", "p75"], keys, exact)
    j = _join_keys(m, qs, keys)
    return j.select(*keys, "n", *["mean", "std", "min", "p25", "p50", "p75", "max"])


def rates_by(df: DataFrame, keys: list[str], cols: list[str], rollup: bool = False) -> DataFrame:
    """Grouped means (booleans as rates); ``rollup`` adds subtotals."""
    g = df.rollup(*keys) if rollup else df.groupBy(*keys)
    return g.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in cols])


def agg_named(df: DataFrame, keys: list[str], col: str, exact: bool = True) -> DataFrame:
    """Mean / median / std with names."""
    x = F.col(col).cast("double")
    m = df.groupBy(*keys).agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    med = quantile_columns(df, col, [0.5], ["median"], keys, exact)
    j = _join_keys(m, med, keys)
    return j.select(*keys, "mean", "median", "std")


def top_n_by(df: DataFrame, key: str, col: str, n: int = 10) -> DataFrame:
    """Count / mean / max per key, top n by count (TakeOrderedAndProject)."""
    x = F.col(col).cast("double")
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.max(x).alias("max"))
            .orderBy(F.desc("n"), F.col(key)).limit(n))


#: Aggregates computed at once; many more make generated code too large to compile.
MOST_AGGREGATES = 48


def _scalars(df: DataFrame, aggs: dict) -> dict:
    """Values of many scalar aggregates, some at a time."""
    names, out = list(aggs), {}
    for i in range(0, len(names), MOST_AGGREGATES):
        some = names[i:i + MOST_AGGREGATES]
        out.update(zip(some, df.agg(*[aggs[n].alias(f"_{k}") for k, n in enumerate(some)]).first()))
    return out


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation of all numeric column pairs
    (a < b), from co-moments: sums of shifted values, squares and products.

    A first aggregate gives each column's mean (the shift, so that large
    offsets cost no digits), extremes and number of values; a second one the
    sums.  Only pairs with a column that has nulls need sums of their own, over
    the rows where both are there.  Constant columns give NULL, not an error."""
    cols = cols or cols_of_kind(df, "numeric")
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    first = _scalars(df, {"n": F.count(F.lit(1)), **{(f, c): g(x[c]) for c in cols for f, g in
                                                     (("n", F.count), ("lo", F.min), ("hi", F.max), ("mean", F.avg))}})
    shift = {c: first["mean", c] if first["mean", c] is not None and math.isfinite(first["mean", c]) else 0.0 for c in cols}
    d = {c: x[c] - F.lit(shift[c]) for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    apart = {p for p in pairs if any(first["n", c] < first["n"] for c in p)}
    want = {}
    for c in {c for p in pairs if p not in apart for c in p}:
        want["s", c], want["ss", c] = F.sum(d[c]), F.sum(d[c] * d[c])
    for a, b in pairs:
        want["sp", a, b] = F.sum(d[a] * d[b])
        if (a, b) in apart:
            want["n", a, b] = F.count(d[a] * d[b])
            for one, other in ((a, b), (b, a)):
                v = F.when(x[other].isNotNull(), d[one])
                for f, g in (("s", F.sum(v)), ("ss", F.sum(v * v)), ("lo", F.min(v)), ("hi", F.max(v))):
                    want[f, one, a, b] = g
    got = _scalars(df, want) if first["n"] else {}

    def corr(a, b):
        own = (a, b) in apart
        n = got["n", a, b] if own else first["n"]
        if not n:
            return None
        var = []
        for c in (a, b):
            lo, hi = (got["lo", c, a, b], got["hi", c, a, b]) if own else (first["lo", c], first["hi", c])
            if lo == hi:
                return None
            s, ss = (got["s", c, a, b], got["ss", c, a, b]) if own else (got["s", c], got["ss", c])
            var.append((s / n, ss / n - (s / n) ** 2))
        den = math.sqrt(max(var[0][1], 0.0)) * math.sqrt(max(var[1][1], 0.0)) if not any(math.isnan(v[1]) for v in var) else math.nan
        return None if den == 0 else (got["sp", a, b] / n - var[0][0] * var[1][0]) / den
    return df.sparkSession.createDataFrame([(a, b, corr(a, b)) for a, b in pairs], "col_a string, col_b string, corr double")


def class_balance(df: DataFrame, label: str, target_rate: float) -> DataFrame:
    """Positives, rate, and positives needed for ``target_rate`` given the
    negatives: round(n_neg * r / (1 - r)) (half up)."""
    y = F.col(label).cast("int")
    a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg"))
    need = F.floor(F.col("n_neg") * F.lit(target_rate) / F.lit(1 - target_rate) + 0.5).cast("long")
    return a.select("n_rows", "n_pos", "n_neg", (F.col("n_pos") / F.col("n_rows")).alias("pos_rate"),
                    need.alias("pos_needed"))


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar month with the month name."""
    m = F.trunc(F.col(ts).cast("date"), "MM")
    return df.groupBy(m.alias("month")).agg(F.count(F.lit(1)).alias("n")).select(
        "month", F.date_format(F.col("month"), "MMMM").alias("month_name"), "n")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def hourly_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows per hour of day and their share."""
    vc = df.groupBy(F.hour(F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return vc.select("hour", "n", (F.col("n") / F.lit(float(max(total, 1)))).alias("share"))


def density2d(df: DataFrame, x: str, y: str, by: str | None = None, bins: int = 50) -> DataFrame:
    """2-D histogram of two numeric columns, optionally per group."""
    lx, hx, ly, hy = df.agg(F.min(x).cast("double"), F.max(x).cast("double"),
                            F.min(y).cast("double"), F.max(y).cast("double")).first()
    wx = (hx - lx) if hx is not None and hx > lx else 1.0
    wy = (hy - ly) if hy is not None and hy > ly else 1.0

    def b(c, lo, w):
        return F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(w) * F.lit(float(bins))) + 1,
                       F.lit(bins)).cast("long")
    keys = [b(x, lx, wx).alias("bin_x"), b(y, ly, wy).alias("bin_y")] + ([F.col(by)] if by else [])
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n")))


def manifest(tables: dict[str, DataFrame], with_samples: bool = False, sample_order: dict | None = None) -> DataFrame:
    """One row per table: rows, columns, mean null % and column kinds
    (from the schema, no job); per-table aggregates are unioned into one job.
    ``with_samples`` adds the first 3 rows (by ``sample_order[name]`` or the
    first column) as a JSON array: a top-3 of each table, brought to its row
    by a group of at most four rows."""
    parts = []
    for name, df in tables.items():
        kinds = ",".join(f"{f.name}:{kind_of(f.dataType)}" for f in df.schema.fields)
        row = overview(df).select(F.lit(name).alias("dataset"), "n_rows", "n_cols", "null_pct", F.lit(kinds).alias("schema_kinds"))
        if with_samples:
            none = F.lit(None)
            samples = sample_rows_json(df, (sample_order or {}).get(name, [df.columns[0]])).select(
                F.lit(name).alias("dataset"), none.cast("long").alias("n_rows"), none.cast("long").alias("n_cols"), none.cast("double").alias("null_pct"),
                none.cast("string").alias("schema_kinds"), F.struct(F.monotonically_increasing_id().alias("i"), "row_json").alias("_s"))
            row = row.withColumn("_s", none.cast(samples.schema["_s"].dataType)).unionByName(samples)
        parts.append(row)
    got = reduce(lambda a, b: a.unionByName(b), parts)
    if not with_samples:
        return got
    rows = F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["row_json"])
    return got.groupBy("dataset").agg(*[F.max(c).alias(c) for c in ("n_rows", "n_cols", "null_pct", "schema_kinds")], F.to_json(rows).alias("sample_rows"))


def sample_rows_json(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """First ``n`` rows by ``order`` as JSON strings (for the manifest view)."""
    return df.orderBy(*order).limit(n).select(F.to_json(F.struct(*df.columns)).alias("row_json"))

