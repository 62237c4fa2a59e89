"""Exact quantiles without gathering a large group in one task.

``percentile`` merges every distinct value of a group into one aggregation
buffer, i.e. one task holds the whole group.  Groups above ``hot_rows`` values
are ranked instead: their values are sorted by (group, value) over range
partitions, rows are numbered by per-partition offsets, and the two order
statistics at floor/ceil of (n-1)q are picked by position.  Nothing but scalars
reaches the driver, and values may be infinite or NaN (the greatest, as in
``percentile``).

Whole columns (no groups) need no sort: :func:`refined_quantiles` brackets each
order statistic by a mergeable KLL sketch and counts its way to the exact value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.operators.windows import null_safe_join, sequential_ids


def exact_quantiles(df: DataFrame, col: str, qs: list[float], keys: list[str] | None = None,
                    hot_rows: int | None = None) -> DataFrame:
    """DataFrame(keys..., q, value): exact quantiles of ``col`` per group, by
    linear interpolation; the same for groups below and above ``hot_rows``."""
    from gridlens.session import setting
    keys = keys or []
    if hot_rows is None:
        hot_rows = setting(df.sparkSession, "quantileHotRows", 5_000_000)
    base = df.select(*keys, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > hot_rows)
    quantiles = F.array(*[F.lit(float(q)) for q in qs])

    def by_percentile(rows):
        p = rows.groupBy(*keys).agg(F.percentile("_x", [float(q) for q in qs]).alias("_p"), F.count(F.lit(1)).alias("_n"))
        p = p.where("_n > 0").select(*keys, F.posexplode("_p").alias("_i", "value"))
        return p.select(*keys, F.element_at(quantiles, F.col("_i") + 1).alias("q"), "value")

    if hot.isEmpty():
        return by_percentile(base)
    if not keys:
        _, got = refined_quantiles(base, ["_x"], qs)
        return df.sparkSession.createDataFrame([(float(q), v) for q, v in zip(qs, got["_x"])], "q double, value double")
    marked = null_safe_join(base, hot, keys, "left")
    small = by_percentile(marked.where("_n IS NULL").drop("_n"))
    # NaN sorts after infinity; positions count from 0 within the group
    ranked = sequential_ids(marked.where("_n IS NOT NULL"), [*keys, "_x"], start=0, out="_at")
    first = ranked.groupBy(*keys).agg(F.min("_at").alias("_first"))
    ranked = null_safe_join(ranked, first, keys)
    place = F.col("_at") - F.col("_first")
    wanted = F.transform(quantiles, lambda q: (F.col("_n") - 1) * q)
    pick = ranked.where(F.exists(wanted, lambda h: (F.floor(h) == place) | (F.ceil(h) == place)))
    pick = pick.withColumn("_h", F.explode(F.arrays_zip(quantiles.alias("q"), wanted.alias("h")))).withColumn("_p", place)
    h = F.col("_h.h")
    low = F.max(F.when(F.floor(h) == F.col("_p"), F.col("_x"))).alias("_lo")
    high = F.max(F.when(F.ceil(h) == F.col("_p"), F.col("_x"))).alias("_hi")
    got = pick.groupBy(*keys, F.col("_h.q").alias("q"), h.alias("_hh")).agg(low, high)
    up = F.col("_hh") - F.floor("_hh")
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise((1 - up) * F.col("_lo") + up * F.col("_hi"))
    return small.unionByName(got.select(*keys, "q", value.alias("value")))


#: Size of a KLL sketch, and twice the rank error that goes with it (99 % of sketches).
SKETCH_K, SKETCH_MARGIN = 1024, 0.009


class _Bracket:
    """Where the order statistic ``rank`` (from 0) of a column's ``rows`` values in question lies: in [low, high]."""

    def __init__(self, col: str, rank: int, rows: int):
        self.col, self.rank, self.rows = col, rank, rows
        self.low = self.high = self.value = None

    def narrow_by(self, steps: list[float], below: int, rows: int):
        """Bracket by the steps of a sketch of ``rows`` values that have ``below`` smaller ones beside them."""
        self.low = steps[max(0, math.floor(((self.rank - below) / rows - SKETCH_MARGIN) * GRID))]
        self.high = steps[min(GRID, math.ceil(((self.rank + 1 - below) / rows + SKETCH_MARGIN) * GRID))]


#: Steps of a sketch that are read, values at ranks 0, 1/GRID, ... 1.
GRID = 400


def _steps(values: Column) -> Column:
    """The steps of a sketch of ``values``, or null where there are none."""
    sketch = F.kll_sketch_agg_double(values, F.lit(SKETCH_K))
    grid = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
    return F.when(F.count(values) > 0, F.kll_sketch_get_quantile_double(sketch, grid))


def refined_quantiles(df: DataFrame, cols: list[str], qs: list[float], aggs: list[Column] | None = None,
                      gather_rows: int = 1_000_000):
    """Exact quantiles (linear interpolation) of whole columns, all columns in the same few scans.

    Returns (row of ``aggs``, {column: [value per q]}).  The first scan sketches
    every column.  The ends of the brackets of all order statistics then cut a
    column into cells; each further scan counts the cells (points and open
    intervals) and sketches those where a statistic is looked for again, so a
    bracket keeps about a fiftieth of its rows, and its ends drop out.  From
    ``gather_rows`` rows on the values of such cells (about a fiftieth of them)
    are sorted in the aggregate and the statistics picked by position.  Counts,
    not sketches, decide: a bracket that missed is replaced by the cell that
    holds the rank.  NaN is the greatest value; a column without values gives None.
    """
    seen = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        real = x.isNotNull() & ~F.isnan(x)
        seen += [_steps(F.when(real, x)).alias(f"_g{i}"), F.count_if(real).alias(f"_r{i}"), F.count(x).alias(f"_n{i}")]
    first = df.agg(*(aggs or []), *seen).first()
    brackets = {}
    for i, c in enumerate(cols):
        real, n = first[f"_r{i}"], first[f"_n{i}"]
        for rank in {f((n - 1) * q) for q in qs for f in (math.floor, math.ceil)} if n else ():
            b = brackets[c, rank] = _Bracket(c, rank, real)
            if rank < real:
                b.narrow_by(first[f"_g{i}"], 0, real)
            else:
                b.value = math.nan
    while any(b.value is None for b in brackets.values()):
        _narrow_all(df, [b for b in brackets.values() if b.value is None], gather_rows)

    def quantile(i, c, q):
        if not first[f"_n{i}"]:
            return None
        h = (first[f"_n{i}"] - 1) * q
        lo, hi = brackets[c, math.floor(h)].value, brackets[c, math.ceil(h)].value
        return lo if lo == hi or h == math.floor(h) else (math.ceil(h) - h) * lo + (h - math.floor(h)) * hi

    return first, {c: [quantile(i, c, q) for q in qs] for i, c in enumerate(cols)}


def _narrow_all(df: DataFrame, brackets: list[_Bracket], gather_rows: int) -> None:
    """One scan for all open brackets: every value is dealt to its cell, cells are counted."""
    cols = sorted({b.col for b in brackets})
    mine = {c: sorted((b for b in brackets if b.col == c), key=lambda b: b.low) for c in cols}
    for group in mine.values():  # brackets that overlap become one: few cells, so the aggregate stays a hash one
        for before, b in zip(group, group[1:]):
            if b.low < before.high:
                b.low = before.low
                for other in group:
                    if other.low == b.low:
                        other.high = max(other.high, b.high)
    cuts = {c: sorted({v for b in mine[c] for v in (b.low, b.high)}) for c in cols}
    gather = {c: all(b.rows <= gather_rows for b in mine[c]) for c in cols}
    cells = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        # 2j - 1 at the j-th cut, 2j between it and the next one, 0 before the first
        code = F.lit(2 * len(cuts[c]))
        for j, v in reversed(list(enumerate(cuts[c]))):
            code = F.when(x < F.lit(v), F.lit(2 * j)).when(x == F.lit(v), F.lit(2 * j + 1)).otherwise(code)
        cells.append(F.struct(F.lit(i).alias("i"), x.alias("x"), code.alias("cell")))
    likely = {c: sorted({k for b in mine[c] for k in range(2 * cuts[c].index(b.low) + 2, 2 * cuts[c].index(b.high) + 1, 2)}) for c in cols}
    width = 1 + max(2 * len(v) for v in cuts.values())
    at = F.col("i") * width + F.col("cell")
    looked = {g: [i * width + k for i, c in enumerate(cols) if gather[c] is g for k in likely[c]] for g in (True, False)}
    values = df.select(F.explode(F.array(*cells)).alias("v")).select("v.*").where("x IS NOT NULL")
    sorted_values = F.sort_array(F.collect_list(F.when(at.isin(looked[True]), F.col("x"))))
    counted = values.groupBy("i", "cell").agg(
        F.count(F.lit(1)).alias("n"), (sorted_values if looked[True] else F.array().cast("array<double>")).alias("values"),
        (_steps(F.when(at.isin(looked[False]), F.col("x"))) if looked[False] else F.lit(None).cast("array<double>")).alias("steps"))
    skip = F.coalesce(F.sum("n").over(Window.partitionBy("i").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = F.create_map(*[m for i, c in enumerate(cols) for m in (F.lit(i), F.array(*[F.lit(b.rank) for b in mine[c]]))])
    picks = F.transform(F.element_at(ranks, F.col("i")), lambda r: F.when(
        (r >= F.col("skip")) & (r < F.col("skip") + F.size("values")), F.get("values", (r - F.col("skip")).cast("int"))))
    rows = counted.withColumn("skip", skip).select("i", "cell", "n", "skip", "steps", picks.alias("picks")).collect()  # a row per cell
    for i, c in enumerate(cols):
        ends = [-math.inf, *cuts[c], math.inf]
        for j, b in enumerate(mine[c]):
            r = next(r for r in rows if r["i"] == i and r["skip"] <= b.rank < r["skip"] + r["n"])
            k = (r["cell"] + 1) // 2
            if r["cell"] % 2:
                b.value = ends[k]
            elif r["picks"][j] is not None:
                b.value = r["picks"][j]
            elif r["steps"]:
                b.rows = r["n"]
                b.narrow_by(r["steps"], r["skip"], b.rows)
            else:
                b.rows, b.low, b.high = r["n"], ends[k], ends[k + 1]
