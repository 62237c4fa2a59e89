"""Dimension joins, baskets and calendar anti-joins.

Broadcasts go through :func:`join_dim`, which measures the dimension first
(row count x schema width) and ships it to executors only below a byte
limit; above it the join is a normal shuffle join (AQE may still convert
it at run time if the filtered side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.operators.windows import null_safe_join

BROADCAST_LIMIT = 64 * 1024 * 1024


def _width(t) -> int:
    from pyspark.sql import types as T
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 32
    if isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return 64
    return 8


def row_width(df: DataFrame) -> int:
    return sum(_width(f.dataType) for f in df.schema.fields) + 16


def row_bytes(df: DataFrame):
    """Bytes of each row: fixed widths plus the bytes of its text."""
    from pyspark.sql import types as T
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(text, F.lit(row_width(df))).cast("long")


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """True when the table stays within ``limit`` bytes (default:
    ``spark.gridlens.broadcastLimitBytes``, else 64 MB): fixed widths plus the
    measured bytes of its text.  Reading stops after as many rows as could fit
    (never a full scan of a big side)."""
    from gridlens.session import setting
    limit = limit or setting(df.sparkSession, "broadcastLimitBytes", BROADCAST_LIMIT)
    cap = max(1, limit // row_width(df))
    rows, size = df.limit(cap + 1).select(row_bytes(df).alias("_t")).agg(F.count(F.lit(1)), F.coalesce(F.sum("_t"), F.lit(0))).first()
    return rows <= cap and size <= limit


def join_dim(big: DataFrame, dim: DataFrame, on, how: str = "inner", limit: int | None = None) -> DataFrame:
    """Join a fact table with a dimension; broadcast only after a size check."""
    side = F.broadcast(dim) if fits(dim, limit) else dim
    return big.join(side, on, how)


def attach_device(tel: DataFrame, devices: DataFrame, key, overrides: dict | None = None) -> DataFrame:
    """Per-device parameters; ``overrides`` maps column -> Column whose
    non-null value replaces the device default (coalesce)."""
    j = join_dim(tel, devices, key)
    for c, o in (overrides or {}).items():
        j = j.withColumn(c, F.coalesce(o, F.col(c)))
    return j


def attach_site(tel: DataFrame, site: DataFrame, time: str, step: str, site_time: str = "site_time") -> DataFrame:
    """Shared per-time conditions: equi-join on the time truncated to the step."""
    t = tel.withColumn(site_time, F.window(time, step).start)
    return t.join(site, site_time)


def attach_lookup(df: DataFrame, col: str, mapping: dict, out: str, default=None) -> DataFrame:
    """Category lookup from a literal map (no join at all)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    v = F.try_element_at(m, F.col(col))
    return df.withColumn(out, v if default is None else F.coalesce(v, F.lit(default)))


def basket_pairs(lines: DataFrame, order: str, item: str) -> DataFrame:
    """Orders containing both items of a pair (a < b).

    ``item`` must be a bounded category (product type, category): each
    order is first reduced to its *set* of items (partial aggregation, so a
    huge order costs one small set), and pairs are formed inside that set -
    at most C(k, 2) for k categories, independent of the order size.
    """
    sets = lines.where(F.col(item).isNotNull()).groupBy(order).agg(F.array_sort(F.collect_set(item)).alias("_s"))
    pairs = sets.select(order, F.explode(F.expr(
        "flatten(transform(_s, x -> transform(filter(_s, y -> y > x), y -> named_struct('a', x, 'b', y))))")).alias("_p"))
    return pairs.groupBy(F.col("_p.a").alias("item_a"), F.col("_p.b").alias("item_b")).agg(
        F.count(F.lit(1)).alias("n_orders"))


#: Items of an order that are paired in one group; longer orders are dealt into more of them.
PAIR_BLOCK = 1024
#: Order lines, and pairs, that one task groups, about; the number of tasks grows with the table.
LINES_PER_TASK, PAIRS_PER_TASK = 500_000, 1_000_000


def _tasks(n: int, per_task: int) -> int:
    return min(20_000, max(1, -(-n // per_task)))


def _pairs(baskets: DataFrame, order: str, item: str, block: int, lines: int, pairs: int) -> DataFrame:
    """(item_a, item_b), a < b, of every order: an equality join on (order, block of b), where an order of
    k items has k / ``block`` blocks, so that no group pairs more than about ``block`` items with all of its order."""
    dealt = baskets.repartition(lines, order)
    sizes = dealt.groupBy(order).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_blocks"))
    sized = dealt.join(sizes, order)
    left = sized.select(F.col(order).alias("_o"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_b"), F.col(item).alias("item_a"))
    right = sized.select(F.col(order).alias("_o"), F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int").alias("_b"), F.col(item).alias("item_b"))
    both = left.repartition(pairs, "_o", "_b").join(right.repartition(pairs, "_o", "_b"), ["_o", "_b"])
    return both.where(F.col("item_a") < F.col("item_b")).select("item_a", "item_b")


def frequent_pairs(lines: DataFrame, order: str, item: str, min_orders: int, buckets: int = 1 << 20,
                   block: int = PAIR_BLOCK) -> DataFrame:
    """L10 over any number of items: pairs (item_a < item_b) that occur together in ``min_orders`` orders or
    more, with n_orders and the orders of each item (n_a, n_b).

    Orders become sets of the items that are frequent themselves.  Pairs are
    first counted in hash ``buckets`` (a fixed number, so the map-side counts
    and the broadcast list of full buckets are bounded by it); only pairs of a
    full bucket are counted one by one.  Neither step can lose a frequent
    pair.  Rows without order or item are in no pair; a repeated line counts once.
    Lines and pairs are dealt to as many tasks as their numbers ask for, before
    they are grouped, so that a task's memory does not grow with the table.
    """
    from gridlens.operators.profile import _scalars
    from gridlens.session import materialised
    given = lines.where(F.col(order).isNotNull() & F.col(item).isNotNull()).select(order, item)
    sets = given.repartition(_tasks(lines.count(), LINES_PER_TASK), order, item).distinct()
    support = sets.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_orders)
    baskets = materialised(sets.join(support.select(item), item, "left_semi"), "baskets")
    support = baskets.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    n_lines = _tasks(baskets.count(), LINES_PER_TASK)
    k = baskets.repartition(n_lines, order).groupBy(order).agg(F.count(F.lit(1)).cast("double").alias("_k"))
    n_pairs = _tasks(int(_scalars(k, {"n": F.sum(F.col("_k") * (F.col("_k") - 1) / 2)})["n"] or 0), PAIRS_PER_TASK)
    bucket = F.pmod(F.xxhash64("item_a", "item_b"), F.lit(buckets)).cast("int")
    pairs = _pairs(baskets, order, item, block, n_lines, n_pairs).withColumn("_h", bucket)
    full = pairs.groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= min_orders).select("_h")
    found = (pairs.join(F.broadcast(full), "_h", "left_semi")  # at most ``buckets`` ints
             .repartition(n_pairs, "item_a", "item_b").groupBy("item_a", "item_b")
             .agg(F.count(F.lit(1)).alias("n_orders")).where(F.col("n_orders") >= min_orders))
    for side in ("a", "b"):
        found = found.join(support.select(F.col(item).alias(f"item_{side}"), F.col("_n").alias(f"n_{side}")), f"item_{side}")
    return found.select("item_a", "item_b", "n_orders", "n_a", "n_b")


def attach_rate(lines: DataFrame, order: str, item: str, anchors: list[str]) -> DataFrame:
    """P(order has item | order has anchor) for every anchor and item,
    from the per-order item sets (bounded by the number of categories)."""
    sets = lines.where(F.col(item).isNotNull()).groupBy(order).agg(F.collect_set(item).alias("_s"))
    anc = F.array(*[F.lit(a) for a in anchors])
    with_anchor = sets.select(order, "_s", F.explode(F.array_intersect("_s", anc)).alias("anchor"))
    base = with_anchor.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_anchor"))
    co = (with_anchor.select("anchor", F.explode("_s").alias("item")).where(F.col("item") != F.col("anchor"))
          .groupBy("anchor", "item").agg(F.count(F.lit(1)).alias("n_both")))
    return co.join(base, "anchor").withColumn("attach_rate", F.col("n_both") / F.col("n_anchor"))


def older_than_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows strictly below the exact q-quantile of ``col`` (scalar first)."""
    from gridlens.operators.quantiles import exact_quantiles
    got = exact_quantiles(df, col, [q]).first()
    return df.where(F.col(col) < F.lit(got["value"] if got else None).cast("double"))


def expected_months(subs: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """One row per key and month from ``start`` to ``end`` (dates)."""
    return subs.select(*key, F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"),
                                                  F.expr("INTERVAL 1 MONTH"))).alias("month"))


def missing_charges(charges: DataFrame, key: list[str], ts: str, until: str | None = None) -> DataFrame:
    """Months between a key's first charge and ``until`` (a date; its own
    last charge by default) without a charge: month spine anti-joined with the
    months that have one, so a key that stops paying is reported."""
    have = charges.select(*key, F.trunc(F.col(ts).cast("date"), "MM").alias("month")).distinct()
    end = F.greatest(F.max("month"), F.trunc(F.lit(until).cast("date"), "MM")) if until else F.max("month")
    span = have.groupBy(*key).agg(F.min("month").alias("_a"), end.alias("_z"))
    spine = expected_months(span, key, "_a", "_z")
    return null_safe_join(spine, have, [*key, "month"], "left_anti")


def late_charges(charges: DataFrame, key: list[str], ts: str, period_days: int = 31, grace_days: int = 3,
                 tiebreak: list[str] | None = None) -> DataFrame:
    """Charges that come more than ``grace_days`` after the previous one of
    the same key plus a period, with the days they are late."""
    from gridlens.operators.windows import prev_row
    p = prev_row(charges, key, ts, [], tiebreak, prefix="_prev_")
    late = F.datediff(F.col(ts).cast("date"), F.col("_prev_" + ts).cast("date")) - F.lit(period_days)
    return p.withColumn("days_late", late).where(F.col("days_late") > grace_days).drop("_prev_" + ts)
