"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in key order.  An alternating Feistel network over
Z_a x Z_b (a*b >= n, both near sqrt(n)) with xxhash64 rounds permutes the
a*b points; a point >= n walks on along its cycle until it is below n.  The
shuffled position is a formula of row number, n and seed: position modulo
shards is the shard, position div shards the slot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlens.llm.common import stored, workspace

ROUNDS = 6


def radices(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def feistel(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """Image of a point of Z_a x Z_b as one expression: a fold over the rounds.

    (A projection per round would be inlined by the optimizer, doubling each time.)
    """
    a, b = radices(n)
    rounds = F.array(*[_long(k) for k in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))])

    def step(point, k):
        add = (lambda u, v: u - v) if inverse else (lambda u, v: u + v)
        key = k + _long(seed * ROUNDS)
        left = F.pmod(add(point["l"], F.pmod(F.xxhash64(key, point["r"]), _long(a))), _long(a))
        right = F.pmod(add(point["r"], F.pmod(F.xxhash64(key, point["l"]), _long(b))), _long(b))
        even = k % 2 == 0
        return F.struct(F.when(even, left).otherwise(point["l"]).alias("l"), F.when(even, point["r"]).otherwise(right).alias("r"))

    start = F.struct(_div(x, b).alias("l"), F.pmod(x, _long(b)).alias("r"))
    return F.aggregate(rounds, start, step, lambda p: p["l"] * _long(b) + p["r"])


def _div(x: Column, b: int) -> Column:
    """Integer quotient without a detour over doubles."""
    return F.call_function("div", x, _long(b))


def permute(df: DataFrame, col: str, out: str, n: int, seed: int, inverse: bool = False, steps: int = 8) -> DataFrame:
    """``out`` = position of row number ``col`` in the shuffle (or back, with ``inverse``).

    A step leaves at most about one in sqrt(n) points outside the range, so
    ``steps`` of the walk in one expression end it nearly always; the walk goes
    on, by as many steps again, until a count finds no point outside.
    """
    def walk(x: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x,
                           lambda v, _: F.when(v >= n, feistel(v, n, seed, inverse)).otherwise(v))

    df = df.withColumn(out, walk(feistel(F.col(col), n, seed, inverse)))
    while not df.where(F.col(out) >= n).isEmpty():
        df = df.withColumn(out, walk(F.col(out)))
    return df


def numbered(spark: SparkSession, df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``df`` with gapless global ``row_no`` in the order of ``keys``, and its row count.

    A range sort gives each row its partition and place; the rows of earlier
    partitions are added from one count per partition.  A running number as the
    last key spreads equal keys over partitions.
    """
    rows = (df.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*keys, "_n")
            .sortWithinPartitions(*keys, "_n").drop("_n").withColumn("_at", F.monotonically_increasing_id()))
    rows = stored(rows, workspace(spark, "numbered"))
    part = F.shiftright("_at", 33).alias("_part")
    sizes = rows.groupBy(part).agg(F.count("*").alias("_rows"))
    # one row per partition of the sort
    base = sizes.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_base"))
    n = rows.count()
    out = rows.withColumn("_part", F.shiftright("_at", 33)).join(base, "_part")
    return out.withColumn("row_no", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_base"), n


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 24, seed: int = 20240601) -> DataFrame:
    """Shard and slot of every document under the law ``rows``: counts differ by at most one.

    Size is the UTF-8 length plus 8; a null text has no bytes (crc32 0).  Rows
    are numbered by doc_id, then text digest and size, so equal rows are
    interchangeable and repeated rows each get a slot.  Null doc_ids come
    first.  Other columns are ignored; an empty table gives no row.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows, n = numbered(spark, rows, ["doc_id", "text_crc32", "size"])
    placed = permute(rows, "row_no", "position", n, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.expr(f"cast(position % {shards} as int)").alias("shard"), F.expr(f"position div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no", "position")


def row_at(spark: SparkSession, places: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    """``row_no`` of each (shard, slot): the permutation run backwards, without the table."""
    return permute(places.withColumn("_p", F.col("slot") * shards + F.col("shard")), "_p", "row_no", n, seed, inverse=True).drop("_p")
