"""Keyed, partition-independent random draws.

Every draw is a pure function of (seed, stream, row key):
``u = int(first 13 hex digits of md5(seed|stream|key)) / 2^52`` in [0, 1).
The same value comes out of any partitioning, any executor and any retry,
and DuckDB computes it identically, so sampling jobs are oracle-checkable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO52 = float(2 ** 52)
TINY = 2.0 ** -53


def keyed_uniform(seed: int, stream: str, *keys) -> Column:
    cols = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), *cols))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(TWO52)


def keyed_uniform_sql(seed: int, stream: str, *keys: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', '{stream}', {parts})), 1, 13)) AS BIGINT)"
            f" / {TWO52:.1f})")


def normal_from(u1: Column, u2: Column) -> Column:
    """Standard normal by Box-Muller from two keyed uniforms."""
    return F.sqrt(F.lit(-2.0) * F.log(F.greatest(u1, F.lit(TINY)))) * F.cos(F.lit(2 * math.pi) * u2)


def expo_from(u: Column, scale: float = 1.0) -> Column:
    return F.lit(-float(scale)) * F.log(F.greatest(u, F.lit(TINY)))


def weighted_choice_sql(u: str, items: list[tuple[str, float]]) -> str:
    """CASE over cumulative weights (weights are normalised)."""
    tot = sum(w for _, w in items)
    acc = 0.0
    parts = []
    for name, w in items[:-1]:
        acc += w / tot
        parts.append(f"WHEN {u} < {acc!r} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{items[-1][0]}' END"
