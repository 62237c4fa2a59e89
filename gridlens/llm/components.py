"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import discard, stored


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its least neighbour (or itself)."""
    both = _neighbours(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) of every node with an edge; component is its least node.

    ``edges`` has long columns u and v.  Only minima are gathered per node and
    joined back, so a hub may have any number of neighbours; every round is a
    table in the shared folder, and rounds end when the edges stay the same.
    """
    def clean(df):
        return df.where("u <> v").distinct()

    now = stored(clean(edges.select("u", "v")), f"{folder}/edges-0")
    mark, i = None, 0
    while True:
        i += 1
        now = stored(clean(_small_star(clean(_large_star(now)))), f"{folder}/edges-{i}")
        discard(edges.sparkSession, f"{folder}/edges-{i - 1}")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
