"""Query registry shared by __spark_entry__, bench.py and the tests."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlens.functions.exprs import rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ["faults", "profile", "scans", "timeseries", "joins", "fraud", "scoring",
           "sampling", "overlays", "stream_twins", "extended", "thermal"]


def register(key: str, sql: str | None = None, digits: int | None = None):
    """Register a query and its oracle SQL; ``digits`` rounds the doubles of its result.

    (Operators return raw doubles; both engines' summation noise goes here.)
    """
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn if digits is None else lambda spark, sf_dir: rounded(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> tuple[dict, dict]:
    for m in MODULES:
        importlib.import_module(f"gridlens.plans.{m}")
    return QUERIES, ORACLE


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one driver table.  ``spread=True`` for scans feeding a CPU-heavy
    row-wise pipeline: see :func:`gridlens.sources.files.ensure_parallel`."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        from gridlens.sources.files import ensure_parallel
        df = ensure_parallel(df)
    return df
