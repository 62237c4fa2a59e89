"""Registered queries (Spark) and their DuckDB oracle SQL.

Each domain module registers ``key -> fn(spark, sf_dir) -> DataFrame`` and,
where SQL can express it, ``key -> oracle SQL`` over the driver's views.
"""

from gridlens.plans.registry import QUERIES, ORACLE, load_all  # noqa: F401
