"""Scans, catalogue, sinks and ingest helpers."""

from gridlens.sources.files import (  # noqa: F401
    catalogue, load, time_bounds, pick_time_col, write_dataset, read_pandas_parquet, publish_view,
    write_nanoseconds, write_bucketed, replace_partitions,
)
