"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.session import checkpoint_dir


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder that ``spark.checkpoint.dir`` names."""
    base = checkpoint_dir(spark)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base if base.startswith("/") and spark.sparkContext.master.startswith("local") else base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, lost executors cost nothing,
    and the shuffle files of the write are deleted."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Arrow batches of texts are at most about this large, whatever the length of the rows.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches of this session by bytes, unless they are limited to less already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "64m").lower().rstrip("b")
    size = int(now.rstrip("kmgt")) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(now[-1], 0)
    if not 0 < size <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def filesystem(path: str):
    """pyarrow file system and path for a URI of the shared folder, opened inside tasks."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def words_column(text, pattern: str = r"[^\x20\x09-\x0D]+"):
    """Words of a text after lower-casing A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(f"({pattern})"), F.lit(1))


#: What operators keep in this Python worker between tasks.
_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """The operator's cache in this worker; those of other operators are dropped."""
    others = [k for k in _KEPT if k != owner]
    for k in others:
        del _KEPT[k]
    if others:
        release_memory()
    return _KEPT.setdefault(owner, {})


def release_memory() -> None:
    """Give freed memory of this worker back to the system, which else keeps it for the worker's life."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run):
    """A ``mapInArrow`` function that gives freed memory back at the end of each task."""
    def whole(batches):
        yield from run(batches)
        release_memory()
    return whole
