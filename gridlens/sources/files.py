"""File-based sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def catalogue(spark: SparkSession, base: str) -> DataFrame:
    """Every Parquet file under ``base``: group (parent folder), dataset
    (file stem), size.  File contents are not read (binaryFile prunes the
    content column when it is not selected)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(base).select("path", "length"))
    parts = F.split(F.col("path"), "/")
    fname = F.element_at(parts, -1)
    return files.select(
        F.element_at(parts, -2).alias("group"),
        F.regexp_replace(fname, r"\.parquet$", "").alias("dataset"),
        F.col("path"), F.col("length").alias("size_bytes"))


def ensure_parallel(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over the cluster's cores when it arrives in fewer input
    partitions (e.g. one Parquet file with a single row group).  A big table
    has far more splits than cores, so then this is a no-op and adds no
    shuffle.  Filters and column pruning still reach the Parquet reader."""
    from gridlens.session import default_parallelism
    want = min_partitions or default_parallelism(df.sparkSession)
    try:
        have = df.rdd.getNumPartitions()   # planning only, no job
    except Exception:  # noqa: BLE001  (no RDD view on this client)
        return df
    return df.repartition(want) if have < want else df


def pick_time_col(schema: T.StructType) -> str | None:
    """S4: 'time', then 'timestamp', else the first timestamp column."""
    names = [f.name for f in schema.fields]
    for pref in ("time", "timestamp"):
        if pref in names:
            return pref
    for f in schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return f.name
    return None


def load(spark: SparkSession, path: str, time_col: str | None = None, start: str | None = None,
         end: str | None = None) -> DataFrame:
    """Parquet scan with a half-open time filter [start, end) that the
    reader receives as PushedFilters (row groups outside are skipped)."""
    df = spark.read.parquet(path)
    time_col = time_col or pick_time_col(df.schema)
    if time_col and start is not None:
        df = df.where(F.col(time_col) >= F.expr(f"TIMESTAMP_NTZ'{start}'"))
    if time_col and end is not None:
        df = df.where(F.col(time_col) < F.expr(f"TIMESTAMP_NTZ'{end}'"))
    return df


def time_bounds(df: DataFrame, col: str | None = None) -> DataFrame:
    """S3: min/max of the time column; only that column is read."""
    col = col or pick_time_col(df.schema)
    return df.select(col).agg(F.min(col).alias("min_time"), F.max(col).alias("max_time"))


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_by: list[str] | None = None, n_files: int | None = None) -> None:
    """Parquet sink, optionally partitioned (e.g. by month) and sorted
    inside each file (range partitioning keeps files disjoint)."""
    out = df
    if sort_by:
        out = (out.repartitionByRange(n_files, *sort_by) if n_files else out.repartitionByRange(*sort_by))
        out = out.sortWithinPartitions(*sort_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_pandas_parquet(spark: SparkSession, path: str, ts_cols: list[str]) -> DataFrame:
    """Parquet written by pandas with nanosecond timestamps.  Spark
    rejects INT64 NANOS unless ``nanosAsLong``; the longs are turned back
    into microsecond timestamp_ntz.  The setting belongs to a session of its
    own, so reads beside this one never see it."""
    own = spark.newSession()
    own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = own.read.parquet(path)
    # whole numbers throughout: a double has not the digits of nanoseconds; the microsecond at or before, also before 1970
    micros = lambda c: F.expr(f"(`{c}` - pmod(`{c}`, 1000)) DIV 1000")
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return df.select(*[F.timestamp_add("MICROSECOND", micros(c), epoch).alias(c) if c in ts_cols else F.col(c) for c in df.columns])


def write_nanoseconds(df: DataFrame, path: str, ts_cols: list[str]) -> DataFrame:
    """S7, the other way: Parquet with INT64 nanosecond timestamps, as pandas writes it.

    Spark has no such type, so each task writes its rows with Arrow, in row
    groups of one batch, to ``path`` (a folder that executors share).  A file
    gets its name once it is whole, so a repeated task replaces its own file.
    Returns one row per file: file, n_rows (lazy: nothing is written before).
    """
    names = df.columns
    # wall clock to micros without a time zone
    parted = df.select(*[F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(c)).alias(c) if c in ts_cols
                         else F.col(c) for c in names])

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if path.startswith("file:"):
            system, folder = fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
        else:
            system, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        system.create_dir(folder, recursive=True)
        name, writer, n = f"part-{part:05d}.parquet", None, 0
        hidden = f"{folder}/_{name}.{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            columns = [pc.multiply(batch.column(i), 1000).cast(pa.timestamp("ns")) if c in ts_cols else batch.column(i)
                       for i, c in enumerate(names)]
            table = pa.Table.from_arrays(columns, names=names)
            if writer is None:
                writer = pq.ParquetWriter(hidden, table.schema, filesystem=system, version="2.6")
            writer.write_table(table)
            n += table.num_rows
        if writer is not None:
            writer.close()
            system.move(hidden, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "n_rows": pa.array([n], pa.int64())})

    return parted.mapInArrow(write, "file string, n_rows long")


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, sort_by: list[str] | None = None) -> DataFrame:
    """A bucketed table ``name`` over ``path``: rows of equal keys in one bucket, sorted inside it.

    Tables with equal numbers of buckets on a key join, group and window on it
    without a shuffle.  Rows are dealt by the bucket hash before they are
    written, so a bucket is one file and its order survives.
    """
    sort_by = sort_by or keys
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*sort_by).saveAsTable(name))
    return df.sparkSession.table(name)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions (e.g. months) that ``df`` has rows of; all others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def publish_view(df: DataFrame, target: str, row_id: str, ignore: list[str] | None = None,
                 ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Publish-ready table: row id first, features, target last;
    ignored (ground-truth leaking) columns dropped; timestamps as text."""
    ignore = set(ignore or [])
    feats = [c for c in df.columns if c not in ignore and c not in (target, row_id)]
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def conv(c):
        if isinstance(kinds[c], (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(F.col(c), ts_format).alias(c)
        return F.col(c)
    return df.select(conv(row_id), *[conv(c) for c in feats], conv(target))
