"""Sources: the catalogue (rows-only query) against a direct directory listing."""

import os

from conftest import SF_SMALL
from gridlens.sources import catalogue, pick_time_col


def test_catalogue_matches_listing(spark):
    got = {(r["group"], r["dataset"], r["size_bytes"]) for r in catalogue(spark, SF_SMALL).collect()}
    group = os.path.basename(SF_SMALL)
    want = {(group, f[:-len(".parquet")], os.path.getsize(os.path.join(SF_SMALL, f)))
            for f in os.listdir(SF_SMALL) if f.endswith(".parquet")}
    assert got == want


def test_pick_time_col(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert pick_time_col(ev.schema) == "ts"
    assert pick_time_col(ev.withColumnRenamed("ts", "time").schema) == "time"
    assert pick_time_col(spark.read.parquet(f"{SF_SMALL}/region.parquet").schema) is None


def test_nanosecond_files_come_back_whole(spark, tmp_path):
    import datetime as dt
    import pyarrow.parquet as pq
    from gridlens.sources import read_pandas_parquet, write_nanoseconds
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456), "a"), (2, None, None), (4, dt.datetime(2024, 1, 4, 6, 21, 33, 298959), "c"), (3, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), "b")]
    df = spark.createDataFrame(rows, "id long, time timestamp_ntz, name string").repartition(2)
    files = write_nanoseconds(df, f"{tmp_path}/ns", ["time"]).collect()
    assert sum(r.n_rows for r in files) == 4
    assert all(str(pq.read_schema(f"{tmp_path}/ns/{r.file}").field("time").type) == "timestamp[ns]" for r in files)
    back = read_pandas_parquet(spark, f"{tmp_path}/ns", ["time"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)  # no microsecond is lost to doubles


def test_bucketed_tables_join_and_group_without_exchange(spark):
    from gridlens.plans.scans import bucketed_telemetry
    from pyspark.sql import functions as F
    ev, orders = bucketed_telemetry(spark, SF_SMALL, buckets=4)
    out = ev.hint("merge").join(orders, "device").groupBy("device").agg(F.count("*").alias("n"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = spark.read.parquet(f"{SF_SMALL}/events.parquet").join(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), F.col("user_id") == F.col("o_custkey"))
    assert sum(r.n for r in out.collect()) == plain.count() > 0


def test_one_month_is_replaced_and_the_others_are_left(spark, tmp_path):
    from gridlens.sources import replace_partitions, write_dataset
    path = f"{tmp_path}/months"
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d")], "id int, month int, v string")
    write_dataset(df, path, partition_by=["month"])
    files = {m: sorted(os.listdir(f"{path}/month={m}")) for m in (1, 2, "__HIVE_DEFAULT_PARTITION__")}
    replace_partitions(df.where("id = 1").selectExpr("9 AS id", "month", "'z' AS v"), path, ["month"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v").collect()) == [(3, "c"), (4, "d"), (9, "z")]
    for m in (2, "__HIVE_DEFAULT_PARTITION__"):
        assert sorted(os.listdir(f"{path}/month={m}")) == files[m]
