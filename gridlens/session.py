"""Session construction and shared-folder handling."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every gridlens job assumes.  Timestamps in the data are
# zone-less (timestamp_ntz); UTC keeps the few zone-aware functions neutral.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Generated methods above 8000 bytecodes are never JIT-compiled by HotSpot;
    # fall back to per-expression codegen instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "gridlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def setting(spark: SparkSession, name: str, default: int) -> int:
    """Integer tuning knob from the session configuration (``spark.gridlens.<name>``):
    broadcastLimitBytes, bucketTargetRows, quantileHotRows."""
    try:
        v = spark.conf.get(f"spark.gridlens.{name}", None)
    except Exception:  # noqa: BLE001
        v = None
    return int(v) if v else default


def default_parallelism(spark: SparkSession) -> int:
    """Cores available to the session (falls back to configuration values when
    the session exposes no SparkContext, e.g. a Spark Connect client)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        for k in ("spark.default.parallelism", "spark.sql.shuffle.partitions"):
            v = spark.conf.get(k, None)
            if v:
                return int(v)
        return 8


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system), and it must name one.  Only a local session without it gets
    a fresh scratch folder, removed when Python ends.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no SparkContext on this client)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="gridlens-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001  (static on some deployments; the context setting below suffices)
            pass
    if sc is None:
        return d
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialised(df, name: str):
    """``df`` written once to the shared folder and read back: computed once, no lineage to redo."""
    path = scratch_path(df.sparkSession, name)
    if path.startswith("/") and df.sparkSession.sparkContext.master.startswith("local"):
        path = "file://" + path
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
