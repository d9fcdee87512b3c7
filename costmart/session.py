"""Session settings shared by tests, bench and the driver entry.

The library itself never creates a session: every public function takes
DataFrames (or a session) from the caller. These helpers only pin the
settings the semantics depend on (UTC, ANSI with ``try_*`` casts, AQE with
skew-join splitting) for local runs.
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run relies on. Cluster deployments should keep these and size
# shuffle partitions / file split size to their data (see README "Scale").
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition 4x the median and above 64 MB counts as skewed and is split
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # shuffled bytes are compressed: 8 MB are up to some hundred MB in a task's hash maps and sorts
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # auto broadcast is Spark's own size check; keep it explicit so it is never -1.
    # Plan statistics are file sizes, compressed, shared out among the columns read:
    # 10 MB of sorted keys are 300 MB in the driver's hash table, so files decide only
    # where they are tiny. AQE re-checks with runtime sizes, which are those of the rows
    # themselves: a hash table of 4 MB of rows is some 12 MB, however large the tables
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "costmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and bench; a cluster passes its own master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("COSTMART_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Pin the semantic settings on a session created elsewhere (the driver's)."""
    for k, v in CORE_CONF.items():
        if k.startswith("spark.ui"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep theirs
            pass
    return spark


def size_shuffles(spark: SparkSession, folder: str, bytes_each: int = 4 << 20) -> int:
    """Deal shuffles of queries over ``folder`` into partitions by its size, ``shuffle.partitions``
    at least: AQE makes small ones one again, but can't split large ones. What a task holds
    then doesn't grow with the tables."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    total = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_each))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local master, where driver
    and executors are one process, gets one under the system temp folder when
    it is unset; any other master without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="costmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/costmart-scratch/{name}-{uuid.uuid4().hex}"


_held = threading.local()  # the scopes open in this thread: lists of folders written in each


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders that ``materialize`` writes inside are deleted at the end, but those written with
    ``keep``: they belong to the scope around this one, if there is one. For functions that
    end with a written result, which need nothing of what led to it."""
    scopes = _held.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_released(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is written, not when the driver
    happens to collect its garbage. For steps whose files would else lie beside those of the next."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def broadcast_up_to(df, most: int = 32 << 20):
    """``df`` with a broadcast hint if its rows take up to ``most`` bytes (a hash table of three times
    that), counted, not taken from file sizes; else, or with nested columns, as it is. For written lookup
    tables: without a hint, AQE learns of a small side only when the events are shuffled already."""
    from pyspark.sql import functions as F

    if any(f.dataType.typeName() in ("array", "map", "struct", "variant", "binary") for f in df.schema.fields):
        return df
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("string", "decimal")]
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    each = 8 + 8 * len(wide) + 24 * (len(df.columns) - len(wide))  # a word a column and one of null bits; 16 bytes for a decimal or a text's ends
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0))).first()
    return F.broadcast(df) if rows * each + text <= most else df


def materialize(df, name: str, keep: bool = False):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Lineage ends there, and the files' size is known to the planner: a small
    result is broadcast by Spark's own byte threshold, a large one is not.
    Inside a ``scratch_scope`` the folder goes with it unless ``keep`` is set.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scopes = _held.__dict__.get("scopes", [])
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
