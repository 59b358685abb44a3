"""Session construction and shared-storage helpers.

Every job reads the checkpoint root from the session (``spark.checkpoint.dir``
or the SparkContext checkpoint dir). Only a ``local[...]`` master without one
gets a temporary folder; any other master without one is an error, so on a
cluster all staging and lineage cuts land on the shared filesystem it names.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets. AQE re-plans joins and coalesces partitions at
# runtime; skew-join splits hot partitions; UTC makes timestamps comparable
# with the SQL oracle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints (global ordering) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(master: str | None = None, app: str = "contrail",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, mode: str = "batch") -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``mode="streaming"`` also sets a default checkpoint location for stream
    queries under the shared checkpoint root.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    root = checkpoint_root(spark)
    if mode == "streaming" and not spark.conf.get("spark.sql.streaming.checkpointLocation", None):
        spark.conf.set("spark.sql.streaming.checkpointLocation", f"{root}/streaming")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Reads ``spark.checkpoint.dir`` (or an already-set SparkContext checkpoint
    dir). A ``local[...]`` session without one, as in tests, gets a private
    folder; on any other master a missing setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir is not set on master {sc.master}: a shared folder is needed")
        configured = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([root, "contrail", *leaf])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on the path's own filesystem (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, on the pattern's own filesystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in found or []]


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
