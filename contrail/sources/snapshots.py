"""Versioned snapshots: read as of a time, restore deleted rows, diff versions.

Plain Parquet has no time travel, so a table is a set of versions
``<root>/v=<n>`` plus a manifest of ``(version, commit_ts)`` rows. A read as
of time T resolves the newest version committed at or before T; only that
version number (a scalar) passes through the driver.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import path_exists

class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest"

    def _manifest(self) -> DataFrame | None:
        if not path_exists(self.spark, self.manifest_path):
            return None  # no commit yet
        return self.spark.read.parquet(self.manifest_path)

    def latest_version(self) -> int:
        m = self._manifest()
        if m is None:
            return 0
        return m.agg(F.max("version")).first()[0] or 0

    def commit(self, df: DataFrame, commit_ts: str | datetime,
               partition_by: list[str] | None = None) -> int:
        """Write a new version (never over one that may be read) and record it."""
        v = self.latest_version() + 1
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/v={v}")
        ts = commit_ts if isinstance(commit_ts, datetime) else datetime.fromisoformat(commit_ts)
        (self.spark.range(1).select(F.lit(v).alias("version"),
                                    F.lit(ts).cast("timestamp_ntz").alias("commit_ts"))
         .write.mode("append").parquet(self.manifest_path))
        return v

    def version_as_of(self, ts: str | datetime) -> int:
        t = ts if isinstance(ts, datetime) else datetime.fromisoformat(ts)
        m = self._manifest()
        v = m.filter(F.col("commit_ts") <= F.lit(t).cast("timestamp_ntz")).agg(F.max("version")).first()[0]
        if v is None:
            raise ValueError(f"no version committed at or before {t}")
        return v

    def read_version(self, v: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v={v}")

    def read_current(self) -> DataFrame:
        return self.read_version(self.latest_version())

    def read_as_of(self, ts: str | datetime) -> DataFrame:
        return self.read_version(self.version_as_of(ts))

    def read_at_offset(self, now: str | datetime, offset_seconds: int) -> DataFrame:
        """``AT (OFFSET => -n)``: as of ``now`` shifted by ``offset_seconds``."""
        t = now if isinstance(now, datetime) else datetime.fromisoformat(now)
        return self.read_as_of(t + timedelta(seconds=offset_seconds))


def deleted_rows(old: DataFrame, current: DataFrame, predicate=None) -> DataFrame:
    """``old [WHERE p] MINUS current [WHERE p]`` (distinct, NULL-safe)."""
    if predicate is not None:
        old, current = old.filter(predicate), current.filter(predicate)
    return old.subtract(current.select(*old.columns))


def restore_deleted(table: SnapshotTable, as_of: str | datetime, predicate,
                    commit_ts: str | datetime) -> DataFrame:
    """Re-insert rows present in the version as of ``as_of`` but missing now
    (restricted by ``predicate``); commits the result as a new version."""
    cur = table.read_current()
    gone = deleted_rows(table.read_as_of(as_of), cur, predicate)
    table.commit(cur.unionByName(gone), commit_ts)
    return table.read_current()


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows added, removed or changed between two versions (full outer join on
    the key; change = any NULL-safe difference in the other columns)."""
    cols = [c for c in old.columns if c != key]
    o = old.select(F.col(key).alias("_o_key"), F.struct(*cols).alias("_o"))
    n = new.select(F.col(key).alias("_n_key"), F.struct(*cols).alias("_n"))
    j = o.join(n, F.col("_o_key") == F.col("_n_key"), "full_outer")
    kind = (F.when(F.col("_o_key").isNull(), "added")
            .when(F.col("_n_key").isNull(), "removed")
            .when(~F.col("_o").eqNullSafe(F.col("_n")), "changed"))
    return (j.select(F.coalesce("_o_key", "_n_key").alias(key), kind.alias("change_type"))
            .filter(F.col("change_type").isNotNull()))
