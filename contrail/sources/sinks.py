"""Sinks: staging Parquet, load-by-name, table writes, partition replace, layout.

Every write goes to shared storage. A write replaces the partitions present in
the new data (dynamic partition overwrite); a load of a whole range also removes
the range's partitions that get no rows, so a re-run leaves just its own result.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.session import delete_path, glob_paths

# Upper bound on rows per written file (keeps files splittable when one
# partition value is hot).
MAX_RECORDS_PER_FILE = 5_000_000


def write_staging_parquet(df: DataFrame, path: str) -> None:
    """Snappy Parquet staging write."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def align_by_name(df: DataFrame, target: StructType) -> DataFrame:
    """Match columns to a target schema by name, case-insensitively: missing
    columns become typed NULLs, extra columns are dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in target.fields:
        src = by_lower.get(f.name.lower())
        c = F.col(f"`{src}`").cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_by_name(df: DataFrame, target_path: str, target: StructType,
                 partition_by: list[str] | None = None) -> int:
    """Append ``df`` to the target after aligning by name; returns rows loaded
    (observed during the write, not by a second scan).

    With ``partition_by`` the write replaces only the partitions present in
    ``df`` (dynamic overwrite), which makes re-running a load idempotent.
    """
    obs = Observation("rows_loaded")
    aligned = align_by_name(df, target).observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        write_partitioned(aligned, target_path, partition_by)
    else:
        aligned.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE) \
            .mode("append").parquet(target_path)
    return int(obs.get["rows"])


def write_table(df: DataFrame, table: str, path: str, mode: str = "append",
                fmt: str = "parquet") -> None:
    """Catalog table write (append/overwrite), stored at ``path`` in shared storage."""
    df.write.mode(mode).format(fmt).option("path", path).saveAsTable(table)


def partition_layout(df: DataFrame, partition_by: list[str], sort_by: list[str] | None = None) -> DataFrame:
    """Rows arranged for a partitioned write.

    Range partitioning on (partition columns, row hash) gives each task a
    contiguous run of partition values, so the file count is about tasks +
    partition values instead of tasks x values, and the row hash splits a hot
    partition value over several tasks instead of funnelling it into one.
    Sorting inside the task keeps one file open at a time; ``sort_by`` orders
    the rows of a partition further, so file statistics prune on it.
    """
    keys = [F.col(c) for c in partition_by]
    return (df.repartitionByRange(*keys, F.xxhash64(*[F.col(c) for c in df.columns]))
            .sortWithinPartitions(*partition_by, *(sort_by or [])))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      sort_by: list[str] | None = None) -> None:
    """Partitioned lake write replacing only the partitions present in ``df``
    (dynamic partition overwrite): re-running a load is idempotent."""
    (partition_layout(df, partition_by, sort_by).write
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").partitionBy(*partition_by).parquet(path))


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], covered: Callable[[str], bool],
                       sort_by: list[str] | None = None) -> None:
    """Partitioned write of all rows of a range of the first partition column:
    partitions of that range that get no rows are removed. ``covered`` tells by
    a first-column value (as text) whether it is in the range. New partitions
    are written before stale ones go, so a failed run loses nothing."""
    spark = df.sparkSession
    before = glob_paths(spark, "/".join([path.rstrip("/"), *(f"{c}=*" for c in partition_by)]))
    df = df.persist()
    try:
        write_partitioned(df, path, partition_by, sort_by)
        # one row per partition of the range
        kept = {tuple("__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in r)
                for r in df.select(*partition_by).distinct().collect()}
    finally:
        df.unpersist()
    for old in before:
        values = tuple(unquote(part.split("=", 1)[1]) for part in old.split("/")[-len(partition_by):])
        if covered(values[0]) and values not in kept:
            delete_path(spark, old)


def write_clustered(df: DataFrame, path: str, keys: list[str],
                    num_partitions: int | None = None) -> None:
    """Clustered layout: range partitioning on the keys plus a sort inside each
    file, so file min/max statistics prune well on the leading keys."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def zorder(df: DataFrame, keys: list[str], bits: int = 8) -> Column:
    """The rows' place on a Z-curve over the ranks of ``keys``: each column's value becomes one
    of ``2^bits`` rank buckets (by approximate quantiles, so skewed columns are cut
    evenly; nulls come first), and the buckets' bits are interleaved."""
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(F.col(c), cuts, 10_000).alias(c) for c in keys]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(keys):
        steps = sorted(set(bounds[c] or []))
        rank = F.lit(0)
        if steps:
            # the number of bounds at or below the value, found by halving
            rank = _bounds_below(F.col(c), steps, 0, len(steps))
        rank = F.coalesce(rank, F.lit(0)).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(keys) + i))
    return place


def _bounds_below(value: Column, steps: list, lo: int, hi: int) -> Column:
    if lo == hi:
        return F.when(value.isNotNull(), F.lit(lo))
    mid = (lo + hi) // 2
    return F.when(value < F.lit(steps[mid]), _bounds_below(value, steps, lo, mid)) \
        .otherwise(_bounds_below(value, steps, mid + 1, hi))


def write_zordered(df: DataFrame, path: str, keys: list[str], num_partitions: int | None = None, bits: int = 6) -> None:
    """Layout clustered on several numeric columns alike: a filter on any of ``keys`` skips
    files by their statistics, where a linear sort helps its first column alone."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_z", zorder(df, keys, bits))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])   # cuts a place that many rows share
    placed.repartitionByRange(n, "_z", spread).sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """Catalog table bucketed and sorted on the join keys: two tables bucketed
    the same way join without a shuffle on either side (co-located join)."""
    (df.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def write_with_bloom(df: DataFrame, path: str, columns: list[str], fpp: float = 0.01) -> None:
    """Parquet with bloom filters on equality-lookup columns."""
    w = df.write.mode("overwrite")
    for c in columns:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true") \
             .option(f"parquet.bloom.filter.fpp#{c}", str(fpp))
    w.parquet(path)


def point_lookup(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Equality lookup; the predicate reaches the scan (row groups skipped by
    min/max and bloom filters)."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(value))
