"""Global order without a single-task window.

``Window.orderBy(...)`` with no PARTITION BY moves every row into one task.
Likewise a window partitioned by a hot key (one aircraft holding a third of
all legs) sorts that key in one task. Here the order is computed the way a
distributed sort does it:

1. ``repartitionByRange`` on the full order (ending in a unique key), so a hot
   key is split across many partitions by its secondary sort columns;
2. ``sortWithinPartitions`` + ``monotonically_increasing_id`` give each row its
   position inside its partition;
3. per-partition row counts (one row per partition -- bounded by the partition
   count, not the data) are turned into offsets and broadcast back.

The result is a dense 0-based index equal to ``row_number() - 1`` of the plain
window. NTILE, successor ("next leg") and global row numbers are derived from
it with equi-joins on a unique key, so no step depends on key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.plans.joins import bounded_broadcast
from contrail.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition << 33) + row


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_index(df: DataFrame, order: list[Column | str], index_col: str = "_rn",
                 num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """Add a dense 0-based position in ``order`` (which must be a total order).

    ``total_col`` also attaches the overall row count (from the same
    per-partition counts, so no extra pass and no cross join).
    """
    n = _num_partitions(df, num_partitions)
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges adjacent ones, so partition ids still follow the global order.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions \
        else df.repartitionByRange(*order)
    s = (ranged
         .sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_local", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("long"), _LOCAL_BITS)))
    # Range bounds come from sampling, whose result depends on the order
    # shuffle blocks arrive in; two plan instances could disagree. A reliable
    # checkpoint fixes one layout that both the counts and the rows read, and
    # that a lost executor's tasks recompute from.
    s = cut_lineage(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_cnt").over(Window.partitionBy()).alias(total_col)] if total_col else []
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
                            *extra)
    return (s.join(bounded_broadcast(offsets, n), "_pid")
            .withColumn(index_col, F.col("_off") + F.col("_local"))
            .drop("_pid", "_local", "_off"))


def ntile_from_index(rn: Column, total: Column, k: int) -> Column:
    """NTILE(k) of a 0-based position among ``total`` rows (SQL semantics:
    the first ``total % k`` buckets hold one extra row)."""
    q = F.floor(total / k).cast("long")
    r = (total % k).cast("long")
    big = r * (q + 1)
    return F.when(rn < big, F.floor(rn / (q + 1)) + 1) \
        .otherwise(r + F.floor((rn - big) / F.greatest(q, F.lit(1))) + 1).cast("int")


def distributed_ntile(df: DataFrame, k: int, order: list[Column | str], out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` without a single-partition window."""
    idx = global_index(df, order, "_nt_rn", num_partitions, total_col="_nt_total")
    return (idx.withColumn(out, ntile_from_index(F.col("_nt_rn"), F.col("_nt_total"), k))
            .drop("_nt_rn", "_nt_total"))


def successor(df: DataFrame, partition_cols: list[str], order: list[Column | str],
              key: str, carry: list[str], prefix: str = "next_",
              num_partitions: int | None = None) -> DataFrame:
    """``LEAD`` of ``key`` and ``carry`` columns within ``partition_cols``.

    Equivalent to ``lead(c) OVER (PARTITION BY p ORDER BY o)`` but a hot
    partition value is spread over range partitions; the next row is found
    by an equi-join on the dense index.
    """
    order_all = [*partition_cols, *order]
    idx = global_index(df, order_all, "_sx_rn", num_partitions)
    nxt = idx.select((F.col("_sx_rn") - 1).alias("_sx_rn"),
                     *[F.col(p).alias(f"_sx_{p}") for p in partition_cols],
                     F.col(key).alias(f"{prefix}{key}"),
                     *[F.col(c).alias(f"{prefix}{c}") for c in carry])
    joined = idx.join(nxt, "_sx_rn", "left")
    same = None
    for p in partition_cols:
        cond = F.col(p).eqNullSafe(F.col(f"_sx_{p}"))
        same = cond if same is None else same & cond
    out_cols = [f"{prefix}{key}", *[f"{prefix}{c}" for c in carry]]
    return joined.select(
        *[c for c in df.columns],
        *[F.when(same, F.col(c)).alias(c) for c in out_cols])
