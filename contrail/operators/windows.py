"""Window operators.

Partitioned windows run after an aggregate, so each window partition is a
bounded group (an airline's months, an airport-day's 24 hours). Windows with
no PARTITION BY over data that grows with the input go through
``plans.ranking`` instead of a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.plans.ranking import distributed_ntile, global_index

UNBOUNDED = Window.unboundedPreceding
# Rows of the global index that one window task sorts at a time.
FRAME_BLOCK = 1 << 17


def running_sum(df: DataFrame, value: str, partition: list[str], order: list[str],
                out: str) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(UNBOUNDED, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def lag_of(df: DataFrame, value: str, partition: list[str], order: list[str], out: str,
           offset: int = 1) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.lag(value, offset).over(w))


def change_vs_previous(df: DataFrame, value: str, partition: list[str], order: list[str],
                       out: str) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.col(value) - F.lag(value, 1).over(w))


def rank_by(df: DataFrame, partition: list[str], order: list[Column], out: str,
            dense: bool = False) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, (F.dense_rank() if dense else F.rank()).over(w))


def ntile(df: DataFrame, k: int, order: list[Column], out: str,
          distributed: bool = True) -> DataFrame:
    """NTILE(k) over the whole frame; ``order`` must end in a unique key."""
    if distributed:
        return distributed_ntile(df, k, order, out)
    return df.withColumn(out, F.ntile(k).over(Window.orderBy(*order)))


def percent_rank_global(df: DataFrame, order_col: str, out: str, descending: bool = True,
                        distributed: bool = True, values: DataFrame | None = None) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY order_col [DESC]) = (rank - 1) / (n - 1).

    Distributed form: rank = 1 + number of rows strictly before the value's
    first position; computed from the dense index, then joined back on the
    value (a partial aggregate per distinct value, so a hot value is one row).
    ``values`` may give the column's rows from where they are cheaper to read.
    """
    o = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    if not distributed:
        return df.withColumn(out, F.percent_rank().over(Window.orderBy(o)))
    idx = global_index(df.select(order_col) if values is None else values, [o], "_pr_rn", total_col="_pr_n")
    first = idx.groupBy(order_col).agg(F.min("_pr_rn").alias("_pr_first"),
                                       F.first("_pr_n").alias("_pr_n"))
    pr = F.when(F.col("_pr_n") <= 1, F.lit(0.0)).otherwise(
        F.col("_pr_first") / (F.col("_pr_n") - 1))
    first = first.withColumnRenamed(order_col, "_pr_k")
    return (df.join(first, F.col(order_col).eqNullSafe(F.col("_pr_k")), "left")
            .withColumn(out, pr).drop("_pr_k", "_pr_first", "_pr_n"))


def moving_avg(df: DataFrame, value: str, order: list[Column], before: int, after: int,
               out: str, partition: list[str] | None = None,
               distributed: bool = False) -> DataFrame:
    """ROWS frame average; ``distributed=True`` avoids the single-task window
    (``order`` must then be total)."""
    if distributed:
        return rows_frame_avg(df, value, partition or [], order, before, out, after=after)
    w = Window.partitionBy(*(partition or [])).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(out, F.avg(value).over(w))


def trailing_avg_excluding_current(df: DataFrame, value: str, partition: list[str],
                                   order: list[str], rows: int, out: str) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-rows, -1)
    return df.withColumn(out, F.avg(value).over(w))


def partition_max(df: DataFrame, value: str, partition: list[str], out: str) -> DataFrame:
    return df.withColumn(out, F.max(value).over(Window.partitionBy(*partition)))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key (ROW_NUMBER() = 1 of
    the descending order); rows with equal ``order`` by their other columns, so
    the result does not depend on the input's order.

    Written as a grouped ``max_by`` over a struct so the reduction is a
    partial aggregate: a hot key is pre-reduced on every task instead of being
    sorted in one.
    """
    others = [c for c in df.columns if c not in keys]
    tie = F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0)
    order_struct = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], tie.alias("tie"))
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order_struct).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]))


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    out: str = "row_num", key: list[str] | None = None,
                    order_cols: list[str] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order) <= n`` for groups
    of any size: a global index in (group, order) order, minus the group's
    first position (a partial ``min`` per group) is the row number. ``order``
    must make the order within a group total.

    With ``key`` (unique row key) and ``order_cols`` (the columns ``order``
    reads) the ranking runs on those narrow columns only and just the
    winning rows are joined back to the full rows.
    """
    if key is not None:
        narrow = df.select(*dict.fromkeys([*group, *(order_cols or []), *key]))
        top = top_n_per_group(narrow, group, order, n, out)
        top = top.select(*[F.col(k).alias(f"_tk_{k}") for k in key], out)
        cond = [F.col(k).eqNullSafe(F.col(f"_tk_{k}")) for k in key]
        return df.join(top, cond).select(*df.columns, out)
    idx = global_index(df, [*[F.col(g) for g in group], *order], "_tn_rn")
    first = (idx.groupBy(*group).agg(F.min("_tn_rn").alias("_tn_first"))
             .withColumnsRenamed({g: f"_tn_g_{g}" for g in group}))
    cond = [F.col(g).eqNullSafe(F.col(f"_tn_g_{g}")) for g in group]
    ranked = idx.join(first, cond).withColumn(out, (F.col("_tn_rn") - F.col("_tn_first") + 1).cast("int"))
    return ranked.filter(F.col(out) <= n).select(*df.columns, out)


def rows_frame_avg(df: DataFrame, value: str, partition: list[str], order: list,
                   before: int, out: str, after: int = 0, key: list[str] | None = None) -> DataFrame:
    """``avg(value) OVER (PARTITION BY p ORDER BY o ROWS BETWEEN before PRECEDING
    AND after FOLLOWING)`` without sorting a hot (or the whole) partition in
    one task; ``partition`` may be empty.

    Rows get a dense index in (partition, order) order (range partitioned, see
    plans.ranking), which is cut into blocks of ``FRAME_BLOCK`` rows. Only the
    ``before`` last and ``after`` first rows of a block are copied to its
    neighbour, and one plain window runs per block, so no task sorts more than
    a block of a hot partition. ``order`` must make the order total.

    With ``key`` (unique row key columns; ``order`` given as names) only the
    partition, order, key and value columns are indexed and the result is
    joined back to the full rows once, so wide rows are neither checkpointed
    nor shuffled twice.
    """
    if key is not None:
        narrow = df.select(*dict.fromkeys([*partition, *order, *key, value]))
        res = rows_frame_avg(narrow, value, partition, order, before, out, after)
        res = res.select(*[F.col(k).alias(f"_rk_{k}") for k in key], out)
        cond = [F.col(k).eqNullSafe(F.col(f"_rk_{k}")) for k in key]
        return df.join(res, cond, "left").select(*df.columns, out)
    idx = global_index(df, [*partition, *order], "_rf_rn")
    size = max(FRAME_BLOCK, before, after, 1)
    own = F.floor(F.col("_rf_rn") / size)
    needed = F.array_distinct(F.array(own, F.floor((F.col("_rf_rn") + before) / size),
                                      F.floor((F.col("_rf_rn") - after) / size)))
    w = Window.partitionBy("_rf_b", *partition).orderBy("_rf_rn").rowsBetween(-before, after)
    return (idx.withColumn("_rf_b", F.explode(needed))
            .withColumn(out, F.avg(value).over(w))
            .filter(F.col("_rf_b") == own).select(*df.columns, out))


def day_range_avg(df: DataFrame, value: str, partition: list[str], day: str, days_before: int,
                  out: str) -> DataFrame:
    """``avg(value) OVER (PARTITION BY p ORDER BY day RANGE BETWEEN d PRECEDING AND
    CURRENT ROW)`` with ``day`` a DATE.

    A RANGE frame includes every peer of the current day, so per-(partition,
    day) sums and counts are exact inputs: the window then runs over one row
    per day (bounded by the calendar, whatever the skew) and the result is
    joined back by (partition, day).
    """
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    daily = (df.groupBy(*partition, day)
             .agg(F.sum(value).alias("_dr_s"), F.count(value).alias("_dr_n"))
             .withColumn("_dr_d", dn))
    w = Window.partitionBy(*partition).orderBy("_dr_d").rangeBetween(-days_before, 0)
    keys = [*partition, day]
    daily = daily.select(*[F.col(c).alias(f"_dr_k_{c}") for c in keys],
                         (F.sum("_dr_s").over(w) / F.sum("_dr_n").over(w)).alias(out))
    cond = [F.col(c).eqNullSafe(F.col(f"_dr_k_{c}")) for c in keys]
    return df.join(daily, cond, "left").select(*df.columns, out)


def partition_percent_rank(df: DataFrame, value: str, partition: list[str], out: str,
                           bounded_values: bool = True, tiebreak: str | None = None) -> DataFrame:
    """``percent_rank() OVER (PARTITION BY p ORDER BY value)`` (NULLs first).

    rank = 1 + rows of the partition ordered before the value, n = partition
    size. With ``bounded_values`` (values from a small domain, such as delay
    minutes) both come from a partial aggregate per (partition, value), so a
    hot partition contributes one row per distinct value to a window.
    Otherwise (continuous values) the global index over (partition, value,
    ``tiebreak`` unique column) gives rank - 1 = first position of the
    (partition, value) pair - first position of the partition, with no window
    at all.
    """
    if not bounded_values:
        if tiebreak is None:
            raise ValueError("a unique tiebreak column is needed when values are unbounded")
        o = [*[F.col(p) for p in partition], F.col(value).asc_nulls_first(), F.col(tiebreak)]
        idx = global_index(df, o, "_pr_rn")
        per_part = (idx.groupBy(*partition).agg(F.min("_pr_rn").alias("_pr_p0"),
                                                 F.count(F.lit(1)).alias("_pr_n"))
                    .withColumnsRenamed({p: f"_pr_pk_{p}" for p in partition}))
        per_val = (idx.groupBy(*partition, value).agg(F.min("_pr_rn").alias("_pr_v0"))
                   .withColumnsRenamed({c: f"_pr_vk_{c}" for c in [*partition, value]}))
        j = (idx.join(per_part, [F.col(p).eqNullSafe(F.col(f"_pr_pk_{p}")) for p in partition])
             .join(per_val, [F.col(c).eqNullSafe(F.col(f"_pr_vk_{c}")) for c in [*partition, value]]))
        pr = F.when(F.col("_pr_n") <= 1, F.lit(0.0)).otherwise(
            (F.col("_pr_v0") - F.col("_pr_p0")) / (F.col("_pr_n") - 1))
        return j.select(*df.columns, pr.alias(out))
    per_value = df.groupBy(*partition, value).agg(F.count(F.lit(1)).alias("_pr_c"))
    w_before = (Window.partitionBy(*partition).orderBy(F.col(value).asc_nulls_first())
                .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*partition)
    ranked = per_value.select(
        *partition, value,
        F.coalesce(F.sum("_pr_c").over(w_before), F.lit(0)).alias("_pr_before"),
        F.sum("_pr_c").over(w_all).alias("_pr_n"))
    pr = F.when(F.col("_pr_n") <= 1, F.lit(0.0)).otherwise(
        F.col("_pr_before") / (F.col("_pr_n") - 1))
    keys = [*partition, value]
    ranked = ranked.select(*[F.col(c).alias(f"_pr_k_{c}") for c in keys], pr.alias(out))
    cond = [F.col(c).eqNullSafe(F.col(f"_pr_k_{c}")) for c in keys]
    return df.join(ranked, cond, "left").select(*df.columns, out)
