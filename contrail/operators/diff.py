"""Differences of two versions of a table that joins only what differs.

Both versions are reduced to one checksum for each bucket of keys (a partial
aggregate, so a scan and a row per bucket and task); only buckets whose
checksums differ are joined row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.plans.joins import bounded_broadcast

BUCKETS = 4096


def checksum(columns: list[str]) -> list[Column]:
    """Order-independent: the number of rows, and xor and sum of their 64-bit hashes (a
    second hash seeds the sum, so repeated rows do not cancel out)."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    second = F.xxhash64(h, F.hash(*[F.col(c) for c in columns]))
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(second.cast("decimal(38,0)")).alias("s")]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def unequal_buckets(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The buckets of ``key`` whose rows are not the same in both versions (column ``_b``)."""
    columns = sorted(old.columns)
    sides = [df.groupBy(bucket_of(key, buckets).alias("_b")).agg(*checksum(columns))
             .select("_b", F.struct("n", "x", "s").alias(f"_{name}")) for name, df in (("old", old), ("new", new))]
    return sides[0].join(sides[1], "_b", "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("_b")


def pruned_diff(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys added, removed or changed (NULL-safe) between two versions with one row
    for each key. Only rows of unequal buckets are shuffled and joined; that equal
    checksums mean equal rows holds up to a collision of 128 hashed bits."""
    differ = bounded_broadcast(unequal_buckets(old, new, key, buckets), buckets)
    columns = [c for c in old.columns if c != key]

    def rows(df: DataFrame, name: str) -> DataFrame:
        some = df.withColumn("_b", bucket_of(key, buckets)).join(differ, "_b", "left_semi")
        return some.select(F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(f"_{name}"))

    both = rows(old, "old").join(rows(new, "new"), F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    kind = (F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
            .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
    return both.select(F.coalesce("_old_key", "_new_key").alias(key), kind.alias("change_type")).filter("change_type IS NOT NULL")
