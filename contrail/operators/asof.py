"""As-of join without a hot task: one timeline of facts and versions.

A range join on (key, date between) sends all facts and versions of one key to
one task. Here both go on one timeline in (key, time) order that is cut into
contiguous ranges, so a key with a third of all facts spans many tasks. In a
range a fact takes the last version before it; the last version of each range
is carried into the following ones (a table with one row per range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.plans.joins import bounded_broadcast
from contrail.session import cut_lineage


def asof_merge(facts: DataFrame, history: DataFrame, key: str, date_col: str, attrs: list[str],
               prefix: str = "", ranges: int | None = None) -> DataFrame:
    """Each fact with the ``attrs`` of its key's version in force on its date
    (``effective_date <= d < expiry_date``; the versions of a key do not
    overlap), null if there is none. Facts without a key or date match nothing.
    """
    spark = facts.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = F.struct(F.col(key).alias("key"), F.col("expiry_date").alias("until"), *[F.col(a).alias(f"a_{a}") for a in attrs])
    row = F.struct(*[F.col(c).alias(f"c_{c}") for c in facts.columns])
    starts = history.filter(F.col(key).isNotNull() & F.col("effective_date").isNotNull()).select(
        F.col(key).alias("_key"), F.col("effective_date").cast("timestamp").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"), version.alias("_version"))
    moments = facts.select(
        F.col(key).alias("_key"), F.col(date_col).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"),
        F.xxhash64(*[F.col(c) for c in facts.columns]).alias("_tie"), row.alias("_row"))
    order = ["_key", "_at", "_kind", "_tie"]   # a version comes before the facts of its first day
    line = starts.unionByName(moments, allowMissingColumns=True)
    # the hash cuts one key's facts of one day as well
    line = line.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    line = cut_lineage(line)   # counts of ranges and their rows must see one layout (see plans.ranking)

    last = line.filter(F.col("_kind") == 0).groupBy("_range").agg(F.max_by("_version", F.struct("_key", "_at")).alias("_last"))
    ids = spark.range(n).select(F.col("id").cast("int").alias("_range"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    carried = ids.join(last, "_range", "left").select("_range", F.last("_last", ignorenulls=True).over(before).alias("_carried"))

    so_far = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_kind") == 1)
    line = line.join(bounded_broadcast(carried, n), "_range", "left")
    v = F.coalesce(F.col("_version"), F.col("_carried"))
    line = line.withColumn("_v", v)
    holds = (F.col("_v.key") == F.col("_key")) & (F.col("_at") < F.col("_v.until").cast("timestamp"))
    return line.select(*[F.col(f"_row.c_{c}").alias(c) for c in facts.columns],
                       *[F.when(holds, F.col(f"_v.a_{a}")).alias(f"{prefix}{a}") for a in attrs])
