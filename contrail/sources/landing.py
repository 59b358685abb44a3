"""Landing writers: put raw records in the shapes the readers consume.

Envelopes hold at most ``max_records`` records: a group's rows are cut by their
position in it, and only one cut's records are collected -- no group, however
hot or repetitive, is gathered into one unbounded array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.plans.ranking import global_index

# Per-request record limits of the source APIs.
FLIGHT_RECORDS_PER_REQUEST = 100_000
WEATHER_RESULTS_PER_REQUEST = 1000


def land_csv_by_month(df: DataFrame, path: str, date_col: str = "FlightDate", mode: str = "overwrite") -> None:
    """Monthly CSV folders (``month=YYYY_MM``), header row, all text; rows whose
    date is not ``yyyy-MM-dd`` go to the folder of no month."""
    from contrail.sources.sinks import partition_layout
    month = F.date_format(F.try_to_timestamp(F.col(date_col), F.lit("yyyy-MM-dd")), "yyyy_MM")
    (partition_layout(df.withColumn("month", month), ["month"])
     .write.mode(mode).option("header", True).partitionBy("month").csv(path))


def _bucketed(df: DataFrame, group_cols: list[str], max_records: int) -> DataFrame:
    """Rows with their bucket: their position in the group (from the global
    index, so equal rows are told apart) in steps of ``max_records``."""
    idx = global_index(df, [*group_cols, F.xxhash64(*[F.col(c) for c in df.columns])], "_at")
    first = idx.groupBy(*group_cols).agg(F.min("_at").alias("_first")) \
        .withColumnsRenamed({c: f"_g_{c}" for c in group_cols})
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]
    bucket = F.floor((F.col("_at") - F.col("_first")) / max_records)
    return idx.join(first, same).withColumn("_bucket", bucket).select(*df.columns, "_bucket")


def land_envelopes(df: DataFrame, path: str, group_cols: list[str], field: str,
                   max_records: int) -> None:
    """JSON lines ``{"<field>": [record, ...]}`` per group (bounded size)."""
    rec_cols = [c for c in df.columns]
    b = _bucketed(df, group_cols, max_records)
    env = (b.groupBy(*group_cols, "_bucket")
           .agg(F.collect_list(F.struct(*rec_cols)).alias(field))
           .select(field))
    env.write.mode("overwrite").json(path)


def land_per_key_json(df: DataFrame, path: str, key: str) -> None:
    """One folder per key value (``<key>=<value>``) of JSON objects."""
    df.write.mode("overwrite").partitionBy(key).json(path)
