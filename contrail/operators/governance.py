"""Row access, column masks by tag, PII tag reports, run-log reporting.

Access rules become plain DataFrame operations: a row policy is a left semi
join with the user's entitlements; column masks are projections chosen by a
column's PII tag (kept in the schema's field metadata).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

from contrail.functions import masking as M

TAG_KEY = "pii_sensitivity"
# Allowed tag values, and the tagged columns.
TAG_VALUES = ("HIGH", "MEDIUM", "LOW", "NONE")
PII_TAGS = {
    "dim_passenger": {"email": "HIGH", "phone": "HIGH", "dob": "MEDIUM"},
    "fact_reservation": {"total_fare": "LOW"},
}
# Which mask a tagged column uses.
MASK_BY_COLUMN = {"email": M.mask_email, "phone": M.mask_phone, "dob": M.mask_dob,
                  "total_fare": M.mask_fare}


def row_access_filter(fact: DataFrame, entitlements: DataFrame, user: str, role: str,
                      code_col: str = "airline_code") -> DataFrame:
    """Privileged roles see every row; other users only the airlines they are
    entitled to (EXISTS on the entitlement table -> left semi join on the
    airline code, the column the policy is about)."""
    if role in M.ALL_ROWS_ROLES:
        return fact
    ent = (entitlements.filter(F.col("username") == user)
           .select(F.col("airline_code").alias("_ent_code")).distinct())
    return fact.join(ent, F.col(code_col) == F.col("_ent_code"), "left_semi")


def tag_columns(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Attach PII tags as field metadata."""
    for col, level in tags.items():
        if level not in TAG_VALUES:
            raise ValueError(f"tag {level!r} not in {TAG_VALUES}")
        if col in df.columns:
            df = df.withMetadata(col, {TAG_KEY: level})
    return df


def tags_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG_KEY] for f in df.schema.fields if TAG_KEY in f.metadata}


def masked_view(df: DataFrame, role: str) -> DataFrame:
    """Apply the mask of every tagged column for ``role`` (untagged pass through)."""
    tags = tags_of(df)
    cols = []
    for c in df.columns:
        mask = MASK_BY_COLUMN.get(c) if c in tags else None
        cols.append(mask(F.col(c), role).alias(c) if mask else F.col(c))
    return df.select(*cols)


def tag_report(df: DataFrame, table: str) -> DataFrame:
    """One row per tagged column: tag and how many rows carry a value (one
    aggregate pass over the data, reshaped with ``stack``)."""
    tags = tags_of(df)
    if not tags:
        raise ValueError(f"{table} has no tagged columns")
    wide = df.agg(*[F.count(F.col(c)).alias(f"{c}__n") for c in tags])
    parts = []
    for c, level in tags.items():
        parts += [f"'{c}'", f"'{level}'", f"`{c}__n`"]
    return (wide.selectExpr(f"stack({len(tags)}, {', '.join(parts)}) AS (column_name, tag_value, values_present)")
            .select(F.lit(table).alias("table_name"), "*"))


def with_keys(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Surrogate keys for the natural codes of cleaned flights (-1: unknown code):
    ``airline`` and ``aircraft`` are dimensions with code and key."""
    from contrail.operators.scd import resolve_key
    for name, code in (("airline", "airline_code"), ("aircraft", "tail_number")):
        if name in dims:
            clean = resolve_key(clean, code, dims[name], code, f"{name}_key", f"{name}_key")
    return clean


RUN_LOG_SCHEMA = StructType([
    StructField("run_ts", TimestampType()), StructField("process_date", DateType()),
    StructField("status", StringType()), StructField("rows_loaded", LongType()),
    StructField("elapsed_sec", DoubleType()), StructField("error_msg", StringType()),
])


def run_log_entries(per_date: DataFrame, run_ts: datetime, status: str, elapsed_sec: float,
                    error_msg: str | None = None, date_col: str = "process_date",
                    count_col: str = "rows_loaded") -> DataFrame:
    """Log rows (one per processed date) from a per-date count frame."""
    return per_date.select(F.lit(run_ts).alias("run_ts"), F.col(date_col).alias("process_date"),
                           F.lit(status).alias("status"), F.col(count_col).cast("long").alias("rows_loaded"),
                           F.lit(float(elapsed_sec)).alias("elapsed_sec"),
                           F.lit(error_msg).cast("string").alias("error_msg"))


def append_run_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def run_log_report(spark: SparkSession, path: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """Runs of the last ``hours`` with a non-empty status, most expensive first."""
    since = as_of - timedelta(hours=hours)
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return (log.filter((F.col("run_ts") > F.lit(since)) & (F.col("status") != ""))
            .orderBy(F.col("elapsed_sec").desc(), F.col("rows_loaded").desc(), "process_date"))
