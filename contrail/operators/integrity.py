"""Declared-constraint checks (Spark does not enforce them on Parquet).

Each check is a grouped aggregate or an anti join; reports are long-form
DataFrames that grow with the number of violations, not with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_text(cols: list[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def unique_violations(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Keys occurring more than once (PRIMARY KEY / UNIQUE)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1)
            .select(F.lit(check).alias("check_name"), _key_text(keys).alias("key_value"),
                    "dup_count"))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column DEFAULTs applied to NULLs (``coalesce``)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()
                           if c in df.columns})


def column_report(df: DataFrame, table: str, rules: list[tuple[str, bool, int | None]]) -> DataFrame:
    """NOT NULL and length checks for ``(column, not_null, max_len)`` rules.

    One aggregate pass computes every count; ``stack`` turns it into one row
    per column.
    """
    aggs = []
    for col, _, max_len in rules:
        aggs.append(F.count_if(F.col(col).isNull()).alias(f"{col}__nulls"))
        too_long = F.length(F.col(col).cast("string")) > max_len if max_len else F.lit(False)
        aggs.append(F.count_if(too_long).alias(f"{col}__long"))
    wide = df.agg(*aggs)
    n = len(rules)
    parts = []
    for col, not_null, _ in rules:
        parts += [f"'{col}'", "true" if not_null else "false", f"`{col}__nulls`", f"`{col}__long`"]
    long = wide.selectExpr(
        f"stack({n}, {', '.join(parts)}) AS (column_name, not_null_required, null_count, too_long_count)")
    return long.select(F.lit(table).alias("table_name"), "*") \
        .withColumn("violations",
                    F.when(F.col("not_null_required"), F.col("null_count")).otherwise(F.lit(0))
                    + F.col("too_long_count"))


def fk_orphans_multi(fact: DataFrame, checks: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """All foreign keys of one fact checked in a single pass over the fact.

    ``checks`` holds ``(fk column, dimension, dimension key, check name)``.
    The fact's FK columns are projected once and left-joined to each
    dimension's distinct keys (small dimensions become broadcast joins), an
    orphan flag per FK is unpivoted, and orphans are counted per (check, key).
    """
    f = fact.select(*dict.fromkeys(fk for fk, _, _, _ in checks))
    flags = []
    for i, (fk, dim, dim_key, name) in enumerate(checks):
        d = dim.select(F.col(dim_key).alias(f"_fk_{i}")).distinct()
        f = f.join(d, F.col(fk) == F.col(f"_fk_{i}"), "left")
        orphan = F.col(fk).isNotNull() & F.col(f"_fk_{i}").isNull()
        flags.append(F.when(orphan, F.struct(F.lit(name).alias("fk_name"),
                                             F.col(fk).cast("string").alias("key_value"))))
    return (f.select(F.explode(F.array(*flags)).alias("_o")).filter(F.col("_o").isNotNull())
            .groupBy("_o.fk_name", "_o.key_value").agg(F.count(F.lit(1)).alias("orphan_rows")))


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Foreign-key values with no dimension row (left anti join), with counts."""
    d = dim.select(F.col(dim_key).alias("__k")).distinct()
    return (fact.select(fk).filter(F.col(fk).isNotNull())
            .join(d, F.col(fk) == F.col("__k"), "left_anti")
            .groupBy(fk).agg(F.count(F.lit(1)).alias("orphan_rows"))
            .select(F.lit(name).alias("fk_name"), F.col(fk).cast("string").alias("key_value"),
                    "orphan_rows"))
