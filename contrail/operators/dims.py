"""Dimension builders: calendar, time of day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.dates import calendar_columns, time_of_day

DIM_DATE_COLUMNS = ["date_key", "full_date", "day_of_week", "day_name", "day_of_month",
                    "month_num", "month_name", "quarter", "year", "is_weekend",
                    "is_holiday", "season"]


def _calendar(days: DataFrame, holidays: DataFrame | None) -> DataFrame:
    cal = days.select(*[c.alias(n) for n, c in calendar_columns("full_date").items()])
    if holidays is None:
        cal = cal.withColumn("is_holiday", F.lit(None).cast("boolean"))
    else:
        h = holidays.select(F.col("holiday_date").alias("full_date")).distinct() \
            .withColumn("is_holiday", F.lit(True))
        cal = cal.join(h, "full_date", "left") \
            .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    return cal.select(*DIM_DATE_COLUMNS)


def build_date_dimension(spark: SparkSession, start: str, end: str,
                         holidays: DataFrame | None = None) -> DataFrame:
    """One row per day in ``[start, end]`` (inclusive)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date"))
    return _calendar(days, holidays)


def date_dimension_for(df: DataFrame, date_col: str,
                       holidays: DataFrame | None = None) -> DataFrame:
    """Calendar covering the date range present in ``df`` (one partial agg pass)."""
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                    F.max(F.col(date_col).cast("date")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return _calendar(days, holidays)


def data_range(*dated: tuple[DataFrame, str]) -> tuple[str, str] | None:
    """First and last day (ISO) of the given frames' date columns, None without any date."""
    both = None
    for df, col in dated:
        d = F.col(col).cast("date")
        own = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
        both = own if both is None else both.unionByName(own)
    r = both.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    return (r["lo"].isoformat(), r["hi"].isoformat()) if r["lo"] else None


def days_in_range(start: str, end: str) -> int:
    return (date.fromisoformat(end) - date.fromisoformat(start)).days + 1


def build_time_dimension(spark: SparkSession) -> DataFrame:
    """One row per minute of the day; ``time_key`` = HHMM as INT.

    TIME is kept as ``HH:mm`` text (Spark's TIME type is off by default).
    """
    m = spark.range(0, 1440).select(F.col("id").cast("int").alias("minute_of_day"))
    hour = (F.col("minute_of_day") / 60).cast("int")
    minute = (F.col("minute_of_day") % 60).cast("int")
    return m.select(
        (hour * 100 + minute).cast("int").alias("time_key"),
        F.format_string("%02d:%02d", hour, minute).alias("full_time"),
        hour.alias("hour_24"),
        F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("int").alias("hour_12"),
        minute.alias("minute_num"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        time_of_day(hour).alias("time_of_day"),
    )
