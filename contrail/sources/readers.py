"""Readers for landed raw data (CSV, JSON envelopes, per-airport JSON) and lake tables.

The network extractors of a single-machine ETL become readers of files that a
landing step (or an upstream system) has put in shared storage; each reader
declares its schema, so nothing is inferred from a sample.
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from contrail.schemas import all_string
from contrail.session import glob_paths

# Weather data types kept from the long-form results.
WEATHER_TYPES = ["AWND", "PRCP", "SNOW", "TMAX", "TMIN", "WDF2"]


def months_between(start: str, end: str) -> list[str]:
    """``YYYY_MM`` of every month from ``start`` to ``end`` (ISO dates)."""
    lo, hi = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (start, end))
    return [f"{m // 12:04d}_{m % 12 + 1:02d}" for m in range(lo, hi + 1)]


def bts_csv_paths(spark: SparkSession, landing: str, months: list[str] | None = None) -> list[str]:
    """Landed monthly files ``bts_otd_YYYY_MM*.csv`` (or folders of that name, as
    Spark writes them) and ``month=YYYY_MM*`` folders, of the given months or of all."""
    names = [f"{kind}{m}*{end}" for m in (months if months is not None else [""])
             for kind, end in (("bts_otd_", ".csv"), ("month=", ""))]
    found = {p for name in names for p in glob_paths(spark, f"{landing}/{name}")}
    return sorted(found)


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of ``paths`` (files or folders of files) by their header. One scan
    finds each file's first line: of the rows at the file's start the one
    that its task read first. The driver gets one line for each file."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"))
    first = lines.filter(F.col("at") == 0).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        header = tuple(c.strip() for c in next(csv.reader([row.header.lstrip("\ufeff")]), ()))
        by_header.setdefault(header, []).append(unquote(row.file))
    return by_header


def read_bts_csv(spark: SparkSession, landing: str, columns: list[str],
                 flight_date: str | None = None, months: list[str] | None = None,
                 month_col: str | None = None) -> DataFrame:
    """The landed files of ``months`` (``YYYY_MM``; else all) as text columns
    chosen by header name; with ``flight_date`` its month's files and its rows.
    ``month_col`` adds the month (``YYYY_MM``) that a row's file is named for.

    Every file's own header counts, also of files in one folder; files with one
    header are one scan, and a file that lacks a column is an error. Empty
    files hold no rows. Without a file of the asked months
    ``FileNotFoundError`` is raised.
    """
    if flight_date:
        months = months_between(flight_date, flight_date)
    paths = bts_csv_paths(spark, landing, months)
    if not paths:
        raise FileNotFoundError(f"no file of {f'{months[0]} to {months[-1]}' if months else 'any month'} in {landing}")
    of_file = [F.regexp_extract("_metadata.file_path", r"(?:bts_otd_|month=)(\d{4}_\d{2})", 1).alias(month_col)] if month_col else []
    out = None
    for header, same in csv_headers(spark, paths).items():
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"{same[0]} has no column {', '.join(missing)}")
        one = spark.read.schema(all_string(list(header))).option("header", True) \
            .option("mode", "PERMISSIVE").csv(same).select(*columns, *of_file)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], all_string([*columns, *([month_col] if month_col else [])]))
    return out.filter(F.col("FlightDate") == flight_date) if flight_date else out


def read_record_envelopes(spark: SparkSession, path: str, record_schema: StructType,
                          flight_date: str | None = None) -> DataFrame:
    """``{"records": [...]}`` documents (one per line) -> one row per record."""
    schema = StructType().add("records", ArrayType(record_schema))
    df = spark.read.schema(schema).json(path).select(F.inline("records"))
    if flight_date:
        df = df.filter(F.col("FlightDate") == flight_date)
    return df


def read_airport_status(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object per airport file; the airport code comes from the file
    path, malformed records are dropped (PERMISSIVE + corrupt-record column)."""
    df = (spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return (df.filter(F.col("_corrupt_record").isNull())
            .select(airport_of_path().alias("airport"), *[f.name for f in schema.fields]))


def rejected_airport_status(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects that ``read_airport_status`` drops: airport and number, with one as a sample."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        airport_of_path().alias("airport"), "value",
        F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("_r"))
    return (lines.filter(F.col("_r._corrupt_record").isNotNull())
            .groupBy("airport").agg(F.count(F.lit(1)).alias("rejected"), F.min("value").alias("sample")))


def airport_of_path() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"airport=([^/]+)", 1)


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructType().add("_corrupt_record", "string").fields[0]])


def read_weather(spark: SparkSession, path: str, stations: list[str] | None = None,
                 date: str | None = None) -> DataFrame:
    """Long-form weather (station, date, datatype, value) from ``results``
    envelopes, restricted to the six data types."""
    rec = (StructType().add("station", "string").add("date", "string")
           .add("datatype", "string").add("value", "double"))
    schema = StructType().add("results", ArrayType(rec))
    df = spark.read.schema(schema).json(path).select(F.inline("results"))
    df = df.filter(F.col("datatype").isin(*WEATHER_TYPES))
    if stations:
        df = df.filter(F.col("station").isin(*stations))
    if date:
        df = df.filter(F.col("date") == date)
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               where: Column | None = None) -> tuple[DataFrame, Observation]:
    """Lake table read; the rows that ``where`` lets through are counted during
    the first action instead of by a separate ``count()`` scan. The filter
    stands below the observation, so it reaches the scan."""
    obs = Observation("rows_read")
    df = spark.read.format(fmt).load(path)
    df = df if where is None else df.filter(where)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
