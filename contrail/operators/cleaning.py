"""Raw flight record cleaning: rename, parse, coerce, DQ rules, audit columns.

One projection chain of built-in expressions (no Python per row). The DQ
counts come from one aggregate pass over the coerced frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.coerce import record_hash, to_flag, to_int_or_zero
from contrail.functions.dates import date_key, parse_hhmm

# Raw BTS column name -> warehouse column name.
BTS_COLUMN_MAP = {
    "FlightDate": "flight_date",
    "Carrier": "airline_code",
    "TailNum": "tail_number",
    "FlightNum": "flight_number",
    "OriginAirportID": "origin_iata",
    "DestAirportID": "dest_iata",
    "CRSDepTime": "sched_dep_time",
    "DepTime": "actual_dep_time",
    "DepDelay": "dep_delay_min",
    "CRSArrTime": "sched_arr_time",
    "ArrTime": "actual_arr_time",
    "ArrDelay": "arr_delay_min",
    "Cancelled": "is_cancelled",
    "CancellationCode": "cancellation_code",
    "Diverted": "is_diverted",
    "CRSElapsedTime": "elapsed_time_min",
    "Distance": "distance_miles",
    "CarrierDelay": "carrier_delay_min",
    "WeatherDelay": "weather_delay_min",
    "NASDelay": "nas_delay_min",
    "SecurityDelay": "security_delay_min",
    "LateAircraftDelay": "late_aircraft_delay",
}

# Coerced numeric columns, HHMM columns, flags, DQ limits.
NUMERIC_COLUMNS = ["dep_delay_min", "arr_delay_min", "carrier_delay_min", "weather_delay_min",
                   "nas_delay_min", "security_delay_min", "late_aircraft_delay",
                   "elapsed_time_min", "distance_miles"]
HHMM_COLUMNS = ["sched_dep_time", "sched_arr_time", "actual_dep_time", "actual_arr_time"]
FLAG_COLUMNS = ["is_cancelled", "is_diverted"]
RANGE_CHECKED = ["dep_delay_min", "arr_delay_min"]
MAX_ABS_DELAY = 1440
ACTUAL_TIMES = ["actual_dep_time", "actual_arr_time"]
ETL_SOURCE = "BTS_OTP"


def rename_mapped(raw: DataFrame) -> DataFrame:
    """Rename by the map, then keep only mapped columns that exist (map order)."""
    present = {k: v for k, v in BTS_COLUMN_MAP.items() if k in raw.columns}
    return raw.select(*[F.col(k).alias(v) for k, v in present.items()])


def coerce_flights(raw: DataFrame, strict_times: bool = False) -> DataFrame:
    """Steps 1-4: rename, parse date and HHMM times, numeric and flag coercion."""
    df = rename_mapped(raw)
    fd = F.try_to_timestamp(F.col("flight_date"), F.lit("yyyy-MM-dd")).cast("date")
    cols: dict[str, Column] = {"flight_date": fd, "date_key": date_key(fd)}
    for c in HHMM_COLUMNS:
        if c in df.columns:
            cols[c] = parse_hhmm(c, strict=strict_times)
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            cols[c] = to_int_or_zero(c)
    for c in FLAG_COLUMNS:
        if c in df.columns:
            cols[c] = to_flag(c)
    return df.withColumns(cols)


def missing_id(df: DataFrame) -> Column:
    return F.col("flight_number").isNull() | F.col("airline_code").isNull()


def out_of_range(c: str) -> Column:
    return F.abs(F.col(c)) > MAX_ABS_DELAY


def apply_dq_rules(df: DataFrame) -> DataFrame:
    """Rule 1 drop rows without flight number or airline; rule 2 NULL delays
    beyond 24 h (after numeric coercion filled NULLs with 0, so NULL means
    "rejected value"); rule 3 cancelled flights lose actual times."""
    out = df.filter(~missing_id(df))
    cols = {c: F.when(~out_of_range(c), F.col(c)) for c in RANGE_CHECKED if c in out.columns}
    if "is_cancelled" in out.columns:
        for c in ACTUAL_TIMES:
            if c in out.columns:
                cols[c] = F.when(~F.col("is_cancelled"), F.col(c))
    return out.withColumns(cols)


def quarantine(df: DataFrame) -> DataFrame:
    """Rows dropped by rule 1, with the reason."""
    return df.filter(missing_id(df)).withColumn("dq_reason", F.lit("missing_flight_id"))


def raw_faults(raw: DataFrame) -> Column:
    """Why a raw row cannot be loaded, NULL if it can: no flight number or
    airline, a date that is not ``yyyy-MM-dd``, a flag that is not a number."""
    text = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    reasons = [F.when(F.col("FlightNum").isNull() | F.col("Carrier").isNull(), "missing_flight_id"),
               F.when(F.col("FlightDate").isNull()
                      | F.try_to_timestamp(F.col("FlightDate"), F.lit("yyyy-MM-dd")).isNull(), "bad_date")]
    reasons += [F.when(text(c) & F.col(c).try_cast("double").isNull(), "bad_flag")
                for c in ("Cancelled", "Diverted") if c in raw.columns]
    return F.coalesce(*reasons)


def quarantine_raw(raw: DataFrame) -> DataFrame:
    """The raw rows that cannot be loaded, as they came, with the first reason."""
    return raw.withColumn("dq_reason", raw_faults(raw)).filter(F.col("dq_reason").isNotNull())


def well_formed(raw: DataFrame) -> DataFrame:
    """The raw rows that ``quarantine_raw`` leaves."""
    return raw.filter(raw_faults(raw).isNull())


def dq_report(df: DataFrame) -> DataFrame:
    """One row of DQ counts over the coerced frame, in one aggregate pass."""
    kept = ~missing_id(df)
    aggs = [F.count(F.lit(1)).alias("rows_in"),
            F.count_if(missing_id(df)).alias("missing_flight_id")]
    for c in RANGE_CHECKED:
        if c in df.columns:
            aggs.append(F.count_if(kept & out_of_range(c)).alias(f"{c}_out_of_range"))
    aggs.append(F.count_if(kept).alias("rows_out"))
    return df.agg(*aggs).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def transform_flights(raw: DataFrame, load_ts: str | None = None,
                      source: str = ETL_SOURCE) -> DataFrame:
    """Full cleaning chain with audit columns and the record hash."""
    df = apply_dq_rules(coerce_flights(raw))
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    return df.withColumns({
        "etl_load_ts": ts,
        "etl_source": F.lit(source),
        "record_hash": record_hash("flight_number", "flight_date", "tail_number"),
    })
