"""Explicit schemas (no inference on raw input)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

# The flight event message (12 fields).
FLIGHT_EVENT_SCHEMA = StructType([
    StructField("event_id", StringType(), False),
    StructField("event_ts", TimestampType(), False),
    StructField("flight_number", StringType(), True),
    StructField("airline_code", StringType(), True),
    StructField("origin_iata", StringType(), True),
    StructField("dest_iata", StringType(), True),
    StructField("sched_dep_ts", TimestampType(), True),
    StructField("actual_dep_ts", TimestampType(), True),
    StructField("dep_delay_min", IntegerType(), True),
    StructField("gate_number", StringType(), True),
    StructField("tail_number", StringType(), True),
    StructField("status", StringType(), True),
])

# The reservation event message (7 fields).
RESERVATION_SCHEMA = StructType([
    StructField("booking_ref", StringType(), False),
    StructField("passenger_id", StringType(), True),
    StructField("flight_number", StringType(), True),
    StructField("cabin_class", StringType(), True),
    StructField("total_fare", DoubleType(), True),
    StructField("booking_channel", StringType(), True),
    StructField("booking_ts", TimestampType(), True),
])


def all_string(columns: list[str]) -> StructType:
    """Raw files are read as text; typing happens in the cleaning step."""
    return StructType([StructField(c, StringType(), True) for c in columns])


# The raw BTS columns of a full file (cleaning.BTS_COLUMN_MAP names
# the warehouse column of each), and those in the landed files of this fixture.
BTS_COLUMNS = ["FlightDate", "Carrier", "TailNum", "FlightNum", "OriginAirportID", "DestAirportID", "CRSDepTime",
               "DepTime", "DepDelay", "CRSArrTime", "ArrTime", "ArrDelay", "Cancelled", "CancellationCode", "Diverted",
               "CRSElapsedTime", "Distance", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
               "LateAircraftDelay"]
BTS_RAW_COLUMNS = ["FlightDate", "Carrier", "FlightNum", "TailNum", "DepTime", "DepDelay", "Cancelled"]
