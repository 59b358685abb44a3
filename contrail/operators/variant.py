"""Semi-structured events: JSON text -> VARIANT -> typed, flattened columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values: (output column, variant path, type) of the flat event view.
EVENT_PATHS = [
    ("flight_number", "$.flightNumber", "string"),
    ("airline_code", "$.airline", "string"),
    ("origin", "$.origin", "string"),
    ("destination", "$.destination", "string"),
    ("status", "$.status", "string"),
    ("carrier_delay", "$.delays.carrier", "int"),
    ("weather_delay", "$.delays.weather", "int"),
    ("nas_delay", "$.delays.nas", "int"),
    ("latitude", "$.position.lat", "double"),
    ("longitude", "$.position.lon", "double"),
    ("altitude_ft", "$.position.altitude", "int"),
]
PASSENGER_PATHS = [("passenger_id", "$.passengerId", "string"), ("cabin_class", "$.cabin", "string")]


def to_variant(df: DataFrame, text_col: str = "payload", out: str = "payload_v",
               source_system: str | None = None) -> DataFrame:
    """Raw event table: JSON text parsed once into a VARIANT column, with
    ``loaded_at`` defaulting to the load time."""
    cols = {out: F.try_parse_json(F.col(text_col)), "loaded_at": F.current_timestamp()}
    if source_system is not None:
        cols["source_system"] = F.lit(source_system)
    return df.withColumns(cols)


def flatten_events(df: DataFrame, variant_col: str = "payload_v",
                   keep: tuple[str, ...] = ("event_id", "event_ts")) -> DataFrame:
    """Typed paths plus one row per passenger (inner: an empty or missing
    passenger array yields no row, as LATERAL FLATTEN does)."""
    v = F.col(variant_col)
    cols = [F.col(c) for c in keep]
    cols += [F.try_variant_get(v, p, t).alias(n) for n, p, t in EVENT_PATHS]
    exploded = df.select(*cols, F.explode(F.try_variant_get(v, "$.passengers", "array<variant>"))
                         .alias("_pax"))
    return exploded.select(*[c for c in exploded.columns if c != "_pax"],
                           *[F.try_variant_get(F.col("_pax"), p, t).alias(n)
                             for n, p, t in PASSENGER_PATHS])


def decode_json(df: DataFrame, schema: StructType, value_col: str = "value",
                keep: tuple[str, ...] = (), options: dict | None = None) -> DataFrame:
    """``from_json(value, schema)`` then ``data.*``; malformed text gives all-NULL fields."""
    return df.select(*[F.col(c) for c in keep],
                     F.from_json(F.col(value_col).cast("string"), schema, options or {}).alias("data")) \
        .select(*keep, "data.*")
