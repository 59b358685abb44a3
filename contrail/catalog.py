"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Each reads the driver tables of ``sf_dir`` through the fixture views, runs
the library operator over the whole tables, and normalizes the output for
comparison with the SQL oracle: doubles rounded to 6 places (in decimal
terms), exact decimals rounded to 6 places and cast to double at the very
end (sums stay exact until then).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from contrail.fixtures import Tables, tables
from contrail.functions.numeric import fround

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            if f.dataType.scale > 6:
                c = F.round(c, 6)
            c = c.cast("double")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = fround(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def calendar(t: Tables) -> DataFrame:
    """The calendar of all dates in the data: one narrow min/max job, and a
    broadcast only if the range it finds is small enough."""
    from contrail.operators.dims import build_date_dimension, data_range, days_in_range
    from contrail.plans.joins import bounded_broadcast
    found = data_range((t.orders, "o_orderdate"), (t.events, "ts"))
    start, end = found or ("1970-01-01", "1970-01-01")
    return bounded_broadcast(build_date_dimension(t.spark, start, end), days_in_range(start, end))


def clock(t: Tables) -> DataFrame:
    from contrail.operators.dims import build_time_dimension
    from contrail.plans.joins import bounded_broadcast
    return bounded_broadcast(build_time_dimension(t.spark), 1440)


def event_legs(t: Tables) -> DataFrame:
    """flight_events with the date and departure-time keys of the star schema."""
    from contrail.functions.dates import date_key
    ts = F.col("event_ts")
    return t.flight_events.withColumns({
        "date_key": date_key(ts),
        "dep_time_key": (F.hour(ts) * 100 + F.minute(ts)).cast("int"),
    })


def routed_flights(t: Tables) -> DataFrame:
    """fact_flight with origin/dest IATA codes (role-playing airport joins)."""
    from contrail.operators.aggregates import with_route_names
    return with_route_names(t.fact_flight, t.dim_airport)


def q(name: str, normalized: bool = True):
    """Register a builder taking ``Tables``; its result is normalized."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Timestamps are UTC wall-clock values: the plan is analysed in that zone,
            # and the caller's zone is given back.
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                out = fn(tables(spark, sf_dir))
                return normalize(out) if normalized else out
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# Registration modules (import order = key families).
from contrail.registered import reports as _reports  # noqa: E402,F401
from contrail.registered import analytics as _analytics  # noqa: E402,F401
from contrail.registered import quality as _quality  # noqa: E402,F401
from contrail.registered import dims as _dims  # noqa: E402,F401
from contrail.registered import storage as _storage  # noqa: E402,F401
from contrail.registered import streams as _streams  # noqa: E402,F401
from contrail.registered import governance as _governance  # noqa: E402,F401
from contrail.registered import dashboard as _dashboard  # noqa: E402,F401
from contrail.registered import jobs as _jobs  # noqa: E402,F401
from contrail.registered import extras as _extras  # noqa: E402,F401
