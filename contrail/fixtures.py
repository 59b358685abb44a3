"""Fixture views: the flight star schema shaped from the driver tables.

Each view is one SELECT template whose table references are ``{name}``
placeholders (literal braces are doubled). The same text runs on Spark --
``spark.sql(template, orders=<DataFrame>, ...)`` so no global temp views are
touched -- and on DuckDB after ``format()`` with plain table names. Arithmetic
is on integers so both engines agree exactly. "Today" for these fixtures is
2001-08-02 and the reporting year is 1996.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# The fixture calendar.
REPORT_YEAR = 1996
AS_OF = "2001-08-02"

TEMPLATES: dict[str, str] = {
    "fact_flight": """
SELECT o_orderkey AS flight_key, CAST(o_orderdate AS DATE) AS full_date,
  CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS INT) AS date_key,
  CAST(o_orderkey % 24 AS INT) AS hour_24,
  CAST(ascii(substr(c_mktsegment,1,1)) AS INT) AS airline_key, c_mktsegment AS airline_code,
  c_nationkey AS origin_airport_key, CAST((o_orderkey*7) % 25 AS INT) AS dest_airport_key,
  CAST(o_custkey % 100 AS INT) AS aircraft_key,
  concat('F', CAST(o_orderkey % 500 AS STRING)) AS flight_number,
  concat('N', CAST(o_custkey % 100 AS STRING)) AS tail_number,
  CAST((o_orderkey*7919) % 240 - 30 AS INT) AS dep_delay_min,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST((o_orderkey*104729) % 400 - 100 AS INT) END AS arr_delay_min,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey*31) % 60 ELSE 0 END AS INT) AS carrier_delay_min,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN (o_orderkey*37) % 90 ELSE 0 END AS INT) AS weather_delay_min,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey*41) % 45 ELSE 0 END AS INT) AS nas_delay_min,
  CAST(CASE WHEN o_orderkey % 97 = 0 THEN 20 ELSE 0 END AS INT) AS security_delay_min,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey*43) % 70 ELSE 0 END AS INT) AS late_aircraft_delay,
  (o_orderkey % 53 = 0) AS is_cancelled,
  CAST(100 + (o_custkey*37) % 2900 AS INT) AS distance_miles,
  CAST(CAST(o_orderkey % 61 + 40 AS DECIMAL(5,2)) / 100 AS DECIMAL(5,2)) AS load_factor,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_revenue
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "dim_airline": """
SELECT CAST(ascii(substr(s,1,1)) AS INT) AS airline_key, s AS airline_code, concat(s, ' Airways') AS airline_name
FROM (SELECT DISTINCT c_mktsegment AS s FROM {customer}) t""",
    "dim_aircraft": """
SELECT s_suppkey AS aircraft_key, concat('N', CAST(s_suppkey AS STRING)) AS tail_number, CAST(100 + (s_suppkey*13) % 250 AS INT) AS seat_capacity
FROM {supplier} WHERE s_suppkey < 90""",
    "dim_airport": """
SELECT n_nationkey AS airport_key, n_name AS iata_code, concat(n_name, ' International') AS airport_name, r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "dim_passenger": """
SELECT c_custkey AS passenger_key, c_name AS passenger_id,
  CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE 'Pat' END AS first_name, concat('N', CAST(c_custkey AS STRING)) AS last_name,
  CASE WHEN c_custkey % 101 = 0 THEN 'a@x.com' ELSE concat('user', CAST(c_custkey AS STRING), '@mail.example.com') END AS email,
  concat('555-010-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS phone,
  make_date(CAST(1950 + c_custkey % 50 AS INT), CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS dob,
  CASE WHEN c_acctbal < 0 THEN 'Bronze' WHEN c_acctbal < 3000 THEN 'Silver' WHEN c_acctbal < 7000 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier
FROM {customer}""",
    "fact_reservation": """
SELECT o_orderkey AS reservation_key, o_custkey AS passenger_key, CAST(o_orderdate AS DATE) AS full_date,
  CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS INT) AS date_key,
  c_mktsegment AS airline_code, concat('B', CAST(o_orderkey AS STRING)) AS booking_ref,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Economy' WHEN 1 THEN 'Business' ELSE 'First' END AS cabin_class,
  CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'Web' WHEN '2' THEN 'App' WHEN '3' THEN 'Agent' ELSE 'API' END AS booking_channel,
  CAST((o_orderkey*17) % 120 AS INT) AS days_before_flight,
  CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Waitlisted' ELSE 'Cancelled' END AS status,
  CAST(o_totalprice AS DECIMAL(10,2)) AS total_fare
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "bts_raw": """
SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS FlightDate,
  CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE substr(o_orderpriority,1,1) END AS Carrier,
  CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS FlightNum,
  concat('N', CAST(o_custkey % 100 AS STRING)) AS TailNum,
  CASE CAST(o_orderkey % 41 AS INT) WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '2400' WHEN 3 THEN '1275' WHEN 4 THEN '-5' WHEN 5 THEN '2500' WHEN 6 THEN '930.0'
    ELSE CAST((o_orderkey % 24)*100 + o_orderkey % 60 AS STRING) END AS DepTime,
  CASE CAST(o_orderkey % 37 AS INT) WHEN 0 THEN 'x' WHEN 1 THEN '1440' WHEN 2 THEN '1441' WHEN 3 THEN '-1500' WHEN 4 THEN NULL
    ELSE CAST((o_orderkey*7919) % 240 - 30 AS STRING) END AS DepDelay,
  CASE CAST(o_orderkey % 53 AS INT) WHEN 0 THEN '1.00' WHEN 1 THEN NULL ELSE '0.00' END AS Cancelled
FROM {orders}""",
    "flight_events": """
SELECT event_id, ts AS event_ts, event_type AS airline_code, CAST(user_id % 5 AS INT) AS origin_airport_key,
  concat('N', CAST(user_id AS STRING)) AS tail_number, CAST(event_id % 90 - 10 AS INT) AS dep_delay_min,
  CAST(CASE WHEN event_id % 7 = 0 THEN 15 ELSE 0 END AS INT) AS weather_delay_min,
  CASE WHEN event_type = 'error' THEN 'CANCELLED' ELSE 'DEPARTED' END AS status
FROM {events}""",
    "raw_flight_events": """
SELECT event_id, ts AS event_ts, concat('{{"flightNumber":"F', CAST(event_id % 500 AS STRING), '","airline":"', event_type,
  '","delays":{{"carrier":', CAST(event_id % 30 AS STRING), ',"weather":', CAST(event_id % 11 AS STRING),
  '}},"position":{{"lat":', CAST(event_id % 90 AS STRING), '.5,"altitude":', CAST(event_id * 10 % 40000 AS STRING), '}},"passengers":[',
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '' WHEN 1 THEN '{{"passengerId":"P1","cabin":"Economy"}}'
    ELSE '{{"passengerId":"P1","cabin":"First"}},{{"passengerId":"P2"}}' END, ']}}') AS payload
FROM {events}""",
    "user_airline_access": """
SELECT concat('analyst', CAST(n_nationkey % 3 AS STRING)) AS username, s AS airline_code
FROM {nation} JOIN (SELECT DISTINCT c_mktsegment AS s FROM {customer}) t ON n_nationkey % 5 = length(s) % 5
WHERE n_nationkey < 5""",
}

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def _deps(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(TEMPLATES[name])))


def fixture_sql(name: str) -> str:
    """The view as plain SQL over base tables (for DuckDB)."""
    tpl = TEMPLATES[name]
    return tpl.format(**{d: d for d in _deps(name)}).strip()


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix a SQL statement with fixture views as CTEs.

    ``sql`` may start with its own ``WITH``; its CTEs are appended after ours.
    """
    ctes = ",\n".join(f"{n} AS ({fixture_sql(n)})" for n in names)
    body = sql.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        rec = "RECURSIVE " if m.group(1) else ""
        return f"WITH {rec}{ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """Lazy access to the base tables and fixture views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        key = f"base:{name}"
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in BASE_TABLES:
            return self.base(name)
        if name in TEMPLATES:
            if name not in self._cache:
                kwargs = {d: self.base(d) for d in _deps(name)}
                self._cache[name] = self.spark.sql(TEMPLATES[name], **kwargs)
            return self._cache[name]
        raise AttributeError(name)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
