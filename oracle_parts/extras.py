"""Oracle SQL: relative-day report filter and the decoded stream source."""

from oracle_sql import ORACLE, add, hour_features

add("filter_relative_day", hour_features("WHERE full_date = DATE '2024-01-29'"), "flight_events", "dim_airport")

ORACLE["stream_source"] = ORACLE["json_decode"]
