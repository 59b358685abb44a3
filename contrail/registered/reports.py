"""Keys for the five reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.catalog import calendar, clock, event_legs, q
from contrail.fixtures import AS_OF, REPORT_YEAR, Tables
from contrail.plans import reports as R


@q("rpt_on_time")
def rpt_on_time(t: Tables) -> DataFrame:
    return R.on_time_performance(t.fact_flight, calendar(t), t.dim_airline, REPORT_YEAR)


@q("rpt_delay_cascade")
def rpt_delay_cascade(t: Tables) -> DataFrame:
    return R.delay_cascade(t.fact_flight, t.dim_airline, t.dim_airport, REPORT_YEAR)


@q("rpt_rfm")
def rpt_rfm(t: Tables) -> DataFrame:
    return R.rfm_segments(t.fact_reservation, t.dim_passenger, calendar(t), AS_OF)


@q("rpt_route_profit")
def rpt_route_profit(t: Tables) -> DataFrame:
    return R.route_profitability(t.fact_flight, t.dim_airport, t.dim_airline, REPORT_YEAR)


@q("rpt_delay_features")
def rpt_delay_features(t: Tables) -> DataFrame:
    return R.delay_features(event_legs(t), calendar(t), clock(t), t.dim_airport)


# Fixed values: "today" for the event data (events span January 2024).
EVENTS_AS_OF = "2024-01-30"


@q("filter_relative_day")
def filter_relative_day(t: Tables) -> DataFrame:
    """Delay features for the day before ``as_of`` (``CURRENT_DATE - 1``)."""
    return R.delay_features(event_legs(t), calendar(t), clock(t), t.dim_airport, as_of=EVENTS_AS_OF)
