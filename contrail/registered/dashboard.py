"""Keys for the dashboard datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.catalog import q, routed_flights
from contrail.fixtures import AS_OF, Tables
from contrail.plans import dashboard as B

# The registered KPI window (the dashboard's "Last Year").
KPI_DAYS = 365


@q("dash_kpi")
def dash_kpi(t: Tables) -> DataFrame:
    return B.kpi_row(t.fact_flight, AS_OF, KPI_DAYS)


@q("dash_monthly_ontime")
def dash_monthly_ontime(t: Tables) -> DataFrame:
    return B.monthly_on_time(t.fact_flight)


@q("dash_cause_share")
def dash_cause_share(t: Tables) -> DataFrame:
    return B.cause_share(t.fact_flight)


@q("dash_hourly_delay")
def dash_hourly_delay(t: Tables) -> DataFrame:
    return B.hourly_delay(t.spark, t.fact_flight)


@q("dash_severity")
def dash_severity(t: Tables) -> DataFrame:
    return B.severity_distribution(t.fact_flight)


@q("dash_top_routes")
def dash_top_routes(t: Tables) -> DataFrame:
    return B.top_delayed_routes(routed_flights(t))


@q("dash_revenue_load")
def dash_revenue_load(t: Tables) -> DataFrame:
    return B.revenue_and_load(t.fact_flight)


@q("rpt_booking_patterns")
def rpt_booking_patterns(t: Tables) -> DataFrame:
    return B.booking_patterns(t.fact_reservation)
