"""Keys for marts, aggregates, windows, joins, filters, scalar functions, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.catalog import calendar, clock, event_legs, q, routed_flights
from contrail.fixtures import AS_OF, REPORT_YEAR, Tables
from contrail.functions import cases, dates, masking
from contrail.functions.numeric import fround
from contrail.operators import aggregates as agg
from contrail.operators import windows as win
from contrail.plans import reports as R

# ---------------------------------------------------------------- marts / aggregates


@q("mart_daily_airline")
def mart_daily_airline(t: Tables) -> DataFrame:
    return agg.daily_airline_mart(t.fact_flight, calendar(t), t.dim_airline)


@q("mart_daily_airline_dt")
def mart_daily_airline_dt(t: Tables) -> DataFrame:
    return agg.daily_airline_mart_dt(t.fact_flight, calendar(t), t.dim_airline)


@q("agg_monthly_stats")
def agg_monthly_stats(t: Tables) -> DataFrame:
    return agg.monthly_airline_stats(t.fact_flight, calendar(t), t.dim_airline, REPORT_YEAR)


@q("agg_rfm_base")
def agg_rfm_base(t: Tables) -> DataFrame:
    return agg.rfm_base(t.fact_reservation, t.dim_passenger, calendar(t), AS_OF)


@q("agg_route_metrics")
def agg_route_metrics(t: Tables) -> DataFrame:
    return agg.route_metrics(t.fact_flight, t.dim_airport, t.dim_airline, REPORT_YEAR)


@q("agg_hourly_load")
def agg_hourly_load(t: Tables) -> DataFrame:
    return agg.hourly_airport_load(event_legs(t), calendar(t), clock(t))


@q("agg_route_kpis")
def agg_route_kpis(t: Tables) -> DataFrame:
    return agg.route_kpis(routed_flights(t))


@q("fact_delays_unpivot")
def fact_delays_unpivot(t: Tables) -> DataFrame:
    return agg.fact_delays(t.fact_flight)


# ---------------------------------------------------------------- windows over monthly stats


def _monthly(t: Tables) -> DataFrame:
    return agg.monthly_airline_stats(t.fact_flight, calendar(t), t.dim_airline, REPORT_YEAR)


@q("win_running_sum")
def win_running_sum(t: Tables) -> DataFrame:
    m = win.running_sum(_monthly(t), "revenue", ["airline_code"], ["month_num"], "revenue_ytd")
    return m.select("airline_code", "month_num", "revenue", "revenue_ytd")


@q("win_lag")
def win_lag(t: Tables) -> DataFrame:
    m = win.lag_of(_monthly(t), "avg_delay", ["airline_code"], ["month_num"], "prev_month_delay")
    return m.select("airline_code", "month_num", "avg_delay", "prev_month_delay")


@q("win_mom_change")
def win_mom_change(t: Tables) -> DataFrame:
    m = win.change_vs_previous(_monthly(t), "avg_delay", ["airline_code"], ["month_num"],
                               "delay_mom_change")
    return m.select("airline_code", "month_num", "delay_mom_change")


@q("win_rank")
def win_rank(t: Tables) -> DataFrame:
    m = _monthly(t)
    ratio = (F.col("total_flights") - F.col("delayed_flights") - F.col("cancelled_flights")) \
        / F.col("total_flights")
    m = win.rank_by(m, ["month_num"], [ratio.desc()], "monthly_rank")
    return m.select("month_num", "airline_code", ratio.alias("on_time_ratio"), "monthly_rank")


@q("win_dense_rank")
def win_dense_rank(t: Tables) -> DataFrame:
    """Airlines ranked per year by on-time % (ties share a rank, no gaps)."""
    f = t.fact_flight.withColumn("year", F.year("full_date"))
    y = (f.groupBy("year", "airline_code")
         .agg(F.count(F.lit(1)).alias("total_flights"),
              F.sum(cases.flag((F.col("arr_delay_min") <= 15) & ~F.col("is_cancelled"))).alias("on_time"))
         .withColumn("on_time_pct", fround(F.lit(100.0) * F.col("on_time") / F.col("total_flights"), 1)))
    y = win.rank_by(y, ["year"], [F.col("on_time_pct").desc()], "performance_rank", dense=True)
    return y.select("year", "airline_code", "on_time_pct", "performance_rank")


@q("win_row_number_dedup")
def win_row_number_dedup(t: Tables) -> DataFrame:
    """Latest leg per aircraft tail (ROW_NUMBER() = 1 by time DESC)."""
    legs = t.fact_flight.select("tail_number", "flight_key", "date_key", "hour_24")
    return win.latest_per_key(legs, ["tail_number"],
                              [F.col("date_key"), F.col("hour_24"), F.col("flight_key")])


# ---------------------------------------------------------------- global windows


@q("win_ntile")
def win_ntile(t: Tables) -> DataFrame:
    base = agg.rfm_base(t.fact_reservation, t.dim_passenger, calendar(t), AS_OF)
    s = win.ntile(base, 5, [F.col("recency_days").desc(), F.col("passenger_id")], "r_score")
    return s.select("passenger_id", "recency_days", "r_score")


@q("win_ntile_distributed")
def win_ntile_distributed(t: Tables) -> DataFrame:
    s = R.rfm_scores(t.fact_reservation, t.dim_passenger, calendar(t), AS_OF, distributed=True)
    return s.select("passenger_id", "recency_days", "frequency", "monetary",
                    "r_score", "f_score", "m_score", "rfm_total")


@q("case_rfm_segment")
def case_rfm_segment(t: Tables) -> DataFrame:
    s = R.rfm_scores(t.fact_reservation, t.dim_passenger, calendar(t), AS_OF)
    return s.select("passenger_id", "segment")


@q("win_percent_rank")
def win_percent_rank(t: Tables) -> DataFrame:
    r = R.route_ranked(t.fact_flight, t.dim_airport, t.dim_airline, REPORT_YEAR)
    return r.select("origin", "destination", "airline_code", "revenue_percentile",
                    "load_percentile", "rpm_percentile")


@q("win_centered_avg")
def win_centered_avg(t: Tables) -> DataFrame:
    r = R.route_ranked(t.fact_flight, t.dim_airport, t.dim_airline, REPORT_YEAR)
    return r.select("origin", "destination", "airline_code", "total_miles", "smoothed_revenue")


@q("case_route_tier")
def case_route_tier(t: Tables) -> DataFrame:
    r = R.route_ranked(t.fact_flight, t.dim_airport, t.dim_airline, REPORT_YEAR)
    r = win.percent_rank_global(r, "total_revenue", "_pct_asc", descending=False)
    return r.select("origin", "destination", "airline_code",
                    cases.route_tier("revenue_percentile").alias("route_tier"),
                    cases.route_tier("_pct_asc").alias("route_tier_best_first"))


@q("topk_routes")
def topk_routes(t: Tables) -> DataFrame:
    """Top 50 routes by revenue over all years (ties by route keys)."""
    f = routed_flights(t)
    r = (f.groupBy("origin_iata", "dest_iata", "airline_code")
         .agg(F.sum("total_revenue").alias("total_revenue"), F.count(F.lit(1)).alias("flight_count")))
    return r.orderBy(F.col("total_revenue").desc(), "origin_iata", "dest_iata",
                     "airline_code").limit(50)


# ---------------------------------------------------------------- windows over airport-hours


def _hourly(t: Tables) -> DataFrame:
    return agg.hourly_airport_load(event_legs(t), calendar(t), clock(t))


_AH = ["origin_airport_key", "full_date"]


@q("win_lag_hour")
def win_lag_hour(t: Tables) -> DataFrame:
    h = win.lag_of(_hourly(t), "avg_dep_delay", _AH, ["hour_24"], "prev_hour_delay")
    return h.select(*_AH, "hour_24", "avg_dep_delay", "prev_hour_delay")


@q("win_trailing_excl")
def win_trailing_excl(t: Tables) -> DataFrame:
    h = win.trailing_avg_excluding_current(_hourly(t), "avg_dep_delay", _AH, ["hour_24"], 3,
                                           "rolling_3h_delay")
    return h.select(*_AH, "hour_24", "rolling_3h_delay")


@q("win_partition_max")
def win_partition_max(t: Tables) -> DataFrame:
    h = win.partition_max(_hourly(t), "departures_this_hour", _AH, "max_departures")
    h = h.withColumn("congestion_index", cases.safe_div(
        F.col("departures_this_hour") * F.lit(1.0), F.col("max_departures")))
    return h.select(*_AH, "hour_24", "departures_this_hour", "max_departures", "congestion_index")


# ---------------------------------------------------------------- per-flight windows


@q("win_rolling_rows")
def win_rolling_rows(t: Tables) -> DataFrame:
    """Literal 8-row frame per airline x origin (ties on date broken by flight_key)."""
    f = routed_flights(t).select("flight_key", "airline_code", "origin_iata", "date_key",
                                 "arr_delay_min")
    out = win.rows_frame_avg(f, "arr_delay_min", ["airline_code", "origin_iata"],
                             ["date_key", "flight_key"], 7, "rolling_7d_avg_delay")
    return out.select("flight_key", "rolling_7d_avg_delay")


@q("win_rolling_days")
def win_rolling_days(t: Tables) -> DataFrame:
    """Fixed form: a 7-day RANGE frame (the day and the 6 before)."""
    f = routed_flights(t).select("flight_key", "airline_code", "origin_iata", "full_date",
                                 "arr_delay_min")
    out = win.day_range_avg(f, "arr_delay_min", ["airline_code", "origin_iata"], "full_date", 6,
                            "rolling_7d_avg_delay")
    return out.select("flight_key", "rolling_7d_avg_delay")


@q("win_percent_rank_part")
def win_percent_rank_part(t: Tables) -> DataFrame:
    f = t.fact_flight.select("flight_key", "airline_code", "date_key", "arr_delay_min")
    out = win.partition_percent_rank(f, "arr_delay_min", ["airline_code", "date_key"],
                                     "delay_percentile")
    return out.select("flight_key", "delay_percentile")


# ---------------------------------------------------------------- joins and filters


@q("join_star")
def join_star(t: Tables) -> DataFrame:
    s = agg.star(t.fact_flight, calendar(t), t.dim_airline)
    return s.select("flight_key", "full_date", "year", "month_num", "month_name",
                    "airline_code", "airline_name")


@q("join_role_playing")
def join_role_playing(t: Tables) -> DataFrame:
    from contrail.plans.joins import role_playing
    f = role_playing(t.fact_flight, t.dim_airport, "origin_airport_key", "airport_key", "origin",
                     ["iata_code", "airport_name"])
    f = role_playing(f, t.dim_airport, "dest_airport_key", "airport_key", "dest",
                     ["iata_code", "airport_name"])
    return f.select("flight_key", "origin_iata_code", "origin_airport_name", "dest_iata_code",
                    "dest_airport_name")


@q("filter_date_range")
def filter_date_range(t: Tables) -> DataFrame:
    f = t.fact_flight
    return f.filter(agg.in_year(f, REPORT_YEAR)).select("flight_key", "date_key")


@q("filter_bool")
def filter_bool(t: Tables) -> DataFrame:
    """year = Y AND NOT is_cancelled (via the calendar's year attribute)."""
    d = calendar(t).filter(F.col("year") == REPORT_YEAR).select("date_key", "year")
    f = t.fact_flight.filter(~F.col("is_cancelled"))
    return f.join(d, "date_key").select("flight_key", "year", "is_cancelled")


@q("cond_flags")
def cond_flags(t: Tables) -> DataFrame:
    f = t.fact_flight
    return f.select("flight_key",
                    cases.flag(F.col("arr_delay_min") > 15).alias("is_delayed"),
                    cases.flag(F.col("is_cancelled")).alias("cancel_flag"),
                    F.when((F.col("arr_delay_min") > 15) & ~F.col("is_cancelled"), 1).otherwise(0)
                    .alias("delayed_not_cancelled"))


# ---------------------------------------------------------------- scalar functions


@q("scalar_strings")
def scalar_strings(t: Tables) -> DataFrame:
    p = t.dim_passenger
    return p.select("passenger_id",
                    F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("passenger_name"))


@q("scalar_safe_div")
def scalar_safe_div(t: Tables) -> DataFrame:
    f = t.fact_flight
    return f.select("flight_key",
                    cases.safe_div(F.col("total_revenue"), F.col("distance_miles")).alias("revenue_per_mile"),
                    cases.safe_div(F.col("carrier_delay_min"), F.col("nas_delay_min")).alias("carrier_to_nas"))


@q("case_delay_severity")
def case_delay_severity(t: Tables) -> DataFrame:
    f = t.fact_flight
    return f.select("flight_key", "arr_delay_min",
                    cases.delay_severity().alias("delay_severity"),
                    cases.delay_severity(fixed=True).alias("delay_severity_fixed"))


@q("case_primary_cause")
def case_primary_cause(t: Tables) -> DataFrame:
    f = t.fact_flight
    return f.select("flight_key",
                    cases.primary_delay_cause().alias("primary_delay_cause"),
                    cases.primary_delay_cause(fixed=True).alias("primary_delay_cause_fixed"))


@q("scalar_date_key")
def scalar_date_key(t: Tables) -> DataFrame:
    e = t.flight_events
    return e.select("event_id",
                    dates.date_key_formatted("event_ts").alias("date_key"),
                    F.hour("event_ts").alias("dep_hour"))


# ---------------------------------------------------------------- masks


_ROLES = {"admin": masking.ADMIN, "analyst": masking.ANALYST, "reader": masking.READER}


@q("mask_email")
def mask_email(t: Tables) -> DataFrame:
    p = t.dim_passenger
    return p.select("passenger_key",
                    *[masking.mask_email(F.col("email"), r).alias(f"email_{k}") for k, r in _ROLES.items()],
                    masking.mask_email(F.col("email"), masking.ANALYST, strict=True).alias("email_analyst_strict"))


@q("mask_phone")
def mask_phone(t: Tables) -> DataFrame:
    p = t.dim_passenger
    return p.select("passenger_key",
                    *[masking.mask_phone(F.col("phone"), r).alias(f"phone_{k}") for k, r in _ROLES.items()])


@q("mask_dob")
def mask_dob(t: Tables) -> DataFrame:
    p = t.dim_passenger
    return p.select("passenger_key",
                    *[masking.mask_dob(F.col("dob"), r).alias(f"dob_{k}") for k, r in _ROLES.items()])


@q("mask_fare")
def mask_fare(t: Tables) -> DataFrame:
    r = t.fact_reservation
    return r.select("reservation_key",
                    *[masking.mask_fare(F.col("total_fare"), role).alias(f"fare_{k}")
                      for k, role in _ROLES.items()])
