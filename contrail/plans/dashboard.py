"""Datasets behind the dashboard: KPI row, trends, shares, top routes.

Each is one grouped aggregate (rollups and period comparisons are
conditional aggregates in the same pass); small post-aggregate windows
(shares over a handful of causes) run on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.cases import DELAY_CAUSES, delay_severity
from contrail.functions.numeric import fround
from contrail.plans.joins import bounded_broadcast

# Hourly colour bands, route status bands, severity merge, lead bands.
HOUR_BANDS = [(25, "high"), (18, "medium")]
HOUR_ELSE = "low"
ROUTE_STATUS = [(20, "High"), (15, "Medium")]
ROUTE_ELSE = "Low"
SEVERITY_MERGE = {"Severe (1-3h)": "Severe (>60m)", "Critical (>3h)": "Severe (>60m)"}
LEAD_BANDS = [(7, "0-7 days"), (30, "8-30 days"), (90, "31-90 days")]
LEAD_ELSE = "90+ days"


def _bands(c, bands, other):
    expr = None
    for bound, label in bands:
        expr = F.when(c > bound, F.lit(label)) if expr is None else expr.when(c > bound, F.lit(label))
    return expr.otherwise(F.lit(other))


def _on_time(df=None):
    return (F.col("arr_delay_min") <= 15) & ~F.col("is_cancelled")


def kpi_row(fact: DataFrame, as_of: str, days: int, airline: str | None = None) -> DataFrame:
    """Flights, on-time %, average delay, cancel %, revenue for the last ``days``
    days up to ``as_of``, and the change against the ``days`` before; per
    airline plus an ``ALL`` row (rollup)."""
    d = F.lit(as_of).cast("date")
    cur = (F.col("full_date") > F.date_sub(d, days)) & (F.col("full_date") <= d)
    prior = (F.col("full_date") > F.date_sub(d, 2 * days)) & (F.col("full_date") <= F.date_sub(d, days))
    f = fact.filter((F.col("full_date") > F.date_sub(d, 2 * days)) & (F.col("full_date") <= d))
    if airline and airline != "ALL":
        f = f.filter(F.col("airline_code") == airline)
    a = (f.rollup("airline_code")
         .agg(F.count_if(cur).alias("total_flights"), F.count_if(prior).alias("prior_flights"),
              F.count_if(cur & _on_time()).alias("_on_time"),
              F.count_if(cur & F.col("is_cancelled")).alias("_cancelled"),
              F.avg(F.when(cur, F.col("arr_delay_min"))).alias("avg_arr_delay"),
              F.sum(F.when(cur, F.col("total_revenue"))).alias("revenue"),
              F.sum(F.when(prior, F.col("total_revenue"))).alias("prior_revenue")))
    pct = lambda num, den: fround(F.try_divide(F.lit(100.0) * num, F.nullif(den, F.lit(0))), 1)
    return a.select(
        F.coalesce(F.col("airline_code"), F.lit("ALL")).alias("airline_code"),
        "total_flights",
        pct(F.col("_on_time"), F.col("total_flights")).alias("on_time_rate_pct"),
        fround(F.col("avg_arr_delay"), 1).alias("avg_arr_delay"),
        pct(F.col("_cancelled"), F.col("total_flights")).alias("cancel_rate_pct"),
        F.col("revenue"),
        pct(F.col("total_flights") - F.col("prior_flights"), F.col("prior_flights")).alias("flights_change_pct"),
        pct(F.col("revenue").cast("double") - F.col("prior_revenue").cast("double"),
            F.col("prior_revenue").cast("double")).alias("revenue_change_pct"))


def monthly_on_time(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.year("full_date").alias("year"), F.month("full_date").alias("month_num"),
                         "airline_code")
            .agg(F.count(F.lit(1)).alias("total_flights"), F.count_if(_on_time()).alias("_ok"))
            .select("year", "month_num", "airline_code", "total_flights",
                    fround(F.lit(100.0) * F.col("_ok") / F.col("total_flights"), 1).alias("on_time_pct")))


def cause_share(fact: DataFrame) -> DataFrame:
    """Minutes per delay cause and share of all cause minutes (%)."""
    sums = fact.agg(*[F.sum(c).alias(label) for c, label in DELAY_CAUSES])
    stack = ", ".join(f"'{label}', `{label}`" for _, label in DELAY_CAUSES)
    long = sums.selectExpr(f"stack({len(DELAY_CAUSES)}, {stack}) AS (cause, delay_minutes)")
    total = F.sum("delay_minutes").over(Window.partitionBy())
    return long.select("cause", "delay_minutes",
                       fround(F.try_divide(F.lit(100.0) * F.col("delay_minutes"), total), 1).alias("share_pct"))


def hourly_delay(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Average arrival delay per hour of day; all 24 hours kept."""
    by_hour = fact.groupBy("hour_24").agg(F.avg("arr_delay_min").alias("_avg"),
                                          F.count(F.lit(1)).alias("flights"))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour_24"))
    j = hours.join(bounded_broadcast(by_hour, 24), "hour_24", "left")  # one row per hour of day
    return j.select("hour_24", F.format_string("%02d:00", F.col("hour_24")).alias("hour_label"),
                    F.coalesce(F.col("flights"), F.lit(0)).alias("flights"),
                    fround(F.col("_avg"), 1).alias("avg_delay"),
                    _bands(F.col("_avg"), HOUR_BANDS, HOUR_ELSE).alias("band"))


def severity_distribution(fact: DataFrame) -> DataFrame:
    sev = delay_severity()
    merged = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SEVERITY_MERGE.items() for x in kv]), sev), sev)
    c = fact.groupBy(merged.alias("severity")).agg(F.count(F.lit(1)).alias("flights"))
    total = F.sum("flights").over(Window.partitionBy())
    return c.select("severity", "flights", fround(F.lit(100.0) * F.col("flights") / total, 1).alias("share_pct"))


def top_delayed_routes(routed: DataFrame, top: int = 8) -> DataFrame:
    r = (routed.groupBy("origin_iata", "dest_iata", "airline_code")
         .agg(F.avg("arr_delay_min").alias("_avg"), F.count(F.lit(1)).alias("flights")))
    r = r.orderBy(F.col("_avg").desc_nulls_last(), F.col("flights").desc(), "origin_iata", "dest_iata",
                  "airline_code").limit(top)
    status = None
    for bound, label in ROUTE_STATUS:
        cond = F.col("_avg") >= bound
        status = F.when(cond, F.lit(label)) if status is None else status.when(cond, F.lit(label))
    return r.select(F.concat("origin_iata", F.lit("→"), "dest_iata").alias("route"), "airline_code",
                    fround(F.col("_avg"), 1).alias("avg_delay"), "flights",
                    status.otherwise(F.lit(ROUTE_ELSE)).alias("status"))


def revenue_and_load(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.year("full_date").alias("year"), F.month("full_date").alias("month_num"))
            .agg(F.sum("total_revenue").alias("_rev"), F.avg("load_factor").alias("_lf"))
            .select("year", "month_num", F.round(F.col("_rev") / 1000000, 2).alias("revenue_musd"),
                    F.round(F.col("_lf") * 100, 1).alias("load_factor_pct")))


def booking_patterns(reservations: DataFrame) -> DataFrame:
    lead = None
    for bound, label in LEAD_BANDS:
        cond = F.col("days_before_flight") <= bound
        lead = F.when(cond, F.lit(label)) if lead is None else lead.when(cond, F.lit(label))
    lead = lead.otherwise(F.lit(LEAD_ELSE))
    return (reservations.groupBy("booking_channel", "cabin_class", lead.alias("lead_time_band"))
            .agg(F.count(F.lit(1)).alias("bookings"),
                 F.round(F.avg("total_fare"), 2).alias("avg_fare"),
                 fround(F.avg("days_before_flight"), 1).alias("avg_days_before_flight")))
