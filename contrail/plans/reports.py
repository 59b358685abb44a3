"""The five analytic reports, as DataFrame plans.

R1 on-time performance, R2 delay cascade, R3 RFM segmentation, R4 route
profitability, R5 delay-prediction features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.cases import rfm_segment, route_tier, safe_div
from contrail.functions.numeric import fround
from contrail.operators import aggregates as agg
from contrail.operators import windows as win
from contrail.plans.ranking import global_index
from contrail.session import cut_lineage

# ---------------------------------------------------------------- R1


def on_time_performance(fact: DataFrame, dim_date: DataFrame, dim_airline: DataFrame,
                        year: int) -> DataFrame:
    """Monthly stats per airline with YTD revenue, MoM delay change, monthly rank.

    The rank key is the fractional on-time ratio (the integer-division form
    would collapse it to 0/1).
    """
    m = agg.monthly_airline_stats(fact, dim_date, dim_airline, year)
    on_time = F.col("total_flights") - F.col("delayed_flights") - F.col("cancelled_flights")
    m = m.withColumn("on_time_pct", fround(F.lit(100.0) * on_time / F.col("total_flights"), 2))
    m = win.running_sum(m, "revenue", ["airline_code"], ["month_num"], "revenue_ytd")
    m = win.lag_of(m, "avg_delay", ["airline_code"], ["month_num"], "prev_month_delay")
    m = win.change_vs_previous(m, "avg_delay", ["airline_code"], ["month_num"], "delay_mom_change")
    m = win.rank_by(m, ["month_num"], [(on_time / F.col("total_flights")).desc()], "monthly_rank")
    return m.orderBy("year", "month_num", "monthly_rank", "airline_code")


# ---------------------------------------------------------------- R2


def delay_chain(fact: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame,
                year: int, max_depth: int = 5, base_late_aircraft: int = 30,
                follow_delay: int | None = 15) -> DataFrame:
    """Delay chains rooted at flights with late-aircraft delay > 30 min.

    Level k+1 is the aircraft's next leg after a level-k leg that arrived more
    than ``follow_delay`` minutes late (``None`` follows every leg). Each leg
    has one successor, so the chain of a root is the run of positions after
    it in the global (aircraft, date, hour, flight key) order: roots expand to
    ``max_depth`` positions, one equi-join on the unique position fetches the
    legs, and a window over at most ``max_depth`` rows per root keeps the
    prefix that follows the rule. No recursion, no per-level re-planning, no
    per-aircraft sort in one task.
    """
    cols = ["flight_key", "aircraft_key", "date_key", "hour_24", "flight_number", "arr_delay_min",
            "late_aircraft_delay", "airline_key", "origin_airport_key", "dest_airport_key"]
    # A chain starts in the year: no earlier leg is needed, and of the later ones only
    # each aircraft's first (the rank limit is applied before the shuffle as well).
    fact = fact.select(*cols, *(["full_date"] if "full_date" in fact.columns else []))
    after = F.col("date_key") > agg.year_key_range(year)[1]
    if "full_date" in fact.columns:
        after = after & (F.col("full_date") > F.lit(f"{year}-12-31").cast("date"))
    first = Window.partitionBy("aircraft_key").orderBy("date_key", "hour_24", "flight_key")
    later = fact.filter(after).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") < max_depth).drop("_n")
    legs = fact.filter(agg.in_year(fact, year)).unionByName(later)
    # Dense position in (aircraft, date, hour, flight key) order: the k-th next
    # leg of the aircraft at position p sits at p + k (if still that aircraft).
    idx = global_index(legs, ["aircraft_key", "date_key", "hour_24", "flight_key"], "_rn")
    roots = (idx.filter((F.col("late_aircraft_delay") > base_late_aircraft) & agg.in_year(idx, year))
             .join(dim_airline.select("airline_key"), "airline_key")
             .join(dim_airport.select(F.col("airport_key").alias("origin_airport_key")), "origin_airport_key")
             .join(dim_airport.select(F.col("airport_key").alias("dest_airport_key")), "dest_airport_key")
             .select(F.col("_rn").alias("_root"), F.col("aircraft_key").alias("_root_aircraft"),
                     F.col("flight_number").alias("root_flight")))
    steps = (roots.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(max_depth - 1))))
             .withColumn("_rn", F.col("_root") + F.col("_k")))
    cand = steps.join(idx.select("_rn", "flight_key", "aircraft_key", "flight_number",
                                 "arr_delay_min"), "_rn")
    # Level k+1 exists while every earlier step stayed on the aircraft and the
    # leg before it arrived late; the window holds at most max_depth rows.
    w = Window.partitionBy("_root").orderBy("_k")
    follows = F.col("aircraft_key") == F.col("_root_aircraft")
    if follow_delay is not None:
        follows = follows & (F.lag("arr_delay_min").over(w) > follow_delay)
    step_ok = F.when(F.col("_k") == 0, F.lit(1)).otherwise(F.coalesce(follows.cast("int"), F.lit(0)))
    alive = F.min(step_ok).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    contiguous = F.row_number().over(w) == F.col("_k") + 1
    chain = cand.withColumn("_alive", alive).withColumn("_contig", contiguous)
    return chain.filter((F.col("_alive") == 1) & F.col("_contig")).select(
        "flight_key", "flight_number", "arr_delay_min", (F.col("_k") + 1).alias("chain_level"),
        "root_flight")


def delay_cascade(fact: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame,
                  year: int, min_depth: int = 2, **kw) -> DataFrame:
    chain = delay_chain(fact, dim_airline, dim_airport, year, **kw)
    return (chain.groupBy("root_flight")
            .agg(F.max("chain_level").alias("cascade_depth"),
                 F.sum("arr_delay_min").alias("total_system_delay_min"),
                 F.countDistinct("flight_number").alias("impacted_flights"))
            .filter(F.col("cascade_depth") > min_depth)
            .orderBy(F.col("total_system_delay_min").desc_nulls_last(), "root_flight"))


# ---------------------------------------------------------------- R3


def rfm_scores(fact_reservation: DataFrame, dim_passenger: DataFrame, dim_date: DataFrame,
               as_of: str, distributed: bool = True) -> DataFrame:
    """RFM base + three NTILE(5) scores + segment, per passenger.

    Ties are broken by passenger_id so scores are deterministic.
    """
    base = cut_lineage(agg.rfm_base(fact_reservation, dim_passenger, dim_date, as_of))  # read once for each score
    pid = F.col("passenger_id").asc()
    s = base
    for col, order, out in (("recency_days", F.col("recency_days").desc(), "r_score"),
                            ("frequency", F.col("frequency").asc(), "f_score"),
                            ("monetary", F.col("monetary").asc(), "m_score")):
        # only the key and the ranked measure are sorted; the score joins back by key
        keys = ["passenger_id", "passenger_name", "loyalty_tier"]
        one = win.ntile(base.select(*keys, col), 5, [order, pid, F.col("passenger_name"), F.col("loyalty_tier")],
                        out, distributed).drop(col)
        one = one.withColumnsRenamed({k: f"_{out}_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{out}_{k}")) for k in keys]
        s = s.join(one, same).drop(*(f"_{out}_{k}" for k in keys))
    return (s.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("segment", rfm_segment()))


def rfm_segments(fact_reservation: DataFrame, dim_passenger: DataFrame, dim_date: DataFrame,
                 as_of: str, distributed: bool = True) -> DataFrame:
    s = rfm_scores(fact_reservation, dim_passenger, dim_date, as_of, distributed)
    return (s.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("passenger_count"),
                 F.round(F.avg("monetary"), 2).alias("avg_spend"),
                 fround(F.avg("frequency"), 1).alias("avg_flights"),
                 fround(F.avg("recency_days"), 0).alias("avg_days_since_flight"))
            .orderBy(F.col("avg_spend").desc(), "segment"))


# ---------------------------------------------------------------- R4


ROUTE_PERCENTILES = {"revenue_percentile": "total_revenue", "load_percentile": "avg_load_factor",
                     "rpm_percentile": "revenue_per_mile"}


def route_ranked(fact: DataFrame, dim_airport: DataFrame, dim_airline: DataFrame, year: int,
                 percentiles: dict[str, str] = ROUTE_PERCENTILES, smoothed: bool = True,
                 descending: bool = True) -> DataFrame:
    """Route metrics with revenue/load/RPM percentiles and smoothed revenue.

    Percent ranks and the centered average over all routes use the global
    index, whatever the number of routes. The routes are aggregated once; each
    index holds just the columns that it orders, and a report asks only for
    those that it shows.
    """
    r = out = cut_lineage(agg.route_metrics(fact, dim_airport, dim_airline, year))
    keys = ["origin", "destination", "airline_code"]
    if smoothed:
        out = win.rows_frame_avg(r, "total_revenue", [], ["total_miles", *keys], 3, "smoothed_revenue", after=3, key=keys)
    for name, col in percentiles.items():
        out = win.percent_rank_global(out, col, name, descending=descending, values=r.select(col))
    return out


def route_profitability(fact: DataFrame, dim_airport: DataFrame, dim_airline: DataFrame,
                        year: int, top: int = 50, tier_order: str = "literal") -> DataFrame:
    """Top routes by revenue with tiers.

    ``tier_order="literal"`` ranks DESC so the best route has percentile 0 and
    the >= 0.8 "Platinum" tier holds the weakest routes, as written;
    ``"best_first"`` ranks ASC so Platinum is the top revenue band.
    """
    r = route_ranked(fact, dim_airport, dim_airline, year, {"revenue_percentile": "total_revenue"}, smoothed=False,
                     descending=tier_order != "best_first")
    out = r.select(
        "origin", "destination", "airline_code", "flight_count",
        F.round("total_revenue", 0).alias("total_revenue"),
        F.round("avg_load_factor", 2).alias("avg_load_factor"),
        fround("avg_delay", 1).alias("avg_delay_min"),
        F.round("revenue_per_mile", 4).alias("revenue_per_mile"),
        fround(F.col("revenue_percentile") * 100, 1).alias("revenue_pct_rank"),
        route_tier("revenue_percentile").alias("route_tier"))
    return out.orderBy(F.col("total_revenue").desc(), "origin", "destination",
                       "airline_code").limit(top)


# ---------------------------------------------------------------- R5


def delay_features(events: DataFrame, dim_date: DataFrame, dim_time: DataFrame,
                   dim_airport: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per airport-day-hour: load, previous-hour delay, trailing 3-row average
    (3 rows, not 3 clock hours, when hours are missing), congestion index.

    The dimension join comes after the aggregate and windows (fewer rows
    joined). ``as_of`` keeps only the day before it; the filter is on the
    window partition key, so Catalyst pushes it below the windows.
    """
    h = agg.hourly_airport_load(events, dim_date, dim_time)
    part = ["origin_airport_key", "full_date"]
    h = win.lag_of(h, "avg_dep_delay", part, ["hour_24"], "prev_hour_delay")
    h = win.trailing_avg_excluding_current(h, "avg_dep_delay", part, ["hour_24"], 3,
                                           "rolling_3h_delay")
    h = win.partition_max(h, "departures_this_hour", part, "_max_dep")
    h = h.withColumn("congestion_index",
                     safe_div(F.col("departures_this_hour") * F.lit(1.0), F.col("_max_dep")))
    if as_of is not None:
        h = h.filter(F.col("full_date") == F.date_sub(F.lit(as_of).cast("date"), 1))
    ap = dim_airport.select(F.col("airport_key").alias("origin_airport_key"), "iata_code",
                            "airport_name")
    return (h.join(ap, "origin_airport_key")
            .select("iata_code", "airport_name", "full_date", "hour_24", "departures_this_hour",
                    fround("avg_dep_delay", 1).alias("avg_delay"),
                    fround("prev_hour_delay", 1).alias("prev_hour_delay"),
                    fround("rolling_3h_delay", 1).alias("rolling_3h_avg"),
                    fround("congestion_index", 3).alias("congestion_index"))
            .orderBy("iata_code", "full_date", "hour_24"))
