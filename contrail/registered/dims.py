"""Keys for dimensions, SCD merges, surrogate keys, key resolution, routing
(G1, M1-M6).

The SCD inputs are derived from the tables: the dimension as known before a
cutoff date (passengers with a booking before it) and a feed of passengers
active from the cutoff on, whose loyalty tier is recomputed from their spend
since then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.catalog import q
from contrail.fixtures import Tables
from contrail.operators import asof as A
from contrail.operators import dims as D
from contrail.operators import scd as S

# Feed cutoff, history start, spend tiers (lower bound, tier).
CUTOFF = "1998-01-01"
HISTORY_START = "1990-01-01"
SPEND_TIERS = [(300000, "Platinum"), (150000, "Gold"), (50000, "Silver")]
SPEND_ELSE = "Bronze"
SHARED = "shared"
LATE_YEARS = (1995, 1996, 1999)


def _orders_before(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))


def _orders_since(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))


def known_passengers(t: Tables) -> DataFrame:
    """dim_passenger as of the cutoff: passengers with a booking before it."""
    p = t.dim_passenger.select("passenger_key", "passenger_id", "email", "loyalty_tier")
    seen = _orders_before(t).select(F.col("o_custkey").alias("passenger_key"))
    return p.join(seen, "passenger_key", "left_semi")


def passenger_feed(t: Tables) -> DataFrame:
    """Passengers active since the cutoff, tier from their spend since then."""
    spend = (_orders_since(t).groupBy(F.col("o_custkey").alias("passenger_key"))
             .agg(F.sum("o_totalprice").alias("spend")))
    tier = None
    for bound, label in SPEND_TIERS:
        cond = F.col("spend") >= bound
        tier = F.when(cond, F.lit(label)) if tier is None else tier.when(cond, F.lit(label))
    tier = tier.otherwise(F.lit(SPEND_ELSE))
    p = t.dim_passenger.select("passenger_key", "passenger_id", "email")
    return p.join(spend, "passenger_key").select("passenger_key", "passenger_id", "email",
                                                  tier.alias("loyalty_tier"))


def passenger_history(t: Tables) -> DataFrame:
    snap = known_passengers(t).select("passenger_id", "email", "loyalty_tier")
    hist = S.scd2_init(snap, HISTORY_START)
    feed = passenger_feed(t).select("passenger_id", "email", "loyalty_tier")
    return S.scd2_upsert(hist, feed, "passenger_id", ["email", "loyalty_tier"], CUTOFF)


@q("dim_date")
def dim_date(t: Tables) -> DataFrame:
    return D.date_dimension_for(t.orders, "o_orderdate")


@q("scd1_upsert")
def scd1_upsert(t: Tables) -> DataFrame:
    return S.scd1_upsert(known_passengers(t), passenger_feed(t), "passenger_key")


@q("scd2_upsert")
def scd2_upsert(t: Tables) -> DataFrame:
    return passenger_history(t)


def late_feed(t: Tables) -> DataFrame:
    """Tiers by the spend of a year, effective from its middle; they reach the
    history of 1998 out of order. A third of the passengers also has a correction
    on the very day of the change of 1998."""
    year = F.year("o_orderdate")
    spend = (t.orders.filter(year.isin(*LATE_YEARS)).groupBy(F.col("o_custkey").alias("passenger_key"), year.alias("year"))
             .agg(F.sum("o_totalprice").alias("spend")))
    tier = F.lit(SPEND_ELSE)
    for bound, label in reversed(SPEND_TIERS):
        tier = F.when(F.col("spend") >= bound, F.lit(label)).otherwise(tier)
    p = t.dim_passenger.select("passenger_key", "passenger_id", "email")
    of_year = p.join(spend, "passenger_key").select("passenger_id", "email", tier.alias("loyalty_tier"),
                                                    F.make_date("year", F.lit(7), F.lit(1)).alias("effective"))
    corrected = p.filter(F.col("passenger_key") % 3 == 0).select(
        "passenger_id", "email", F.lit("Staff").alias("loyalty_tier"), F.lit(CUTOFF).cast("date").alias("effective"))
    return of_year.unionByName(corrected)


@q("scd2_late_feed")
def scd2_late_feed(t: Tables) -> DataFrame:
    """Feeds of 1995, 1996 and 1999 after the history of 1998 was made."""
    return S.scd2_late_feed(passenger_history(t), late_feed(t), "passenger_id", ["email", "loyalty_tier"], "effective")


@q("scd2_as_of")
def scd2_as_of(t: Tables) -> DataFrame:
    """Loyalty tier in force on each booking date (point-in-time lookup)."""
    r = t.fact_reservation.join(
        t.dim_passenger.select("passenger_key", "passenger_id"), "passenger_key")
    out = S.scd2_as_of(r, passenger_history(t), "passenger_id", "full_date", ["loyalty_tier"],
                       prefix="tier_")
    return out.select("reservation_key", "passenger_id", "full_date", "tier_loyalty_tier")


@q("surrogate_keys")
def surrogate_keys(t: Tables) -> DataFrame:
    existing = known_passengers(t).select("passenger_id", "passenger_key")
    incoming = passenger_feed(t).select("passenger_id")
    return S.assign_surrogate_keys(existing, incoming, "passenger_id", "passenger_key")


@q("fact_key_lookup")
def fact_key_lookup(t: Tables) -> DataFrame:
    """Natural codes on the fact resolved to surrogate keys; unknown -> -1."""
    f = t.fact_flight.select("flight_key", "tail_number", "airline_code")
    f = S.resolve_key(f, "tail_number", t.dim_aircraft, "tail_number", "aircraft_key", "aircraft_key")
    f = S.resolve_key(f, "airline_code", t.dim_airline, "airline_code", "airline_key", "airline_key")
    return f


@q("partition_routing")
def partition_routing(t: Tables) -> DataFrame:
    f = t.fact_flight.select("flight_key", "date_key")
    return f.withColumn("partition_name", S.quarter_partition("date_key"))


def shared_account(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Bookings of which a third go to one account, and a history where that account
    has a version for every second day of bookings."""
    r = t.fact_reservation.join(t.dim_passenger.select("passenger_key", "passenger_id"), "passenger_key")
    r = r.select("reservation_key", "full_date", F.when(F.col("reservation_key") % 3 == 0, F.lit(SHARED))
                 .otherwise(F.col("passenger_id")).alias("passenger_id"))
    days = r.filter(F.day("full_date") % 2 == 0).select("full_date").distinct()
    until = F.lead("full_date").over(Window.orderBy("full_date"))   # one row per day of the calendar
    versions = days.select(
        F.lit(SHARED).alias("passenger_id"), F.concat(F.lit("T"), F.day("full_date")).alias("loyalty_tier"),
        F.col("full_date").alias("effective_date"), F.coalesce(until, F.lit(S.OPEN_END).cast("date")).alias("expiry_date"))
    columns = versions.columns
    return r, passenger_history(t).select(*columns).unionByName(versions)


@q("asof_merge")
def asof_merge(t: Tables) -> DataFrame:
    """Tier in force on each booking date, where one account holds a third of the bookings."""
    r, history = shared_account(t)
    return A.asof_merge(r, history, "passenger_id", "full_date", ["loyalty_tier"], prefix="tier_")
