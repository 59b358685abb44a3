"""Keys for the reservation event reader (S8) and SCD2 current-row uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.catalog import q
from contrail.fixtures import Tables
from contrail.operators import integrity as I
from contrail.operators import variant as V
from contrail.registered.dims import passenger_history
from contrail.registered.storage import TS_FORMAT
from contrail.schemas import RESERVATION_SCHEMA


def reservation_messages(t: Tables) -> DataFrame:
    """fact_reservation rendered as reservation event messages."""
    r = t.fact_reservation.join(t.dim_passenger.select("passenger_key", "passenger_id"), "passenger_key")
    body = F.struct("booking_ref", "passenger_id", F.lit(None).cast("string").alias("flight_number"),
                    "cabin_class", F.col("total_fare").cast("double").alias("total_fare"),
                    "booking_channel", F.col("full_date").cast("timestamp").alias("booking_ts"))
    return r.select(F.to_json(body, {"timestampFormat": TS_FORMAT}).alias("value"))


@q("reservation_decode")
def reservation_decode(t: Tables) -> DataFrame:
    d = V.decode_json(reservation_messages(t), RESERVATION_SCHEMA,
                      options={"timestampFormat": TS_FORMAT})
    return d.withColumn("booking_ts", F.col("booking_ts").cast("timestamp_ntz"))


@q("chk_unique_current")
def chk_unique_current(t: Tables) -> DataFrame:
    """Natural key unique among current SCD2 rows (history may repeat it)."""
    h = passenger_history(t)
    return (I.unique_violations(h.filter("is_current"), ["passenger_id"], "passenger_history.current")
            .unionByName(I.unique_violations(h, ["passenger_id", "effective_date"],
                                             "passenger_history.version")))


@q("chk_unique_current_found")
def chk_unique_current_found(t: Tables) -> DataFrame:
    """The same check on a history where some passengers were added twice: a second
    current row, for every other of them on the day of the first."""
    h = passenger_history(t)
    number = F.regexp_extract("passenger_id", "([0-9]+)$", 1).cast("int")
    twice = h.filter(F.col("is_current") & (number % 50 == 0)).withColumn(
        "effective_date", F.when(number % 100 == 0, F.col("effective_date")).otherwise(F.date_add("effective_date", 1)))
    h = h.unionByName(twice)
    return (I.unique_violations(h.filter("is_current"), ["passenger_id"], "passenger_history.current")
            .unionByName(I.unique_violations(h, ["passenger_id", "effective_date"], "passenger_history.version")))


@q("win_top_n")
def win_top_n(t: Tables) -> DataFrame:
    """The three most delayed arrivals per airline and year (ROW_NUMBER <= 3)."""
    from contrail.operators import windows as win
    f = t.fact_flight.select("flight_key", "airline_code", F.year("full_date").alias("year"),
                             "arr_delay_min")
    return win.top_n_per_group(f, ["airline_code", "year"],
                               [F.col("arr_delay_min").desc_nulls_last(), F.col("flight_key")], 3,
                               "delay_rank")


# Bucket count of the co-located passenger tables.
PASSENGER_BUCKETS = 16


@q("join_bucketed")
def join_bucketed(t: Tables) -> DataFrame:
    """Confirmed bookings per passenger from two tables bucketed on
    passenger_key: the sort-merge join reads both sides without a shuffle."""
    from contrail.session import shared_path
    from contrail.sources import sinks as K
    tag = shared_path(t.spark, "warehouse", "bucketed").rsplit("/", 1)[-1]
    res_path = shared_path(t.spark, "warehouse", "fact_reservation_b")
    pax_path = shared_path(t.spark, "warehouse", "dim_passenger_b")
    K.write_bucketed(t.fact_reservation.filter(F.col("status") == "Confirmed")
                     .select("reservation_key", "passenger_key", "total_fare"),
                     f"fact_reservation_b_{tag}", res_path, ["passenger_key"], PASSENGER_BUCKETS)
    K.write_bucketed(t.dim_passenger.select("passenger_key", "passenger_id"),
                     f"dim_passenger_b_{tag}", pax_path, ["passenger_key"], PASSENGER_BUCKETS)
    r = t.spark.table(f"fact_reservation_b_{tag}")
    p = t.spark.table(f"dim_passenger_b_{tag}")
    return (r.join(p, "passenger_key")
            .groupBy("passenger_key", "passenger_id")
            .agg(F.count("reservation_key").alias("frequency"), F.sum("total_fare").alias("monetary")))
