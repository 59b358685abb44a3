"""Keys for cleaning, DQ rules and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.catalog import calendar, clock, event_legs, q
from contrail.fixtures import Tables
from contrail.functions import coerce, dates
from contrail.operators import cleaning as C
from contrail.operators import integrity as I

# ---------------------------------------------------------------- cleaning


@q("proj_rename_map")
def proj_rename_map(t: Tables) -> DataFrame:
    return C.rename_mapped(t.bts_raw)


@q("scalar_hhmm")
def scalar_hhmm(t: Tables) -> DataFrame:
    r = t.bts_raw
    return r.select("FlightDate", "FlightNum", "TailNum", "DepTime",
                    dates.parse_hhmm("DepTime").alias("actual_dep_time"),
                    dates.parse_hhmm("DepTime", strict=True).alias("actual_dep_time_strict"))


@q("scalar_coerce_num")
def scalar_coerce_num(t: Tables) -> DataFrame:
    r = t.bts_raw
    return r.select("FlightDate", "FlightNum", "TailNum", "DepDelay",
                    coerce.to_int_or_zero("DepDelay").alias("dep_delay_min"))


@q("scalar_coerce_bool")
def scalar_coerce_bool(t: Tables) -> DataFrame:
    r = t.bts_raw
    return r.select("FlightDate", "FlightNum", "TailNum", "Cancelled",
                    coerce.to_flag("Cancelled").alias("is_cancelled"))


@q("scalar_record_hash")
def scalar_record_hash(t: Tables) -> DataFrame:
    c = C.coerce_flights(t.bts_raw)
    return c.select("flight_number", "flight_date", "tail_number",
                    coerce.record_hash("flight_number", "flight_date", "tail_number").alias("record_hash"))


@q("dq_missing_id")
def dq_missing_id(t: Tables) -> DataFrame:
    qd = C.quarantine(C.coerce_flights(t.bts_raw))
    return qd.select("flight_date", "airline_code", "flight_number", "tail_number", "dq_reason")


@q("dq_delay_range")
def dq_delay_range(t: Tables) -> DataFrame:
    c = C.coerce_flights(t.bts_raw)
    kept = c.filter(~C.missing_id(c)).withColumn("dep_delay_out_of_range", C.out_of_range("dep_delay_min"))
    ruled = C.apply_dq_rules(kept)
    return ruled.select("flight_number", "flight_date", "tail_number", "dep_delay_min",
                        "dep_delay_out_of_range")


@q("dq_cancelled_times")
def dq_cancelled_times(t: Tables) -> DataFrame:
    out = C.apply_dq_rules(C.coerce_flights(t.bts_raw))
    return out.select("flight_number", "flight_date", "tail_number", "is_cancelled", "actual_dep_time")


@q("dq_report")
def dq_report(t: Tables) -> DataFrame:
    return C.dq_report(C.coerce_flights(t.bts_raw))


@q("etl_transform_flights")
def etl_transform_flights(t: Tables) -> DataFrame:
    out = C.transform_flights(t.bts_raw)
    return out.drop("etl_load_ts")


# ---------------------------------------------------------------- integrity


@q("chk_unique")
def chk_unique(t: Tables) -> DataFrame:
    checks = [
        I.unique_violations(t.fact_flight, ["flight_key"], "fact_flight.flight_key"),
        I.unique_violations(t.fact_flight, ["flight_number", "date_key"], "fact_flight.flight_number+date_key"),
        I.unique_violations(t.fact_reservation, ["booking_ref"], "fact_reservation.booking_ref"),
        I.unique_violations(t.dim_passenger, ["passenger_id"], "dim_passenger.passenger_id"),
        I.unique_violations(t.dim_airline, ["airline_code"], "dim_airline.airline_code"),
        I.unique_violations(t.dim_airport, ["iata_code"], "dim_airport.iata_code"),
        I.unique_violations(t.dim_aircraft, ["tail_number"], "dim_aircraft.tail_number"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# Column DEFAULTs of fact_flight.
FACT_FLIGHT_DEFAULTS = {
    "dep_delay_min": 0, "arr_delay_min": 0, "carrier_delay_min": 0, "weather_delay_min": 0,
    "nas_delay_min": 0, "security_delay_min": 0, "late_aircraft_delay": 0, "is_cancelled": False,
}


@q("chk_defaults")
def chk_defaults(t: Tables) -> DataFrame:
    f = I.fill_defaults(t.fact_flight, FACT_FLIGHT_DEFAULTS)
    return f.select("flight_key", *FACT_FLIGHT_DEFAULTS)


# Fixed values: (column, NOT NULL, max length) per table.
COLUMN_RULES = {
    "dim_airline": [("airline_code", True, 2), ("airline_name", True, 100)],
    "dim_airport": [("iata_code", True, 3), ("airport_name", True, 150), ("region", False, 50)],
    "dim_aircraft": [("tail_number", True, 10)],
    "dim_passenger": [("passenger_id", True, 20), ("first_name", False, 50), ("last_name", False, 50),
                      ("email", False, 100), ("phone", False, 20)],
    "fact_flight": [("flight_number", False, 10), ("tail_number", False, 10),
                    ("arr_delay_min", False, None)],
}


@q("chk_not_null")
def chk_not_null(t: Tables) -> DataFrame:
    parts = [I.column_report(getattr(t, table), table, rules) for table, rules in COLUMN_RULES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@q("chk_fk_orphans")
def chk_fk_orphans(t: Tables) -> DataFrame:
    flights = I.fk_orphans_multi(t.fact_flight, [
        ("date_key", calendar(t), "date_key", "fact_flight.date_key"),
        ("airline_key", t.dim_airline, "airline_key", "fact_flight.airline_key"),
        ("origin_airport_key", t.dim_airport, "airport_key", "fact_flight.origin_airport_key"),
        ("dest_airport_key", t.dim_airport, "airport_key", "fact_flight.dest_airport_key"),
        ("aircraft_key", t.dim_aircraft, "aircraft_key", "fact_flight.aircraft_key"),
    ])
    bookings = I.fk_orphans_multi(t.fact_reservation, [
        ("passenger_key", t.dim_passenger, "passenger_key", "fact_reservation.passenger_key"),
        ("date_key", calendar(t), "date_key", "fact_reservation.date_key"),
        ("airline_code", t.dim_airline, "airline_code", "fact_reservation.airline_code"),
    ])
    departures = I.fk_orphans_multi(event_legs(t), [
        ("dep_time_key", clock(t), "time_key", "flight_events.dep_time_key"),
        ("origin_airport_key", t.dim_airport, "airport_key", "flight_events.origin_airport_key"),
    ])
    return flights.unionByName(bookings).unionByName(departures)



@q("chk_fk_times")
def chk_fk_times(t: Tables) -> DataFrame:
    """Time-of-day keys of both facts: departure, arrival and booking."""
    key, hour = F.col("flight_key"), F.col("hour_24")
    flights = t.fact_flight.select(
        F.when(key % 211 == 0, F.lit(2400)).otherwise(hour * 100 + key % 60).alias("dep_time_key"),
        F.when(key % 97 == 0, hour * 100 + 60 + key % 40).otherwise((hour + 2) % 24 * 100 + key % 60).alias("arr_time_key"))
    k = F.col("reservation_key")
    bookings = t.fact_reservation.select(F.when(k % 89 == 0, F.lit(-1)).otherwise(k % 24 * 100 + k % 60).alias("time_key"))
    return I.fk_orphans_multi(flights, [
        ("dep_time_key", clock(t), "time_key", "fact_flight.dep_time_key"),
        ("arr_time_key", clock(t), "time_key", "fact_flight.arr_time_key"),
    ]).unionByName(I.fk_orphans_multi(bookings, [("time_key", clock(t), "time_key", "fact_reservation.time_key")]))
