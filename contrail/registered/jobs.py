"""Keys for the batch jobs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.catalog import calendar, q, routed_flights
from contrail.fixtures import Tables
from contrail.operators import cleaning as C
from contrail.operators import governance as G
from contrail.operators.deltas import row_changes
from contrail.operators.dims import data_range
from contrail.plans import jobs as J
from contrail.schemas import BTS_RAW_COLUMNS
from contrail.session import shared_path
from contrail.sources import landing as L
from contrail.sources import sinks as K

# Job scenario dates.
BATCH_DAY = "1996-06-14"
STATE_DAY = "1996-05-02"
RUN_TS = datetime(2001, 8, 2, 6, 0, 0)
FIRST_LOAD_BEFORE = "1998-01-01"
INCREMENT_HWM_BEFORE = "1999-01-01"


def scheduled_flights(t: Tables) -> DataFrame:
    """Fact legs with a scheduled departure timestamp (day + hour)."""
    f = routed_flights(t)
    return f.withColumn("sched_dep_ts", (F.col("full_date").cast("timestamp")
                                         + F.make_interval(hours=F.col("hour_24"))))


@q("batch_enrich")
def batch_enrich(t: Tables) -> DataFrame:
    e = J.enrich_flights(scheduled_flights(t))
    return e.select("flight_key", "date_key", "dep_hour", "delay_severity", "primary_delay_cause",
                    "rolling_7d_avg_delay", "delay_percentile")


@q("batch_run")
def batch_run(t: Tables) -> DataFrame:
    raw = shared_path(t.spark, "lake", "raw_flights")
    scheduled_flights(t).write.mode("overwrite").parquet(raw)
    fact = shared_path(t.spark, "lake", "fact_flight")
    kpis = shared_path(t.spark, "lake", "agg_route_kpis")
    J.daily_batch(t.spark, raw, BATCH_DAY, fact, kpis)
    return t.spark.read.parquet(kpis)


@q("batch_day")
def batch_day(t: Tables) -> DataFrame:
    """The enriched day that the daily batch writes, with the rolling frame's
    earlier rows from the state that an earlier day's run kept."""
    raw = shared_path(t.spark, "lake", "raw_flights")
    scheduled_flights(t).write.mode("overwrite").parquet(raw)
    fact, kpis = shared_path(t.spark, "lake", "fact_flight"), shared_path(t.spark, "lake", "agg_route_kpis")
    tail = shared_path(t.spark, "lake", "rolling_state")
    for day in (STATE_DAY, BATCH_DAY):
        J.daily_batch(t.spark, raw, day, fact, kpis, tail)
    day = t.spark.read.parquet(fact).filter(F.col("date_key") == int(BATCH_DAY.replace("-", "")))
    return day.select("flight_key", "date_key", "dep_hour", "delay_severity", "primary_delay_cause",
                      "rolling_7d_avg_delay", "delay_percentile")


@q("batch_corrected")
def batch_corrected(t: Tables) -> DataFrame:
    """A day's batch after an earlier day was corrected: the state that an earlier run
    kept of the wrong rows does not count, so the day equals one of the full history."""
    raw, wrong = shared_path(t.spark, "lake", "raw_flights"), shared_path(t.spark, "lake", "raw_flights_wrong")
    right = scheduled_flights(t)
    fact, kpis = shared_path(t.spark, "lake", "fact_flight"), shared_path(t.spark, "lake", "agg_route_kpis")
    tail = shared_path(t.spark, "lake", "rolling_state")
    shifted = F.when(F.col("flight_key") % 2 == 0, F.col("arr_delay_min") + 100).otherwise(F.col("arr_delay_min"))
    right.withColumn("arr_delay_min", shifted.cast("int")).write.parquet(wrong)
    J.daily_batch(t.spark, wrong, STATE_DAY, fact, kpis, tail)
    right.write.parquet(raw)
    J.daily_batch(t.spark, raw, BATCH_DAY, fact, kpis, tail)
    day = t.spark.read.parquet(fact).filter(F.col("date_key") == int(BATCH_DAY.replace("-", "")))
    return day.select("flight_key", "date_key", "dep_hour", "delay_severity", "primary_delay_cause",
                      "rolling_7d_avg_delay", "delay_percentile")


def _backfilled(t: Tables) -> tuple[DataFrame, str]:
    landing = shared_path(t.spark, "landing", "bts_csv")
    L.land_csv_by_month(t.bts_raw, landing)
    target = shared_path(t.spark, "warehouse", "fact_flight_clean")
    log = shared_path(t.spark, "warehouse", "etl_run_log")
    start, end = data_range((t.orders, "o_orderdate"))
    out = J.backfill(t.spark, landing, BTS_RAW_COLUMNS, start, end, target, log, RUN_TS,
                     keys={"airline": t.dim_airline, "aircraft": t.dim_aircraft})
    return out, log


_CLEAN_COLS = ["flight_date", "airline_code", "tail_number", "flight_number", "actual_dep_time",
               "dep_delay_min", "is_cancelled", "date_key", "etl_source", "record_hash"]


@q("etl_backfill")
def etl_backfill(t: Tables) -> DataFrame:
    out, _ = _backfilled(t)
    return out.select(*_CLEAN_COLS, "airline_key", "aircraft_key")


@q("etl_quarantine")
def etl_quarantine(t: Tables) -> DataFrame:
    """Raw rows kept out of the load: no id, a date or flag that does not parse."""
    n = F.col("FlightNum").cast("long")
    raw = t.bts_raw.withColumns({
        "FlightDate": F.when(n % 59 == 0, F.date_format(F.to_date("FlightDate"), "MM/dd/yyyy")).otherwise(F.col("FlightDate")),
        "Cancelled": F.when(n % 61 == 0, "yes").otherwise(F.col("Cancelled"))})
    return C.quarantine_raw(raw).select("FlightDate", "Carrier", "FlightNum", "TailNum", "Cancelled", "dq_reason")


@q("run_log_report")
def run_log_report(t: Tables) -> DataFrame:
    _, log = _backfilled(t)
    rep = G.run_log_report(t.spark, log, RUN_TS + timedelta(hours=1))
    return rep.select("process_date", "status", "rows_loaded", "error_msg")


@q("mart_refresh")
def mart_refresh(t: Tables) -> DataFrame:
    """Mart built from an early load, then refreshed for the months a second
    load touched."""
    path = shared_path(t.spark, "lake", "mart_daily_airline")
    first = t.fact_flight.filter(F.col("full_date") < F.lit(FIRST_LOAD_BEFORE).cast("date"))
    J.build_daily_mart(first, calendar(t), t.dim_airline, path)
    loaded = t.fact_flight.filter(F.col("full_date") >= F.lit(FIRST_LOAD_BEFORE).cast("date"))
    J.refresh_mart(t.fact_flight, loaded, calendar(t), t.dim_airline, path)
    return t.spark.read.parquet(path).drop("month_key")


def later_fact(t: Tables) -> DataFrame:
    """The fact after a second load: new flights, corrected delays, withdrawn flights."""
    key = F.col("flight_key")
    corrected = F.when(key % 17 == 0, F.col("arr_delay_min") - 200).otherwise(F.col("arr_delay_min")).cast("int")
    return t.fact_flight.filter(key % 23 != 0).withColumn("arr_delay_min", corrected)


@q("mart_delta")
def mart_delta(t: Tables) -> DataFrame:
    """A state of the early flights, brought up to the later fact from the changed rows alone."""
    path = shared_path(t.spark, "lake", "mart_state")
    early = t.fact_flight.filter(F.col("full_date") < F.lit(FIRST_LOAD_BEFORE).cast("date"))
    J.build_mart_state(early, path)
    J.apply_mart_delta(t.spark, path, row_changes(early, later_fact(t)), later_fact(t))
    return J.read_mart_state(t.spark, path, calendar(t), t.dim_airline)


@q("incremental_load")
def incremental_load(t: Tables) -> DataFrame:
    """Initial load up to a high-water mark, then a partial increment: half of
    the flights, with a changed delay. Those from three days before the mark on
    are merged; the loaded rows that the increment lacks stay."""
    path = shared_path(t.spark, "warehouse", "fact_flight_incremental")
    first = C.transform_flights(t.bts_raw, load_ts="2001-08-01 06:00:00")
    first = first.filter(F.col("flight_date") < F.lit(INCREMENT_HWM_BEFORE).cast("date"))
    K.write_partitioned(first.withColumn("month_key", J.month_key()), path, ["month_key"], sort_by=["date_key"])
    half = t.bts_raw.filter(F.col("FlightNum").cast("long") % 2 == 0).withColumn("DepDelay", F.lit("7"))
    increment = C.transform_flights(half, load_ts="2001-08-02 06:00:00")
    return J.incremental_load(t.spark, path, increment)["table"].select(*_CLEAN_COLS)


def legs_raw(t: Tables) -> DataFrame:
    """Raw flights where carriers share numbers, tails are partly unknown, and a
    flight has two legs a day that differ in origin alone."""
    key = F.col("FlightNum").cast("long")
    raw = t.bts_raw.filter(F.col("FlightNum").isNotNull() & F.col("Carrier").isNotNull()).withColumns({
        "_id": key, "FlightNum": (key % 20).cast("string"),
        "TailNum": F.when(key % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("TailNum"))})
    return raw.withColumn("OriginAirportID", F.explode(F.array(*[
        F.concat(F.lit(letter), F.col("_id").cast("string")) for letter in ("A", "B")])))


@q("incremental_legs")
def incremental_legs(t: Tables) -> DataFrame:
    """An increment that corrects one leg of every fourth flight since the look-back:
    flights of other carriers with its number and its other leg stay."""
    path = shared_path(t.spark, "warehouse", "fact_flight_legs")
    raw = legs_raw(t)
    first = C.transform_flights(raw.drop("_id"), load_ts="2001-08-01 06:00:00")
    first = first.filter(F.col("flight_date") < F.lit(INCREMENT_HWM_BEFORE).cast("date"))
    K.write_partitioned(first.withColumn("month_key", J.month_key()), path, ["month_key"], sort_by=["date_key"])
    corrected = raw.filter((F.col("_id") % 4 == 0) & F.col("OriginAirportID").startswith("A")).drop("_id")
    increment = C.transform_flights(corrected.withColumn("DepDelay", F.lit("7")), load_ts="2001-08-02 06:00:00")
    return J.incremental_load(t.spark, path, increment)["table"].select(*_CLEAN_COLS, "origin_iata")
