"""Keys for semi-structured data, sources, sinks, snapshots and layout
(S1-S5, S7, S9, F1, J8, K1-K4, X1-X4, A12, U3, L1, L2).

Queries that exercise a reader first land data derived from the driver tables
in the shared folder (``session.shared_path``), then read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, DoubleType, StructType

from contrail.catalog import calendar, q, routed_flights
from contrail.fixtures import REPORT_YEAR, Tables
from contrail.operators import aggregates as agg
from contrail.operators import cleaning as C
from contrail.operators import variant as V
from contrail.operators.diff import pruned_diff
from contrail.schemas import BTS_RAW_COLUMNS, FLIGHT_EVENT_SCHEMA, all_string
from contrail.session import shared_path
from contrail.sources import landing as L
from contrail.sources import readers as RD
from contrail.sources import sinks as K
from contrail.sources import snapshots as X

# JSON timestamp format with microseconds (the default keeps millis).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Weather data types by line number (the seventh is not kept).
WEATHER_BY_LINE = ["AWND", "PRCP", "SNOW", "TMAX", "TMIN", "WDF2", "TAVG"]
# Snapshot scenario (commit times, the deleted day).
V1_TS, V2_TS, NOW = "2001-08-01 08:00:00", "2001-08-02 08:00:00", "2001-08-02 09:00:00"
DELETED_DAY = 19961201


# ---------------------------------------------------------------- semi-structured


@q("variant_flatten")
def variant_flatten(t: Tables) -> DataFrame:
    raw = V.to_variant(t.raw_flight_events, source_system="events")
    return V.flatten_events(raw)


def flight_event_messages(t: Tables) -> DataFrame:
    """flight_events rendered as JSON messages of the flight event schema."""
    ap = t.dim_airport.select(F.col("airport_key").alias("origin_airport_key"),
                              F.col("iata_code").alias("origin_iata"))
    e = t.flight_events.join(ap, "origin_airport_key")
    body = F.struct(F.col("event_id").cast("string").alias("event_id"),
                    F.col("event_ts").cast("timestamp").alias("event_ts"),
                    "airline_code", "origin_iata", "dep_delay_min", "tail_number", "status")
    return e.select(F.to_json(body, {"timestampFormat": TS_FORMAT}).alias("value"))


@q("json_decode")
def json_decode(t: Tables) -> DataFrame:
    msgs = flight_event_messages(t)
    d = msgs.select(F.from_json("value", FLIGHT_EVENT_SCHEMA, {"timestampFormat": TS_FORMAT})
                    .alias("data")).select("data.*")
    return d.withColumns({c: F.col(c).cast("timestamp_ntz")
                          for c in ("event_ts", "sched_dep_ts", "actual_dep_ts")})


# ---------------------------------------------------------------- sources


@q("src_csv_daily")
def src_csv_daily(t: Tables) -> DataFrame:
    landing = shared_path(t.spark, "landing", "bts_csv")
    L.land_csv_by_month(t.bts_raw, landing)
    return RD.read_bts_csv(t.spark, landing, BTS_RAW_COLUMNS)


@q("src_csv_mixed")
def src_csv_mixed(t: Tables) -> DataFrame:
    """Folders of a month with files of three layouts: as declared, in reverse, and with further columns."""
    landing = shared_path(t.spark, "landing", "bts_csv_mixed")
    part = F.pmod(F.xxhash64("FlightNum", "TailNum"), F.lit(3))
    layouts = (BTS_RAW_COLUMNS, BTS_RAW_COLUMNS[::-1], ["Note", *BTS_RAW_COLUMNS[3:], "More", *BTS_RAW_COLUMNS[:3]])
    raw = t.bts_raw.withColumns({"Note": F.lit("n, m"), "More": F.col("FlightDate")})
    for k, columns in enumerate(layouts):
        L.land_csv_by_month(raw.filter(part == k).select(*columns), landing, mode="append")
    return RD.read_bts_csv(t.spark, landing, BTS_RAW_COLUMNS)


@q("src_json_records")
def src_json_records(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "landing", "bts_json")
    L.land_envelopes(t.bts_raw.select(*BTS_RAW_COLUMNS), path, ["FlightDate"], "records",
                     L.FLIGHT_RECORDS_PER_REQUEST)
    return RD.read_record_envelopes(t.spark, path, all_string(BTS_RAW_COLUMNS))


AIRPORT_STATUS = (StructType().add("departures", LongType()).add("avg_dep_delay", DoubleType())
                  .add("cancellations", LongType()))


@q("src_json_permissive")
def src_json_permissive(t: Tables) -> DataFrame:
    ap = t.dim_airport.select(F.col("airport_key").alias("origin_airport_key"),
                              F.col("iata_code").alias("airport"))
    status = (t.flight_events.join(ap, "origin_airport_key").groupBy("airport")
              .agg(F.count(F.lit(1)).alias("departures"), F.avg("dep_delay_min").alias("avg_dep_delay"),
                   F.count_if(F.col("status") == "CANCELLED").alias("cancellations")))
    path = shared_path(t.spark, "landing", "faa_status")
    L.land_per_key_json(status, path, "airport")
    return RD.read_airport_status(t.spark, path, AIRPORT_STATUS)


@q("src_json_rejected")
def src_json_rejected(t: Tables) -> DataFrame:
    """Airports with objects that do not parse: a cut-off copy for every third airport."""
    path = shared_path(t.spark, "landing", "faa_status_bad")
    ap = t.dim_airport.select(F.col("iata_code").alias("airport"), "airport_key")
    whole = F.to_json(F.struct(F.col("airport_key").cast("long").alias("departures")))
    cut = F.when(F.col("airport_key") % 3 == 0, F.expr("substring(_v, 1, length(_v) - 1)"))
    lines = ap.withColumn("_v", whole).select("airport", F.explode(F.array(F.col("_v"), cut, cut)).alias("value"))
    lines.filter(F.col("value").isNotNull()).write.partitionBy("airport").text(path)
    return RD.rejected_airport_status(t.spark, path, AIRPORT_STATUS).select("airport", "rejected")


def weather_observations(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    types = F.array(*[F.lit(x) for x in WEATHER_BY_LINE])
    return (t.lineitem.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, "s_nationkey")
            .select(F.concat(F.lit("GHCND:"), F.col("n_name")).alias("station"),
                    F.col("l_shipdate").cast("date").cast("string").alias("date"),
                    F.element_at(types, F.col("l_linenumber")).alias("datatype"),
                    F.col("l_quantity").alias("value")))


@q("src_weather_long")
def src_weather_long(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "landing", "weather")
    L.land_envelopes(weather_observations(t), path, ["station", "date"], "results",
                     L.WEATHER_RESULTS_PER_REQUEST)
    return RD.read_weather(t.spark, path)


_FACT_COLS = ["flight_key", "date_key", "airline_key", "airline_code", "arr_delay_min", "is_cancelled"]


@q("src_batch_table")
def src_batch_table(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "lake", "raw_flights")
    t.fact_flight.select(*_FACT_COLS).write.mode("overwrite").parquet(path)
    df, _obs = RD.read_table(t.spark, path)
    return df


# ---------------------------------------------------------------- sinks


@q("sink_parquet_roundtrip")
def sink_parquet_roundtrip(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "stage", "fact_reservation")
    K.write_staging_parquet(t.fact_reservation, path)
    return t.spark.read.parquet(path)


LOAD_TARGET = (StructType().add("flight_date", "date").add("flight_number", "string")
               .add("tail_number", "string").add("airline_code", "string")
               .add("dep_delay_min", "integer").add("arr_delay_min", "integer")
               .add("record_hash", "string").add("date_key", "integer"))


@q("sink_match_by_name")
def sink_match_by_name(t: Tables) -> DataFrame:
    """Cleaned flights with upper-case names and an extra column, loaded by
    name into a target that also has a column the source lacks."""
    clean = C.transform_flights(t.bts_raw).withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))
    src = clean.select(*[F.col(c).alias(c.upper()) for c in clean.columns])
    path = shared_path(t.spark, "warehouse", "fact_flight_load")
    target = StructType([*LOAD_TARGET.fields]).add("month_key", "integer")
    K.load_by_name(src, path, target, partition_by=["month_key"])
    return t.spark.read.parquet(path).drop("month_key")


@q("sink_table_mode")
def sink_table_mode(t: Tables) -> DataFrame:
    kpis = agg.route_kpis(routed_flights(t)).select("airline_code", "origin_iata", "dest_iata",
                                                     "total_flights")
    path = shared_path(t.spark, "warehouse", "agg_route_kpis")
    name = "agg_route_kpis_" + path.rsplit("/", 1)[-1]
    K.write_table(kpis, name, path, mode="overwrite")
    K.write_table(kpis, name, path, mode="overwrite")   # re-run: same table
    K.write_table(kpis, name, path, mode="append")      # append: rows twice
    return t.spark.table(name)


@q("sink_partition_overwrite")
def sink_partition_overwrite(t: Tables) -> DataFrame:
    """Daily mart partitioned by (year, airline); a corrected load for one
    year replaces only that year's partitions."""
    cols = ["full_date", "year", "airline_code", "total_flights", "delayed_flights"]
    mart = agg.daily_airline_mart(t.fact_flight, calendar(t), t.dim_airline).select(*cols)
    path = shared_path(t.spark, "lake", "mart_daily")
    K.write_partitioned(mart, path, ["year", "airline_code"])
    lo, hi = agg.year_key_range(REPORT_YEAR)
    corrected_fact = t.fact_flight.filter(F.col("date_key").between(lo, hi) & ~F.col("is_cancelled"))
    corrected = agg.daily_airline_mart(corrected_fact, calendar(t), t.dim_airline).select(*cols)
    K.write_partitioned(corrected, path, ["year", "airline_code"])
    return t.spark.read.parquet(path).select(*cols)


# ---------------------------------------------------------------- snapshots


_SNAP_COLS = ["flight_key", "date_key", "arr_delay_min", "is_cancelled"]


def _snapshot_scenario(t: Tables) -> X.SnapshotTable:
    """v1 = the fact table; v2 = the same after one day was deleted."""
    snap = X.SnapshotTable(t.spark, shared_path(t.spark, "snapshots", "fact_flight"))
    v1 = t.fact_flight.select(*_SNAP_COLS)
    snap.commit(v1, V1_TS)
    snap.commit(snap.read_version(1).filter(F.col("date_key") != DELETED_DAY), V2_TS)
    return snap


@q("asof_count")
def asof_count(t: Tables) -> DataFrame:
    snap = _snapshot_scenario(t)
    v = snap.version_as_of("2001-08-01 09:00:00")
    then = snap.read_at_offset(NOW, -86400)
    return then.agg(F.count(F.lit(1)).alias("row_count")).withColumn("version", F.lit(v))


@q("restore_deleted")
def restore_deleted(t: Tables) -> DataFrame:
    snap = _snapshot_scenario(t)
    return X.restore_deleted(snap, "2001-08-02 07:00:00", F.col("date_key") == DELETED_DAY,
                             "2001-08-02 10:00:00")


@q("snapshot_diff")
def snapshot_diff(t: Tables) -> DataFrame:
    """v1 vs a corrected v2 (one day deleted, missing arrival delays set to 0)."""
    snap = _snapshot_scenario(t)
    v2 = snap.read_version(2).withColumn("arr_delay_min", F.coalesce("arr_delay_min", F.lit(0)))
    return X.snapshot_diff(snap.read_version(1), v2, "flight_key")


@q("diff_pruned")
def diff_pruned(t: Tables) -> DataFrame:
    """A fact against one with a day's rows withdrawn, some corrected and some new."""
    old = t.fact_flight.filter(F.col("flight_key") % 1000 != 7).select("flight_key", "date_key", "arr_delay_min", "total_revenue")
    later = t.fact_flight.filter(F.col("flight_key") % 1000 != 11).select(*old.columns)
    fixed = F.when(F.col("flight_key") % 500 == 3, F.lit(None)).otherwise(F.col("arr_delay_min"))
    return pruned_diff(old, later.withColumn("arr_delay_min", fixed.cast("int")), "flight_key")


@q("set_minus")
def set_minus(t: Tables) -> DataFrame:
    """Routes flown in the report year and not in the next (EXCEPT, distinct)."""
    f = t.fact_flight.withColumn("y", F.floor(F.col("date_key") / 10000))
    cols = ["origin_airport_key", "dest_airport_key", "airline_code"]
    a = f.filter(F.col("y") == REPORT_YEAR).select(*cols)
    b = f.filter(F.col("y") == REPORT_YEAR + 1).select(*cols)
    return a.subtract(b)


# ---------------------------------------------------------------- layout


@q("layout_clustered")
def layout_clustered(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "lake", "fact_flight_clustered")
    K.write_clustered(t.fact_flight.select("flight_key", "date_key", "airline_key"), path,
                      ["date_key", "airline_key"])
    return t.spark.read.parquet(path)


@q("layout_zorder")
def layout_zorder(t: Tables) -> DataFrame:
    """A fact laid out on two columns alike, read with a filter on the second."""
    path = shared_path(t.spark, "lake", "fact_flight_zorder")
    K.write_zordered(t.fact_flight.select("flight_key", "date_key", "distance_miles"), path, ["date_key", "distance_miles"])
    return t.spark.read.parquet(path).filter(F.col("distance_miles").between(500, 700))


@q("point_lookup")
def point_lookup(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "lake", "dim_passenger")
    K.write_with_bloom(t.dim_passenger, path, ["passenger_id", "email"])
    return K.point_lookup(t.spark, path, "email", "a@x.com").select("passenger_key", "passenger_id", "email")
