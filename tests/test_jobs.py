"""Job-level properties: partition pruning, idempotent re-runs, dashboard filters."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from contrail.catalog import calendar
from contrail.fixtures import tables
from contrail.operators import cleaning as C
from contrail.plans import dashboard as B
from contrail.plans import jobs as J
from contrail.registered.jobs import scheduled_flights
from contrail.schemas import BTS_RAW_COLUMNS
from contrail.session import shared_path
from contrail.sources.sinks import write_partitioned


def test_partition_pruning_on_date_key(spark):
    t = tables(spark, SMALL)
    path = shared_path(spark, "test", "fact_by_day")
    write_partitioned(t.fact_flight.select("flight_key", "date_key", "arr_delay_min"), path, ["date_key"])
    df = spark.read.parquet(path).filter(F.col("date_key").between(19960101, 19961231))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "19960101" in plan
    assert df.count() == t.fact_flight.filter(F.col("date_key").between(19960101, 19961231)).count()


def test_incremental_load_rerun_is_noop(spark):
    t = tables(spark, SMALL)
    path = shared_path(spark, "test", "incr")
    first = C.transform_flights(t.bts_raw, load_ts="2001-08-01 06:00:00")
    first = first.withColumn("month_key", J.month_key())
    write_partitioned(first.filter(F.col("flight_date") < F.lit("1999-01-01").cast("date")), path, ["month_key"])
    inc = C.transform_flights(t.bts_raw, load_ts="2001-08-02 06:00:00")
    one = J.incremental_load(spark, path, inc)
    a = one["table"].drop("etl_load_ts").collect()
    b = J.incremental_load(spark, path, inc)["table"].drop("etl_load_ts").collect()
    assert one["merged"] + one["rejected"] == inc.count() and one["merged"] > 0 and one["rejected"] > 0
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) == first.count()


def test_kpi_row_airline_filter(spark):
    t = tables(spark, SMALL)
    everyone = {r.airline_code: r for r in B.kpi_row(t.fact_flight, "2001-08-02", 365).collect()}
    one = B.kpi_row(t.fact_flight, "2001-08-02", 365, airline="BUILDING").collect()
    codes = {r.airline_code for r in one}
    assert codes == {"BUILDING", "ALL"}
    row = next(r for r in one if r.airline_code == "BUILDING")
    assert row.total_flights == everyone["BUILDING"].total_flights
    assert sum(r.total_flights for k, r in everyone.items() if k != "ALL") == everyone["ALL"].total_flights


def test_cli_etl_backfill(spark):
    from contrail.cli import main
    from contrail.sources.landing import land_csv_by_month
    t = tables(spark, SMALL)
    landing = shared_path(spark, "test", "cli_landing")
    land_csv_by_month(t.bts_raw, landing)
    target, log = shared_path(spark, "test", "cli_target"), shared_path(spark, "test", "cli_log")
    main(["etl", "--landing", landing, "--target", target, "--log", log,
          "--backfill", "1996-01-01", "1996-12-31", "--columns", ",".join(BTS_RAW_COLUMNS)])
    loaded = spark.read.parquet(target)
    expected = C.transform_flights(t.bts_raw).filter(
        F.col("flight_date").between(F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")))
    assert loaded.count() == expected.count() > 0
    assert spark.read.parquet(log).filter("status = 'success'").count() > 0


def test_partial_increment_keeps_the_days_other_rows(spark):
    path = shared_path(spark, "test", "partial")
    cols = "flight_date date, record_hash string, etl_load_ts timestamp, v int, date_key int"
    row = lambda d, h, ts, v: (date(2024, 1, d), h, datetime(2024, 2, ts), v, 20240100 + d)
    first = spark.createDataFrame([row(5, "b", 1, 1), row(5, "c", 1, 1)], cols).withColumn("month_key", J.month_key())
    write_partitioned(first, path, ["month_key"])
    inc = spark.createDataFrame([row(5, "d", 2, 2), row(5, "c", 2, 2), row(1, "x", 2, 2),
                                 (None, "n", datetime(2024, 2, 2), 2, None)], cols)
    out = J.incremental_load(spark, path, inc)
    assert sorted((r.record_hash, r.v) for r in out["table"].collect()) == [("b", 1), ("c", 2), ("d", 2)]
    assert (out["merged"], out["rejected"]) == (2, 2)


def test_reruns_remove_what_left_the_data(spark):
    t = tables(spark, SMALL)
    raw, fact, kpis = (shared_path(spark, "test", n) for n in ("raw", "fact", "kpis"))
    flights = scheduled_flights(t)
    flights.write.parquet(raw)
    busy = flights.groupBy("full_date").agg(F.countDistinct("airline_code").alias("n"), F.min("airline_code").alias("a"))
    day, before, gone = busy.orderBy(F.desc("n"), "full_date").first()
    J.daily_batch(spark, raw, day.isoformat(), fact, kpis)
    assert spark.read.parquet(fact).select("airline_code").distinct().count() == before > 1
    raw2 = shared_path(spark, "test", "raw2")
    flights.filter(F.col("airline_code") != gone).write.parquet(raw2)
    J.daily_batch(spark, raw2, day.isoformat(), fact, kpis)
    left = {r.airline_code for r in spark.read.parquet(fact).select("airline_code").distinct().collect()}
    assert gone not in left and len(left) == before - 1
    assert spark.read.parquet(kpis).filter(F.col("airline_code") == gone).count() == 0


def test_emptied_month_leaves_the_mart(spark):
    t = tables(spark, SMALL)
    path, dim = shared_path(spark, "test", "mart"), calendar(t)
    J.build_daily_mart(t.fact_flight, dim, t.dim_airline, path)
    held = spark.read.parquet(path).filter("month_key = 199606").count()
    J.refresh_mart(t.fact_flight.filter("date_key < 19960601 or date_key > 19960630"), [199606], dim, t.dim_airline, path)
    after = spark.read.parquet(path)
    assert held > 0 and after.filter("month_key = 199606").count() == 0 and after.filter("month_key = 199607").count() > 0


def test_dates_beyond_any_fixed_calendar(spark):
    from contrail.operators import aggregates as agg
    from contrail.operators.dims import build_date_dimension, data_range
    f = tables(spark, SMALL).fact_flight.limit(5).withColumn("full_date", F.lit("2035-03-01").cast("date")) \
        .withColumn("date_key", F.lit(20350301))
    dim = build_date_dimension(spark, *data_range((f, "full_date")))
    mart = agg.daily_airline_mart(f, dim, tables(spark, SMALL).dim_airline)
    assert mart.agg(F.sum("total_flights")).first()[0] == 5


def test_failed_backfill_is_logged_and_raised(spark):
    log = shared_path(spark, "test", "failed_log")
    with pytest.raises(FileNotFoundError):
        J.backfill(spark, shared_path(spark, "test", "nothing"), BTS_RAW_COLUMNS, "1996-01-01", "1996-01-31",
                   shared_path(spark, "test", "t"), log)
    rows = spark.read.parquet(log).collect()
    assert [(r.status, r.rows_loaded) for r in rows] == [("failed", 0)] and rows[0].error_msg


def test_daily_batch_pushes_its_day_filter(spark):
    from contrail.sources.readers import read_table
    path = shared_path(spark, "test", "lake")
    tables(spark, SMALL).fact_flight.write.parquet(path)
    df, _ = read_table(spark, path, where=F.col("date_key") == 19960614)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(date_key,19960614)" in plan and "CollectMetrics" in plan
