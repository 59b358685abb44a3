"""Pruned differences, Z-order layout, rejected objects, quarantine and kept state of re-run jobs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from contrail.operators import diff as D
from contrail.plans import jobs as J
from contrail.session import glob_paths, shared_path
from contrail.sources import readers as RD
from contrail.sources import sinks as K
from contrail.sources.snapshots import snapshot_diff


def changes(df):
    return sorted((str(r.k), r.change_type) for r in df.collect())


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_pruned_diff_equals_the_plain_one(spark, buckets):
    rng = random.Random(buckets)
    old = [(k, rng.choice([None, 1, 2]), rng.choice([None, "x"])) for k in range(300)]
    new = [(k, a if rng.random() > 0.02 else 9, b) for k, a, b in old if rng.random() > 0.02] + [(900, 1, None)]
    schema = "k long, a int, b string"
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = changes(D.pruned_diff(o, n.select("b", "k", "a"), "k", buckets))
    assert got == changes(snapshot_diff(o, n, "k")) and {c for _, c in got} == {"added", "removed", "changed"}
    assert changes(D.pruned_diff(o, o, "k", buckets)) == [] and changes(D.pruned_diff(o.limit(0), o.limit(0), "k", buckets)) == []


def test_equal_buckets_are_not_joined(spark):
    o = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"))
    n = o.withColumn("a", F.when(F.col("k") == 77, F.lit(-1)).otherwise(F.col("a")))
    differ = D.unequal_buckets(o, n, "k", 256)
    assert differ.count() == 1
    joined = o.withColumn("_b", D.bucket_of("k", 256)).join(differ, "_b", "left_semi").count()
    assert 0 < joined < 5000 / 100
    # a repeated pair of rows does not cancel out
    assert D.unequal_buckets(o, o.unionByName(o.filter("k < 2")).unionByName(o.filter("k < 2")), "k", 256).count() == 2


def files_with(spark, path, cond):
    """The files that a filter has to open by their statistics of the two columns."""
    stats = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        *[f(c).alias(f"{n}_{c}") for c in ("a", "b") for n, f in (("lo", F.min), ("hi", F.max))])
    return stats.filter(cond).count()


def test_a_filter_on_either_column_reads_few_files(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"))
    linear, z = shared_path(spark, "test", "linear"), shared_path(spark, "test", "z")
    K.write_clustered(df, linear, ["a", "b"], 64)
    K.write_zordered(df, z, ["a", "b"], 64)
    assert sorted(map(tuple, spark.read.parquet(z).collect())) == sorted(map(tuple, df.collect()))
    on_b = (F.col("lo_b") <= 520) & (F.col("hi_b") >= 500)
    on_a = (F.col("lo_a") <= 520) & (F.col("hi_a") >= 500)
    assert files_with(spark, linear, on_b) >= 60
    assert files_with(spark, z, on_b) < files_with(spark, linear, on_b) / 2
    assert files_with(spark, z, on_a) < 32


def test_zorder_of_nulls_ties_and_empty(spark):
    rows = [(None, 1), (5, None), (None, None), (5, 1)] * 3
    df = spark.createDataFrame(rows, "a int, b int")
    for part in (df, df.limit(0), df.filter("a is null and b is null")):
        path = shared_path(spark, "test", "zn")
        K.write_zordered(part, path, ["a", "b"], 4)
        assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, part.collect()))


def test_rejected_objects_are_counted(spark):
    base = shared_path(spark, "test", "faa_bad")
    for airport, lines in (("JFK", ['{"departures": 12}']), ("BAD", ["{not json", '{"departures": 1}', "", "{x"])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/airport={airport}")
    schema = StructType().add("departures", LongType())
    assert [tuple(r) for r in RD.rejected_airport_status(spark, base, schema).collect()] == [("BAD", 2, "{not json")]
    assert sorted((r.airport, r.departures) for r in RD.read_airport_status(spark, base, schema).collect()) == [("BAD", 1), ("JFK", 12)]


def test_a_rerun_replaces_the_quarantine(spark):
    base, target = shared_path(spark, "test", "land"), shared_path(spark, "test", "target")
    log, held = shared_path(spark, "test", "log"), shared_path(spark, "test", "held")
    cols = ["FlightDate", "Carrier", "FlightNum", "TailNum", "DepTime", "DepDelay", "Cancelled"]
    for month, rows in (("2024_01", ["2024-01-05,AA,1,N1,1200,5,0.00", "2024-01-06,,2,N1,1200,5,0.00", "01/07/2024,AA,3,N1,1200,5,0"]),
                        ("2024_02", ["2024-02-01,AA,,N1,1200,5,0.00"])):
        text = "\n".join([",".join(cols), *rows])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/month={month}")

    def run(start, end):
        J.backfill(spark, base, cols, start, end, target, log, quarantine_path=held)
        return sorted((r.file_month, r.FlightNum or "", r.dq_reason) for r in spark.read.parquet(held).collect())

    january = [("2024_01", "2", "missing_flight_id"), ("2024_01", "3", "bad_date")]
    assert run("2024-01-01", "2024-01-31") == january
    assert run("2024-01-10", "2024-02-05") == january + [("2024_02", "", "missing_flight_id")]
    assert run("2024-01-01", "2024-02-29") == january + [("2024_02", "", "missing_flight_id")]


def test_a_corrected_day_voids_the_later_states(spark):
    def raw(rows):
        df = spark.createDataFrame(rows, "flight_key long, d string, arr_delay_min int")
        ts = F.col("d").cast("timestamp")
        zero = {c: F.lit(0) for c in ("carrier_delay_min", "weather_delay_min", "nas_delay_min", "security_delay_min",
                                      "late_aircraft_delay", "dep_delay_min", "distance_miles")}
        return df.withColumns({"sched_dep_ts": ts, "date_key": F.date_format(ts, "yyyyMMdd").cast("int"), "airline_code": F.lit("AA"),
                               "origin_iata": F.lit("JFK"), "dest_iata": F.lit("LAX"), "is_cancelled": F.lit(False),
                               "load_factor": F.lit("0.50").cast("decimal(5,2)"),
                               "total_revenue": F.lit("1.00").cast("decimal(12,2)"), **zero}).drop("d")

    rows = [(n, f"2024-01-{n + 1:02d}", 10 * n) for n in range(12)]
    lake, tail = shared_path(spark, "test", "raw"), shared_path(spark, "test", "tail")
    fact, kpis = shared_path(spark, "test", "fact"), shared_path(spark, "test", "kpis")

    def average(day):
        out = spark.read.parquet(fact).filter(F.col("date_key") == 20240100 + day).collect()
        return [r.rolling_7d_avg_delay for r in out]

    def plain(values, day):
        past = values[max(0, day - 8):day]
        return [sum(past) / len(past)]

    values = [r[2] for r in rows]
    raw(rows).write.parquet(lake)
    for day in (5, 8, 10):
        J.daily_batch(spark, lake, f"2024-01-{day:02d}", fact, kpis, tail)
        assert average(day) == plain(values, day)
    assert len(glob_paths(spark, f"{tail}/state_day=*")) == 3

    fixed = [(n, d, v + 1000 if n == 6 else v) for n, d, v in rows]   # the seventh of January
    lake2 = shared_path(spark, "test", "raw2")
    raw(fixed).write.parquet(lake2)
    J.daily_batch(spark, lake2, "2024-01-11", fact, kpis, tail)
    assert average(11) == plain([r[2] for r in fixed], 11)
    assert sorted(p.rsplit("=", 1)[1] for p in glob_paths(spark, f"{tail}/state_day=*")) == ["20240105", "20240111"]
    J.daily_batch(spark, lake2, "2024-01-12", fact, kpis, tail)
    assert average(12) == plain([r[2] for r in fixed], 12)
    assert len(glob_paths(spark, f"{tail}/state_day=*")) == 3
