"""Mart states after deltas equal states built anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import deltas as D
from contrail.plans import jobs as J
from contrail.session import glob_paths, shared_path


@pytest.fixture
def kept(spark):
    return D.MartState(["g"], {"v": F.col("v"), "w": F.col("w")}, {"top": F.col("v")})


SCHEMA = "k int, g string, v int, w decimal(8,2)"


def fact(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def lines(df):
    columns = ["g", "n_rows", "v", "v_n", "w", "w_n", "top"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def random_rows(rng, n):
    from decimal import Decimal
    return [(k, rng.choice(["a", "b", None, f"g{k % 5}"]), rng.choice([None, 1, 2, 3, 50]),
             rng.choice([None, Decimal("1.25"), Decimal("-3.10")])) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_deltas(spark, kept, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 60)
    state = kept.build(fact(spark, rows))
    for _ in range(2):
        later = [r for r in rows if rng.random() > 0.2] + random_rows(rng, 10)
        later = [(k, g, rng.choice([v, None, 99]) if rng.random() < 0.2 else v, w) for k, g, v, w in later]
        later += later[:3]   # repeated rows
        merged = kept.merge(state, D.row_changes(fact(spark, rows), fact(spark, later)))
        state = kept.refreshed(merged, fact(spark, later))
        assert lines(state) == lines(kept.build(fact(spark, later)))
        rows = later


def test_only_lines_that_lost_their_maximum_are_stale(spark, kept):
    before = fact(spark, [(1, "a", 9, None), (2, "a", 5, None), (3, "b", 7, None), (4, "c", 4, None)])
    after = fact(spark, [(2, "a", 5, None), (3, "b", 8, None), (4, "c", 4, None), (5, "d", 1, None)])
    merged = kept.merge(kept.build(before), D.row_changes(before, after))
    assert {r.g: r._stale for r in merged.collect()} == {"a": True, "b": False, "c": False, "d": False}
    empty = D.row_changes(before, before)
    assert empty.count() == 0 and lines(kept.merge(kept.build(before), empty)) == lines(kept.build(before))
    assert kept.merge(kept.build(before), D.row_changes(before, before.limit(0))).count() == 0


FLIGHT = ("flight_key long, full_date date, date_key int, airline_key int, airline_code string, is_cancelled boolean, "
          "arr_delay_min int, dep_delay_min int, total_revenue decimal(12,2), load_factor decimal(5,2)")


def flights(spark, rows):
    df = spark.createDataFrame(rows, "flight_key long, day string, airline_key int, arr_delay_min int")
    return df.select("flight_key", F.col("day").cast("date").alias("full_date"),
                     F.date_format(F.col("day").cast("date"), "yyyyMMdd").cast("int").alias("date_key"), "airline_key",
                     F.lit("AA").alias("airline_code"), F.lit(False).alias("is_cancelled"), "arr_delay_min",
                     F.lit(1).alias("dep_delay_min"), F.lit("10.50").cast("decimal(12,2)").alias("total_revenue"),
                     F.lit("0.50").cast("decimal(5,2)").alias("load_factor"))


def test_the_job_touches_only_the_delta_s_months(spark):
    path = shared_path(spark, "test", "mart_state")
    before = flights(spark, [(1, "2024-01-05", 1, 30), (2, "2024-01-05", 1, 5), (3, "2024-02-05", 1, 7), (4, "2024-03-01", 2, 1)])
    after = flights(spark, [(2, "2024-01-05", 1, 5), (3, "2024-02-05", 1, 7), (5, "2024-03-02", 2, 9)])
    J.build_mart_state(before, path)
    files = glob_paths(spark, f"{path}/month_key=202402/*")
    out = J.apply_mart_delta(spark, path, D.row_changes(before, after), after)
    assert out == {"months": [202401, 202403], "stale": 1}
    now = spark.read.parquet(path)
    assert files and glob_paths(spark, f"{path}/month_key=202402/*") == files
    assert sorted((str(r.full_date), r.airline_key, r.n_rows, r.max_arr_delay) for r in now.collect()) == [
        ("2024-01-05", 1, 1, 5), ("2024-02-05", 1, 1, 7), ("2024-03-02", 2, 1, 9)]
    gone = flights(spark, [(9, "2024-02-05", 1, 7), (10, "2024-02-05", 1, 7)])
    with pytest.raises(ValueError, match="more rows"):
        J.apply_mart_delta(spark, path, D.row_changes(gone, gone.limit(0)), after)
    assert J.apply_mart_delta(spark, path, D.row_changes(after, after), after) == {"months": [], "stale": 0}
