"""Skew-safe operators equal the plain window forms, including on a hot key."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators import windows as win
from contrail.plans.ranking import distributed_ntile, global_index, successor


def _skewed(spark, n=3000):
    # one key holds a third of the rows; values repeat to create ties
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("grp"),
        (F.col("id") * 7919 % 97).cast("int").alias("v"),
        (F.col("id") % 40).cast("int").alias("day"))


def test_global_index_dense_and_ordered(spark):
    df = _skewed(spark)
    idx = global_index(df, ["grp", "v", "k"], "rn", num_partitions=7, total_col="n")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("grp", "v", "k")) - 1)
    j = idx.join(ref, "k")
    assert j.filter(F.col("rn") != F.col("ref")).count() == 0
    assert idx.select(F.max("n")).first()[0] == 3000


def test_distributed_ntile_matches(spark):
    df = _skewed(spark)
    for k in (3, 5, 7):
        d = distributed_ntile(df, k, [F.col("v").desc(), "k"], "nt", num_partitions=5)
        ref = df.withColumn("ref", F.ntile(k).over(Window.orderBy(F.col("v").desc(), "k")))
        assert d.join(ref, "k").filter(F.col("nt") != F.col("ref")).count() == 0


def test_successor_matches_lead_on_hot_partition(spark):
    df = _skewed(spark)
    s = successor(df, ["grp"], ["day", "k"], key="k", carry=["v"], num_partitions=6)
    ref = df.withColumn("ref", F.lead("k").over(Window.partitionBy("grp").orderBy("day", "k")))
    bad = s.join(ref.select("k", "ref"), "k").filter(~F.col("next_k").eqNullSafe(F.col("ref")))
    assert bad.count() == 0


def test_rows_frame_avg_matches_window(spark):
    df = _skewed(spark).withColumn("v", F.when(F.col("k") % 11 == 0, None).otherwise(F.col("v")))
    got = win.rows_frame_avg(df, "v", ["grp"], ["day", "k"], 7, "avg7")
    ref = df.withColumn("ref", F.avg("v").over(
        Window.partitionBy("grp").orderBy("day", "k").rowsBetween(-7, 0)))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(~F.col("avg7").eqNullSafe(F.col("ref"))).count() == 0


def test_day_range_avg_matches_window(spark):
    df = _skewed(spark).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))
    got = win.day_range_avg(df, "v", ["grp"], "d", 6, "avg7d")
    dn = F.datediff("d", F.lit("1970-01-01").cast("date"))
    ref = df.withColumn("dn", dn).withColumn("ref", F.avg("v").over(
        Window.partitionBy("grp").orderBy("dn").rangeBetween(-6, 0)))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(F.abs(F.col("avg7d") - F.col("ref")) > 1e-9).count() == 0


def test_partition_percent_rank_matches(spark):
    df = _skewed(spark).withColumn("v", F.when(F.col("k") % 13 == 0, None).otherwise(F.col("v")))
    got = win.partition_percent_rank(df, "v", ["grp", "day"], "pr")
    ref = df.withColumn("ref", F.percent_rank().over(
        Window.partitionBy("grp", "day").orderBy(F.col("v").asc_nulls_first())))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(F.abs(F.col("pr") - F.col("ref")) > 1e-12).count() == 0


def test_latest_per_key_matches_row_number(spark):
    df = _skewed(spark)
    got = win.latest_per_key(df.select("grp", "k", "v"), ["grp"], [F.col("v"), F.col("k")])
    ref = (df.withColumn("rn", F.row_number().over(
        Window.partitionBy("grp").orderBy(F.col("v").desc(), F.col("k").desc())))
        .filter("rn = 1").select("grp", "k", "v"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_global_index_with_aqe_sized_partitions(spark):
    df = _skewed(spark, 5000)
    idx = global_index(df, ["grp", "day", "k"], "rn", total_col="n")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("grp", "day", "k")) - 1)
    assert idx.join(ref, "k").filter(F.col("rn") != F.col("ref")).count() == 0


def test_top_n_per_group_matches_row_number(spark):
    df = _skewed(spark)
    got = win.top_n_per_group(df, ["grp"], [F.col("v").desc(), F.col("k")], 4, "rn")
    ref = (df.withColumn("rn", F.row_number().over(Window.partitionBy("grp").orderBy(F.col("v").desc(), "k")))
           .filter("rn <= 4"))
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert ref.select(*got.columns).exceptAll(got).count() == 0


def test_percent_rank_global_matches(spark):
    df = _skewed(spark)
    got = win.percent_rank_global(df, "v", "pr", descending=True)
    ref = df.withColumn("ref", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(F.abs(F.col("pr") - F.col("ref")) > 1e-12).count() == 0


def test_route_ranking_distributed_equals_single_task(spark):
    from conftest import MEDIUM
    from contrail.fixtures import tables
    from contrail.operators import aggregates as agg
    from contrail.plans import reports as R
    t = tables(spark, MEDIUM)
    cols = ["origin", "destination", "airline_code", "revenue_percentile", "load_percentile",
            "rpm_percentile", "smoothed_revenue"]
    a = R.route_ranked(t.fact_flight, t.dim_airport, t.dim_airline, 1996).select(*cols)
    plain = agg.route_metrics(t.fact_flight, t.dim_airport, t.dim_airline, 1996)
    for col, out in (("total_revenue", "revenue"), ("avg_load_factor", "load"), ("revenue_per_mile", "rpm")):
        w = Window.orderBy(F.col(col).desc_nulls_last())
        plain = plain.withColumn(f"{out}_percentile", F.percent_rank().over(w))
    near = Window.orderBy("total_miles", "origin", "destination", "airline_code").rowsBetween(-3, 3)
    b = plain.withColumn("smoothed_revenue", F.avg("total_revenue").over(near)).select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_centered_rows_frame_matches_window(spark):
    df = _skewed(spark)
    got = win.rows_frame_avg(df, "v", [], ["day", "k"], 3, "c", after=3)
    ref = df.withColumn("ref", F.avg("v").over(Window.orderBy("day", "k").rowsBetween(-3, 3)))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(~F.col("c").eqNullSafe(F.col("ref"))).count() == 0


def test_partition_percent_rank_unbounded_values_matches(spark):
    df = _skewed(spark).withColumn("x", F.when(F.col("k") % 13 == 0, None)
                                   .otherwise(F.col("k") * 1.5 % 101))
    got = win.partition_percent_rank(df, "x", ["grp", "day"], "pr", bounded_values=False, tiebreak="k")
    ref = df.withColumn("ref", F.percent_rank().over(
        Window.partitionBy("grp", "day").orderBy(F.col("x").asc_nulls_first())))
    j = got.join(ref.select("k", "ref"), "k")
    assert got.count() == df.count()
    assert j.filter(F.abs(F.col("pr") - F.col("ref")) > 1e-12).count() == 0


def test_global_operators_on_empty_input(spark):
    df = _skewed(spark).filter("k < 0")
    assert global_index(df, ["grp", "k"], "rn", total_col="n").count() == 0
    assert distributed_ntile(df, 5, ["v", "k"], "nt").count() == 0
    assert win.rows_frame_avg(df, "v", ["grp"], ["day", "k"], 7, "a").count() == 0
    assert win.top_n_per_group(df, ["grp"], [F.col("v"), F.col("k")], 3).count() == 0
    assert successor(df, ["grp"], ["day", "k"], key="k", carry=["v"]).count() == 0


def test_rows_frame_avg_keyed_path_matches(spark):
    df = _skewed(spark).withColumn("wide", F.repeat(F.lit("x"), 50))
    a = win.rows_frame_avg(df, "v", ["grp"], ["day", "k"], 7, "a", key=["k"])
    b = win.rows_frame_avg(df, "v", ["grp"], ["day", "k"], 7, "a")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_top_n_keyed_path_matches(spark):
    df = _skewed(spark).withColumn("wide", F.repeat(F.lit("y"), 40))
    order = [F.col("v").desc(), F.col("k")]
    a = win.top_n_per_group(df, ["grp"], order, 4, "rn", key=["k"], order_cols=["v", "k"])
    b = win.top_n_per_group(df, ["grp"], order, 4, "rn")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rows_frame_over_many_blocks_matches_window(spark, monkeypatch):
    monkeypatch.setattr(win, "FRAME_BLOCK", 10)
    df = _skewed(spark)
    for parts in ([], ["grp"]):
        got = win.rows_frame_avg(df, "v", parts, ["day", "k"], 7, "c", after=2)
        w = Window.partitionBy(*parts).orderBy("day", "k").rowsBetween(-7, 2)
        j = got.join(df.withColumn("ref", F.avg("v").over(w)).select("k", "ref"), "k")
        assert j.count() == df.count() and j.filter(~F.col("c").eqNullSafe(F.col("ref"))).count() == 0
