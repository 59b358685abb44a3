"""Stateful operators: SCD merges, snapshots, idempotent loads, streaming restart."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from contrail.operators import scd as S
from contrail.session import shared_path
from contrail.sources import snapshots as X


def test_scd2_cases_and_rerun_noop(spark):
    hist = S.scd2_init(spark.createDataFrame(
        [("p1", "Gold"), ("p2", "Silver"), ("p3", None)], "pid string, tier string"), "2020-01-01")
    feed = spark.createDataFrame([("p1", "Gold"), ("p2", "Platinum"), ("p3", "Bronze"), ("p4", "Silver")],
                                 "pid string, tier string")
    h1 = S.scd2_upsert(hist, feed, "pid", ["tier"], "2024-05-01")
    rows = {(r.pid, r.tier, r.is_current) for r in h1.collect()}
    assert ("p1", "Gold", True) in rows
    assert ("p2", "Silver", False) in rows and ("p2", "Platinum", True) in rows
    assert ("p3", None, False) in rows and ("p3", "Bronze", True) in rows   # NULL -> value is a change
    assert ("p4", "Silver", True) in rows
    h2 = S.scd2_upsert(h1, feed, "pid", ["tier"], "2024-05-02")
    assert h2.exceptAll(h1).count() == 0 and h1.exceptAll(h2).count() == 0


def test_scd1_prefers_source(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    out = sorted(tuple(r) for r in S.scd1_upsert(tgt, src, "k").collect())
    assert out == [(1, "a"), (2, "B"), (3, "c")]


def test_surrogate_keys_continue_after_max(spark):
    existing = spark.createDataFrame([("a", 10), ("b", 11)], "nid string, sk long")
    incoming = spark.createDataFrame([("b",), ("d",), ("c",), ("c",)], "nid string")
    out = {r.nid: (r.sk, r.is_new) for r in S.assign_surrogate_keys(existing, incoming, "nid", "sk").collect()}
    assert out == {"a": (10, False), "b": (11, False), "c": (12, True), "d": (13, True)}


def test_snapshot_as_of_and_restore(spark):
    snap = X.SnapshotTable(spark, shared_path(spark, "test", "snap"))
    base = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).alias("day"))
    snap.commit(base, "2024-12-01 00:00:00")
    snap.commit(base.filter("day != 1"), "2024-12-01 12:00:00")
    assert snap.read_as_of("2024-12-01 06:00:00").count() == 10
    assert snap.read_at_offset("2024-12-02 06:00:00", -86400).count() == 10
    assert snap.read_current().count() == 7
    restored = X.restore_deleted(snap, "2024-12-01 06:00:00", F.col("day") == 1, "2024-12-01 13:00:00")
    assert restored.count() == 10
    diff = X.snapshot_diff(base, base.filter("day != 1"), "k")
    assert {r.change_type for r in diff.collect()} == {"removed"}


def test_partition_overwrite_is_idempotent(spark):
    from contrail.sources.sinks import write_partitioned
    path = shared_path(spark, "test", "po")
    df = spark.range(20).select(F.col("id"), (F.col("id") % 4).alias("p"))
    write_partitioned(df, path, ["p"])
    write_partitioned(df.filter("p = 1"), path, ["p"])
    write_partitioned(df.filter("p = 1"), path, ["p"])
    assert spark.read.parquet(path).count() == 20


def test_upsert_sink_replay_does_not_duplicate(spark):
    from contrail.streaming.sink import UpsertSink
    sink = UpsertSink(shared_path(spark, "test", "sink"), ["k"])
    b0 = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    b1 = spark.createDataFrame([(1, 7)], "k int, v int")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replay after a failure
    sink(spark.createDataFrame([], "k int, v int"), 2)  # empty batch skipped
    got = sorted(tuple(r) for r in sink.read(spark).collect())
    assert got == [(1, 7), (2, 6)]
    assert not os.path.exists(sink.path.replace("file:", "") + "/batch_id=2")


def test_stream_restart_from_checkpoint_and_late_rows(spark):
    from contrail.streaming import kpis as SK
    from contrail.streaming.runner import start_upsert
    from contrail.streaming.sink import UpsertSink
    import json
    src = shared_path(spark, "test", "stream_src")
    msgs = [json.dumps({"event_id": str(i), "event_ts": f"2024-01-01T10:{i:02d}:00.000000",
                        "airline_code": "AA", "origin_iata": "JFK", "dep_delay_min": 40,
                        "tail_number": f"N{i}", "status": "DEPARTED"}) for i in range(0, 50, 5)]
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(src)
    sink = UpsertSink(shared_path(spark, "test", "stream_sink"), ["window_start", "airline_code", "origin_iata"])
    ck = shared_path(spark, "test", "stream_ck")
    start_upsert(SK.windowed_kpis(SK.file_events(spark, src)), sink, ck, available_now=True).awaitTermination()
    late = [json.dumps({"event_id": "late1", "event_ts": "2024-01-01T10:15:00.000000", "airline_code": "AA",
                        "origin_iata": "JFK", "dep_delay_min": 1, "tail_number": "NX", "status": "DEPARTED"}),
            json.dumps({"event_id": "ok1", "event_ts": "2024-01-01T10:44:00.000000", "airline_code": "AA",
                        "origin_iata": "JFK", "dep_delay_min": 1, "tail_number": "NY", "status": "DEPARTED"})]
    spark.createDataFrame([(m,) for m in late], "value string").coalesce(1).write.mode("append").text(src)
    q = start_upsert(SK.windowed_kpis(SK.file_events(spark, src)), sink, ck, available_now=True)
    q.awaitTermination()
    rows = {r.window_start.minute: r.flights_in_window for r in sink.read(spark).collect()}
    assert rows[15] == 1          # the 10:15 late row (behind the watermark) was dropped
    assert rows[40] == 2          # the 10:44 row (within tolerance) was added


def test_scd2_same_day_second_change_replaces_version(spark):
    hist = S.scd2_init(spark.createDataFrame([("p1", "Gold")], "pid string, tier string"), "2020-01-01")
    h1 = S.scd2_upsert(hist, spark.createDataFrame([("p1", "Silver")], "pid string, tier string"),
                       "pid", ["tier"], "2024-05-01")
    h2 = S.scd2_upsert(h1, spark.createDataFrame([("p1", "Bronze")], "pid string, tier string"),
                       "pid", ["tier"], "2024-05-01")
    rows = sorted((r.tier, str(r.effective_date), str(r.expiry_date), r.is_current) for r in h2.collect())
    assert rows == [("Bronze", "2024-05-01", "9999-12-31", True),
                    ("Gold", "2020-01-01", "2024-05-01", False)]


def test_upserts_take_one_feed_row_per_key_and_reject_null_keys(spark):
    feed = spark.createDataFrame([("p1", "Gold", 2), ("p1", "Silver", 1), (None, "x", 3)], "pid string, tier string, at int")
    hist = S.scd2_init(spark.createDataFrame([("p1", "Bronze")], "pid string, tier string"), "2024-01-01")
    out = S.scd2_upsert(hist, feed, "pid", ["tier"], "2024-05-01", order=["at"])
    assert sorted((r.tier, r.is_current) for r in out.collect()) == [("Bronze", False), ("Gold", True)]
    again = S.scd2_upsert(out, feed, "pid", ["tier"], "2024-05-02", order=["at"])
    assert again.count() == 2 and S.without_key(feed, "pid").count() == 1
    tgt = spark.createDataFrame([("p1", "Bronze"), ("p2", "Tin")], "pid string, tier string")
    got = {tuple(r) for r in S.scd1_upsert(tgt, feed, "pid", order=["at"]).collect()}
    assert got == {("p1", "Gold"), ("p2", "Tin")}
