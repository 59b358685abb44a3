"""Streams over time: closed windows folded, copies dropped, late events kept, bitmaps merged."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from contrail.session import delete_path, glob_paths, shared_path
from contrail.streaming import kpis as SK
from contrail.streaming.late import LateRouter, dedup_events
from contrail.streaming.progress import ProgressLog, parsed, watermark_of
from contrail.streaming.runner import start_upsert
from contrail.streaming.sink import UpsertSink

START = datetime(2024, 5, 1, 10, 0, 0)
KEYS = ["window_start", "window_end", "airline_code", "origin_iata"]


def message(n, minute, tail="N1", origin="JFK"):
    return json.dumps({"event_id": str(n), "event_ts": (START + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.%f"),
                       "airline_code": "AA", "origin_iata": origin, "dep_delay_min": n % 50, "tail_number": tail,
                       "status": "DEPARTED"})


def land(spark, path, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(path)


def decoded(spark, messages):
    return SK.decode_events(spark.createDataFrame([(m,) for m in messages], "value string"))


def rows(df):
    return sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect())


def test_closed_windows_are_folded_once(spark):
    src, ck = shared_path(spark, "test", "src"), shared_path(spark, "test", "ck")
    sink = UpsertSink(shared_path(spark, "test", "sink"), KEYS)
    rng = random.Random(2)
    sent, left = [], []
    for batch in range(6):
        new = [message(100 * batch + k, 12 * batch + rng.uniform(0, 12), f"N{rng.randint(0, 4)}") for k in range(20)]
        sent += new
        land(spark, src, new)
        query = start_upsert(SK.windowed_kpis(SK.file_events(spark, src)), sink, ck, available_now=True)
        query.awaitTermination()
        left.append(sink.compact(spark, watermark_of(query)))
        assert sink.compact(spark, watermark_of(query)) == left[-1]   # nothing new to close
    want = rows(SK.windowed_kpis(decoded(spark, sent)))
    assert rows(sink.read(spark)) == want
    assert max(left) <= 3 and len(sink.folds(spark)) >= 4   # the open batches do not grow with the batches
    assert len(glob_paths(spark, f"{sink.path}/batch_id=*")) == left[-1]

    # a batch of closed windows comes again, and a fold breaks off before its marker
    again = sink.read(spark).limit(3).withColumn("flights_in_window", F.lit(999).cast("long"))
    sink(again.filter(F.col("window_end") <= F.timestamp_micros(F.lit(sink.folds(spark)[-1]))), 0)
    assert rows(sink.read(spark)) == want
    last = sink.folds(spark)[-1]
    end = watermark_of(query) + timedelta(minutes=60)
    sink.compact(spark, end)
    assert rows(sink.read(spark)) == want and not sink.batches(spark)
    delete_path(spark, f"{sink.path}/closed/fold={sink.folds(spark)[-1]}/_SUCCESS")
    assert sink.folds(spark)[-1] == last


def test_a_sink_before_its_first_batch(spark):
    sink = UpsertSink(shared_path(spark, "test", "none"), ["k"], SK.decode_events(
        spark.createDataFrame([], "value string")).schema)
    assert sink.read(spark).count() == 0 and sink.compact(spark, datetime.now(timezone.utc)) == 0
    assert parsed(None) is None and parsed("1970-01-01T00:00:00.000Z") is None


def test_copies_are_dropped_across_a_restart(spark):
    src, ck = shared_path(spark, "test", "dup"), shared_path(spark, "test", "dupck")
    sink = UpsertSink(shared_path(spark, "test", "dupsink"), ["event_id"])
    one = [message(n, n % 9) for n in range(30)]
    two = [message(n, 9 + n % 4) for n in range(30, 50)]
    for files in ([one, one[:7]], [one, two, two], [two[:5], one]):
        for f in files:
            land(spark, src, f)
        (dedup_events(SK.file_events(spark, src)).writeStream.foreachBatch(sink).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    got = [r.event_id for r in sink.rows(spark).collect()]
    assert sorted(map(int, got)) == list(range(50))


def test_late_events_are_kept_and_agree_with_the_dropped_rows(spark):
    src, log = shared_path(spark, "test", "late"), ProgressLog(spark)
    router = LateRouter(shared_path(spark, "test", "routed"))
    sink = UpsertSink(shared_path(spark, "test", "latesink"), KEYS)
    cks = shared_path(spark, "test", "ck1"), shared_path(spark, "test", "ck2")
    spark.streams.addListener(log)
    try:
        sent = [message(n, n) for n in range(40)]
        late = [message(100 + n, m) for n, m in enumerate((0, 1, 2, 14, 29.9, 31, 39))]
        for batch in (sent, late):
            land(spark, src, batch)
            events = SK.file_events(spark, src)
            route = (events.writeStream.foreachBatch(router).option("checkpointLocation", cks[0])
                     .trigger(availableNow=True).start())
            route.awaitTermination()
            kpis = start_upsert(SK.windowed_kpis(SK.file_events(spark, src)), sink, cks[1], available_now=True)
            kpis.awaitTermination()
            assert log.wait(route) and log.wait(kpis)
    finally:
        spark.streams.removeListener(log)
    # windows up to minute 25 are closed: the newest event is of minute 39, the delay ten minutes
    side = {r.event_id: r.late_by_sec for r in router.late(spark).collect()}
    assert side == {"100": 29 * 60.0, "101": 28 * 60.0, "102": 27 * 60.0, "103": 15 * 60.0}
    kept = router.kept(spark)
    assert kept.count() + len(side) == len(sent) + len(late)
    assert log.input[str(route.id)] == len(sent) + len(late)
    # Spark's counter is of window lines, not of events: minutes 0 to 2 are one line
    assert log.dropped[str(kpis.id)] == 2
    assert rows(sink.read(spark)) == rows(SK.windowed_kpis(kept.drop("batch_id")))


def test_a_replayed_batch_is_routed_alike(spark):
    router = LateRouter(shared_path(spark, "test", "replay"))
    first, second = [message(n, n) for n in range(30)], [message(90, 1), message(91, 29)]
    no_time = decoded(spark, ['{"event_id": "x"}', "not json"])
    router(decoded(spark, first), 0)
    router(decoded(spark, second).unionByName(no_time), 1)
    router(decoded(spark, [message(200, 300)]), 2)
    before = rows(router.late(spark)), rows(router.kept(spark))
    router(decoded(spark, second).unionByName(no_time), 1)
    assert (rows(router.late(spark)), rows(router.kept(spark))) == before
    assert [r.event_id for r in router.late(spark).collect()] == ["90"]
    assert router.kept(spark).count() == 30 + 1 + 2 + 1


def test_bitmaps_count_like_sets(spark):
    rng = random.Random(4)
    sent = [message(n, rng.uniform(0, 60), rng.choice([None, "N-unknown", *[f"N{k}" for k in range(12)]]),
                    rng.choice(["JFK", "LAX"])) for n in range(400)]
    events = decoded(spark, sent)
    # keys in two buckets of 32,768
    aircraft = spark.createDataFrame([(f"N{k}", 1 + k * 5000) for k in range(12)], "tail_number string, aircraft_key long")
    got = SK.sliding_aircraft(SK.aircraft_panes(events, aircraft, ["origin_iata"]), ["origin_iata"])
    want = (events.join(aircraft, "tail_number", "left").groupBy(F.window("event_ts", "15 minutes", "5 minutes").alias("w"), "origin_iata")
            .agg(F.count("*").alias("events"), F.countDistinct("aircraft_key").alias("active_aircraft"))
            .select("origin_iata", "events", "active_aircraft", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")))
    assert rows(got) == rows(want)
    cells = SK.aircraft_panes(events, aircraft, ["origin_iata"]).filter("bucket is not null")
    assert {r[0] for r in cells.select(F.length("aircraft")).collect()} == {4096}
