"""Keys for Structured Streaming.

Flight events are landed as JSON-lines messages (the shape of Kafka values)
in the shared folder and consumed with the file stream source; the stream
queries run with ``availableNow`` and write through the idempotent upsert
sink, whose latest-per-key view is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.catalog import q
from contrail.fixtures import Tables
from contrail.operators.scd import assign_surrogate_keys
from contrail.registered.storage import TS_FORMAT
from contrail.session import shared_path
from contrail.streaming import kpis as SK
from contrail.streaming.late import LateRouter, dedup_events
from contrail.streaming.progress import watermark_of
from contrail.streaming.runner import run_both, start_upsert
from contrail.streaming.sink import UpsertSink

KPI_KEYS = ["window_start", "window_end", "airline_code", "origin_iata"]
ALERT_KEYS = ["window_start", "window_end", "origin_iata"]
# Number of time-ordered files for the multi-batch runs; late offsets.
SLICES = 4
LATE_OFFSETS_MIN = (30, 3)
HELD_BACK = 7


def event_messages(t: Tables) -> DataFrame:
    ap = t.dim_airport.select(F.col("airport_key").alias("origin_airport_key"),
                              F.col("iata_code").alias("origin_iata"))
    e = t.flight_events.join(ap, "origin_airport_key")
    ts = F.col("event_ts").cast("timestamp")
    body = F.struct(F.col("event_id").cast("string").alias("event_id"), ts.alias("event_ts"),
                    "airline_code", "origin_iata", "dep_delay_min", "tail_number", "status")
    return e.select(ts.alias("ts"), F.to_json(body, {"timestampFormat": TS_FORMAT}).alias("value"))


def land_messages(t: Tables, path: str) -> None:
    """All messages at once, time-ordered across files."""
    m = event_messages(t)
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    m.repartitionByRange(n, "ts").sortWithinPartitions("ts").select("value") \
        .write.mode("overwrite").text(path)


def time_slices(t: Tables, path: str, slices: int = SLICES) -> Iterator[None]:
    """Lands the messages slice by slice of equal time ranges, in event-time
    order as a topic would deliver them; the caller runs its query after each.
    The messages are made once, and a slice is as many files as it has tasks."""
    staged = shared_path(t.spark, "stream", "staged")
    event_messages(t).write.parquet(staged)
    m = t.spark.read.parquet(staged)
    lo, hi = m.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return
    step = (hi - lo) / slices
    for i in range(slices):
        start = lo + step * i
        cond = F.col("ts") >= F.lit(start)
        if i < slices - 1:
            cond = cond & (F.col("ts") < F.lit(start + step))
        m.filter(cond).select("value").write.mode("append").text(path)
        yield


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                           "window_end": F.col("window_end").cast("timestamp_ntz")})


@q("stream_tumbling_kpi")
def stream_tumbling_kpi(t: Tables) -> DataFrame:
    src = shared_path(t.spark, "stream", "flight_events")
    land_messages(t, src)
    sink = UpsertSink(shared_path(t.spark, "sinks", "airport_kpi"), KPI_KEYS)
    qy = start_upsert(SK.windowed_kpis(SK.file_events(t.spark, src)), sink,
                      shared_path(t.spark, "checkpoints", "airport_kpi"), available_now=True)
    qy.awaitTermination()
    return _ntz(sink.read(t.spark))


@q("stream_cascade_alerts")
def stream_cascade_alerts(t: Tables) -> DataFrame:
    """Both queries on one decoded source; the alert table is returned."""
    src = shared_path(t.spark, "stream", "flight_events")
    land_messages(t, src)
    events = SK.file_events(t.spark, src)
    kpi_sink = UpsertSink(shared_path(t.spark, "sinks", "airport_kpi"), KPI_KEYS)
    alert_sink = UpsertSink(shared_path(t.spark, "sinks", "delay_alerts"), ALERT_KEYS)
    run_both(SK.windowed_kpis(events), SK.cascade_alerts(events), kpi_sink, alert_sink,
             shared_path(t.spark, "checkpoints"), available_now=True)
    return _ntz(alert_sink.read(t.spark)).drop("alert_ts")


@q("stream_sink_upsert")
def stream_sink_upsert(t: Tables) -> DataFrame:
    """Several micro-batches (one time slice each) in update mode: windows are
    re-emitted as they change and the sink keeps the latest version."""
    src = shared_path(t.spark, "stream", "flight_events_sliced")
    sink = UpsertSink(shared_path(t.spark, "sinks", "airport_kpi"), KPI_KEYS)
    checkpoint = shared_path(t.spark, "checkpoints", "airport_kpi")
    for _ in time_slices(t, src):
        start_upsert(SK.windowed_kpis(SK.file_events(t.spark, src)), sink, checkpoint,
                     available_now=True).awaitTermination()
    return _ntz(sink.read(t.spark))


@q("stream_late_data")
def stream_late_data(t: Tables) -> DataFrame:
    """Run, then restart from the checkpoint with two late copies of the newest
    event (30 and 3 minutes behind): the first is behind the 10-minute
    watermark and dropped, the second updates its open window."""
    src = shared_path(t.spark, "stream", "flight_events_late")
    land_messages(t, src)
    sink = UpsertSink(shared_path(t.spark, "sinks", "airport_kpi"), KPI_KEYS)
    ck = shared_path(t.spark, "checkpoints", "airport_kpi")
    start_upsert(SK.windowed_kpis(SK.file_events(t.spark, src)), sink, ck,
                 available_now=True).awaitTermination()
    newest = event_messages(t).orderBy(F.col("ts").desc()).limit(1)
    parsed = SK.decode_events(newest.select("value"))
    late = None
    for minutes in LATE_OFFSETS_MIN:
        shifted = parsed.withColumn("event_ts", F.col("event_ts") - F.expr(f"INTERVAL {minutes} MINUTES"))
        body = F.to_json(F.struct(*[F.col(c) for c in shifted.columns]), {"timestampFormat": TS_FORMAT})
        part = shifted.select(body.alias("value"))
        late = part if late is None else late.unionByName(part)
    late.coalesce(1).write.mode("append").text(src)
    start_upsert(SK.windowed_kpis(SK.file_events(t.spark, src)), sink, ck,
                 available_now=True).awaitTermination()
    return _ntz(sink.read(t.spark))


@q("stream_source")
def stream_source(t: Tables) -> DataFrame:
    """The decoded event stream itself, appended batch by batch to the sink
    folder (every event once; keys are unique event ids)."""
    src = shared_path(t.spark, "stream", "flight_events_raw")
    sink = UpsertSink(shared_path(t.spark, "sinks", "flight_events"), ["event_id"])
    checkpoint = shared_path(t.spark, "checkpoints", "flight_events")
    for _ in time_slices(t, src):
        events = SK.file_events(t.spark, src)
        (events.writeStream.foreachBatch(sink).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    out = sink.read(t.spark)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz")
                            for c in ("event_ts", "sched_dep_ts", "actual_dep_ts")})


def _timestamps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("event_ts", "sched_dep_ts", "actual_dep_ts")})


def _append(df: DataFrame, sink, checkpoint: str) -> None:
    (df.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


@q("stream_compacted")
def stream_compacted(t: Tables) -> DataFrame:
    """KPIs in several micro-batches whose closed windows are folded after each; then the
    first batch is delivered to the sink again."""
    src = shared_path(t.spark, "stream", "flight_events_sliced")
    sink = UpsertSink(shared_path(t.spark, "sinks", "airport_kpi"), KPI_KEYS)
    checkpoint, first = shared_path(t.spark, "checkpoints", "airport_kpi"), shared_path(t.spark, "stream", "first_batch")
    for k, _ in enumerate(time_slices(t, src)):
        query = start_upsert(SK.windowed_kpis(SK.file_events(t.spark, src)), sink, checkpoint, available_now=True)
        query.awaitTermination()
        if k == 0:
            sink.rows(t.spark, [0]).drop("_written_batch").write.parquet(first)
        sink.compact(t.spark, watermark_of(query))
    if t.events.isEmpty():
        return _ntz(SK.windowed_kpis(SK.decode_events(event_messages(t).select("value"))))
    sink(t.spark.read.parquet(first), 0)
    return _ntz(sink.read(t.spark))


@q("stream_dedup")
def stream_dedup(t: Tables) -> DataFrame:
    """Every slice's files are delivered twice, and the first slice once more after a
    restart; the rows of all batches together hold each event once."""
    src = shared_path(t.spark, "stream", "flight_events_twice")
    sink = UpsertSink(shared_path(t.spark, "sinks", "flight_events_once"), ["event_id"])
    checkpoint = shared_path(t.spark, "checkpoints", "flight_events_once")
    staged = shared_path(t.spark, "stream", "slices")
    schema = SK.decode_events(event_messages(t).select("value")).schema
    seen = 0
    for seen, _ in enumerate(time_slices(t, f"{staged}/now"), 1):
        # the slices so far: the newest of them is delivered twice, the others once again
        now = t.spark.read.text(f"{staged}/now")
        now.write.text(f"{src}/run={seen}a")
        now.write.text(f"{src}/run={seen}b")
        _append(dedup_events(SK.file_events(t.spark, f"{src}/run=*")), sink, checkpoint)
    if not seen:
        return _timestamps(t.spark.createDataFrame([], schema))
    return _timestamps(sink.rows(t.spark).drop("_written_batch"))


@q("stream_late_side")
def stream_late_side(t: Tables) -> DataFrame:
    """Every seventh event is delivered after all others: those whose window is closed
    by then come out late, with by how much; all events come out."""
    src = shared_path(t.spark, "stream", "flight_events_held")
    router = LateRouter(shared_path(t.spark, "sinks", "routed"))
    checkpoint = shared_path(t.spark, "checkpoints", "routed")
    held = F.get_json_object("value", "$.event_id").cast("long") % HELD_BACK == 0
    for k, cond in enumerate((~held, held)):
        event_messages(t).filter(cond).select("value").write.text(f"{src}/run={k}")
        _append(SK.file_events(t.spark, f"{src}/run=*"), router, checkpoint)
    columns = ["event_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "airline_code", "origin_iata"]
    kept, late = router.kept(t.spark), router.late(t.spark)
    if kept is None:
        none = SK.decode_events(event_messages(t).select("value"))
        return none.select(*columns, F.lit(False).alias("is_late"), F.lit(None).cast("double").alias("late_by_sec"))
    return kept.select(*columns, F.lit(False).alias("is_late"), F.lit(None).cast("double").alias("late_by_sec")).unionByName(
        late.select(*columns, F.lit(True).alias("is_late"), "late_by_sec"))


@q("stream_bitmap_distinct")
def stream_bitmap_distinct(t: Tables) -> DataFrame:
    """Exact distinct aircraft of sliding windows per airport, from panes' bitmaps kept by a
    stream in several batches."""
    src = shared_path(t.spark, "stream", "flight_events_panes")
    tails = t.flight_events.select("tail_number").distinct()
    known = t.spark.createDataFrame([], "tail_number string, aircraft_key long")
    numbered = shared_path(t.spark, "stream", "aircraft")
    assign_surrogate_keys(known, tails, "tail_number", "aircraft_key").write.parquet(numbered)
    aircraft = t.spark.read.parquet(numbered)
    keys = ["origin_iata"]
    panes = None
    sink = UpsertSink(shared_path(t.spark, "sinks", "aircraft_panes"), ["window_start", "window_end", *keys, "bucket"])
    checkpoint = shared_path(t.spark, "checkpoints", "aircraft_panes")
    for _ in time_slices(t, src):
        panes = SK.aircraft_panes(SK.file_events(t.spark, src), aircraft, keys)
        start_upsert(panes, sink, checkpoint, available_now=True).awaitTermination()
    if panes is None:
        batch = SK.aircraft_panes(SK.decode_events(event_messages(t).select("value")), aircraft, keys)
        return _ntz(SK.sliding_aircraft(batch, keys))
    return _ntz(SK.sliding_aircraft(sink.read(t.spark), keys))
