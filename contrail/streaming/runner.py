"""Starting the stream queries: triggers, checkpoints, two queries on one source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from contrail.streaming.sink import UpsertSink

# Production trigger intervals of the two queries.
KPI_TRIGGER = "5 minutes"
ALERT_TRIGGER = "1 minute"


def start_upsert(df: DataFrame, sink: UpsertSink, checkpoint: str,
                 trigger: str | None = KPI_TRIGGER, available_now: bool = False,
                 name: str | None = None) -> StreamingQuery:
    """Update-mode query into an idempotent foreachBatch sink.

    ``available_now=True`` processes what is there and stops (tests, backfills);
    otherwise a processing-time trigger runs continuously.
    """
    w = (df.writeStream.foreachBatch(sink).outputMode("update")
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_both(kpis: DataFrame, alerts: DataFrame, kpi_sink: UpsertSink, alert_sink: UpsertSink,
             checkpoint_root: str, available_now: bool = False) -> list[StreamingQuery]:
    """KPIs and alerts as two queries; waits for whichever ends first so a
    failure of either surfaces."""
    q1 = start_upsert(kpis, kpi_sink, f"{checkpoint_root}/airport_kpi", KPI_TRIGGER,
                      available_now, "airport_kpi")
    q2 = start_upsert(alerts, alert_sink, f"{checkpoint_root}/delay_alerts", ALERT_TRIGGER,
                      available_now, "delay_alerts")
    spark = kpis.sparkSession
    if available_now:
        for q in (q1, q2):
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return [q1, q2]
