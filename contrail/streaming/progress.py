"""What running queries report: watermarks and rows dropped as late, by a query listener."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from contrail.streaming.sink import UpsertSink


def parsed(stamp: str | None) -> datetime | None:
    """A progress report's time (ISO with Z); None for none, or for the epoch, where a watermark begins."""
    at = datetime.fromisoformat(stamp.replace("Z", "+00:00")) if stamp else None
    return at if at and at.timestamp() > 0 else None


def watermark_of(query: StreamingQuery) -> datetime | None:
    """The watermark that the query's last finished batch used."""
    progress = query.lastProgress
    return parsed((progress or {}).get("eventTime", {}).get("watermark"))


class ProgressLog(StreamingQueryListener):
    """Counts per query id the input rows and the rows that stateful operators dropped
    behind the watermark. With a sink, its closed windows are folded every
    ``fold_every`` reports, which keeps a long-running query's reads bounded."""

    def __init__(self, spark: SparkSession, sink: UpsertSink | None = None, query_name: str | None = None, fold_every: int = 12):
        self.spark, self.sink, self.query_name, self.fold_every = spark, sink, query_name, fold_every
        self.input: dict[str, int] = {}
        self.dropped: dict[str, int] = {}
        self.reports = 0
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        key = str(p.id)
        self.input[key] = self.input.get(key, 0) + p.numInputRows
        self.dropped[key] = self.dropped.get(key, 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        if self.sink is not None and p.name == self.query_name:
            self.reports += 1
            if self.reports % self.fold_every == 0:
                self.sink.compact(self.spark, parsed((p.eventTime or {}).get("watermark")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Until the listener has heard that a query's run ended (reports come before that)."""
        return self._ended.setdefault(str(query.runId), threading.Event()).wait(timeout)
