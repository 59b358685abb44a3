"""Late and repeated events: kept apart with their lateness, or dropped as copies.

Spark drops events whose window is closed and only counts them. ``LateRouter``
decides before the aggregation, by the same rule: an event is late if its
window ends at or before the highest event time of earlier batches less the
delay. Late events go to a side table with how late they are, the rest to the
main one; both together hold every event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import glob_paths
from contrail.streaming.kpis import KPI_WATERMARK, KPI_WINDOW


def dedup_events(events: DataFrame, within: str = KPI_WATERMARK, key: str = "event_id") -> DataFrame:
    """Each event id once: copies that come within the watermark's delay of the
    first (files or offsets delivered again) are dropped, with one state row
    for each id until the watermark passes it. Copies that come later than that are
    behind the watermark themselves and go as late."""
    return events.withWatermark("event_ts", within).dropDuplicatesWithinWatermark([key])


class LateRouter:
    """``foreachBatch`` sink: ``kept/batch_id=<n>``, ``late/batch_id=<n>`` and, last, the batch's
    highest event time in ``seen/batch_id=<n>``. A batch is judged by earlier ones
    alone, so a replayed batch writes the same again. Events without a time are kept."""

    def __init__(self, path: str, delay: str = KPI_WATERMARK, window: str = KPI_WINDOW):
        self.path, self.delay, self.window = path.rstrip("/"), delay, window

    def _table(self, spark: SparkSession, name: str) -> DataFrame | None:
        found = glob_paths(spark, f"{self.path}/{name}/batch_id=*")
        return spark.read.option("basePath", f"{self.path}/{name}").parquet(*found) if found else None

    def bound(self, spark: SparkSession, batch_id: int) -> Column:
        """What closes windows for a batch: null before any event was seen."""
        seen = self._table(spark, "seen")
        top = seen.filter(F.col("batch_id") < batch_id).agg(F.max("event_ts")).first()[0] if seen is not None else None
        return F.lit(top).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bound = self.bound(spark, batch_id)
        # the window that holds the event; F.window would leave out events without a time
        width = F.expr(f"INTERVAL {self.window}")
        size = F.unix_micros(F.timestamp_micros(F.lit(0)) + width)
        end = F.timestamp_micros(F.unix_micros("event_ts") - F.pmod(F.unix_micros("event_ts"), size) + size)
        late = F.coalesce(end <= bound, F.lit(False))
        batch = batch.withColumns({"_late": late, "_bound": bound}).persist()
        try:
            for name, rows in (("kept", batch.filter(~F.col("_late"))),
                               ("late", batch.filter("_late").withColumn(
                                   "late_by_sec", F.unix_micros("_bound") / 1e6 - F.unix_micros("event_ts") / 1e6))):
                rows.drop("_late", "_bound").write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")
            batch.agg(F.max("event_ts").alias("event_ts")).write.mode("overwrite").parquet(
                f"{self.path}/seen/batch_id={batch_id}")
        finally:
            batch.unpersist()

    def kept(self, spark: SparkSession) -> DataFrame | None:
        return self._table(spark, "kept")

    def late(self, spark: SparkSession) -> DataFrame | None:
        return self._table(spark, "late")
