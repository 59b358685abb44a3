"""Idempotent ``foreachBatch`` sink for update-mode aggregates.

Update mode emits a window's row again whenever it changes. Appending those
rows would leave several versions per window; instead each micro-batch is
written to its own ``batch_id=<n>`` folder (a replayed batch overwrites the
same folder, so retries do not duplicate), and readers see the latest row
per key.

Windows behind the query's watermark can change no more. ``compact`` folds
them once into ``closed/fold=<n>/day=<date>`` and removes the batches that hold
nothing else, so a read is the closed partitions plus the open batches, however
long the query has run.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.operators.windows import latest_per_key
from contrail.session import delete_path, glob_paths

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class UpsertSink:
    def __init__(self, path: str, keys: list[str], schema: StructType | None = None, window_end: str = "window_end"):
        """``schema`` is what ``read`` returns, without rows, before any batch was written;
        ``window_end`` the column that tells when a row's window closes."""
        self.path = path.rstrip("/")
        self.keys = keys
        self.schema = schema
        self.window_end = window_end

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            (batch.withColumn("_written_batch", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    def batches(self, spark: SparkSession) -> list[int]:
        """The batches that are still read one by one."""
        return sorted(int(p.rsplit("=", 1)[1]) for p in glob_paths(spark, f"{self.path}/batch_id=*"))

    def folds(self, spark: SparkSession) -> list[int]:
        """The finished folds, each named by the time (microseconds) up to which it closed windows."""
        done = glob_paths(spark, f"{self.path}/closed/fold=*/_SUCCESS")
        return sorted(int(p.split("/")[-2].split("=", 1)[1]) for p in done)

    def rows(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        """The batches' rows as they were written."""
        found = self.batches(spark) if batches is None else batches
        return spark.read.parquet(*[f"{self.path}/batch_id={n}" for n in found])

    def read(self, spark: SparkSession) -> DataFrame:
        """Latest version of every key: the closed windows, and of the open batches
        the last row of each key (a partial aggregate) whose window is not closed."""
        batches, folds = self.batches(spark), self.folds(spark)
        if self.schema is not None and not batches and not folds:
            return spark.createDataFrame([], self.schema)
        out = None
        if batches:
            out = self._latest(self._after(self.rows(spark, batches), folds[-1] if folds else None))
        if folds:
            closed = (spark.read.option("basePath", f"{self.path}/closed")
                      .parquet(*[f"{self.path}/closed/fold={n}" for n in folds]).drop("fold", "day"))
            out = closed if out is None else closed.unionByName(out)
        return out

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, [F.col("_written_batch")]).drop("_written_batch")

    def _after(self, rows: DataFrame, micros: int | None) -> DataFrame:
        return rows if micros is None else rows.filter(F.col(self.window_end) > F.timestamp_micros(F.lit(micros)))

    def compact(self, spark: SparkSession, watermark: datetime | None) -> int:
        """Fold the windows that end at or before ``watermark`` (of a finished batch of the
        query, so no later batch can touch them) and remove batches with nothing
        else; returns how many batches are left.

        A fold counts from its success marker on, and reads then pass over the batches'
        rows of its windows: a run that fails before the marker is repeated into
        the same folder, and neither one that fails before the removal nor a replayed
        batch brings a closed window back.
        """
        batches, folds = self.batches(spark), self.folds(spark)
        if watermark is None or not batches:
            return len(batches)
        upto = (watermark.astimezone(timezone.utc) - EPOCH) // timedelta(microseconds=1)
        rows = self.rows(spark, batches)
        if not folds or upto > folds[-1]:
            closing = self._after(rows, folds[-1] if folds else None) \
                .filter(F.col(self.window_end) <= F.timestamp_micros(F.lit(upto)))
            closed = self._latest(closing).withColumn("day", F.to_date(self.window_end))
            (closed.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("day").parquet(f"{self.path}/closed/fold={upto}"))
        else:
            upto = folds[-1]
        spent = rows.groupBy("_written_batch").agg(F.max(self.window_end).alias("last")) \
            .filter(F.col("last") <= F.timestamp_micros(F.lit(upto)))
        gone = [r[0] for r in spent.collect()]   # one row per open batch
        for n in gone:
            delete_path(spark, f"{self.path}/batch_id={n}")
        return len(batches) - len(gone)
