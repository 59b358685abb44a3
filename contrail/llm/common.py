"""Shared helpers of the operators: tables, staged results, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import contrail.llm
from contrail.session import shared_path

# Arrow batches handed to Python hold at most so many rows and bytes, so a run
# of very long texts cannot fill a worker's memory (set only where unset).
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes unless the user has chosen bounds."""
    for key, default, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", None, BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or now == default or int(now) > (1 << 30):
            spark.conf.set(key, str(value))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    bound_batches(df.sparkSession)
    # tasks get this subpackage's functions themselves: executors need no copy of it
    cloudpickle.register_pickle_by_value(contrail.llm)
    return df.mapInArrow(fn, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage and
    fixes values that several later plans must see alike; survives lost executors."""
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
