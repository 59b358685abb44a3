"""Run the global index with injected task failures (first attempts fail).

Executed by tests/test_fault_tolerance.py in its own JVM (local[4,3] allows
retries). Prints OK when the index equals row_number() of the same order.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from contrail.plans.ranking import global_index  # noqa: E402


def main() -> None:
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fault-ckpt-"))

    @F.udf("long")
    def flaky(x):  # test-only: fail the first attempt of partitions 1 and 2
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() in (1, 2) and x % 97 == 0:
            raise RuntimeError("injected task failure")
        return x

    df = spark.range(0, 20000, numPartitions=4).select(
        flaky("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("grp"),
        (F.col("id") * 7919 % 97).alias("v"))
    idx = global_index(df, ["grp", "v", "k"], "rn")
    ref = df.select("k", (F.row_number().over(Window.orderBy("grp", "v", "k")) - 1).alias("ref"))
    bad = idx.join(ref, "k").filter(F.col("rn") != F.col("ref")).count()
    n = idx.count()
    print("OK" if bad == 0 and n == 20000 else f"FAIL bad={bad} n={n}")
    spark.stop()


if __name__ == "__main__":
    main()
