"""Reader and loader behaviours: corrupt records skipped, missing files raise, rows loaded."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from contrail.schemas import BTS_RAW_COLUMNS
from contrail.session import shared_path
from contrail.sources import readers as RD
from contrail.sources import sinks as K


def test_airport_status_skips_malformed_files(spark):
    base = shared_path(spark, "test", "faa")
    spark.createDataFrame([('{"departures": 12}',)], "value string").write.text(f"{base}/airport=JFK")
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{base}/airport=BAD")
    out = RD.read_airport_status(spark, base, StructType().add("departures", LongType())).collect()
    assert [(r.airport, r.departures) for r in out] == [("JFK", 12)]


def test_missing_monthly_csv_raises(spark):
    with pytest.raises(FileNotFoundError):
        RD.read_bts_csv(spark, shared_path(spark, "test", "empty_landing"), BTS_RAW_COLUMNS,
                        flight_date="2024-12-01").count()


def test_load_by_name_returns_rows_and_aligns(spark):
    src = spark.createDataFrame([("F1", 5, "x"), ("F2", None, "y")], "FLIGHT_NUMBER string, Dep_Delay_Min int, extra string")
    target = StructType().add("flight_number", "string").add("dep_delay_min", "integer").add("arr_delay_min", "integer")
    path = shared_path(spark, "test", "load")
    assert K.load_by_name(src, path, target) == 2
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert rows == [("F1", 5, None), ("F2", None, None)]
    assert K.load_by_name(src, path, target) == 2   # append without partitions
    assert spark.read.parquet(path).filter(F.col("flight_number") == "F1").count() == 2


def test_csv_columns_by_header_name_and_only_asked_months(spark):
    base = shared_path(spark, "test", "bts")
    cols = ["FlightDate", "FlightNum", "Carrier"]
    one = "FlightDate,FlightNum,Carrier\n2024-01-05,1,AA\n2024-01-06,2,AA\n"
    two = "Extra,Carrier,FlightNum,FlightDate\nq,BB,3,2024-01-05\n"
    for name, text in (("bts_otd_2024_01a.csv", one), ("bts_otd_2024_01b.csv", two), ("bts_otd_2024_02.csv", one)):
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(f"{base}/{name}")
    assert [p.rsplit("/", 1)[-1] for p in RD.bts_csv_paths(spark, base, ["2024_01"])] == \
        ["bts_otd_2024_01a.csv", "bts_otd_2024_01b.csv"]
    day = RD.read_bts_csv(spark, base, cols, flight_date="2024-01-05")
    assert sorted(map(tuple, day.collect())) == [("2024-01-05", "1", "AA"), ("2024-01-05", "3", "BB")]
    assert not [f for f in day.inputFiles() if "2024_02" in f]
    with pytest.raises(ValueError, match="TailNum"):
        RD.read_bts_csv(spark, base, [*cols, "TailNum"])


def test_envelopes_of_equal_and_null_keyed_rows_stay_bounded(spark):
    from contrail.sources.landing import land_envelopes
    df = spark.createDataFrame([("a", 1)] * 25 + [(None, 2)] * 3, "g string, v int")
    path = shared_path(spark, "test", "envelopes")
    land_envelopes(df, path, ["g"], "records", 10)
    sizes = [len(r.records) for r in spark.read.json(path).collect()]
    assert max(sizes) <= 10 and sum(sizes) == 28


def test_a_cluster_without_a_shared_folder_is_an_error():
    from contrail import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
