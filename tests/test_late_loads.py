"""Loads that must lose nothing: legs of one number, files of several layouts, late feeds."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from contrail.operators import scd as S
from contrail.plans import jobs as J
from contrail.session import shared_path
from contrail.sources import readers as RD
from contrail.sources import sinks as K

LEGS = ("airline_code string, flight_number string, flight_date date, tail_number string, origin_iata string, "
        "dep_delay_min int, etl_load_ts timestamp, record_hash string, date_key int")


def legs(spark, rows, ts):
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], LEGS)
    return df.withColumns({"etl_load_ts": F.lit(ts).cast("timestamp"), "record_hash": F.lit("same"),
                           "date_key": F.date_format("flight_date", "yyyyMMdd").cast("int")})


def loaded(df):
    return sorted((r.airline_code, r.flight_number, r.origin_iata or "", r.dep_delay_min) for r in df.collect())


def test_increment_of_another_flight_loses_no_leg(spark):
    d = date(2024, 1, 5)
    rows = [("AA", "1", d, None, "JFK", 1), ("BB", "1", d, None, "JFK", 2),          # two carriers, one number, no tail
            ("CC", "9", d, "N1", "JFK", 3), ("CC", "9", d, "N1", "BOS", 4),          # two legs of one flight
            ("DD", "7", d, "N2", None, 5), ("DD", "7", d, "N2", None, 6)]            # legs that the key cannot tell apart
    path = shared_path(spark, "test", "legs")
    K.write_partitioned(legs(spark, rows, "2024-01-06").withColumn("month_key", J.month_key()), path, ["month_key"])
    out = J.incremental_load(spark, path, legs(spark, [("EE", "1", d, None, "LAX", 7)], "2024-01-07"))
    assert loaded(out["table"]) == sorted([(r[0], r[1], r[4] or "", r[5]) for r in rows] + [("EE", "1", "LAX", 7)])
    again = legs(spark, [("CC", "9", d, "N1", "BOS", 40), ("BB", "1", d, None, "JFK", 20)], "2024-01-08")
    for _ in range(2):   # a rerun changes nothing
        out = J.incremental_load(spark, path, again)["table"]
        assert loaded(out) == [("AA", "1", "JFK", 1), ("BB", "1", "JFK", 20), ("CC", "9", "BOS", 40), ("CC", "9", "JFK", 3),
                               ("DD", "7", "", 5), ("DD", "7", "", 6), ("EE", "1", "LAX", 7)]
    older = legs(spark, [("AA", "1", d, None, "JFK", 99)], "2024-01-01")
    assert ("AA", "1", "JFK", 1) in loaded(J.incremental_load(spark, path, older)["table"])


def csv_file(spark, folder, name, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/{name}")


def test_every_file_of_a_folder_has_its_own_header(spark):
    base = shared_path(spark, "test", "mixed")
    cols = ["FlightDate", "Carrier", "FlightNum"]
    csv_file(spark, base, "month=1996_06", "FlightDate,Carrier,FlightNum\n1996-06-01,AA,1")
    csv_file(spark, base, "month=1996_06", 'Note,FlightNum,FlightDate,Carrier\n"x, y",2,1996-06-02,BB\n,3,1996-06-03,')
    csv_file(spark, base, "month=1996_07", "Carrier,FlightDate,FlightNum")
    out = RD.read_bts_csv(spark, base, cols)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1996-06-01", "AA", "1"), ("1996-06-02", "BB", "2"), ("1996-06-03", None, "3")]
    assert [tuple(r) for r in RD.read_bts_csv(spark, base, cols, flight_date="1996-06-02").collect()] == [
        ("1996-06-02", "BB", "2")]
    csv_file(spark, base, "month=1996_08", "Carrier,FlightDate\nAA,1996-08-01")
    with pytest.raises(ValueError, match="FlightNum"):
        RD.read_bts_csv(spark, base, cols)


HIST = "pid string, tier string, effective_date date, expiry_date date, is_current boolean"
OPEN = date(9999, 12, 31)


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def in_force(versions, pid, at):
    hit = [v[1] for v in versions if v[0] == pid and v[2] <= at < v[3]]
    assert len(hit) <= 1, (pid, at, versions)
    return hit


def test_a_late_feed_keeps_the_newer_version(spark):
    history = spark.createDataFrame([("p", "a", day(0), day(150), False), ("p", "c", day(150), OPEN, True),
                                     ("q", "x", day(3), OPEN, True)], HIST)
    feed = spark.createDataFrame([("p", "b", day(60)), (None, "z", day(1)), ("p", "z", None)], "pid string, tier string, on date")
    out = S.scd2_late_feed(history, feed, "pid", ["tier"], "on")
    assert sorted(tuple(r) for r in out.collect()) == [
        ("p", "a", day(0), day(60), False), ("p", "b", day(60), day(150), False), ("p", "c", day(150), OPEN, True),
        ("q", "x", day(3), OPEN, True)]
    assert S.without_key_or_date(feed, "pid", "on").count() == 2


def test_late_feeds_equal_a_day_by_day_replay(spark):
    rng = random.Random(11)
    history, rows, closed = [], [], {}
    for pid in "abcdefgh":
        at = rng.randint(0, 3)
        for _ in range(rng.randint(0, 3)):
            end = at + rng.randint(1, 6)
            history.append((pid, rng.choice("xyz"), day(at), day(end), False))
            at = end + rng.choice((0, 0, 2))
        if rng.random() < 0.6:
            history.append((pid, rng.choice("xyz"), day(at), OPEN, True))
    # equal neighbours would be one version: start from a history without them
    keep = []
    for v in history:
        if keep and keep[-1][0] == v[0] and keep[-1][1] == v[1] and keep[-1][3] == v[2]:
            keep[-1] = (*keep[-1][:3], v[3], v[4])
        else:
            keep.append(v)
    for pid in "abcdefghij":
        for seq in range(rng.randint(0, 5)):
            rows.append((pid, rng.choice(["x", "y", None]), day(rng.randint(0, 20)), seq))
    hist = spark.createDataFrame(keep, HIST)
    feed = spark.createDataFrame(rows, "pid string, tier string, on date, seq int")
    out = S.scd2_late_feed(hist, feed, "pid", ["tier"], "on", ["seq"])
    got = [tuple(r) for r in out.collect()]
    for pid in "abcdefghij":
        of_feed = {}
        for p, tier, on, _ in sorted(rows, key=lambda r: r[3]):
            if p == pid:
                of_feed[on] = tier
        now = []
        for n in range(40):
            starts = [v[1] for v in keep if v[0] == pid and v[2] == day(n)]
            ends = any(v[0] == pid and v[3] == day(n) for v in keep)
            now = [of_feed[day(n)]] if day(n) in of_feed else starts or ([] if ends else now)
            assert in_force(got, pid, day(n)) == now, (pid, n)
    again = S.scd2_late_feed(spark.createDataFrame(got, HIST), feed, "pid", ["tier"], "on", ["seq"])
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    assert all((v[3] == OPEN) == v[4] and v[2] < v[3] for v in got)


def test_one_feed_in_order_equals_the_upsert(spark):
    hist = S.scd2_init(spark.createDataFrame([(f"p{i}", "abc"[i % 3]) for i in range(30)], "pid string, tier string"), "2020-01-01")
    feed = spark.createDataFrame([(f"p{i}", "ab"[i % 2]) for i in range(10, 40)], "pid string, tier string")
    one = S.scd2_upsert(hist, feed, "pid", ["tier"], "2024-05-01")
    two = S.scd2_late_feed(hist, feed.withColumn("on", F.lit("2024-05-01").cast("date")), "pid", ["tier"], "on")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert S.scd2_late_feed(hist.limit(0), feed.limit(0).withColumn("on", F.current_date()), "pid", ["tier"], "on").count() == 0
