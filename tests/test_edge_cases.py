"""Edge cases of the scalar rules (literal vs fixed forms) on small frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from contrail.functions import cases, coerce, dates, masking


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_severity_null_falls_through_literal(spark):
    vals = _one(spark, cases.delay_severity("d"), [(None,), (0,), (15,), (16,), (60,), (180,), (181,)], "d int")
    assert vals == ["Critical (>3h)", "On Time", "Minor (<15m)", "Moderate (15-60m)",
                    "Moderate (15-60m)", "Severe (1-3h)", "Critical (>3h)"]
    fixed = _one(spark, cases.delay_severity("d", fixed=True), [(None,)], "d int")
    assert fixed == ["Unknown"]


def test_primary_cause_zero_and_ties(spark):
    schema = ("carrier_delay_min int, weather_delay_min int, nas_delay_min int, "
              "security_delay_min int, late_aircraft_delay int")
    rows = [(0, 0, 0, 0, 0), (5, 10, 10, 0, 0), (None, None, None, None, 7), (None, None, None, None, None)]
    lit = _one(spark, cases.primary_delay_cause(), rows, schema)
    assert lit == ["Carrier", "Weather", "Late Aircraft", "Unknown"]
    fixed = _one(spark, cases.primary_delay_cause(fixed=True), rows, schema)
    assert fixed[0] == "None" and fixed[1] == "Weather"


def test_hhmm_literal_and_strict(spark):
    raw = [("2400",), ("1275",), ("-5",), ("abc",), ("",), ("930.0",), ("2500",), (None,), ("5",)]
    lit = _one(spark, dates.parse_hhmm("v"), raw, "v string")
    assert lit == ["24:00", "12:75", None, None, None, "09:30", None, None, "00:05"]
    strict = _one(spark, dates.parse_hhmm("v", strict=True), raw, "v string")
    assert strict[:2] == [None, None] and strict[5] == "09:30"


def test_numeric_and_flag_coercion(spark):
    nums = _one(spark, coerce.to_int_or_zero("v"), [("x",), (None,), ("1440",), ("-1500",), ("12.9",)], "v string")
    assert nums == [0, 0, 1440, -1500, 12]
    flags = _one(spark, coerce.to_flag("v"), [("1.00",), ("0.00",), (None,), ("junk",)], "v string")
    assert flags == [True, False, False, False]


def test_dq_range_boundary(spark):
    from contrail.operators import cleaning as C
    raw = spark.createDataFrame(
        [("1996-01-02", "A", "1", "N1", "1440", "0"), ("1996-01-02", "A", "2", "N1", "1441", "1.00"),
         ("1996-01-02", None, "3", "N1", "5", "0"), ("bad-date", "A", "4", "N1", "5", "0")],
        "FlightDate string, Carrier string, FlightNum string, TailNum string, DepDelay string, Cancelled string")
    out = {r["flight_number"]: r for r in C.apply_dq_rules(C.coerce_flights(raw)).collect()}
    assert out["1"]["dep_delay_min"] == 1440 and out["2"]["dep_delay_min"] is None
    assert "3" not in out and out["4"]["flight_date"] is None
    rep = C.dq_report(C.coerce_flights(raw)).first()
    assert (rep["rows_in"], rep["missing_flight_id"], rep["dep_delay_min_out_of_range"], rep["rows_dropped"]) == (4, 1, 1, 1)


def test_email_mask_short_address(spark):
    rows = [("john.doe@mail.com",), ("a@x.com",), (None,)]
    partial = _one(spark, masking.mask_email(F.col("e"), masking.ANALYST), rows, "e string")
    assert partial[0] == "jo****@mail.com" and partial[1] == "a@x.com"
    strict = _one(spark, masking.mask_email(F.col("e"), masking.ANALYST, strict=True), rows, "e string")
    assert strict[1] == "***MASKED***" and strict[2] is None
    assert _one(spark, masking.mask_email(F.col("e"), masking.READER), rows, "e string")[0] == "***MASKED***"
    assert _one(spark, masking.mask_email(F.col("e"), masking.ADMIN), rows, "e string")[0] == rows[0][0]


def test_dob_and_fare_masks(spark):
    d = _one(spark, masking.mask_dob(F.col("d"), masking.READER), [(dt.date(1980, 7, 9),)], "d date")
    assert d == [dt.date(1980, 1, 1)]
    fare = spark.createDataFrame([(12.5,)], "f double")
    assert fare.select(masking.mask_fare(F.col("f"), masking.READER).alias("x")).first()[0] is None
    assert fare.select(masking.mask_fare(F.col("f"), masking.ANALYST).alias("x")).first()[0] == 12.5


def test_safe_div_zero(spark):
    v = _one(spark, cases.safe_div("a", "b"), [(10, 0), (10, 4)], "a int, b int")
    assert v == [None, 2.5]


def test_empty_and_missing_passenger_arrays(spark):
    from contrail.operators import variant as V
    df = spark.createDataFrame(
        [(1, '{"flightNumber":"F1","passengers":[]}'), (2, '{"flightNumber":"F2"}'),
         (3, '{"flightNumber":"F3","delays":{"carrier":4},"passengers":[{"passengerId":"P9"}]}'),
         (4, "not json")], "event_id int, payload string").withColumn("event_ts", F.current_timestamp())
    out = V.flatten_events(V.to_variant(df)).collect()
    assert [(r.event_id, r.passenger_id, r.carrier_delay, r.cabin_class) for r in out] == [(3, "P9", 4, None)]


def test_fround_removes_binary_noise(spark):
    from contrail.functions.numeric import fround
    v = _one(spark, fround("x", 1), [(51.949999999999996,), (0.15,), (-2.25,)], "x double")
    assert v == [52.0, 0.2, -2.3]
