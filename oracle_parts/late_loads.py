"""Oracle SQL: loads of legs, files of several layouts, feeds that arrive late."""

from oracle_sql import COERCED, ORACLE, PASSENGER_SETS, _HASH, _MISSING, _DAY, add, exact_avg_round, r6

ORACLE["src_csv_mixed"] = ORACLE["src_csv_daily"]

# every leg of both origins; the increment's flights change their first leg's delay alone
add("incremental_legs", f"""
WITH {COERCED},
flights AS (
  SELECT * EXCLUDE (flight_number, tail_number), CAST(flight_number AS BIGINT) AS id,
    CAST(CAST(flight_number AS BIGINT) % 20 AS VARCHAR) AS flight_number,
    CASE WHEN CAST(flight_number AS BIGINT) % 2 = 1 THEN tail_number END AS tail_number
  FROM coerced_k WHERE NOT {_MISSING}),
legs AS (SELECT *, o || CAST(id AS VARCHAR) AS origin_iata, o FROM flights, (VALUES ('A'), ('B')) v(o)),
mark AS (SELECT MAX(flight_date) AS top FROM flights WHERE flight_date < DATE '1999-01-01'),
marked AS (SELECT l.*, id % 4 = 0 AND o = 'A' AND flight_date >= top - 3 AS corrected FROM legs l, mark)
SELECT flight_date, airline_code, tail_number, flight_number,
  CASE WHEN NOT is_cancelled THEN actual_dep_time END AS actual_dep_time,
  CASE WHEN corrected THEN 7 WHEN abs(dep_delay_min) <= 1440 THEN dep_delay_min END AS dep_delay_min,
  is_cancelled, date_key, 'BTS_OTP' AS etl_source, {_HASH} AS record_hash, origin_iata
FROM marked WHERE corrected OR flight_date < DATE '1999-01-01'""", "bts_raw")

# every day that a version starts, with the tier in force then: the latest feed row or
# version up to the day; a day without change is left out
add("scd2_late_feed", f"""
WITH {PASSENGER_SETS},
years AS (
  SELECT o_custkey, year(o_orderdate) AS y, SUM(o_totalprice) AS spend FROM orders
  WHERE year(o_orderdate) IN (1995, 1996, 1999) GROUP BY ALL),
late AS (
  SELECT p.passenger_id, p.email, CASE WHEN spend >= 300000 THEN 'Platinum' WHEN spend >= 150000 THEN 'Gold'
    WHEN spend >= 50000 THEN 'Silver' ELSE 'Bronze' END AS tier, make_date(CAST(y AS INT), 7, 1) AS at
  FROM years JOIN dim_passenger p ON p.passenger_key = o_custkey
  UNION ALL
  SELECT passenger_id, email, 'Staff', DATE '1998-01-01' FROM dim_passenger WHERE passenger_key % 3 = 0),
points AS (
  SELECT * FROM late
  UNION ALL
  SELECT passenger_id, email, loyalty_tier, effective_date FROM history h
  WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.passenger_id = h.passenger_id AND l.at = h.effective_date)),
steps AS (
  SELECT p.*, (SELECT max(b.at) FROM points b WHERE b.passenger_id = p.passenger_id AND b.at < p.at) AS before_at FROM points p),
changes AS (
  SELECT s.* FROM steps s LEFT JOIN points b ON b.passenger_id = s.passenger_id AND b.at = s.before_at
  WHERE s.before_at IS NULL OR b.tier IS DISTINCT FROM s.tier OR b.email IS DISTINCT FROM s.email)
SELECT c.passenger_id, c.email, c.tier AS loyalty_tier, c.at AS effective_date,
  coalesce(min(n.at), DATE '9999-12-31') AS expiry_date, min(n.at) IS NULL AS is_current
FROM changes c LEFT JOIN changes n ON n.passenger_id = c.passenger_id AND n.at > c.at
GROUP BY c.passenger_id, c.email, c.tier, c.at""", "dim_passenger")

# the mart built anew from the later fact
add("mart_delta", f"""
WITH later AS (
  SELECT * REPLACE (CASE WHEN flight_key % 17 = 0 THEN arr_delay_min - 200 ELSE arr_delay_min END AS arr_delay_min)
  FROM fact_flight WHERE flight_key % 23 <> 0),
lines AS (
  SELECT airline_key, full_date, count(*) AS n, sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END)::BIGINT AS off,
    sum(CASE WHEN arr_delay_min > 15 THEN 1 ELSE 0 END)::BIGINT AS late, avg(arr_delay_min) AS arr, avg(dep_delay_min) AS dep,
    sum(total_revenue) AS revenue, sum(load_factor * 100) AS lf, count(load_factor) AS lf_n, max(arr_delay_min) AS longest
  FROM later GROUP BY ALL)
SELECT {_DAY}, off AS cancelled_flights, late AS delayed_flights, {r6("arr")} AS avg_arr_delay, {r6("dep")} AS avg_dep_delay,
  CAST(revenue AS DOUBLE) AS total_revenue, {exact_avg_round("lf", "lf_n", 2, 6)} AS avg_load_factor, longest AS max_arr_delay
FROM lines JOIN dim_airline USING (airline_key)""", "fact_flight", "dim_airline")

# a third of the bookings on one account, whose tier changes on even days of bookings
add("asof_merge", f"""
WITH {PASSENGER_SETS},
r AS (
  SELECT reservation_key, full_date, CASE WHEN reservation_key % 3 = 0 THEN 'shared' ELSE passenger_id END AS passenger_id
  FROM fact_reservation JOIN dim_passenger USING (passenger_key)),
even AS (SELECT DISTINCT full_date AS d FROM r WHERE day(full_date) % 2 = 0),
tiers AS (
  SELECT passenger_id, loyalty_tier, effective_date, expiry_date FROM history
  UNION ALL
  SELECT 'shared', 'T' || day(e.d), e.d, coalesce((SELECT min(n.d) FROM even n WHERE n.d > e.d), DATE '9999-12-31') FROM even e)
SELECT r.*, h.loyalty_tier AS tier_loyalty_tier
FROM r LEFT JOIN tiers h ON h.passenger_id = r.passenger_id AND h.effective_date <= r.full_date AND r.full_date < h.expiry_date""",
    "fact_reservation", "dim_passenger")

ORACLE_DIFF = """
WITH old AS (SELECT flight_key, date_key, arr_delay_min, total_revenue FROM fact_flight WHERE flight_key % 1000 <> 7),
later AS (
  SELECT flight_key, date_key, CASE WHEN flight_key % 500 = 3 THEN NULL ELSE arr_delay_min END AS arr_delay_min, total_revenue
  FROM fact_flight WHERE flight_key % 1000 <> 11)
SELECT flight_key, 'removed' AS change_type FROM old WHERE flight_key NOT IN (SELECT flight_key FROM later)
UNION ALL
SELECT flight_key, 'added' FROM later WHERE flight_key NOT IN (SELECT flight_key FROM old)
UNION ALL
SELECT o.flight_key, 'changed' FROM old o JOIN later l USING (flight_key) WHERE o.arr_delay_min IS DISTINCT FROM l.arr_delay_min"""
add("diff_pruned", ORACLE_DIFF, "fact_flight")

add("layout_zorder", "SELECT flight_key, date_key, distance_miles FROM fact_flight WHERE distance_miles BETWEEN 500 AND 700",
    "fact_flight")

add("src_json_rejected", "SELECT iata_code AS airport, CAST(2 AS BIGINT) AS rejected FROM dim_airport WHERE airport_key % 3 = 0",
    "dim_airport")

add("chk_unique_current_found", f"""
WITH {PASSENGER_SETS},
twice AS (
  SELECT * REPLACE (CASE WHEN CAST(regexp_extract(passenger_id, '([0-9]+)$', 1) AS INT) % 100 = 0 THEN effective_date
    ELSE effective_date + 1 END AS effective_date)
  FROM history WHERE is_current AND CAST(regexp_extract(passenger_id, '([0-9]+)$', 1) AS INT) % 50 = 0)
SELECT 'passenger_history.current' AS check_name, passenger_id AS key_value, CAST(2 AS BIGINT) AS dup_count FROM twice
UNION ALL
SELECT 'passenger_history.version', passenger_id || '|' || CAST(CAST(effective_date AS DATE) AS VARCHAR), 2
FROM twice WHERE CAST(regexp_extract(passenger_id, '([0-9]+)$', 1) AS INT) % 100 = 0""", "dim_passenger")

# the time keys of departures, arrivals and bookings: minutes of the day as HHMM, 2400 is none of them
add("chk_fk_times", """
WITH legs AS (
  SELECT CASE WHEN flight_key % 211 = 0 THEN 2400 ELSE hour_24 * 100 + flight_key % 60 END AS dep,
    CASE WHEN flight_key % 97 = 0 THEN hour_24 * 100 + 60 + flight_key % 40 ELSE (hour_24 + 2) % 24 * 100 + flight_key % 60 END AS arr
  FROM fact_flight),
bookings AS (SELECT CASE WHEN reservation_key % 89 = 0 THEN -1 ELSE reservation_key % 24 * 100 + reservation_key % 60 END AS booked FROM fact_reservation),
keys AS (
  SELECT 'fact_flight.dep_time_key' AS fk_name, dep AS k FROM legs
  UNION ALL SELECT 'fact_flight.arr_time_key', arr FROM legs
  UNION ALL SELECT 'fact_reservation.time_key', booked FROM bookings)
SELECT fk_name, CAST(k AS VARCHAR) AS key_value, count(*) AS orphan_rows FROM keys
WHERE NOT (k BETWEEN 0 AND 2359 AND k % 100 < 60) GROUP BY ALL""", "fact_flight", "fact_reservation")
