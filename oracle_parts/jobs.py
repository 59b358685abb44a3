"""Oracle SQL: batch jobs (final states)."""

from oracle_sql import COERCED, ORACLE, ROUTED, _CAUSE, _HASH, _MISSING, _SEV, add, r6

add("batch_enrich", f"""
WITH {ROUTED}
SELECT flight_key, date_key, hour_24 AS dep_hour, {_SEV.format(n="")} AS delay_severity,
  {_CAUSE.format(n="")} AS primary_delay_cause,
  {r6("AVG(arr_delay_min) OVER (PARTITION BY airline_code, origin_iata ORDER BY date_key, flight_key ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)")} AS rolling_7d_avg_delay,
  {r6("PERCENT_RANK() OVER (PARTITION BY airline_code, date_key ORDER BY arr_delay_min ASC NULLS FIRST)")} AS delay_percentile
FROM routed""", "fact_flight", "dim_airport")

_CLEANED = f"""cleaned AS (
  SELECT flight_date, airline_code, tail_number, flight_number,
    CASE WHEN NOT is_cancelled THEN actual_dep_time END AS actual_dep_time,
    CASE WHEN abs(dep_delay_min) <= 1440 THEN dep_delay_min END AS dep_delay_min,
    is_cancelled, date_key, 'BTS_OTP' AS etl_source, {_HASH} AS record_hash
  FROM coerced_k WHERE NOT {_MISSING})"""

add("etl_backfill", f"""
WITH {COERCED}, {_CLEANED}
SELECT c.*, COALESCE(al.airline_key, -1) AS airline_key, COALESCE(ac.aircraft_key, -1) AS aircraft_key
FROM cleaned c LEFT JOIN dim_airline al ON al.airline_code = c.airline_code
LEFT JOIN dim_aircraft ac ON ac.tail_number = c.tail_number""", "bts_raw", "dim_airline", "dim_aircraft")

# the increment's rows from the mark's look-back on, and the loaded rows it does not hold
add("incremental_load", f"""
WITH {COERCED}, {_CLEANED},
loaded AS (SELECT * FROM cleaned WHERE flight_date < DATE '1999-01-01'),
mark AS (SELECT MAX(flight_date) - 3 AS since FROM loaded),
inc AS (
  SELECT c.* REPLACE (7 AS dep_delay_min) FROM cleaned c, mark
  WHERE CAST(flight_number AS BIGINT) % 2 = 0 AND flight_date >= since)
SELECT * FROM inc
UNION ALL
SELECT * FROM loaded l WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.record_hash = l.record_hash)""", "bts_raw")

add("etl_quarantine", """
WITH raw AS (
  SELECT * REPLACE (
    CASE WHEN CAST(FlightNum AS BIGINT) % 59 = 0 THEN strftime(CAST(FlightDate AS DATE), '%m/%d/%Y') ELSE FlightDate END AS FlightDate,
    CASE WHEN CAST(FlightNum AS BIGINT) % 61 = 0 THEN 'yes' ELSE Cancelled END AS Cancelled)
  FROM bts_raw),
checked AS (
  SELECT *, CASE WHEN Carrier IS NULL OR FlightNum IS NULL THEN 'missing_flight_id'
    WHEN NOT regexp_full_match(FlightDate, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'bad_date'
    WHEN Cancelled = 'yes' THEN 'bad_flag' END AS dq_reason
  FROM raw)
SELECT FlightDate, Carrier, FlightNum, TailNum, Cancelled, dq_reason FROM checked WHERE dq_reason IS NOT NULL""", "bts_raw")

# the frame over all days, whatever the gap to the day
add("batch_day", f"""
WITH {ROUTED},
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY airline_code, origin_iata ORDER BY date_key, flight_key) AS at FROM routed),
today AS (SELECT * FROM numbered WHERE date_key = 19960614),
frame AS (
  SELECT t.flight_key, AVG(p.arr_delay_min) AS m FROM today t
  JOIN numbered p ON p.airline_code = t.airline_code AND p.origin_iata = t.origin_iata AND p.at BETWEEN t.at - 7 AND t.at
  GROUP BY t.flight_key),
below AS (
  SELECT t.flight_key, COUNT(*) AS n,
    COUNT(*) FILTER (o.arr_delay_min < t.arr_delay_min OR (o.arr_delay_min IS NULL AND t.arr_delay_min IS NOT NULL)) AS b
  FROM today t JOIN today o ON o.airline_code = t.airline_code GROUP BY t.flight_key)
SELECT t.flight_key, t.date_key, t.hour_24 AS dep_hour, {_SEV.format(n="")} AS delay_severity,
  {_CAUSE.format(n="")} AS primary_delay_cause, {r6("f.m")} AS rolling_7d_avg_delay,
  {r6("CASE WHEN b.n > 1 THEN b.b::DOUBLE / (b.n - 1) ELSE 0 END")} AS delay_percentile
FROM today t JOIN frame f USING (flight_key) JOIN below b USING (flight_key)""", "fact_flight", "dim_airport")

ORACLE["batch_corrected"] = ORACLE["batch_day"]
ORACLE["mart_refresh"] = ORACLE["mart_daily_airline"]

add("run_log_report", f"""
WITH {COERCED}
SELECT flight_date AS process_date, 'success' AS status, COUNT(*) AS rows_loaded, CAST(NULL AS VARCHAR) AS error_msg
FROM coerced WHERE NOT {_MISSING} GROUP BY flight_date""", "bts_raw")
