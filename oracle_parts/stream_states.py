"""Oracle SQL: compacted, deduplicated and late streams, distinct aircraft of sliding windows."""

from oracle_sql import ORACLE, STREAM_EVENTS, add

ORACLE["stream_compacted"] = ORACLE["stream_tumbling_kpi"]
ORACLE["stream_dedup"] = ORACLE["json_decode"]

# an event held back is late if its five minutes end ten minutes before the newest of the others
add("stream_late_side", """
WITH ev AS (
  SELECT e.*, a.iata_code AS origin_iata, event_id % 7 = 0 AS held
  FROM flight_events e JOIN dim_airport a ON e.origin_airport_key = a.airport_key),
bound AS (SELECT max(event_ts) - INTERVAL 10 MINUTES AS b FROM ev WHERE NOT held),
judged AS (SELECT *, coalesce(held AND time_bucket(INTERVAL 5 MINUTES, event_ts) + INTERVAL 5 MINUTES <= b, false) AS is_late FROM ev, bound)
SELECT CAST(event_id AS VARCHAR) AS event_id, event_ts, airline_code, origin_iata, is_late,
  CASE WHEN is_late THEN round((epoch_us(b) - epoch_us(event_ts)) / 1000000.0, 6) END AS late_by_sec
FROM judged""", "flight_events", "dim_airport")

add("stream_bitmap_distinct", f"""
WITH {STREAM_EVENTS},
w AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) - i * INTERVAL 5 MINUTES AS window_start, origin_iata, tail_number
  FROM ev, (VALUES (0), (1), (2)) x(i))
SELECT origin_iata, count(*) AS events, count(DISTINCT tail_number) AS active_aircraft, window_start,
  window_start + INTERVAL 15 MINUTES AS window_end
FROM w GROUP BY origin_iata, window_start""", "flight_events", "dim_airport")
