"""Oracle SQL: the daily batch's KPIs, and the stream state after late data."""

from oracle_sql import add, r6, route_kpi_sql

add("batch_run", route_kpi_sql("WHERE date_key = 19960614", ", 19960614 AS date_key"), "fact_flight", "dim_airport")

add("stream_late_data", f"""
WITH ev AS (
  SELECT e.event_id, e.event_ts, e.airline_code, a.iata_code AS origin_iata, e.dep_delay_min, e.tail_number, e.status
  FROM flight_events e JOIN dim_airport a ON e.origin_airport_key = a.airport_key),
newest AS (SELECT * FROM ev ORDER BY event_ts DESC LIMIT 1),
allev AS (
  SELECT * FROM ev
  UNION ALL
  SELECT event_id, event_ts - INTERVAL 3 MINUTES, airline_code, origin_iata, dep_delay_min, tail_number, status
  FROM newest)
SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTES, event_ts) + INTERVAL 5 MINUTES AS window_end,
  airline_code, origin_iata, COUNT(*) AS flights_in_window, {r6("AVG(dep_delay_min)")} AS avg_dep_delay,
  CAST(SUM(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS cancellations,
  CAST(COUNT(DISTINCT tail_number) AS INT) AS active_aircraft, MAX(dep_delay_min) AS max_delay
FROM allev GROUP BY 1, 2, 3, 4""", "flight_events", "dim_airport")
