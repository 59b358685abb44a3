"""Oracle SQL: reservation events, SCD2 uniqueness."""

from oracle_sql import PASSENGER_SETS, add

add("reservation_decode", """
SELECT r.booking_ref, p.passenger_id, CAST(NULL AS VARCHAR) AS flight_number, r.cabin_class,
  CAST(r.total_fare AS DOUBLE) AS total_fare, r.booking_channel, CAST(r.full_date AS TIMESTAMP) AS booking_ts
FROM fact_reservation r JOIN dim_passenger p ON r.passenger_key = p.passenger_key""",
    "fact_reservation", "dim_passenger")

add("chk_unique_current", f"""
WITH {PASSENGER_SETS}
SELECT 'passenger_history.current' AS check_name, COALESCE(CAST(passenger_id AS VARCHAR), '<null>') AS key_value,
  COUNT(*) AS dup_count
FROM history WHERE is_current GROUP BY passenger_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'passenger_history.version', COALESCE(CAST(passenger_id AS VARCHAR), '<null>') || '|' ||
  COALESCE(CAST(effective_date AS VARCHAR), '<null>'), COUNT(*)
FROM history GROUP BY passenger_id, effective_date HAVING COUNT(*) > 1""", "dim_passenger")

add("win_top_n", """
SELECT flight_key, airline_code, year, arr_delay_min, delay_rank FROM (
  SELECT flight_key, airline_code, CAST(year(full_date) AS INT) AS year, arr_delay_min,
    CAST(ROW_NUMBER() OVER (PARTITION BY airline_code, year(full_date)
                            ORDER BY arr_delay_min DESC NULLS LAST, flight_key) AS INT) AS delay_rank
  FROM fact_flight) x
WHERE delay_rank <= 3""", "fact_flight")

add("join_bucketed", """
SELECT r.passenger_key, p.passenger_id, COUNT(r.reservation_key) AS frequency,
  CAST(SUM(r.total_fare) AS DOUBLE) AS monetary
FROM fact_reservation r JOIN dim_passenger p ON r.passenger_key = p.passenger_key
WHERE r.status = 'Confirmed'
GROUP BY r.passenger_key, p.passenger_id""", "fact_reservation", "dim_passenger")
