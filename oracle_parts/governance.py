"""Oracle SQL: row access and PII tag report."""

from oracle_sql import add

add("row_access_filter", """
SELECT flight_key, airline_code FROM fact_flight f
WHERE EXISTS (SELECT 1 FROM user_airline_access u WHERE u.username = 'analyst0'
              AND u.airline_code = f.airline_code)""", "fact_flight", "user_airline_access")

add("pii_tag_report", """
SELECT 'dim_passenger' AS table_name, 'email' AS column_name, 'HIGH' AS tag_value, COUNT(email) AS values_present FROM dim_passenger
UNION ALL SELECT 'dim_passenger', 'phone', 'HIGH', COUNT(phone) FROM dim_passenger
UNION ALL SELECT 'dim_passenger', 'dob', 'MEDIUM', COUNT(dob) FROM dim_passenger
UNION ALL SELECT 'fact_reservation', 'total_fare', 'LOW', COUNT(total_fare) FROM fact_reservation""",
    "dim_passenger", "fact_reservation")

add("masked_view_reader", """
SELECT passenger_key, passenger_id, '***MASKED***' AS email, '***-***-' || right(phone, 4) AS phone,
  CAST(date_trunc('year', dob) AS DATE) AS dob, loyalty_tier
FROM dim_passenger""", "dim_passenger")
