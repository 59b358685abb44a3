"""Oracle SQL: dashboard datasets."""

from oracle_sql import ROUTED, _SEV, add, dround, exact_avg_round, exact_div_round

_D = "DATE '2001-08-02'"
_CUR = f"(full_date > {_D} - 365 AND full_date <= {_D})"
_PRI = f"(full_date > {_D} - 730 AND full_date <= {_D} - 365)"
_OK = "(arr_delay_min <= 15 AND NOT is_cancelled)"

add("dash_kpi", f"""
WITH g AS (
  SELECT airline_code, COUNT(*) FILTER (WHERE {_CUR}) AS total_flights,
    COUNT(*) FILTER (WHERE {_PRI}) AS prior_flights,
    COUNT(*) FILTER (WHERE {_CUR} AND {_OK}) AS ok, COUNT(*) FILTER (WHERE {_CUR} AND is_cancelled) AS canc,
    AVG(arr_delay_min) FILTER (WHERE {_CUR}) AS avg_arr_delay,
    SUM(total_revenue) FILTER (WHERE {_CUR}) AS revenue, SUM(total_revenue) FILTER (WHERE {_PRI}) AS prior_revenue
  FROM fact_flight WHERE full_date > {_D} - 730 AND full_date <= {_D}
  GROUP BY ROLLUP (airline_code))
SELECT COALESCE(airline_code, 'ALL') AS airline_code, total_flights,
  {dround("100.0::DOUBLE * ok / NULLIF(total_flights, 0)", 1)} AS on_time_rate_pct,
  {dround("avg_arr_delay", 1)} AS avg_arr_delay,
  {dround("100.0::DOUBLE * canc / NULLIF(total_flights, 0)", 1)} AS cancel_rate_pct,
  CAST(revenue AS DOUBLE) AS revenue,
  {dround("100.0::DOUBLE * (total_flights - prior_flights) / NULLIF(prior_flights, 0)", 1)} AS flights_change_pct,
  {dround("100.0::DOUBLE * (CAST(revenue AS DOUBLE) - CAST(prior_revenue AS DOUBLE)) / NULLIF(CAST(prior_revenue AS DOUBLE), 0)", 1)} AS revenue_change_pct
FROM g""", "fact_flight")

add("dash_monthly_ontime", f"""
SELECT CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month_num, airline_code,
  COUNT(*) AS total_flights, {dround(f"100.0::DOUBLE * COUNT(*) FILTER (WHERE {_OK}) / COUNT(*)", 1)} AS on_time_pct
FROM fact_flight GROUP BY 1, 2, 3""", "fact_flight")

_CAUSES = [("carrier_delay_min", "Carrier"), ("weather_delay_min", "Weather"), ("nas_delay_min", "NAS"),
           ("security_delay_min", "Security"), ("late_aircraft_delay", "Late Aircraft")]
add("dash_cause_share", "WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{lab}' AS cause, CAST(SUM({c}) AS BIGINT) AS delay_minutes FROM fact_flight" for c, lab in _CAUSES)
    + f""")
SELECT cause, delay_minutes, {dround("100.0::DOUBLE * delay_minutes / SUM(delay_minutes) OVER ()", 1)} AS share_pct
FROM s""", "fact_flight")

add("dash_hourly_delay", f"""
WITH h AS (SELECT hour_24, AVG(arr_delay_min) AS a, COUNT(*) AS n FROM fact_flight GROUP BY hour_24),
r AS (SELECT CAST(i AS INT) AS hour_24 FROM range(0, 24) t(i))
SELECT r.hour_24, lpad(CAST(r.hour_24 AS VARCHAR), 2, '0') || ':00' AS hour_label, COALESCE(h.n, 0) AS flights,
  {dround("h.a", 1)} AS avg_delay,
  CASE WHEN h.a > 25 THEN 'high' WHEN h.a > 18 THEN 'medium' ELSE 'low' END AS band
FROM r LEFT JOIN h ON r.hour_24 = h.hour_24""", "fact_flight")

add("dash_severity", f"""
WITH s AS (SELECT {_SEV.format(n="")} AS sev FROM fact_flight),
m AS (SELECT CASE WHEN sev IN ('Severe (1-3h)', 'Critical (>3h)') THEN 'Severe (>60m)' ELSE sev END AS severity FROM s),
c AS (SELECT severity, COUNT(*) AS flights FROM m GROUP BY severity)
SELECT severity, flights, {dround("100.0::DOUBLE * flights / SUM(flights) OVER ()", 1)} AS share_pct FROM c""",
    "fact_flight")

add("dash_top_routes", f"""
WITH {ROUTED},
r AS (SELECT origin_iata, dest_iata, airline_code, AVG(arr_delay_min) AS a, COUNT(*) AS flights
      FROM routed GROUP BY 1, 2, 3)
SELECT origin_iata || '→' || dest_iata AS route, airline_code, {dround("a", 1)} AS avg_delay, flights,
  CASE WHEN a >= 20 THEN 'High' WHEN a >= 15 THEN 'Medium' ELSE 'Low' END AS status
FROM r ORDER BY a DESC NULLS LAST, flights DESC, origin_iata, dest_iata, airline_code LIMIT 8""",
    "fact_flight", "dim_airport")

_LF3 = exact_avg_round("SUM(load_factor * 100)", "COUNT(load_factor)", 2, 3)
add("dash_revenue_load", f"""
SELECT CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month_num,
  {exact_div_round("SUM(total_revenue) * 100", "1000000", 2, 2)} AS revenue_musd,
  ({_LF3}) * 1000 / 10 AS load_factor_pct
FROM fact_flight GROUP BY 1, 2""", "fact_flight")

add("rpt_booking_patterns", f"""
SELECT booking_channel, cabin_class,
  CASE WHEN days_before_flight <= 7 THEN '0-7 days' WHEN days_before_flight <= 30 THEN '8-30 days'
       WHEN days_before_flight <= 90 THEN '31-90 days' ELSE '90+ days' END AS lead_time_band,
  COUNT(*) AS bookings, {exact_avg_round("SUM(total_fare * 100)", "COUNT(total_fare)", 2, 2)} AS avg_fare,
  {dround("AVG(days_before_flight)", 1)} AS avg_days_before_flight
FROM fact_reservation GROUP BY 1, 2, 3""", "fact_reservation")
