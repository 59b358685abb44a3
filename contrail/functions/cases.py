"""Searched-CASE classifiers as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay severity bands (upper bounds in minutes, label).
SEVERITY_BANDS = [
    (0, "On Time"),
    (15, "Minor (<15m)"),
    (60, "Moderate (15-60m)"),
    (180, "Severe (1-3h)"),
]
SEVERITY_ELSE = "Critical (>3h)"

# Delay cause columns in priority order, with their labels.
DELAY_CAUSES = [
    ("carrier_delay_min", "Carrier"),
    ("weather_delay_min", "Weather"),
    ("nas_delay_min", "NAS"),
    ("security_delay_min", "Security"),
    ("late_aircraft_delay", "Late Aircraft"),
]

# RFM segments, first match wins; each test is (score, bound, at least?).
RFM_SEGMENTS = [
    ((("r", 4, True), ("f", 4, True), ("m", 4, True)), "Champions"),
    ((("r", 3, True), ("f", 3, True)), "Loyal Customers"),
    ((("r", 4, True), ("f", 2, False)), "Recent Customers"),
    ((("r", 2, False), ("f", 4, True)), "At Risk"),
    ((("r", 2, False), ("m", 4, True)), "Cant Lose Them"),
    ((("r", 2, False), ("f", 2, False)), "Lost"),
]
RFM_ELSE = "Potential Loyalists"

# Route tiers by revenue percentile (lower bound, label).
ROUTE_TIERS = [(0.8, "Platinum Route"), (0.6, "Gold Route"), (0.4, "Silver Route")]
ROUTE_TIER_ELSE = "Review Route"

# Alert levels by severe-delay count.
ALERT_LEVELS = [(10, "CRITICAL"), (5, "HIGH")]
ALERT_ELSE = "MEDIUM"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_severity(arr_delay="arr_delay_min", fixed: bool = False) -> Column:
    """Severity band of an arrival delay.

    Literal form: a NULL delay falls through every test to the last band.
    ``fixed=True`` labels NULL as "Unknown" first.
    """
    c = _col(arr_delay)
    expr = None
    if fixed:
        expr = F.when(c.isNull(), F.lit("Unknown"))
    for bound, label in SEVERITY_BANDS:
        cond = c <= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SEVERITY_ELSE))


def primary_delay_cause(fixed: bool = False) -> Column:
    """The cause with the largest minutes; ties go to the earlier cause.

    ``greatest`` skips NULLs. Literal form: all-zero causes yield "Carrier"
    (greatest = 0 equals the first column). ``fixed=True`` yields "None" when
    the greatest value is <= 0.
    """
    g = F.greatest(*[F.col(c) for c, _ in DELAY_CAUSES])
    expr = None
    if fixed:
        expr = F.when(g <= 0, F.lit("None"))
    for c, label in DELAY_CAUSES:
        cond = F.col(c) == g
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("Unknown"))


def rfm_segment(r="r_score", f="f_score", m="m_score") -> Column:
    """RFM segment name from three 1..5 scores, ordered branches."""
    scores = {"r": _col(r), "f": _col(f), "m": _col(m)}
    expr = None
    for tests, label in RFM_SEGMENTS:
        cond = None
        for name, bound, at_least in tests:
            term = scores[name] >= bound if at_least else scores[name] <= bound
            cond = term if cond is None else (cond & term)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(RFM_ELSE))


def route_tier(percentile="revenue_percentile") -> Column:
    """Tier from a revenue percentile (see reports.route_profitability for order)."""
    p = _col(percentile)
    expr = None
    for bound, label in ROUTE_TIERS:
        expr = F.when(p >= bound, F.lit(label)) if expr is None else expr.when(p >= bound, F.lit(label))
    return expr.otherwise(F.lit(ROUTE_TIER_ELSE))


def alert_level(severe="severe_delays") -> Column:
    c = _col(severe)
    expr = None
    for bound, label in ALERT_LEVELS:
        expr = F.when(c >= bound, F.lit(label)) if expr is None else expr.when(c >= bound, F.lit(label))
    return expr.otherwise(F.lit(ALERT_ELSE))


def flag(cond: Column) -> Column:
    """``CASE WHEN p THEN 1 ELSE 0 END`` (a NULL predicate counts 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_col(num), F.nullif(_col(den), F.lit(0)))
