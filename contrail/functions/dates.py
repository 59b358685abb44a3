"""Date/time column helpers: keys, calendar parts, HHMM parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meteorological season per month number.
SEASONS = [
    ((12, 1, 2), "Winter"),
    ((3, 4, 5), "Spring"),
    ((6, 7, 8), "Summer"),
    ((9, 10, 11), "Fall"),
]

# Time-of-day buckets by hour (inclusive start, inclusive end).
TIME_OF_DAY = [((5, 11), "Morning"), ((12, 16), "Afternoon"), ((17, 20), "Evening")]
TIME_OF_DAY_ELSE = "Night"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyymmdd as INT, from a date or timestamp (arithmetic, no string format)."""
    c = _col(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def date_key_formatted(ts) -> Column:
    """The ``date_format(ts,'yyyyMMdd')::int`` form of the same key."""
    return F.date_format(_col(ts), "yyyyMMdd").cast("int")


def season(month) -> Column:
    m = _col(month)
    expr = None
    for months, label in SEASONS:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def time_of_day(hour) -> Column:
    h = _col(hour)
    expr = None
    for (lo, hi), label in TIME_OF_DAY:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(TIME_OF_DAY_ELSE))


def calendar_columns(full_date="full_date") -> dict[str, Column]:
    """dim_date attributes of a DATE column (ISO weekday, 1 = Monday)."""
    d = _col(full_date)
    dow = (F.weekday(d) + 1).cast("int")
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "day_of_month": F.dayofmonth(d),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": dow.isin(6, 7),
        "season": season(F.month(d)),
    }


def parse_hhmm(value, strict: bool = False) -> Column:
    """HHMM text -> ``HH:MM``.

    ``int(float(v))`` semantics: parse as double, truncate toward zero; NULL
    when unparsable, negative or above 2400. Minutes >= 60 and 2400 pass
    (literal behaviour); ``strict=True`` also rejects them.
    """
    v = _col(value).try_cast("double")
    iv = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e9), v.cast("bigint"))
    ok = iv.isNotNull() & (iv >= 0) & (iv <= 2400)
    if strict:
        ok = ok & (iv % 100 < 60) & (iv < 2400)
    hh = F.lpad(F.floor(iv / 100).cast("string"), 2, "0")
    mm = F.lpad((iv % 100).cast("string"), 2, "0")
    return F.when(ok, F.concat(hh, F.lit(":"), mm))
