"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fround(c, digits: int) -> Column:
    """ROUND of a floating value in decimal terms, HALF_UP.

    The value first becomes DECIMAL(38,12) (nearest), which drops binary
    noise such as 51.949999999999996 for 51.95; the decimal is then rounded.
    Without this, the same rational average can round differently depending
    on summation order.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("decimal(38,12)"), digits).cast("double")
