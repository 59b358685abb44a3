"""Column masks by role, as plain projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roles and the policies that name them.
ADMIN = "AIRLINE_ADMIN"
ANALYST = "AIRLINE_ANALYST"
READER = "AIRLINE_READER"
ETL = "ETL_ROLE"
STEWARD = "DATA_STEWARD"

CLEAR_PII_ROLES = (ADMIN, STEWARD)
CLEAR_FARE_ROLES = (ADMIN, ANALYST)
ALL_ROWS_ROLES = (ADMIN, ETL)

# The email pattern, its replacement and the full mask.
EMAIL_PATTERN = "(.{2})(.+)(@.+)"
EMAIL_REPLACEMENT = "$1****$3"
FULL_MASK = "***MASKED***"
PHONE_PREFIX = "***-***-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_email(c, role: str, strict: bool = False) -> Column:
    """Clear for admin/steward, partial for analysts, else fully masked.

    The partial mask keeps text that does not match the pattern as is
    (``a@x.com``); ``strict=True`` masks such values fully instead.
    """
    v = _col(c)
    if role in CLEAR_PII_ROLES:
        return v
    if role == ANALYST:
        partial = F.regexp_replace(v, EMAIL_PATTERN, EMAIL_REPLACEMENT)
        if strict:
            return F.when(v.rlike(EMAIL_PATTERN), partial).when(v.isNotNull(), F.lit(FULL_MASK))
        return partial
    return F.lit(FULL_MASK)


def mask_phone(c, role: str) -> Column:
    v = _col(c)
    if role in CLEAR_PII_ROLES:
        return v
    return F.concat(F.lit(PHONE_PREFIX), F.right(v, F.lit(4)))


def mask_dob(c, role: str) -> Column:
    v = _col(c)
    if role in CLEAR_PII_ROLES:
        return v
    return F.trunc(v, "year")


def mask_fare(c, role: str) -> Column:
    v = _col(c)
    if role in CLEAR_FARE_ROLES:
        return v
    # NULL of the column's own type
    return F.when(F.lit(False), v)
