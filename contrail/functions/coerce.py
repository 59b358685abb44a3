"""Type coercion of raw text and record hashing, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one NULL token and the separator used by hashes we define.
NULL_TOKEN = ""


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int_or_zero(c) -> Column:
    """``to_numeric(errors='coerce').fillna(0).astype(int)``: parse, 0 if not, truncate."""
    v = _col(c).try_cast("double")
    v = F.when(F.isnan(v) | (F.abs(v) >= 2147483648.0), None).otherwise(v)
    return F.coalesce(v, F.lit(0.0)).cast("int")


def to_flag(c) -> Column:
    """``astype(float).fillna(0).astype(bool)``: ``"1.00"`` -> true, NULL -> false.

    Text that does not parse becomes false here (pandas would raise);
    ``cleaning.quarantine_raw`` keeps such rows out of a load.
    """
    v = _col(c).try_cast("double")
    return F.coalesce(v, F.lit(0.0)) != 0


def record_hash(*cols) -> Column:
    """MD5 of the concatenated values (NULL rendered as the empty token)."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat(*parts))
