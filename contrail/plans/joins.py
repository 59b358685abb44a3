"""Join helpers with explicit size reasoning.

Broadcast is used only where a side's row count has a bound known before
running (a generated calendar of N days, a per-partition offsets table). All
other dimension joins are left to Catalyst: ``autoBroadcastJoinThreshold``
checks the estimated size at planning time and AQE re-checks the real shuffle
size at runtime, falling back to a sort-merge join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row bound we broadcast on a static guarantee (a few MB at most):
# calendars (days in range), the time of day (1,440), offsets (one per partition).
MAX_BOUNDED_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast ``df`` only if its proven row bound is small enough."""
    if row_bound <= MAX_BOUNDED_BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def role_playing(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                 prefix: str, columns: list[str]) -> DataFrame:
    """Join one dimension under a role name (origin/dest ...)."""
    d = dim.select(F.col(dim_key).alias(f"__{prefix}_key"),
                   *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
    return fact.join(d, fact[fact_key] == d[f"__{prefix}_key"]).drop(f"__{prefix}_key")
