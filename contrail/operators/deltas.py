"""Marts kept from deltas: partial states that take inserts, corrections and deletes.

A mart line is kept as sums and counts, which add and subtract, plus extremes,
which do not: taking away a row that held the maximum leaves the line's
maximum unknown. Such lines alone are read again from the fact. All kept
values are integers or decimals, so a state after any number of deltas equals
one built anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "_weight"   # copies of a row that a delta adds, negative if it takes them away
ROWS = "n_rows"


@dataclass(frozen=True)
class MartState:
    """Which measures a mart line keeps. ``sums`` and ``maxima`` are expressions over
    the fact; of each sum the number of non-null values is kept as ``<name>_n``."""
    by: list[str]
    sums: dict[str, Column]
    maxima: dict[str, Column] = field(default_factory=dict)

    def columns(self) -> list[str]:
        return [*self.by, ROWS, *(c for s in self.sums for c in (s, f"{s}_n")), *self.maxima]

    def build(self, fact: DataFrame) -> DataFrame:
        """The state of a whole fact."""
        return self.partial(fact.withColumn(WEIGHT, F.lit(1))).select(
            *self.by, ROWS, *(c for s in self.sums for c in (s, f"{s}_n")),
            *[F.col(f"{m}_in").alias(m) for m in self.maxima])

    def partial(self, delta: DataFrame) -> DataFrame:
        """What a weighted delta adds to each line; of a maximum's values the highest
        that comes (``_in``) and the highest that goes (``_out``)."""
        w = F.col(WEIGHT)
        aggs = [F.sum(w).cast("long").alias(ROWS)]
        for name, x in self.sums.items():
            aggs += [F.coalesce(F.sum(w * x), F.lit(0)).alias(name),
                     F.coalesce(F.sum(F.when(x.isNotNull(), w)), F.lit(0)).cast("long").alias(f"{name}_n")]
        for name, x in self.maxima.items():
            aggs += [F.max(F.when(w > 0, x)).alias(f"{name}_in"), F.max(F.when(w < 0, x)).alias(f"{name}_out")]
        return delta.groupBy(*self.by).agg(*aggs)

    def merge(self, state: DataFrame, delta: DataFrame) -> DataFrame:
        """``state`` after a weighted delta. ``_stale`` marks lines that lost a row with
        their maximum; lines without rows are left out, a negative count of rows
        stays for the caller to reject."""
        d = self.partial(delta).withColumnsRenamed({c: f"_d_{c}" for c in self.by})
        d = d.withColumnsRenamed({c: f"_d_{c}" for c in d.columns if not c.startswith("_d_")})
        both = state.join(d, [F.col(c).eqNullSafe(F.col(f"_d_{c}")) for c in self.by], "full_outer")
        old, new = F.col(ROWS).isNotNull(), F.col(f"_d_{ROWS}").isNotNull()
        out = [F.when(old, F.col(c)).otherwise(F.col(f"_d_{c}")).alias(c) for c in self.by]
        types = {f.name: f.dataType for f in state.schema.fields}
        for c in [ROWS, *(x for s in self.sums for x in (s, f"{s}_n"))]:
            out.append((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_d_{c}"), F.lit(0))).cast(types[c]).alias(c))
        stale = F.lit(False)
        for m in self.maxima:
            gone, come = F.col(f"_d_{m}_out"), F.col(f"_d_{m}_in")
            # what goes below the old maximum, or below what comes, leaves the maximum known
            stale = stale | (gone.isNotNull() & ~F.coalesce(gone < F.col(m), F.lit(False))
                             & ~F.coalesce(come >= F.col(m), F.lit(False)))
            out.append(F.greatest(F.col(m), come).cast(types[m]).alias(m))
        return both.select(*out, (old & new & stale).alias("_stale")).filter(F.col(ROWS) != 0)

    def refreshed(self, merged: DataFrame, fact: DataFrame) -> DataFrame:
        """``merged`` with the maxima of stale lines read again from ``fact``."""
        if not self.maxima:
            return merged.drop("_stale")
        stale = merged.filter("_stale").select(*[F.col(c).alias(f"_s_{c}") for c in self.by])
        same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in self.by]
        again = fact.join(stale, same, "left_semi").groupBy(*[F.col(c).alias(f"_s_{c}") for c in self.by]).agg(
            *[F.max(x).alias(f"_m_{m}") for m, x in self.maxima.items()])
        joined = merged.join(again, same, "left")
        return joined.select(*[c for c in self.columns() if c not in self.maxima],
                             *[F.when(F.col("_stale"), F.col(f"_m_{m}")).otherwise(F.col(m)).alias(m) for m in self.maxima])

    def average(self, name: str) -> Column:
        return F.when(F.col(f"{name}_n") > 0, F.col(name) / F.col(f"{name}_n"))

    def total(self, name: str) -> Column:
        """The sum, null without values, as SUM gives it."""
        return F.when(F.col(f"{name}_n") > 0, F.col(name))


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The weighted delta between two versions of the touched rows: equal rows cancel
    out, a corrected row is taken away as it was and added as it is."""
    both = before.withColumn(WEIGHT, F.lit(-1)).unionByName(after.withColumn(WEIGHT, F.lit(1)))
    return both.groupBy(*before.columns).agg(F.sum(WEIGHT).cast("int").alias(WEIGHT)).filter(F.col(WEIGHT) != 0)
