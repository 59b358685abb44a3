"""Slowly changing dimensions, surrogate keys, key resolution, partition routing.

MERGE is not available on plain Parquet tables, so upserts are written as
set operations that produce the next version of the table (written to a new
path by the caller, never over the one being read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.windows import latest_per_key
from contrail.plans.ranking import global_index

# Open-ended SCD2 expiry date.
OPEN_END = "9999-12-31"


def one_row_per_key(feed: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """The feed's last row of each key by the ``order`` columns, equal rows by
    their values; rows without a key are left out (``without_key`` has them)."""
    return latest_per_key(feed.filter(F.col(key).isNotNull()), [key], [F.col(c) for c in order or []])


def without_key(feed: DataFrame, key: str) -> DataFrame:
    """The feed rows that an upsert rejects, to be counted or kept by the caller."""
    return feed.filter(F.col(key).isNull())


def scd1_upsert(target: DataFrame, source: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Matched keys take the source row; unmatched source rows are inserted.

    Of several source rows of a key the last by ``order`` counts; source rows
    without a key are rejected. Written as union + per-key ``max_by`` on a
    priority flag: one shuffle and a partial aggregate, so a hot key is
    pre-reduced.
    """
    cols = target.columns
    src = one_row_per_key(source, key, order).select(*cols).withColumn("_prio", F.lit(1))
    tgt = target.withColumn("_prio", F.lit(0))
    both = tgt.unionByName(src)
    others = [c for c in cols if c != key]
    return (both.groupBy(key)
            .agg(F.max_by(F.struct(*others), F.col("_prio")).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in others]))


def scd2_init(snapshot: DataFrame, effective: str) -> DataFrame:
    return snapshot.withColumns({
        "effective_date": F.lit(effective).cast("date"),
        "expiry_date": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
    })


def _changed(attrs: list[str], prefix: str) -> Column:
    same = None
    for a in attrs:
        cond = F.col(a).eqNullSafe(F.col(f"{prefix}{a}"))
        same = cond if same is None else same & cond
    return ~same


def scd2_upsert(history: DataFrame, feed: DataFrame, key: str, attrs: list[str],
                as_of: str, order: list[str] | None = None) -> DataFrame:
    """Type 2 merge as of ``as_of``. Of several feed rows of a key the last by
    ``order`` counts; feed rows without a key are rejected.

    * current rows whose attributes differ (NULL-safe) from the feed are
      closed (expiry = as_of, is_current = false) and a new version is added;
    * a change on the day the current version became effective replaces it
      (no zero-length version);
    * feed keys without a current row are inserted as new versions;
    * unchanged rows and rows absent from the feed stay as they are;
    * closed history passes through. Re-running the same feed changes nothing.
    """
    d = F.lit(as_of).cast("date")
    closed_hist = history.filter(~F.col("is_current"))
    current = history.filter(F.col("is_current"))
    f = one_row_per_key(feed, key, order).select(F.col(key).alias("_f_key"), *[F.col(a).alias(f"_f_{a}") for a in attrs]) \
        .withColumn("_f_present", F.lit(True))
    j = current.join(f, F.col(key) == F.col("_f_key"), "full_outer")
    has_cur = F.col(key).isNotNull()
    has_feed = F.col("_f_present").isNotNull()
    changed = has_cur & has_feed & _changed(attrs, "_f_")
    hist_cols = [key, *attrs, "effective_date", "expiry_date", "is_current"]
    kept = j.filter(has_cur & ~changed).select(*hist_cols)
    # A second change on the day a version became effective replaces that
    # version instead of leaving a zero-length one behind.
    closed = j.filter(changed & (F.col("effective_date") < d)).select(
        key, *attrs, "effective_date", d.alias("expiry_date"), F.lit(False).alias("is_current"))
    new_versions = j.filter(changed | (~has_cur & has_feed)).select(
        F.coalesce(F.col(key), F.col("_f_key")).alias(key),
        *[F.col(f"_f_{a}").alias(a) for a in attrs],
        d.alias("effective_date"), F.lit(OPEN_END).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"))
    return (closed_hist.select(*hist_cols).unionByName(kept).unionByName(closed)
            .unionByName(new_versions))


def without_key_or_date(feed: DataFrame, key: str, date_col: str) -> DataFrame:
    """The feed rows that an interval rebuild rejects."""
    return feed.filter(F.col(key).isNull() | F.col(date_col).isNull())


def scd2_late_feed(history: DataFrame, feed: DataFrame, key: str, attrs: list[str], date_col: str,
                   order: list[str] | None = None) -> DataFrame:
    """Type 2 merge of feed rows that carry their own effective dates, in any
    order and as late as they like: the intervals of the keys in the feed are
    rebuilt from their change points.

    * A version starts at its effective date; a version that ends without a
      successor ends its key there until a later point.
    * A feed row on the date of a version replaces it; of several feed rows of
      a key and date the last by ``order`` counts, then the greatest values.
    * A point whose attributes equal those in force (NULL-safe) changes nothing and
      is dropped; each other one lasts until the next.
    * Feed rows without a key or date are rejected (``without_key_or_date``); keys
      that the feed does not name pass through. Running the feed again changes nothing.

    Points are first reduced to one for each key and date (a partial aggregate), so
    the window that follows sorts at most one row a day for a key, however
    many rows the feed has of it.
    """
    cols = [key, *attrs, "effective_date", "expiry_date", "is_current"]
    feed = feed.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull())
    named = feed.select(key).distinct()
    touched = history.join(named, key, "left_semi")

    values = F.struct(*[F.col(a) for a in attrs])
    last = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order or [])],
                    *[F.col(a).alias(f"v{i}") for i, a in enumerate(attrs)])

    def points(rows: DataFrame, at: Column, rank: int, live: bool, by: Column) -> DataFrame:
        return rows.select(F.col(key), at.cast("date").alias("_at"), F.lit(rank).alias("_rank"), F.lit(live).alias("_live"),
                           values.alias("_values"), by.alias("_by"))

    # a feed row beats a version that starts on its day, which beats one that ends
    of_feed = points(feed, F.col(date_col), 2, True, last)
    no_order = F.lit(None).cast(of_feed.schema["_by"].dataType)
    ended = touched.filter(F.col("expiry_date") < F.lit(OPEN_END).cast("date"))
    change = (of_feed.unionByName(points(touched, F.col("effective_date"), 1, True, no_order))
              .unionByName(points(ended, F.col("expiry_date"), 0, False, no_order))
              .groupBy(key, "_at")
              .agg(F.max_by(F.struct("_live", "_values"), F.struct("_rank", "_by", "_values")).alias("_s")))
    w = Window.partitionBy(key).orderBy("_at")
    state = F.struct(F.col("_s._live").alias("live"), F.when(F.col("_s._live"), F.col("_s._values")).alias("v"))
    change = change.withColumn("_s", state).withColumn("_before", F.lag("_s").over(w))
    change = change.filter(~F.col("_s").eqNullSafe(F.col("_before")))
    until = F.coalesce(F.lead("_at").over(w), F.lit(OPEN_END).cast("date"))
    rebuilt = change.withColumn("_until", until).filter("_s.live").select(
        key, *[F.col(f"_s.v.{a}").alias(a) for a in attrs], F.col("_at").alias("effective_date"),
        F.col("_until").alias("expiry_date"), (F.col("_until") == F.lit(OPEN_END).cast("date")).alias("is_current"))
    return history.join(named, key, "left_anti").select(*cols).unionByName(rebuilt.select(*cols))


def scd2_as_of(facts: DataFrame, history: DataFrame, key: str, date_col: str,
               attrs: list[str], prefix: str = "") -> DataFrame:
    """Attach the dimension version valid on each fact's date
    (``effective_date <= d < expiry_date``): equi-join on the key plus a
    range condition; a key has few versions, so the join stays narrow."""
    h = history.select(F.col(key).alias("_h_key"), *[F.col(a).alias(f"{prefix}{a}") for a in attrs],
                       F.col("effective_date").alias("_h_eff"), F.col("expiry_date").alias("_h_exp"))
    cond = ((F.col(key) == F.col("_h_key")) & (F.col("_h_eff") <= F.col(date_col))
            & (F.col(date_col) < F.col("_h_exp")))
    return facts.join(h, cond, "left").drop("_h_key", "_h_eff", "_h_exp")


def assign_surrogate_keys(existing: DataFrame, incoming: DataFrame, natural: str,
                          key: str) -> DataFrame:
    """Keep existing keys; new natural keys get ``max(key) + 1 ..`` in natural-key
    order. The order is a distributed dense index (no single-task window);
    only the scalar max key passes through the driver."""
    new = (incoming.select(natural).distinct()
           .join(existing.select(natural), natural, "left_anti"))
    mx = existing.agg(F.max(key)).first()[0] or 0
    ranked = global_index(new, [F.col(natural)], "_sk_rn")
    fresh = ranked.select(natural, (F.lit(mx) + F.col("_sk_rn") + 1).cast(
        existing.schema[key].dataType).alias(key), F.lit(True).alias("is_new"))
    return existing.select(natural, key, F.lit(False).alias("is_new")).unionByName(fresh)


def resolve_key(fact: DataFrame, natural: str, dim: DataFrame, dim_natural: str, dim_key: str,
                out: str, unknown: int = -1) -> DataFrame:
    """Natural code -> surrogate key by a left join; unknown codes map to -1."""
    d = dim.select(F.col(dim_natural).alias(f"_rk_{out}"), F.col(dim_key).alias(out))
    return (fact.join(d, F.col(natural) == F.col(f"_rk_{out}"), "left")
            .drop(f"_rk_{out}")
            .withColumn(out, F.coalesce(F.col(out), F.lit(unknown).cast(d.schema[out].dataType))))


def quarter_partition(date_key_col: str = "date_key", table: str = "fact_flight") -> Column:
    """Name of the half-open quarterly range partition holding a date key
    (``[yyyy0101, yyyy0401)`` -> ``<table>_yyyy_q1`` ...)."""
    k = F.col(date_key_col)
    year = F.floor(k / 10000).cast("int")
    month = (F.floor(k / 100) % 100).cast("int")
    quarter = (F.floor((month - 1) / 3) + 1).cast("int")
    return F.concat(F.lit(f"{table}_"), year.cast("string"), F.lit("_q"), quarter.cast("string"))
