"""Batch jobs: enrichment, the daily batch, backfill, mart refresh, incremental load.

A job is one lazy plan per output. Date ranges are predicates (a backfill is
one job over the range, not a loop of daily jobs); outputs replace only the
partitions they recompute, so re-running any job is idempotent.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.cases import delay_severity, flag, primary_delay_cause
from contrail.functions.dates import date_key, date_key_formatted
from contrail.operators import aggregates as agg
from contrail.operators import cleaning as C
from contrail.operators import governance as G
from contrail.operators import windows as win
from contrail.operators.deltas import ROWS, MartState
from contrail.operators.diff import checksum
from contrail.session import delete_path, glob_paths, path_exists, shared_path
from contrail.sources import readers as RD
from contrail.sources import sinks as K

# Rows before the current one in the rolling frame, incremental look-back.
ROLLING_ROWS = 7
INCREMENTAL_LOOKBACK_DAYS = 3
# The columns that tell one flight leg from another; a load uses those its table has.
LEG_KEY = ["airline_code", "flight_number", "flight_date", "tail_number", "origin_iata", "sched_dep_time"]


def enrich_flights(df: DataFrame) -> DataFrame:
    """Keys, severity, primary cause, rolling average (8-row frame per
    airline x origin, ties on the day broken by flight_key), and delay
    percentile within airline x day -- both windows skew-safe."""
    out = df.withColumns({
        "date_key": date_key_formatted("sched_dep_ts"),
        "dep_hour": F.hour("sched_dep_ts"),
        "delay_severity": delay_severity(),
        "primary_delay_cause": primary_delay_cause(),
    })
    out = win.rows_frame_avg(out, "arr_delay_min", ["airline_code", "origin_iata"],
                             ["date_key", "flight_key"], ROLLING_ROWS, "rolling_7d_avg_delay",
                             key=["flight_key"])
    return win.partition_percent_rank(out, "arr_delay_min", ["airline_code", "date_key"],
                                      "delay_percentile")


def last_rows(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest rows of every airline x origin, which is all that a
    later day's rolling frame needs of the past. Every task keeps at most ``n``
    rows of a pair before the shuffle (the rank limit is applied on both sides)."""
    w = Window.partitionBy("airline_code", "origin_iata").orderBy(F.desc("date_key"), F.desc("flight_key"))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def daily_batch(spark: SparkSession, raw_path: str, process_date: str, fact_path: str, kpi_path: str,
                tail_path: str | None = None, check_state: bool = True) -> dict:
    """Enrich one day of the raw lake table; write the day's fact partitions and
    route KPIs, replacing whatever that day had.

    The rolling frame's preceding rows are the pair's latest ones, whatever
    their date. Without ``tail_path`` they are taken from all earlier days;
    with it, from the newest kept state before the day (``state_day=<key>``)
    plus the days since, and the day's own state is kept for the next run.
    A state counts only while the days that it sums up are as it saw them
    (``check_state``: one narrow scan for checksums by day); a corrected, new or
    withdrawn day voids the states from that day on.
    """
    day = int(date.fromisoformat(process_date).strftime("%Y%m%d"))
    known = _states(spark, tail_path)
    if known and check_state:
        known = _drop_void_states(spark, raw_path, tail_path, known)
    since = max((k for k in known if k < day), default=None)
    where = F.col("date_key") <= day
    if since is not None:
        where = where & (F.col("date_key") > since)
    raw, obs = RD.read_table(spark, raw_path, where=where)
    past = raw.filter(F.col("date_key") < day)
    if since is not None:
        past = past.unionByName(spark.read.parquet(f"{tail_path}/state_day={since}"))
    rows = last_rows(past, ROLLING_ROWS).unionByName(raw.filter(F.col("date_key") == day)).persist()
    enriched = enrich_flights(rows).filter(F.col("date_key") == day).persist()
    try:
        K.replace_partitions(enriched, fact_path, ["date_key", "airline_code"], lambda v: v == str(day))
        kpis = agg.route_kpis(enriched).withColumn("date_key", F.lit(day))
        K.replace_partitions(kpis, kpi_path, ["date_key"], lambda v: v == str(day))
        if tail_path:
            sums = day_checksums(raw.filter(where & (F.col("date_key") <= day)))
            sums.write.mode("overwrite").parquet(f"{tail_path}/checksums/state_day={day}")
            last_rows(rows, ROLLING_ROWS).write.mode("overwrite").parquet(f"{tail_path}/state_day={day}")
    finally:
        enriched.unpersist()
        rows.unpersist()
    return {"rows_read": obs.get.get("rows"), "date_key": day}


ROLLING_COLUMNS = ["airline_code", "origin_iata", "date_key", "flight_key", "arr_delay_min"]


def day_checksums(raw: DataFrame) -> DataFrame:
    """Checksums by day of what the rolling state sees of the raw rows."""
    return raw.groupBy("date_key").agg(*checksum(ROLLING_COLUMNS))


def _states(spark: SparkSession, tail_path: str | None) -> list[int]:
    return sorted(int(p.rsplit("=", 1)[1]) for p in glob_paths(spark, f"{tail_path}/state_day=*")) if tail_path else []


def _drop_void_states(spark: SparkSession, raw_path: str, tail_path: str, known: list[int]) -> list[int]:
    """The states before the first day that differs from what a state saw; the others are
    removed. Every state keeps the checksums of the days since the state before it,
    so a state without checksums is void as well."""
    seen_by = sorted(int(p.rsplit("=", 1)[1]) for p in glob_paths(spark, f"{tail_path}/checksums/state_day=*"))
    first_bad = min((k for k in known if k not in seen_by), default=None)
    if seen_by:
        seen = spark.read.parquet(*[f"{tail_path}/checksums/state_day={k}" for k in seen_by])
        now = day_checksums(spark.read.parquet(raw_path).filter(F.col("date_key") <= max(known)))
        pairs = [df.select("date_key", F.struct("n", "x", "s").alias(side)) for side, df in (("seen", seen), ("now", now))]
        differ = pairs[0].join(pairs[1], "date_key", "full_outer").filter(~F.col("seen").eqNullSafe(F.col("now")))
        changed = differ.agg(F.min("date_key")).first()[0]
        first_bad = min((d for d in (first_bad, changed) if d is not None), default=None)
    if first_bad is None:
        return known
    for k in {*known, *seen_by}:
        if k >= first_bad:
            delete_path(spark, f"{tail_path}/state_day={k}")
            delete_path(spark, f"{tail_path}/checksums/state_day={k}")
    return [k for k in known if k < first_bad]


def month_key(col: str = "date_key"):
    return F.floor(F.col(col) / 100).cast("int")


def backfill(spark: SparkSession, landing: str, columns: list[str], start: str, end: str,
             target_path: str, log_path: str, run_ts: datetime | None = None,
             quarantine_path: str | None = None, keys: dict[str, DataFrame] | None = None,
             mart: dict | None = None) -> DataFrame:
    """Clean and load every date in ``[start, end]`` in one job: the range's
    monthly files are read, its dates replaced in the target (partitioned by
    month, sorted by day), and one run-log row written per date.

    ``keys`` (``airline``, ``aircraft``: dimensions with natural code and key)
    adds surrogate keys, -1 for unknown codes. Raw rows that fail a check go to
    ``quarantine_path`` with the reason. ``mart`` (``dim_date``,
    ``dim_airline``, ``fact``, ``path``) refreshes the loaded months of the
    daily mart; the quarantine is kept by the month of the file. A failing run logs one ``failed`` row and raises.
    """
    t0 = time.time()
    run_ts = run_ts or datetime.now()
    clean = None
    try:
        files = RD.read_bts_csv(spark, landing, columns, months=RD.months_between(start, end), month_col="file_month")
        if quarantine_path:
            # the files' months as a whole: a run again, or one after a failure, replaces what it wrote
            months = set(RD.months_between(start, end))
            K.replace_partitions(C.quarantine_raw(files).withColumn("run_ts", F.lit(run_ts)), quarantine_path,
                                 ["file_month"], lambda v: v in months)
        raw = files.drop("file_month")
        clean = C.transform_flights(C.well_formed(raw), load_ts=run_ts.isoformat(sep=" ")).drop("etl_load_ts")
        clean = clean.filter(F.col("flight_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        clean = G.with_keys(clean, keys) if keys else clean
        clean = clean.withColumn("month_key", month_key()).persist()
        _replace_days(clean, target_path, start, end)
        per_date = clean.groupBy(F.col("flight_date").alias("process_date")) \
            .agg(F.count(F.lit(1)).alias("rows_loaded"))
        if mart:
            months = [int(m.replace("_", "")) for m in RD.months_between(start, end)]
            refresh_mart(mart["fact"], months, mart["dim_date"], mart["dim_airline"], mart["path"])
        G.append_run_log(G.run_log_entries(per_date, run_ts, "success", time.time() - t0), log_path)
    except Exception as e:
        failed = spark.range(1).select(F.lit(start).cast("date").alias("process_date"), F.lit(0).alias("rows_loaded"))
        G.append_run_log(G.run_log_entries(failed, run_ts, "failed", time.time() - t0, str(e)[:500]), log_path)
        raise
    finally:
        if clean is not None:
            clean.unpersist()
    return spark.read.parquet(target_path).drop("month_key")


def _replace_days(rows: DataFrame, path: str, start: str, end: str) -> None:
    """Replace the dates of ``[start, end]`` in a table partitioned by
    ``month_key``: whole months are replaced, the first and last month keep
    their days outside the range."""
    spark = rows.sparkSession
    months = {m.replace("_", "") for m in RD.months_between(start, end)}
    if path_exists(spark, path) and glob_paths(spark, f"{path}/month_key=*"):
        edge = spark.read.parquet(path).filter(F.col("month_key").isin(*[int(m) for m in (min(months), max(months))]))
        edge = edge.filter(~F.col("flight_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        both = shared_path(spark, "staging", "replace_days")  # the table is read here and replaced below
        rows.unionByName(edge.select(*rows.columns)).write.parquet(both)
        rows = spark.read.parquet(both)
    K.replace_partitions(rows, path, ["month_key"], lambda v: v in months, sort_by=["date_key"])


def build_daily_mart(fact: DataFrame, dim_date: DataFrame, dim_airline: DataFrame, mart_path: str,
                     months: set[int] | None = None) -> None:
    """Write the daily mart by month; with ``months`` (the months that ``fact``
    holds all rows of), a month without rows loses its partition."""
    mart = agg.daily_airline_mart(fact, dim_date, dim_airline).withColumn(
        "month_key", (F.year("full_date") * 100 + F.month("full_date")).cast("int"))
    if months is None:
        K.write_partitioned(mart, mart_path, ["month_key"])
    else:
        K.replace_partitions(mart, mart_path, ["month_key"], lambda v: v.isdigit() and int(v) in months)


def refresh_mart(fact: DataFrame, loaded: DataFrame | Iterable[int], dim_date: DataFrame, dim_airline: DataFrame,
                 mart_path: str) -> None:
    """Recompute the mart for the months a load touched -- those of its rows, or
    a list of months, which may also be empty by now -- and replace them."""
    if isinstance(loaded, DataFrame):  # one row per month
        months = {r[0] for r in loaded.select(month_key()).distinct().collect() if r[0] is not None}
    else:
        months = set(loaded)
    if not months:
        return
    lo, hi = min(months) * 100, max(months) * 100 + 99
    f = fact.filter(F.col("date_key").between(lo, hi) & month_key().isin(*sorted(months)))
    build_daily_mart(f, dim_date, dim_airline, mart_path, months)


def daily_mart_state() -> MartState:
    """The daily airline mart's lines, and the day's longest arrival delay."""
    return MartState(["full_date", "airline_key"], {
        "cancelled": flag(F.col("is_cancelled")), "delayed": flag(agg.LATE["any"]()),
        "arr": F.col("arr_delay_min"), "dep": F.col("dep_delay_min"), "revenue": F.col("total_revenue"),
        "load": F.col("load_factor")}, {"max_arr_delay": F.col("arr_delay_min")})


def build_mart_state(fact: DataFrame, path: str) -> None:
    """Write the state of a whole fact by month."""
    state = daily_mart_state().build(fact).withColumn("month_key", _month_of_date())
    K.write_partitioned(state, path, ["month_key"])


def _month_of_date() -> Column:
    return (F.year("full_date") * 100 + F.month("full_date")).cast("int")


def apply_mart_delta(spark: SparkSession, path: str, delta: DataFrame, fact: DataFrame) -> dict:
    """Bring the state up to a delta (``deltas.row_changes``): reads the delta, the
    months of the state that it touches, and of ``fact`` (as it is now) the rows
    of lines whose maximum went. Returns the counts of touched and stale lines.

    The new months are staged before they replace the old ones, so a run that fails
    before the replacement changes nothing. A delta is applied once: applied
    again it counts again, so a caller that repeats it starts from the state before.
    """
    kept = daily_mart_state()
    delta = delta.persist()
    try:
        months = sorted(r[0] for r in delta.select(_month_of_date()).distinct().collect() if r[0] is not None)
        if not months:
            return {"months": [], "stale": 0}
        state = spark.read.parquet(path).filter(F.col("month_key").isin(*months)).drop("month_key")
        merged = shared_path(spark, "staging", "mart_merged")
        kept.merge(state, delta).write.parquet(merged)
    finally:
        delta.unpersist()
    rows = spark.read.parquet(merged)
    counts = rows.agg(F.count_if("_stale"), F.count_if(F.col(ROWS) < 0)).first()
    if counts[1]:
        raise ValueError(f"the delta takes more rows away than {counts[1]} mart lines hold")
    lo, hi = months[0] * 100, months[-1] * 100 + 99
    touched = fact.filter(F.col("date_key").between(lo, hi) & month_key().isin(*months))
    fresh = kept.refreshed(rows, touched).withColumn("month_key", _month_of_date())
    K.replace_partitions(fresh, path, ["month_key"], lambda v: v.isdigit() and int(v) in set(months))
    return {"months": months, "stale": counts[0]}


def read_mart_state(spark: SparkSession, path: str, dim_date: DataFrame, dim_airline: DataFrame) -> DataFrame:
    """The daily mart's lines from their state, with the dimensions' names."""
    kept = daily_mart_state()
    state = agg.star(spark.read.parquet(path).drop("month_key").withColumn("date_key", date_key("full_date")),
                     dim_date, dim_airline.select(*agg.AIRLINE))
    return state.select(*agg.BY_DAY, F.col(ROWS).alias("total_flights"), F.col("cancelled").alias("cancelled_flights"),
                        F.col("delayed").alias("delayed_flights"), kept.average("arr").alias("avg_arr_delay"),
                        kept.average("dep").alias("avg_dep_delay"), kept.total("revenue").alias("total_revenue"),
                        F.round(kept.average("load"), 6).alias("avg_load_factor"), "max_arr_delay")


def merge_legs(loaded: DataFrame, increment: DataFrame, key: list[str], order: str = "etl_load_ts") -> DataFrame:
    """All rows of each leg's latest load (NULL-safe on ``key``): a leg that both
    sides hold takes the increment's rows unless the loaded ones are newer.
    Rows of one load are never merged with each other, so legs that the key
    cannot tell apart all stay."""
    both = increment.withColumn("_side", F.lit(1)).unionByName(
        loaded.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    load = F.struct(F.col(order), F.col("_side"))
    latest = both.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(F.max(load).alias("_latest"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key]
    return both.join(latest, [*same, load.eqNullSafe(F.col("_latest"))], "left_semi").drop("_side")


def incremental_load(spark: SparkSession, table_path: str, increment: DataFrame,
                     lookback_days: int = INCREMENTAL_LOOKBACK_DAYS, key: list[str] | None = None) -> dict:
    """Merge an increment into a table partitioned by ``month_key``: rows from
    ``high-water mark - lookback_days`` on are merged with the rows of the
    months they touch, the latest load of each leg stays. A leg's key is ``key``,
    else the columns of ``LEG_KEY`` that the table has (the record hash is an audit
    column that lacks the airline; only tables without airline and number use it).

    Returns the table and the counts ``merged`` and ``rejected`` (rows before
    the look-back or without a date).
    """
    start = None
    held = sorted(int(p.rsplit("=", 1)[1]) for p in glob_paths(spark, f"{table_path}/month_key=[0-9]*"))
    if held:  # the newest month's partition alone tells the high-water mark
        newest = spark.read.parquet(table_path).filter(F.col("month_key") == held[-1])
        top = newest.agg(F.max("flight_date")).first()[0]
        start = top - timedelta(days=lookback_days) if top else None
    taken = F.col("flight_date").isNotNull()
    if start is not None:
        taken = taken & (F.col("flight_date") >= F.lit(start))
    taken = F.coalesce(taken, F.lit(False))
    staged = shared_path(spark, "staging", "increment")
    increment.withColumn("month_key", month_key()).withColumn("_taken", taken).write.parquet(staged)
    staged_rows = spark.read.parquet(staged)
    counts = {r["_taken"]: r["count"] for r in staged_rows.groupBy("_taken").count().collect()}
    inc = staged_rows.filter("_taken").drop("_taken")
    months = sorted(r[0] for r in inc.select("month_key").distinct().collect())
    if months:
        old = (spark.read.parquet(table_path).filter(F.col("month_key").isin(*months)) if held
               else spark.createDataFrame([], inc.schema))
        shared = [c for c in LEG_KEY if c in inc.columns and c in old.columns]
        key = key or (shared if set(LEG_KEY[:3]) <= set(shared) else ["record_hash"])
        merged = shared_path(spark, "staging", "merged")  # the table is read here and replaced below
        merge_legs(old, inc, key).write.parquet(merged)
        K.write_partitioned(spark.read.parquet(merged), table_path, ["month_key"], sort_by=["date_key"])
    return {"table": spark.read.parquet(table_path).drop("month_key") if held or months else inc.drop("month_key"),
            "merged": counts.get(True, 0), "rejected": counts.get(False, 0)}
