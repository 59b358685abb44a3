"""Command line for the jobs.

    python -m contrail.cli etl    --landing L --target T --log G (--date D | --backfill START END)
                                  [--columns A,B,...] [--quarantine Q]
    python -m contrail.cli spark  --mode batch|stream|both --date D --raw R --fact F --kpis K
                                  [--events E | --brokers B --topic T] --sinks S

``etl`` cleans landed raw CSV for one day or a date range in one job (a
range is a predicate, not a loop) and replaces those date partitions.
``spark`` runs the daily batch (enrich + route KPIs for one day, with the
earlier rows the rolling window needs, kept in ``--tail``) and/or the two stream queries
(KPIs and alerts) until either stops.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime, timedelta

from contrail.schemas import BTS_COLUMNS
from contrail.session import get_session, shared_path


def _etl(args) -> None:
    from contrail.plans.jobs import backfill
    spark = get_session(app="contrail-etl")
    if args.backfill:
        start, end = args.backfill
    else:
        d = args.date or (date.today() - timedelta(days=1)).isoformat()
        start = end = d
    columns = args.columns.split(",") if args.columns else BTS_COLUMNS
    out = backfill(spark, args.landing, columns, start, end, args.target, args.log, datetime.now(),
                   quarantine_path=args.quarantine)
    print(f"loaded {out.filter(out.flight_date.between(start, end)).count()} rows for {start}..{end}")


def _spark(args) -> None:
    mode = args.mode
    spark = get_session(app="contrail-spark", mode="streaming" if mode != "batch" else "batch")
    if mode in ("batch", "both"):
        from contrail.plans.jobs import daily_batch
        info = daily_batch(spark, args.raw, args.date, args.fact, args.kpis, args.tail)
        print(f"batch {info}")
    if mode in ("stream", "both"):
        from contrail.streaming import kpis as SK
        from contrail.streaming.runner import run_both
        from contrail.streaming.sink import UpsertSink
        events = (SK.kafka_events(spark, args.brokers, args.topic) if args.brokers
                  else SK.file_events(spark, args.events))
        sinks = args.sinks or shared_path(spark, "sinks", unique=False)
        run_both(SK.windowed_kpis(events), SK.cascade_alerts(events),
                 UpsertSink(f"{sinks}/airport_kpi", ["window_start", "window_end", "airline_code", "origin_iata"]),
                 UpsertSink(f"{sinks}/delay_alerts", ["window_start", "window_end", "origin_iata"]),
                 args.checkpoints or shared_path(spark, "checkpoints", unique=False))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="contrail")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="clean and load landed raw flight files")
    e.add_argument("--landing", required=True)
    e.add_argument("--target", required=True)
    e.add_argument("--log", required=True)
    e.add_argument("--columns", help="comma-separated raw columns to load (default: all 22)")
    e.add_argument("--quarantine", help="folder for raw rows that fail a check")
    g = e.add_mutually_exclusive_group()
    g.add_argument("--date", help="YYYY-MM-DD (default: yesterday)")
    g.add_argument("--backfill", nargs=2, metavar=("START", "END"))
    e.set_defaults(fn=_etl)
    s = sub.add_parser("spark", help="daily batch and/or streaming KPIs and alerts")
    s.add_argument("--mode", choices=["batch", "stream", "both"], default="batch")
    s.add_argument("--date", default=(date.today() - timedelta(days=1)).isoformat())
    s.add_argument("--raw")
    s.add_argument("--fact")
    s.add_argument("--kpis")
    s.add_argument("--tail", help="folder of the rolling frame's kept state")
    s.add_argument("--events", help="folder of JSON-lines event files")
    s.add_argument("--brokers")
    s.add_argument("--topic")
    s.add_argument("--sinks")
    s.add_argument("--checkpoints")
    s.set_defaults(fn=_spark)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
