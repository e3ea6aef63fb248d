"""Command line: load every unconsumed feed day into the warehouse.

    python -m cardwatch load --feeds DIR --warehouse DIR \\
        --accounts PATH --cards PATH --clients PATH [--semantics literal]

Source tables are parquet paths or catalog table names (``table:db.name``).
Run it from any scheduler; reruns are idempotent and a failed day is
invisible until it succeeds.  ``report`` prints one day's report, all of it, or
writes it with ``--out`` (CSV, or parquet by ``--format``).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession

from cardwatch.plans.daily import Sources, report_of, run_daily
from cardwatch.plans.report import with_labels
from cardwatch.session import tune
from cardwatch.sources.compaction import compact, vacuum
from cardwatch.sources.feeds import FAIL, FORMATS, QUARANTINE, next_day
from cardwatch.sources.store import Store
from cardwatch.sources.tables import source_parquet, source_table


def _source(spark: SparkSession, spec: str, kind: str):
    if spec.startswith("table:"):
        return source_table(spark, spec[len("table:"):], kind)
    return source_parquet(spark, spec, kind)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cardwatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load all unconsumed feed days")
    ld.add_argument("--feeds", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--accounts", required=True)
    ld.add_argument("--cards", required=True)
    ld.add_argument("--clients", required=True)
    ld.add_argument("--semantics", choices=["corrected", "literal"], default="corrected")
    ld.add_argument("--terminals-format", choices=FORMATS, default="auto")
    ld.add_argument("--blacklist-format", choices=FORMATS, default="auto")
    ld.add_argument("--bad-rows", choices=[FAIL, QUARANTINE], default=FAIL, help="what happens to feed lines that do not parse")
    ld.add_argument("--max-reject-share", type=float, default=0.01, help="share of a day's lines that may be left out")
    rp = sub.add_parser("report", help="print the report of one load date")
    rp.add_argument("--warehouse", required=True)
    rp.add_argument("--date", required=True, help="YYYY-MM-DD")
    rp.add_argument("--out", help="folder to write the report to instead of printing it")
    rp.add_argument("--format", choices=["csv", "parquet"], default="csv")
    rp.add_argument("--labels", action="store_true", help="event sentences instead of codes")
    cp = sub.add_parser("compact", help="merge the folders of old runs")
    cp.add_argument("--warehouse", required=True)
    cp.add_argument("--vacuum-days", type=int, help="also delete folders out of use for so many days")
    args = ap.parse_args(argv)

    spark = tune(SparkSession.builder.appName("cardwatch").getOrCreate())
    store = Store(spark, args.warehouse)
    if args.cmd == "compact":
        print(f"{len(compact(store))} units written")
        if args.vacuum_days is not None:
            print(f"{len(vacuum(store, _dt.timedelta(days=args.vacuum_days)))} folders deleted")
        return 0
    if args.cmd == "report":
        df = report_of(store, _dt.datetime.fromisoformat(args.date))
        df = with_labels(df) if args.labels else df
        if args.out:
            df.write.mode("overwrite").option("header", True).format(args.format).save(args.out)
            return 0
        print("|".join(df.columns))
        for row in df.toLocalIterator():   # partition by partition, so the driver holds one at a time
            print("|".join("" if v is None else str(v) for v in row))
        return 0
    sources = Sources(
        accounts=_source(spark, args.accounts, "accounts"),
        cards=_source(spark, args.cards, "cards"),
        clients=_source(spark, args.clients, "clients"),
    )
    while True:
        day = next_day(spark, args.feeds, store.ledger(store.effective()),
                       args.terminals_format, args.blacklist_format, args.bad_rows, args.max_reject_share)
        if day is None:
            return 0
        run = run_daily(spark, store, day, sources, args.semantics)
        print(f"loaded {day.load_dt:%Y-%m-%d} as {run.run_id}")


if __name__ == "__main__":
    sys.exit(main())
