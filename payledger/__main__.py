"""Command line: build and publish every dataset.

    python -m payledger deploy --database erp --out /shared/ledger --as-of 2001-06-30
    python -m payledger deploy --root /shared/erp --out /shared/ledger

ERP tables are read through a ``TableResolver`` (a catalog database or a
parquet root). ``spark.checkpoint.dir`` should name a shared folder.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from payledger.config import LedgerConfig
from payledger.plans.pipeline import deploy
from payledger.sources.erp import HOLIDAY_TABLE, MODEL_TABLES, TableResolver, table_states


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="payledger")
    sub = ap.add_subparsers(dest="command", required=True)
    dp = sub.add_parser("deploy", help="build helper tables and views")
    src = dp.add_mutually_exclusive_group(required=True)
    src.add_argument("--database", help="catalog database holding the ERP tables")
    src.add_argument("--root", help="folder with one parquet folder per ERP table")
    dp.add_argument("--out", required=True, help="shared folder for the persisted outputs")
    dp.add_argument("--as-of", type=_date, help="date used as 'today' (default: the current date)")
    dp.add_argument("--calendar-start", type=_date)
    dp.add_argument("--calendar-end", type=_date)
    dp.add_argument("--target-database", help="catalog database for the outputs")
    dp.add_argument("--holiday-csv", help="holiday files to load (default: the table febraban_holiday)")
    dp.add_argument("--rebuild", action="store_true", help="build every dataset, also those whose inputs did not change")
    dp.add_argument("--keep-versions", type=int, help="remove all but the newest versions of every output")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("payledger-deploy").getOrCreate()
    cfg = LedgerConfig(as_of=args.as_of)
    if args.calendar_start:
        cfg = dataclasses.replace(cfg, calendar_start=args.calendar_start)
    if args.calendar_end:
        cfg = dataclasses.replace(cfg, calendar_end=args.calendar_end)
    resolver = TableResolver(root=args.root, database=args.database)
    names = MODEL_TABLES if args.holiday_csv else (*MODEL_TABLES, HOLIDAY_TABLE)
    states = None if args.rebuild else table_states(spark, resolver, MODEL_TABLES)
    out = deploy(spark, resolver.tables(spark, names), cfg, args.out, database=args.target_database, holiday_csv=args.holiday_csv,
                 states=states, keep_versions=args.keep_versions)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
