"""Benchmark: headline datasets on $BENCH_SF_DIR with local[$BENCH_CPUS].

1. The ERP-shaped tables are derived from the driver tables and staged once as
   stored tables (bucketed on their document keys), as replicated ERP tables
   would be. Timed and reported as ``stage_erp_tables``.
2. Each headline dataset is planned and executed in full with the ``noop``
   sink (every row computed, nothing collected), best of $BENCH_RUNS (3) runs;
   every run builds a fresh model, so planning and dimension checkpoints count.

``value`` is the sum of the headline dataset times. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from payledger.config import FIXTURE_CONFIG  # noqa: E402
from payledger.plans.model import LedgerModel  # noqa: E402
from payledger.session import checkpoint_dir, local_session  # noqa: E402
from payledger.sources.erp import stage_tables  # noqa: E402
from payledger.sources.fixtures import ERP_TABLES, erp_tables  # noqa: E402

HEADLINE = [
    "accounts_payable",
    "accounting_documents",
    "invoices",
    "purchase_history",
    "customers",
    "vendors",
    "currency_conversion",
    "business_days",
    "calendar",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    os.environ.setdefault("PAYLEDGER_DRIVER_MEMORY", "16g")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    root = tempfile.mkdtemp(prefix="erp-", dir=checkpoint_dir(spark).replace("file:", ""))
    db = "payledger_bench"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    t0 = time.perf_counter()
    resolver = stage_tables(erp_tables(spark, sf_dir), root, buckets=int(cpus) * 2, database=db)
    stage_sec = round(time.perf_counter() - t0, 3)

    timings = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            model = LedgerModel(spark, resolver.tables(spark, ERP_TABLES), FIXTURE_CONFIG)
            t1 = time.perf_counter()
            run(getattr(model, name))
            took = time.perf_counter() - t1
            print(f"bench {name}: {took:.3f}s", file=sys.stderr, flush=True)
            best = took if best is None else min(best, took)
        timings[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_datasets_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "stage_erp_tables": stage_sec,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
