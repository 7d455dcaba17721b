"""Count physical operators of each headline dataset (bucketed staged inputs,
automatic broadcast off so only size-checked broadcasts remain: the shape a
large input gets). Prints a markdown table."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from payledger.config import FIXTURE_CONFIG  # noqa: E402
from payledger.plans.model import LedgerModel  # noqa: E402
from payledger.session import local_session  # noqa: E402
from payledger.sources.erp import stage_tables  # noqa: E402
from payledger.sources.fixtures import ERP_TABLES, erp_tables  # noqa: E402

DATASETS = ["accounts_payable", "accounting_documents", "invoices", "purchase_history", "business_days",
            "currency_conversion"]
KINDS = ["Exchange hashpartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "WindowGroupLimit", "BatchEvalPython"]


def main(sf_dir: str) -> None:
    spark = local_session(8, 16)
    spark.sql("CREATE DATABASE IF NOT EXISTS plan_summary")
    res = stage_tables(erp_tables(spark, sf_dir), tempfile.mkdtemp(prefix="erp-"), buckets=16,
                       database="plan_summary")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before AQE re-plans
    model = LedgerModel(spark, res.tables(spark, ERP_TABLES), FIXTURE_CONFIG)
    print("| dataset | " + " | ".join(k.split()[0] if k.startswith("Exchange") else k for k in KINDS) + " |")
    print("| --- |" + " --- |" * len(KINDS))
    for name in DATASETS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            getattr(model, name).explain()
        plan = buf.getvalue()
        counts = [len(re.findall(rf"[ -]{re.escape(k)}\b", plan)) for k in KINDS]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
