"""Run one dataset with Spark's event log in a scratch folder and print the
slowest stages (duration, tasks, shuffle bytes) and the job time per action."""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from payledger.config import FIXTURE_CONFIG  # noqa: E402
from payledger.plans.model import LedgerModel  # noqa: E402
from payledger.sources.erp import stage_tables  # noqa: E402
from payledger.sources.fixtures import ERP_TABLES, erp_tables  # noqa: E402


def main(name: str, sf_dir: str, bucketed: bool) -> None:
    logdir = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", logdir)
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="erp-", dir="/tmp")
    db = "stage_prof" if bucketed else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    res = stage_tables(erp_tables(spark, sf_dir), root, buckets=16 if bucketed else None, database=db)
    spark.sparkContext.setJobGroup("measure", name)
    t = time.perf_counter()
    df = getattr(LedgerModel(spark, res.tables(spark, ERP_TABLES), FIXTURE_CONFIG), name)
    built = time.perf_counter() - t
    df.write.format("noop").mode("overwrite").save()
    print(f"{name}: build {built:.2f}s total {time.perf_counter() - t:.2f}s")
    spark.stop()
    stages, jobs = {}, {}
    for path in glob.glob(f"{logdir}/**/*", recursive=True):
        if os.path.isdir(path) or "appstatus" in path:
            continue
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                jobs[ev["Job ID"]] = [props.get("spark.jobGroup.id"), ev["Submission Time"], None, ev.get("Stage IDs")]
            elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
                jobs[ev["Job ID"]][2] = ev["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                dur = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
                scopes = []
                for rdd in info.get("RDD Info", []):
                    try:
                        nm = json.loads(rdd.get("Scope") or "{}").get("name", "")
                    except ValueError:
                        nm = ""
                    if nm and nm not in scopes:
                        scopes.append(nm)
                stages[info["Stage ID"]] = (dur, info["Number of Tasks"], ",".join(scopes)[:100],
                                            acc.get("internal.metrics.shuffle.write.bytesWritten"),
                                            acc.get("internal.metrics.executorRunTime") or 0)
    measured = {j: v for j, v in jobs.items() if v[0] == "measure"}
    ids = {s for v in measured.values() for s in (v[3] or [])}
    print(f"jobs in measured group: {len(measured)}; "
          f"sum of job times {sum((v[2] or v[1]) - v[1] for v in measured.values()) / 1000:.2f}s")
    total_cpu = sum(stages[s][4] for s in ids if s in stages)
    print(f"executor run time, all measured stages: {total_cpu / 1000:.2f}s")
    for sid, (dur, n, nm, sw, cpu) in sorted(((s, stages[s]) for s in ids if s in stages), key=lambda x: -x[1][4])[:15]:
        print(f"  stage {sid:4d} wall {dur / 1000:6.2f}s run {cpu / 1000:6.2f}s tasks={n:4d} shuffle_write={sw} {nm}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1", "--plain" not in sys.argv)
