"""Versioned tables: commit markers, changed partitions, refresh of what depends on a change."""

import contextlib
import datetime as dt
import io
import json
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from payledger.plans.pipeline import deploy
from payledger.sources import versioned as V
from payledger.sources.erp import TableResolver, stage_tables, table_states
from payledger.streaming.holiday_feed import feed_holiday_table

YEARS = V.Partition("y", "year(d)")


def root(name):
    return os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), "t")


def rows(spark, *pairs):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, v) for d, v in pairs], "d date, v string")


def got(df):
    return sorted(((str(r["d"]), r["v"]) for r in df.collect()))


def test_one_of_many_markers_wins(spark):
    path = os.path.join(root("marker"), "m.json")
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda i: V.put_if_absent(spark, path, f"writer {i}"), range(8)))
    assert done.count(True) == 1
    with open(path) as f:
        assert f.read() == f"writer {done.index(True)}"
    assert os.listdir(os.path.dirname(path)) == ["m.json"]


def test_concurrent_upserts_lose_nothing(spark):
    at = root("concurrent")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda i: V.upsert_table(spark, at, rows(spark, (f"2001-01-0{i + 1}", f"w{i}")), ["d"], retries=9).version, range(4)))
    assert sorted(made) == [0, 1, 2, 3] == V.versions(spark, at)
    assert got(V.read(spark, at)) == [(f"2001-01-0{i + 1}", f"w{i}") for i in range(4)]
    assert not [n for n in os.listdir(at) if n.startswith("_writing")]


def test_a_lost_race_rebases_or_raises(spark):
    at = root("race")
    V.upsert_table(spark, at, rows(spark, ("2001-01-01", "a")), ["d"])
    schema, seen = rows(spark).schema, []

    def late(base):
        """Another writer publishes while this one is at work, once."""
        seen.append(base.version)
        if len(seen) == 1:
            V.upsert_table(spark, at, rows(spark, ("2001-01-02", "rival")), ["d"])
        return V.Draft(V.read(spark, at, base).unionByName(rows(spark, ("2001-01-03", "late"))), {}, {})

    assert V.commit(spark, at, schema, late).version == 2 and seen == [0, 1]
    assert got(V.read(spark, at)) == [("2001-01-01", "a"), ("2001-01-02", "rival"), ("2001-01-03", "late")]
    seen.clear()
    with pytest.raises(V.ConflictError):
        V.commit(spark, at, schema, late, rebase=False)
    assert V.versions(spark, at) == [0, 1, 2, 3]  # the rival's


def test_an_unfinished_move_is_finished_by_the_next_reader(spark):
    at = root("lost")
    V.upsert_table(spark, at, rows(spark, ("2001-01-01", "a")), ["d"])
    rows(spark, ("2001-01-01", "b")).write.parquet(f"{at}/_writing-x")  # written and committed, then lost
    text = {"version": 1, "folders": {"": "version=1"}, "schema": rows(spark).schema.json(), "partition": None, "digests": {},
            "inputs": {}, "aside": "_writing-x"}
    assert V.put_if_absent(spark, f"{at}/_commits/{1:020d}.json", json.dumps(text))
    rows(spark, ("2009-09-09", "never committed")).write.parquet(f"{at}/_writing-y")
    assert got(V.read(spark, at)) == [("2001-01-01", "b")]
    assert got(V.read(spark, at, V.load(spark, at, 0))) == [("2001-01-01", "a")]


def test_only_changed_partitions_are_written(spark):
    at = root("partitions")
    old = [("1999-05-05", "x"), ("2000-05-05", "y"), ("2001-05-05", "z"), (None, "n")]
    first = V.replace_table(spark, at, rows(spark, *old), YEARS)
    assert set(first.folders) == {"1999", "2000", "2001", V.NULL}
    appended = V.replace_table(spark, at, rows(spark, *old, ("2001-05-06", "new")).repartition(3), YEARS)
    assert {v for v, f in appended.folders.items() if f.startswith("version=1/")} == {"2001"}
    assert os.listdir(f"{at}/version=1") and not os.path.exists(f"{at}/version=1/y=2000")
    assert len(got(V.read(spark, at))) == 5 and got(V.read(spark, at, first)) == sorted((str(d), v) for d, v in [(None, "n"), *old[:3]])
    assert got(V.read(spark, at, only={"2001"})) == [("2001-05-05", "z"), ("2001-05-06", "new")]
    same = V.replace_table(spark, at, V.read(spark, at), YEARS)
    assert same.state() == appended.state() and not os.path.exists(f"{at}/version=2")
    fewer = V.replace_table(spark, at, rows(spark, ("2000-05-05", "y")), YEARS)
    assert got(V.read(spark, at)) == [("2000-05-05", "y")] and fewer.folders == {"2000": "version=0/y=2000"}
    nothing = V.replace_table(spark, at, rows(spark), YEARS)
    assert nothing.folders == {} and V.read(spark, at).count() == 0


def test_upsert_reads_and_writes_partitions_of_the_source(spark):
    at = root("delta")
    V.upsert_table(spark, at, rows(spark, *[(f"{y}-0{m}-01", "old") for y in range(1990, 2010) for m in range(1, 10)], (None, "n")), ["d"], YEARS)
    os.rename(f"{at}/version=0/y=1995", f"{at}/hidden")  # a partition that must not be read
    V.upsert_table(spark, at, rows(spark, ("2001-02-01", "new"), ("2001-12-01", "new"), ("2015-01-01", "new")), ["d"], YEARS)
    assert sorted(n for n in os.listdir(f"{at}/version=1") if n.startswith("y=")) == ["y=2001", "y=2015"]
    os.rename(f"{at}/hidden", f"{at}/version=0/y=1995")
    out = dict(got(V.read(spark, at)))
    assert len(out) == 20 * 9 + 2 + 1 and [d for d, v in sorted(out.items()) if v == "new"] == ["2001-02-01", "2001-12-01", "2015-01-01"]
    V.upsert_table(spark, at, rows(spark, ("2001-02-01", "new")), ["d"], YEARS)
    assert not os.path.exists(f"{at}/version=2")  # the rows are there already
    with pytest.raises(ValueError):
        V.upsert_table(spark, at, rows(spark, ("2001-02-01", "p"), ("2001-02-01", "q")), ["d"], YEARS)
    assert V.versions(spark, at) == [0, 1, 2]


def test_retention_keeps_what_newer_versions_use(spark):
    at = root("retain")
    V.replace_table(spark, at, rows(spark, ("1999-05-05", "x"), ("2001-05-05", "z")), YEARS)
    for n in range(3):
        V.replace_table(spark, at, rows(spark, ("1999-05-05", "x"), ("2001-05-05", f"z{n}")), YEARS)
    assert V.retain(spark, at, 2) == [0, 1] and V.versions(spark, at) == [2, 3]
    assert V.retain(spark, at, 2) == []
    assert got(V.read(spark, at)) == [("1999-05-05", "x"), ("2001-05-05", "z2")]
    assert got(V.read(spark, at, V.load(spark, at, 2)))[1] == ("2001-05-05", "z1")
    assert not os.path.exists(f"{at}/version=1") and not os.path.exists(f"{at}/version=0/y=2001")


def test_a_date_filter_on_the_view_prunes_folders(spark):
    at = root("view")
    spark.sql("CREATE DATABASE IF NOT EXISTS versioned_test")
    V.replace_table(spark, at, rows(spark, *[(f"{y}-05-05", "x") for y in range(1990, 2000)], (None, "n")), YEARS)
    kept = V.replace_table(spark, at, rows(spark, *[(f"{y}-05-05", "y" if y == 1995 else "x") for y in range(1990, 2000)], (None, "n")), YEARS)
    name = V.catalog_view(spark, "versioned_test", "T", at, kept)
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.maxMetadataStringLength", "2000")
    assert got(fresh.table(name)) == got(V.read(spark, at)) and fresh.table(name).columns == ["d", "v"]
    one = fresh.table(name).where("d = DATE'1995-05-05'")
    assert got(one) == [("1995-05-05", "y")]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    filters = [p.split("PushedFilters")[0] for p in buf.getvalue().split("PartitionFilters: ")[1:]]
    assert len(filters) == 2 and all("<=> 1995" in p for p in filters), buf.getvalue()


def test_refresh_rebuilds_what_a_change_reaches(spark, erp, cfg):
    """A new holiday and a new rate show through the stored views in a new session;
    datasets that do not depend on them keep their version."""
    staged, out = tempfile.mkdtemp(prefix="refresh-erp-"), tempfile.mkdtemp(prefix="refresh-")
    small = ["tcurr", "tcurf", "tcurx", "t001", "tvarvc", "febraban_holiday", "bkpf", "rbkp", "t009", "t009b"]
    stage_tables({k: erp[k] for k in small}, staged)
    resolver = TableResolver(root=staged)
    spark.sql("CREATE DATABASE IF NOT EXISTS refresh_test")
    wanted = ["CurrencyConversion", "CompaniesMD", "VendorConfig"]

    def run():
        names = [n for n in small if n != "febraban_holiday"]
        return deploy(spark, resolver.tables(spark, small), cfg, out, "refresh_test", datasets=wanted,
                      states=table_states(spark, resolver, names))["rebuilt"]

    assert run() == ",".join(wanted)
    assert run() == ""
    before = spark.newSession().table("refresh_test.CurrencyConversion").count()
    # an ordinary Wednesday becomes a holiday
    day = dt.date(1999, 3, 10)
    assert spark.newSession().table("refresh_test.BusinessDays").where(F.col("date") == F.lit(day)).first()["is_business_day"]
    hol = resolver.read(spark, "febraban_holiday")
    spark.createDataFrame([(day,)], "HolidayDate date").select(*[
        F.col("HolidayDate").cast(f.dataType).alias(f.name) if f.name.lower() == "holidaydate" else F.lit(None).cast(f.dataType).alias(f.name)
        for f in hol.schema.fields]).write.mode("append").parquet(f"{staged}/febraban_holiday")
    assert run() == ""  # none of the three depends on it
    days = spark.newSession().table("refresh_test.BusinessDays")
    assert not days.where(F.col("date") == F.lit(day)).first()["is_business_day"]
    changed = V.current(spark, f"{out}/BusinessDays")
    assert {v for v, f in changed.folders.items() if not f.startswith("version=0/")} == {"1999"}
    # a rate for a new pair
    resolver.read(spark, "tcurr").limit(1).withColumn("fcurr", F.lit("XXX")).write.mode("append").parquet(f"{staged}/tcurr")
    assert run() == "CurrencyConversion"
    after = spark.newSession().table("refresh_test.CurrencyConversion")
    assert after.count() > before and after.where("FromCurrency_FCURR = 'XXX'").count() > 0


def test_feed_reaches_the_deployed_holiday_table(spark):
    base = tempfile.mkdtemp(prefix="feed-table-")
    inbox, table, bad, ckpt = (os.path.join(base, x) for x in ("inbox", "table", "bad", "ckpt"))
    os.makedirs(inbox)
    for name, text in (("a", "HolidayDate\n2001-01-01\nnot a day\n"), ("b", "HolidayDate\n25/12/2001\n2001-01-01\n")):
        with open(f"{inbox}/{name}.csv", "w") as f:
            f.write(text)
        feed_holiday_table(spark, inbox, table, bad, ckpt).awaitTermination()
    assert sorted(str(r[0]) for r in V.read(spark, table).collect()) == ["2001-01-01", "2001-12-25"]
    assert [r["given"] for r in spark.read.parquet(bad).collect()] == ["not a day"]
