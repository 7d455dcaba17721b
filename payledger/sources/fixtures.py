"""ERP-shaped input tables derived from the driver's TPC-H-style tables.

The reference reads replicated ERP tables that the driver does not ship, so
FIXTURES.md derives each of them from ``orders``, ``lineitem``, ``supplier``,
``customer``, ``nation`` and ``part``. The column expressions below are those
derivations; the same strings feed Spark (``selectExpr``) and the DuckDB oracle
(``fixture_ctes``), so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payledger.operators.joins import broadcast_if_small

# The derivations of FIXTURES.md, one (field, expression) per column.
_COMPANY = "concat('10', lpad(cast(o_custkey % 5 as string), 2, '0'))"
_DOC_PREFIX = (
    "case o_orderkey % 6 when 0 then '51' when 1 then '15' when 2 then '20' "
    "when 3 then '17' when 4 then '12' else '19' end"
)
_DOC_CURRENCY = (
    "case o_orderkey % 6 when 0 then 'BRL' when 1 then 'USD' when 2 then 'EUR' "
    "when 3 then 'JPY' when 4 then 'KWD' else 'ZZZ' end"
)
_ACC_DOC = f"concat({_DOC_PREFIX}, lpad(cast(o_orderkey as string), 8, '0'))"
_YEAR = "cast(year(o_orderdate) as string)"
_DEBIT_CREDIT = "case l_returnflag when 'A' then 'S' when 'R' then 'H' end"

COLUMNS: dict[str, list[tuple[str, str]]] = {
    "bkpf": [
        ("mandt", "'100'"),
        ("bukrs", _COMPANY),
        ("belnr", _ACC_DOC),
        ("gjahr", _YEAR),
        ("blart", "case o_orderkey % 5 when 0 then 'RE' when 1 then 'KR' when 2 then 'KZ' when 3 then 'ZP' else 'SA' end"),
        ("bldat", "cast(o_orderdate as date)"),
        ("budat", "cast(o_orderdate as date) + cast(o_orderkey % 4 as int)"),
        ("monat", "lpad(cast(month(o_orderdate) as string), 2, '0')"),
        ("waers", _DOC_CURRENCY),
        ("hwaer", "'BRL'"),
        ("hwae2", "'USD'"),
        ("hwae3", "'JPY'"),
        ("awkey", "concat('51', lpad(cast(o_orderkey as string), 8, '0'), cast(year(o_orderdate) as string))"),
    ],
    "bseg": [
        ("mandt", "'100'"),
        ("bukrs", _COMPANY),
        ("belnr", _ACC_DOC),
        ("gjahr", _YEAR),
        ("buzei", "lpad(cast(l_linenumber as string), 3, '0')"),
        ("koart", "case l_linenumber % 4 when 0 then 'M' when 3 then 'D' else 'K' end"),
        ("shkzg", _DEBIT_CREDIT),
        ("dmbtr", "cast(l_extendedprice as decimal(23,2))"),
        ("wrbtr", "cast(l_quantity * 100 as decimal(23,2))"),
        ("kzbtr", "cast(l_tax * 100 as decimal(23,2))"),
        ("skfbt", "cast(l_extendedprice as decimal(23,2))"),
        ("nebtr", "case when l_partkey % 7 = 0 then null else cast(l_quantity as decimal(23,2)) end"),
        ("dmbe2", "cast(l_quantity * 20 as decimal(23,2))"),
        ("dmbe3", "cast(l_quantity * 2500 as decimal(23,2))"),
        ("pswbt", "cast(l_quantity * 100 as decimal(23,2))"),
        ("rewrt", "cast(l_quantity * 3 as decimal(23,2))"),
        ("pswsl", _DOC_CURRENCY),
        ("zfbdt", "case when l_linestatus = 'F' then cast(l_shipdate as date) end"),
        ("zbd1t", "cast(case l_suppkey % 4 when 1 then 0 when 2 then 14 when 3 then 30 end as decimal(3,0))"),
        ("zbd2t", "cast(case l_suppkey % 3 when 1 then 45 when 2 then 0 end as decimal(3,0))"),
        ("zbd3t", "cast(case l_suppkey % 5 when 1 then 60 when 2 then 90 end as decimal(3,0))"),
        ("zbd1p", "cast(l_discount * 100 as decimal(5,3))"),
        ("augdt", "case l_partkey % 3 when 1 then date '0001-01-01' when 2 then cast(l_shipdate as date) + cast(l_partkey % 40 as int) end"),
        ("augbl", "case l_partkey % 3 when 2 then concat('20', lpad(cast(o_orderkey as string), 8, '0')) end"),
        ("rebzg", "case when l_partkey % 4 = 0 then lpad(cast(l_orderkey as string), 10, '0') end"),
        ("rebzt", "case when l_partkey % 10 = 0 then 'Z' end"),
        ("umskz", "case when l_suppkey % 11 = 0 then 'D' end"),
        ("xumsw", "case when l_partkey % 2 = 0 then 'X' end"),
        ("ktosl", "case when l_linenumber = 5 then 'SKE' else 'KBS' end"),
        ("bschl", "case when l_returnflag = 'R' then '31' else '40' end"),
        ("zlspr", "case l_suppkey % 4 when 0 then 'A' when 1 then 'P' when 2 then ' ' end"),
        ("lifnr", "lpad(cast(l_suppkey as string), 10, '0')"),
        ("ebeln", "case when l_partkey % 2 = 0 then concat('45', lpad(cast(l_orderkey as string), 8, '0')) end"),
        ("ebelp", "lpad(cast(l_linenumber as string), 5, '0')"),
        ("zterm", "case l_suppkey % 2 when 0 then 'Z030' else 'Z014' end"),
    ],
    "rbkp": [
        ("mandt", "'100'"),
        ("belnr", "concat('51', lpad(cast(o_orderkey as string), 8, '0'))"),
        ("gjahr", _YEAR),
        ("bukrs", _COMPANY),
        ("gsber", "case when o_custkey % 2 = 0 then '0001' end"),
        ("blart", "'RE'"),
        ("bldat", "cast(o_orderdate as date)"),
        ("budat", "cast(o_orderdate as date) + cast(o_orderkey % 4 as int)"),
        ("lifnr", "lpad(cast(o_custkey % 10 as string), 10, '0')"),
        ("waers", "case o_orderkey % 3 when 0 then 'BRL' when 1 then 'JPY' else 'EUR' end"),
        ("rmwwr", "cast(o_totalprice as decimal(23,2))"),
        ("rbstat", "case o_orderstatus when 'P' then 'A' else '5' end"),
    ],
    "rseg": [
        ("mandt", "'100'"),
        ("belnr", "concat('51', lpad(cast(l_orderkey as string), 8, '0'))"),
        ("gjahr", _YEAR),
        ("buzei", "lpad(cast(l_linenumber as string), 6, '0')"),
        ("zekkn", "'01'"),
        ("bukrs", _COMPANY),
        ("werks", "case when l_partkey % 2 = 0 then 'W001' end"),
        ("shkzg", _DEBIT_CREDIT),
        ("wrbtr", "cast(l_extendedprice as decimal(23,2))"),
        ("bnkan", "cast(l_tax * 10 as decimal(23,2))"),
        ("rbwwr", "cast(l_quantity * 7 as decimal(23,2))"),
        ("retamt_fc", "cast(l_quantity as decimal(23,2))"),
        ("diff_amount", "cast(l_discount * 100 as decimal(23,2))"),
        ("ebeln", "concat('45', lpad(cast(l_orderkey as string), 8, '0'))"),
        ("ebelp", "lpad(cast(l_linenumber as string), 5, '0')"),
        ("menge", "cast(l_quantity as decimal(13,3))"),
    ],
    "rbco": [
        ("mandt", "'100'"),
        ("belnr", "concat('51', lpad(cast(l_orderkey as string), 8, '0'))"),
        ("gjahr", _YEAR),
        ("buzei", "lpad(cast(l_linenumber as string), 6, '0')"),
        ("cobl_nr", "lpad(cast(l_suppkey % 3 as string), 4, '0')"),
        ("zekkn", "'02'"),
        ("bukrs", _COMPANY),
        ("gsber", "'0002'"),
        ("werks", "'W002'"),
        ("shkzg", _DEBIT_CREDIT),
        ("wrbtr", "cast(l_extendedprice as decimal(23,2))"),
        ("bnkan_fw", "cast(l_tax * 10 as decimal(23,2))"),
        ("fwbas", "cast(l_quantity as decimal(23,2))"),
        ("menge", "cast(l_quantity as decimal(13,3))"),
        ("ps_psp_pnr", "lpad(cast(l_partkey as string), 8, '0')"),
    ],
    "prps": [
        ("pspnr", "lpad(cast(p_partkey as string), 8, '0')"),
        ("posid", "concat('WBS-', p_brand)"),
    ],
    "ekbe": [
        ("mandt", "'100'"),
        ("ebeln", "concat('45', lpad(cast(l_orderkey as string), 8, '0'))"),
        ("ebelp", "lpad(cast(l_linenumber as string), 5, '0')"),
        ("zekkn", "lpad(cast(l_suppkey % 2 as string), 2, '0')"),
        ("vgabe", "cast(1 + l_partkey % 3 as string)"),
        ("gjahr", _YEAR),
        ("belnr", "concat('51', lpad(cast(l_orderkey as string), 8, '0'))"),
        ("buzei", "lpad(cast(l_linenumber as string), 4, '0')"),
        ("bwart", "case l_suppkey % 5 when 0 then '101' when 1 then '102' when 2 then '501' when 3 then '122' else '502' end"),
        ("budat", "cast(l_shipdate as date)"),
        ("bldat", "cast(o_orderdate as date)"),
        ("menge", "cast(l_quantity as decimal(13,3))"),
        ("waers", _DOC_CURRENCY),
        ("dmbtr", "cast(l_extendedprice as decimal(23,2))"),
        ("wrbtr", "cast(l_quantity * 10 as decimal(23,2))"),
    ],
    "lfa1": [
        ("mandt", "'100'"),
        ("lifnr", "lpad(cast(s_suppkey as string), 10, '0')"),
        ("name1", "s_name"),
        ("land1", "lpad(cast(s_nationkey as string), 2, '0')"),
        ("ktokk", "case s_suppkey % 4 when 0 then '1000' when 1 then '2000' when 2 then '3000' else '4000' end"),
        ("adrnr", "concat('S', lpad(cast(s_suppkey as string), 9, '0'))"),
    ],
    "kna1": [
        ("mandt", "'100'"),
        ("kunnr", "lpad(cast(c_custkey as string), 10, '0')"),
        ("name1", "c_name"),
        ("pstlz", "case when c_custkey % 3 = 0 then lpad(cast(c_custkey as string), 5, '0') end"),
        ("regio", "case when c_custkey % 2 = 0 then c_mktsegment end"),
        ("adrnr", "concat('C', lpad(cast(c_custkey as string), 9, '0'))"),
    ],
    "adrc": [
        ("client", "'100'"),
        ("addrnumber", "a"),
        ("date_from", "case v when 0 then date '1990-01-01' else date '2000-01-01' end"),
        ("date_to", "case v when 0 then date '1999-12-31' else date '9999-12-31' end"),
        ("post_code1", "lpad(cast(k * 7 + v as string), 5, '0')"),
        ("region", "concat('R', cast(k % 9 as string))"),
        ("name1", "concat('Addr ', a)"),
    ],
    "t001": [
        ("mandt", "'100'"),
        ("bukrs", "concat('10', lpad(cast(n_nationkey as string), 2, '0'))"),
        ("butxt", "n_name"),
        ("waers", "'BRL'"),
        ("periv", "case n_nationkey when 0 then 'K1' when 1 then 'K2' when 2 then 'K3' when 3 then 'K4' else 'XX' end"),
    ],
    "t009": [
        ("mandt", "'100'"),
        ("periv", "case n_nationkey when 0 then 'K1' when 1 then 'K2' when 2 then 'K3' else 'K4' end"),
        ("xkale", "case n_nationkey when 0 then 'X' when 3 then '' end"),
        ("xjabh", "case n_nationkey when 1 then 'X' when 3 then 'X' end"),
    ],
    "t009b": [
        ("mandt", "'100'"),
        ("periv", "p"),
        ("bdatj", "case when p = 'K3' and m <= 6 then '0000' else cast(y as string) end"),
        ("bumon", "lpad(cast(m as string), 2, '0')"),
        ("butag", "case when m = 2 then '28' else '30' end"),
        ("poper", "lpad(cast((m + 8) % 12 + 1 as string), 3, '0')"),
        ("reljr", "case when m >= 4 then '+1' else '0' end"),
    ],
    "tcurx": [
        ("currkey", "c"),
        ("currdec", "cast(d as int)"),
    ],
    "tcurr": [
        ("mandt", "'100'"),
        ("kurst", "case when i = 4 then 'M' else 'B' end"),
        ("fcurr", "f"),
        ("tcurr", "case when i = 5 then 'USD' else 'BRL' end"),
        ("gdatu", "cast(99999999 - (year(d) * 10000 + month(d) * 100 + day(d)) as string)"),
        ("ukurs", "cast(case when month(d) % 4 = 0 then -(i + day(d)) else i + day(d) end as decimal(14,5))"),
    ],
    "tcurf": [
        ("mandt", "'100'"),
        ("kurst", "'B'"),
        ("fcurr", "f"),
        ("tcurr", "'BRL'"),
        ("gdatu", "cast(99999999 - (year(d) * 10000 + month(d) * 100 + day(d)) as string)"),
        ("ffact", "cast(case when f = 'JPY' then 100 end as decimal(9,0))"),
        ("tfact", "cast(b as decimal(9,0))"),
    ],
    "tvarvc": [
        ("mandt", "'100'"),
        ("name", "concat('Z_VENDOR_', lpad(cast(s_suppkey as string), 10, '0'))"),
        ("low", "case s_suppkey % 6 when 0 then '2' when 2 then 'abc' when 4 then case when s_suppkey % 12 = 4 then '5000000000' else '1.5' end else '1.5' end"),
        ("high", "cast(null as string)"),
    ],
    "febraban_holiday": [
        ("holidaydate", "make_date(cast(y as int), m, d)"),
    ],
}

# The source row sets of FIXTURES.md, as SQL (used by the oracle).
SQL_SOURCES: dict[str, str] = {
    "bkpf": "orders",
    "bseg": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "rbkp": "orders WHERE o_orderkey % 2 = 0",
    "rseg": "lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <= 5",
    "rbco": "lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber >= 4",
    "prps": "part WHERE p_partkey % 2 = 0",
    "ekbe": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "lfa1": "supplier",
    "kna1": "customer",
    "adrc": (
        "(select concat('S', lpad(cast(s_suppkey as string), 9, '0')) a, s_suppkey k from supplier "
        "union all select concat('C', lpad(cast(c_custkey as string), 9, '0')), c_custkey from customer "
        "where c_custkey % 5 <> 0) s CROSS JOIN (select 0 v union all select 1) w"
    ),
    "t001": "nation WHERE n_nationkey < 5",
    "t009": "nation WHERE n_nationkey < 4",
    "t009b": (
        "(select n_nationkey m, y from nation cross join (select distinct year(o_orderdate) y from orders) o "
        "where n_nationkey between 1 and 12) n CROSS JOIN (select 'K2' p union all select 'K3') v"
    ),
    "tcurx": "(select 'JPY' c, 0 d union all select 'KWD', 3 union all select 'BRL', 2 union all select 'USD', null union all select 'ZZZ', 5) x",
    "tcurr": (
        "(select distinct cast(o_orderdate as date) d from orders) o "
        "CROSS JOIN (select 'USD' f, 1 i union all select 'EUR', 2 union all select 'JPY', 3 "
        "union all select 'BRL', 4 union all select 'BRL', 5) c"
    ),
    "tcurf": (
        "(select date '1990-01-01' d, 1 b union all select date '1998-07-01', 100) o "
        "CROSS JOIN (select 'USD' f union all select 'EUR' union all select 'JPY') c"
    ),
    "tvarvc": "supplier WHERE s_suppkey % 2 = 0",
    "febraban_holiday": (
        "(select distinct year(o_orderdate) y from orders) o CROSS JOIN (select 1 m, 1 d union all "
        "select 4, 21 union all select 5, 1 union all select 9, 7 union all select 12, 25) h"
    ),
}

ERP_TABLES = tuple(COLUMNS)
RAW_TABLES = ("orders", "lineitem", "supplier", "customer", "nation", "part")


def _project(df: DataFrame, name: str) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {col}" for col, expr in COLUMNS[name]])


def _explode_rows(df: DataFrame, rows_sql: str, alias: str) -> DataFrame:
    """Attach each row of a small constant list to every row of ``df``.

    Written as a generator (``inline``) instead of a cross join: every input
    row is expanded in place, in its own partition, with no exchange.
    """
    return df.selectExpr("*", f"inline({rows_sql})").alias(alias)


# Raw tables that feed line-level data, with the key they are spread by.
_SPREAD_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def spread_input(df: DataFrame, key: str, parallelism: int) -> DataFrame:
    """Give a scan at least ``parallelism`` partitions.

    A file of a single row group is read by one task, and everything up to
    the first shuffle then runs in that task. Inputs that already arrive in
    enough splits (the normal case for large tables) are left untouched; a
    small input is hash-partitioned by its key (deterministic on retry).
    """
    try:
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Spark Connect session): leave as is
        return df
    return df if splits >= parallelism else df.repartition(parallelism, key)


def erp_tables(spark: SparkSession, sf_dir: str, parallelism: int | None = None) -> dict[str, DataFrame]:
    """Derive the ERP-shaped tables from the parquet files in ``sf_dir``."""
    if parallelism is None:
        try:
            parallelism = spark.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect)
            parallelism = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    raw = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in RAW_TABLES}
    for t, key in _SPREAD_KEYS.items():
        raw[t] = spread_input(raw[t], key, parallelism)
    orders, lineitem = raw["orders"], raw["lineitem"]
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    order_years = orders.select(F.year("o_orderdate").alias("y")).distinct()

    out: dict[str, DataFrame] = {}
    out["bkpf"] = _project(orders, "bkpf")
    out["bseg"] = _project(lines, "bseg")
    out["rbkp"] = _project(orders.where("o_orderkey % 2 = 0"), "rbkp")
    out["rseg"] = _project(lines.where("l_linenumber <= 5"), "rseg")
    out["rbco"] = _project(lines.where("l_linenumber >= 4"), "rbco")
    out["prps"] = _project(raw["part"].where("p_partkey % 2 = 0"), "prps")
    out["ekbe"] = _project(lines, "ekbe")
    out["lfa1"] = _project(raw["supplier"], "lfa1")
    out["kna1"] = _project(raw["customer"], "kna1")

    addresses = raw["supplier"].selectExpr(
        "concat('S', lpad(cast(s_suppkey as string), 9, '0')) AS a", "s_suppkey AS k"
    ).unionByName(
        raw["customer"].where("c_custkey % 5 <> 0").selectExpr(
            "concat('C', lpad(cast(c_custkey as string), 9, '0')) AS a", "c_custkey AS k"
        )
    )
    out["adrc"] = _project(_explode_rows(addresses, "array(struct(0 AS v), struct(1 AS v))", "adrc"), "adrc")

    nation = raw["nation"]
    out["t001"] = _project(nation.where("n_nationkey < 5"), "t001")
    out["t009"] = _project(nation.where("n_nationkey < 4"), "t009")
    # months 1..12 are the nation keys 1..12; every year of orders gets each of them
    months = nation.where("n_nationkey between 1 and 12").select(F.col("n_nationkey").alias("m"))
    year_months = _year_months(order_years, months)
    out["t009b"] = _project(
        _explode_rows(year_months, "array(struct('K2' AS p), struct('K3' AS p))", "t009b"), "t009b"
    )

    out["tcurx"] = _project(
        spark.range(1).selectExpr(
            "inline(array(struct('JPY' AS c, 0 AS d), struct('KWD' AS c, 3 AS d), "
            "struct('BRL' AS c, 2 AS d), struct('USD' AS c, cast(null as int) AS d), struct('ZZZ' AS c, 5 AS d)))"
        ),
        "tcurx",
    )
    rate_days = orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    out["tcurr"] = _project(
        _explode_rows(
            rate_days,
            "array(struct('USD' AS f, 1 AS i), struct('EUR' AS f, 2 AS i), struct('JPY' AS f, 3 AS i), "
            "struct('BRL' AS f, 4 AS i), struct('BRL' AS f, 5 AS i))",
            "tcurr",
        ),
        "tcurr",
    )
    out["tcurf"] = _project(
        spark.range(1).selectExpr(
            "inline(array(struct(date '1990-01-01' AS d, 1 AS b), struct(date '1998-07-01' AS d, 100 AS b)))"
        ).selectExpr("*", "explode(array('USD', 'EUR', 'JPY')) AS f"),
        "tcurf",
    )
    out["tvarvc"] = _project(raw["supplier"].where("s_suppkey % 2 = 0"), "tvarvc")
    out["febraban_holiday"] = _project(
        _explode_rows(
            order_years,
            "array(struct(1 AS m, 1 AS d), struct(4 AS m, 21 AS d), struct(5 AS m, 1 AS d), "
            "struct(9 AS m, 7 AS d), struct(12 AS m, 25 AS d))",
            "h",
        ),
        "febraban_holiday",
    )
    return out


def _year_months(order_years: DataFrame, months: DataFrame) -> DataFrame:
    """Every (month, year) pair: years from orders, months kept only if nation has them.

    Candidate months 1..12 are generated next to each year; a semi join on the
    (tiny) nation keys keeps the ones the fixture defines. No cross join.
    """
    candidates = order_years.select("y", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    return candidates.join(broadcast_if_small(months, 1 << 20), "m", "left_semi")


def fixture_ctes(names: list[str] | tuple[str, ...] | None = None) -> str:
    """``WITH``-clause bodies deriving the ERP tables in SQL (for DuckDB)."""
    parts = []
    for name in names or ERP_TABLES:
        cols = ", ".join(f"{expr} AS {col}" for col, expr in COLUMNS[name])
        parts.append(f"{name} AS (SELECT {cols} FROM {SQL_SOURCES[name]})")
    return ",\n".join(parts)
