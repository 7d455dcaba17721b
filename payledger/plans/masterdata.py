"""Master data: companies, customers, vendors and vendor configuration.

Each dataset is a rename projection of an ERP table. The rename lists are data
(source field -> business name); a source field missing from the input becomes
a typed NULL column, so the output schema does not depend on the replication.
Only the fields consumed downstream or present in the inputs are listed here;
callers can pass a longer list through ``extra_columns``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType

from payledger.config import LedgerConfig
from payledger.operators.joins import lookup_left_join

Rename = Sequence[tuple[str, str]]


def pick(df: DataFrame, field: str, dtype: DataType = StringType(), prefix: str | None = None) -> Column:
    """Column ``field`` of ``df`` (case-insensitive), or a typed NULL."""
    names = {c.lower(): c for c in df.columns}
    src = names.get(field.lower())
    if src is None:
        return F.lit(None).cast(dtype)
    return F.col(f"{prefix}.{src}") if prefix else F.col(src)


def pick_sql(df: DataFrame, field: str, dtype: DataType = StringType(), prefix: str | None = None) -> str:
    """SQL text of ``pick``: wide projections are sent to Spark as one
    ``selectExpr`` list instead of one JVM call per column operation."""
    names = {c.lower(): c for c in df.columns}
    src = names.get(field.lower())
    if src is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    return f"`{prefix}`.`{src}`" if prefix else f"`{src}`"


def rename_sql(df: DataFrame, mapping: Rename, prefix: str | None = None,
               types: Mapping[str, DataType] | None = None) -> list[str]:
    types = types or {}
    return [f"{pick_sql(df, s, types.get(s.lower(), StringType()), prefix)} AS `{t}`" for s, t in mapping]


def unmapped_sql(df: DataFrame, mapped: Sequence[str], taken: Sequence[str], prefix: str | None = None) -> list[str]:
    """Pass-through rule for source fields without a business name: each one
    keeps its field code, upper-cased, unless that name is already produced."""
    skip = {m.lower() for m in mapped}
    used = {t.lower() for t in taken}
    out = []
    for c in df.columns:
        if c.lower() in skip or c.upper().lower() in used:
            continue
        used.add(c.lower())
        out.append(f"`{prefix}`.`{c}` AS `{c.upper()}`" if prefix else f"`{c}` AS `{c.upper()}`")
    return out


def rename(df: DataFrame, mapping: Rename, prefix: str | None = None, types: Mapping[str, DataType] | None = None) -> list[Column]:
    return [F.expr(e) for e in rename_sql(df, mapping, prefix, types)]


# Business names of the company table.
COMPANY_NAMES: Rename = [
    ("mandt", "Client_MANDT"),
    ("waers", "CurrencyCode_WAERS"),
    ("bukrs", "CompanyCode_BUKRS"),
    ("butxt", "CompanyText_BUTXT"),
    ("ort01", "CityName_ORT01"),
    ("land1", "Country_LAND1"),
    ("spras", "Language_SPRAS"),
    ("ktopl", "ChartOfAccounts_KTOPL"),
    ("periv", "FiscalyearVariant_PERIV"),
    ("rcomp", "Company_RCOMP"),
    ("kkber", "CreditControlArea_KKBER"),
    ("ktop2", "CountryChartofAccounts_KTOP2"),
    ("fikrs", "FundsManagement_FIKRS"),
]

# Business names of the customer and address fields kept.
CUSTOMER_NAMES: Rename = [
    ("mandt", "Client_MANDT"),
    ("kunnr", "CustomerNumber_KUNNR"),
    ("land1", "CountryKey_LAND1"),
    ("name1", "Name1_NAME1"),
    ("name2", "Name2_NAME2"),
    ("ort01", "City_ORT01"),
    ("adrnr", "Address_ADRNR"),
    ("lifnr", "AccountNumberOfVendorOrCreditor_LIFNR"),
]
CUSTOMER_ADDRESS_NAMES: Rename = [
    ("date_from", "ValidFromDate_DATE_FROM"),
    ("date_to", "ValidToDate_DATE_TO"),
    ("name1", "Addr_NAME1"),
    ("post_code1", "CityPostalCode_POST_CODE1"),
    ("region", "Region__REGION"),
]

# Business names of the vendor and address fields kept.
VENDOR_NAMES: Rename = [
    ("mandt", "Client_MANDT"),
    ("lifnr", "AccountNumberOfVendorOrCreditor_LIFNR"),
    ("land1", "CountryKey_LAND1"),
    ("name1", "NAME1"),
    ("name2", "NAME2"),
    ("ort01", "City_ORT01"),
    ("pstlz", "PostalCode_PSTLZ"),
    ("regio", "Region__REGIO"),
    ("adrnr", "Address_ADRNR"),
    ("ktokk", "VendorAccountGroup_KTOKK"),
    ("kunnr", "CustomerNumber_KUNNR"),
]
VENDOR_ADDRESS_NAMES: Rename = [
    ("date_from", "ValidFromDate_DATE_FROM"),
    ("date_to", "ValidToDate_DATE_TO"),
    ("name1", "Addr_NAME1"),
    ("post_code1", "CityPostalCode_POST_CODE1"),
    ("region", "Region_Addr_REGION"),
]

# Business names of the variant-variable table.
VENDOR_CONFIG_NAMES: Rename = [
    ("mandt", "Client_MANDT"),
    ("name", "NameOfVariantVariable_NAME"),
    ("low", "LowField_LOW"),
    ("high", "HighField_HIGH"),
]

_DATE_FIELDS = {"date_from": DateType(), "date_to": DateType()}


def companies_md(tables: Mapping[str, DataFrame], extra_columns: Rename = (), passthrough: bool = False) -> DataFrame:
    """Company codes. ``passthrough`` also carries every unnamed T001 field."""
    t001 = tables["t001"]
    names = list(COMPANY_NAMES) + list(extra_columns)
    cols = rename_sql(t001, names)
    if passthrough:
        cols += unmapped_sql(t001, [s for s, _ in names], [t for _, t in names])
    return t001.selectExpr(*cols)


def vendor_config(tables: Mapping[str, DataFrame]) -> DataFrame:
    tv = tables["tvarvc"]
    return tv.select(*rename(tv, VENDOR_CONFIG_NAMES))


def customers_md(tables: Mapping[str, DataFrame], cfg: LedgerConfig, extra_columns: Rename = (),
                 ordered: bool = False, passthrough: bool = False) -> DataFrame:
    """Customers with their current address (validity ending on the open date).

    The validity test filters the address side *before* the outer join, so a
    customer without a current address keeps its row with NULL address fields.
    ``ordered`` sorts by client (a range shuffle): meant for a final sink,
    since later operators do not keep an order anyway.
    """
    kna1 = tables["kna1"]
    adrc = tables["adrc"].where(F.col("date_to") == F.lit(cfg.current_address_until))
    addr = adrc.select(*[F.col(f"`{c}`").alias(f"__a_{c.lower()}") for c in adrc.columns])
    salt = [c for c in kna1.columns if c.lower() in ("mandt", "kunnr")] or kna1.columns[:1]
    # customers without an address number never match: salted, not piled in one task
    joined = lookup_left_join(
        kna1, addr,
        [(pick(kna1, "adrnr"), "__a_addrnumber"), (pick(kna1, "mandt"), "__a_client")],
        salt, cfg.broadcast_bytes,
    )
    cols = rename(kna1, list(CUSTOMER_NAMES) + list(extra_columns))
    cols.insert(6, F.coalesce(pick(kna1, "pstlz"), F.col("__a_post_code1")).alias("PostalCode_PSTLZ"))
    cols.insert(7, F.coalesce(pick(kna1, "regio"), F.col("__a_region")).alias("CustomerRegion_REGIO"))
    cols += rename(addr, [(f"__a_{s}", t) for s, t in CUSTOMER_ADDRESS_NAMES],
                   types={f"__a_{k}": v for k, v in _DATE_FIELDS.items()})
    if passthrough:
        names = list(CUSTOMER_NAMES) + list(extra_columns)
        taken = [t for _, t in names] + ["PostalCode_PSTLZ", "CustomerRegion_REGIO"] + \
            [t for _, t in CUSTOMER_ADDRESS_NAMES]
        cols += [F.expr(e) for e in unmapped_sql(kna1, [s for s, _ in names] + ["pstlz", "regio"], taken)]
    out = joined.select(*cols)
    return out.orderBy("Client_MANDT") if ordered else out


def vendors_md(tables: Mapping[str, DataFrame], extra_columns: Rename = (), passthrough: bool = False) -> DataFrame:
    """Vendors joined with *all* their address rows (one row per validity period).

    An inner join: a vendor without an address row is not in the result.
    """
    lfa1 = tables["lfa1"].alias("v")
    adrc = tables["adrc"].alias("a")
    joined = lfa1.join(
        adrc, (F.col("v.adrnr") == F.col("a.addrnumber")) & (F.col("v.mandt") == F.col("a.client")), "inner"
    )
    cols = rename(tables["lfa1"], list(VENDOR_NAMES) + list(extra_columns), "v")
    cols += rename(tables["adrc"], VENDOR_ADDRESS_NAMES, "a", _DATE_FIELDS)
    if passthrough:
        names = list(VENDOR_NAMES) + list(extra_columns)
        taken = [t for _, t in names] + [t for _, t in VENDOR_ADDRESS_NAMES]
        cols += [F.expr(e) for e in unmapped_sql(tables["lfa1"], [s for s, _ in names], taken, "v")]
    return joined.select(*cols)
