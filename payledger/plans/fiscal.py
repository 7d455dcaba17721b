"""Fiscal periods from fiscal-year variants (T009) and period tables (T009B).

A variant is one of three cases: calendar year = month (CASE1), year-dependent
period table (CASE2), or year-independent/shortened table (CASE3). The period
of a date is resolved as a lookup: distinct (client, variant, date) keys are
solved once as a small frame and joined back to the documents.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payledger.functions.dates import fiscal_case1
from payledger.operators.joins import broadcast_if_small, is_small


def variant_cases(t009: DataFrame) -> DataFrame:
    """(mandt, periv, fiscal_case): CASE3 when both flags are empty or NULL,
    CASE1 when XKALE is not NULL (even if empty), else CASE2."""
    xkale, xjabh = F.col("xkale"), F.col("xjabh")
    empty = (F.coalesce(F.length(xkale), F.lit(0)) + F.coalesce(F.length(xjabh), F.lit(0))) == 0
    case = F.when(empty, F.lit("CASE3")).when(xkale.isNotNull(), F.lit("CASE1")).otherwise(F.lit("CASE2"))
    return t009.select("mandt", "periv", case.alias("fiscal_case"))


def _year_or(bdatj: Column, d: Column) -> Column:
    return F.when(bdatj == "0000", F.year(d).cast("string")).otherwise(bdatj)


def _period_label(year_str: Column, reljr: Column, poper: Column) -> Column:
    return F.concat((year_str.cast("int") + reljr.cast("int")).cast("string"), poper)


def fiscal_period_lookup(keys: DataFrame, t009: DataFrame, t009b: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """Resolve ``keys`` (mandt, periv, date) to (mandt, periv, date, fiscal_case, fiscal_period).

    One left join of the keys to the period table on (client, variant), whose
    residual condition admits only the rows a case can use: CASE2 the row of
    the date's year and month; CASE3 the rows whose (year, or the date's year
    for '0000') + month + day is on or after the date. A grouped MIN then
    picks the period (CASE1 needs no row and is computed from the date). Keys
    with no period come out with a NULL period.

    Few variants means few join keys, so this join is only right for a period table
    small enough to broadcast; a larger one goes through ``carried_period_lookup``.
    """
    cases = broadcast_if_small(variant_cases(t009), limit)
    k = keys.join(cases, ["mandt", "periv"], "left").alias("k")
    if not is_small(t009b, limit):
        return carried_period_lookup(k.distinct(), t009b)
    b = F.broadcast(t009b).alias("b")
    d = F.col("k.date")
    case = F.col("k.fiscal_case")
    year_eff = _year_or(F.col("b.bdatj"), d)
    case2 = (case == "CASE2") & (F.col("b.bdatj") == F.year(d).cast("string")) \
        & (F.col("b.bumon") == F.date_format(d, "MM"))
    case3 = (case == "CASE3") \
        & ((F.col("b.bdatj") == "0000") | (F.col("b.bdatj") >= F.year(d).cast("string"))) \
        & (F.concat(year_eff, F.col("b.bumon"), F.col("b.butag")) >= F.date_format(d, "yyyyMMdd"))
    cond = (F.col("k.mandt") == F.col("b.mandt")) & (F.col("k.periv") == F.col("b.periv")) & (case2 | case3)
    label = (
        F.when(case == "CASE1", fiscal_case1(d))
        .when(case == "CASE2", _period_label(F.col("b.bdatj"), F.col("b.reljr"), F.col("b.poper")))
        .when(case == "CASE3", _period_label(year_eff, F.col("b.reljr"), F.col("b.poper")))
    )
    return k.join(b, cond, "left").groupBy(
        F.col("k.mandt").alias("mandt"), F.col("k.periv").alias("periv"), d.alias("date"), case.alias("fiscal_case")
    ).agg(F.min(label).alias("fiscal_period"))


VARIANT = ["mandt", "periv"]


def carried_period_lookup(keys: DataFrame, t009b: DataFrame) -> DataFrame:
    """``fiscal_period_lookup`` for a period table of any size; ``keys`` carry their
    ``fiscal_case`` and are distinct. No task holds a whole variant:

    - CASE2 is an equi-join on client, variant, year and month;
    - CASE3, "smallest label of all period ends on or after the date", is an as-of
      lookup: dates and period ends are put in one sequence per (client, variant,
      year), latest first, and a running MIN carries the label to the dates. What
      later years contribute is one row a year (ends of year-independent rows count
      for their date's year only, so they are never carried over).

    A chunk holds the distinct dates and the period ends of one year."""
    year = F.year("date").cast("string")
    case1 = keys.where("fiscal_case = 'CASE1'").withColumn("fiscal_period", fiscal_case1(F.col("date")))
    none = keys.where("fiscal_case IS NULL").withColumn("fiscal_period", F.lit(None).cast("string"))

    rows = t009b.select(
        *VARIANT, F.col("bdatj").alias("year"), F.col("bumon").alias("month"),
        F.concat("bumon", "butag").alias("month_day"), "reljr", "poper")
    label = _period_label(F.col("year"), F.col("reljr"), F.col("poper"))
    months = rows.groupBy(*VARIANT, "year", "month").agg(F.min(label).alias("fiscal_period"))
    case2 = keys.where("fiscal_case = 'CASE2'").withColumns({"year": year, "month": F.date_format("date", "MM")})
    case2 = case2.join(months, [*VARIANT, "year", "month"], "left").drop("year", "month")

    dates = keys.where("fiscal_case = 'CASE3'").withColumns({"year": year, "at": F.date_format("date", "yyyyMMdd")})
    years = dates.select(*VARIANT, "year").distinct()
    every = rows.where("year = '0000'").drop("year").join(years, VARIANT)
    own = rows.where("year <> '0000'")
    ends = own.unionByName(every, allowMissingColumns=True).select(
        *VARIANT, "year", F.concat("year", "month_day").alias("at"), label.alias("label")).where("at IS NOT NULL")
    chunk = Window.partitionBy(*VARIANT, "year")
    # at the same day the end (NULL date) comes first: a period that ends on the date counts
    running = chunk.orderBy(F.desc("at"), F.asc_nulls_first("date")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = dates.unionByName(ends, allowMissingColumns=True).withColumn("in_year", F.min("label").over(running)).where("date IS NOT NULL")
    per_year = own.where("month_day IS NOT NULL").select(*VARIANT, "year", label.alias("label")).unionByName(
        years, allowMissingColumns=True).groupBy(*VARIANT, "year").agg(F.min("label").alias("least"))
    later = Window.partitionBy(*VARIANT).orderBy(F.desc("year")).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_year.select(*VARIANT, "year", F.min("least").over(later).alias("carried"))
    case3 = found.join(carry, [*VARIANT, "year"]).withColumn("fiscal_period", F.least("in_year", "carried"))

    out = [*VARIANT, "date", "fiscal_case", "fiscal_period"]
    return case1.select(*out).unionByName(case2.select(*out)).unionByName(case3.select(*out)).unionByName(none.select(*out))
