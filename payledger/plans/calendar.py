"""Calendar dimension, bank holidays and the business-day calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payledger.config import LedgerConfig
from payledger.operators.joins import bounded_broadcast, broadcast_if_small, lookup_left_join


def day_count(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "Date") -> DataFrame:
    """One row per day of ``[start, end]``, generated in parallel by ``range``."""
    n = max(day_count(start, end), 0)
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def _iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return ((F.dayofweek(d) + 5) % 7) + 1


def calendar_date_dim(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The 47-attribute calendar dimension (the reference only declares it).

    Rule choices: weeks are ISO-8601 (Monday first, ``weekofyear``); DayOfWeek
    counts 1 = Sunday like ``EXTRACT(DAYOFWEEK)``; semesters are Jan-Jun / Jul-Dec.
    """
    d = F.col("Date")
    iso_dow = _iso_weekday(d)
    week_start = F.date_sub(d, iso_dow - 1)
    week_end = F.date_add(week_start, 6)
    iso_year = F.year(F.date_add(week_start, 3))
    semester = F.when(F.month(d) <= 6, 1).otherwise(2)
    quarter_start = F.trunc(d, "quarter")
    semester_start = F.make_date(F.year(d), F.when(semester == 1, 1).otherwise(7), F.lit(1))
    year = F.year(d)
    dec28 = F.make_date(iso_year, F.lit(12), F.lit(28))
    cols = {
        "DateInt": F.date_format(d, "yyyyMMdd").cast("long"),
        "DateStr": F.date_format(d, "yyyy-MM-dd"),
        "DateStr2": F.date_format(d, "yyyyMMdd"),
        "CalYear": year.cast("long"),
        "CalSemester": semester.cast("long"),
        "CalQuarter": F.quarter(d).cast("long"),
        "CalMonth": F.month(d).cast("long"),
        "CalWeek": F.weekofyear(d).cast("long"),
        "CalYearStr": year.cast("string"),
        "CalSemesterStr": F.concat(F.lit("S"), semester.cast("string")),
        "CalSemesterStr2": F.concat(year.cast("string"), F.lit("-S"), semester.cast("string")),
        "CalQuarterStr": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "CalQuarterStr2": F.concat(year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
        "CalMonthLongStr": F.date_format(d, "MMMM"),
        "CalMonthShortStr": F.date_format(d, "MMM"),
        "CalWeekStr": F.concat(F.lit("W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
        "DayNameLong": F.date_format(d, "EEEE"),
        "DayNameShort": F.date_format(d, "EEE"),
        "DayOfWeek": F.dayofweek(d).cast("long"),
        "DayOfMonth": F.dayofmonth(d).cast("long"),
        "DayOfQuarter": (F.datediff(d, quarter_start) + 1).cast("long"),
        "DayOfSemester": (F.datediff(d, semester_start) + 1).cast("long"),
        "DayOfYear": F.dayofyear(d).cast("long"),
        "YearSemester": F.concat(year.cast("string"), F.lit("/"), semester.cast("string")),
        "YearQuarter": F.concat(year.cast("string"), F.lit("/"), F.quarter(d).cast("string")),
        "YearMonth": F.date_format(d, "yyyy/MM"),
        "YearMonth2": F.date_format(d, "yyyyMM"),
        "YearWeek": F.concat(iso_year.cast("string"), F.lit("/"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
        "IsFirstDayOfYear": (F.dayofyear(d) == 1),
        "IsLastDayOfYear": (F.month(d) == 12) & (F.dayofmonth(d) == 31),
        "IsFirstDayOfSemester": d == semester_start,
        "IsLastDayOfSemester": d == F.date_sub(F.add_months(semester_start, 6), 1),
        "IsFirstDayOfQuarter": d == quarter_start,
        "IsLastDayOfQuarter": d == F.date_sub(F.add_months(quarter_start, 3), 1),
        "IsFirstDayOfMonth": F.dayofmonth(d) == 1,
        "IsLastDayOfMonth": d == F.last_day(d),
        "IsFirstDayOfWeek": iso_dow == 1,
        "IsLastDayOfWeek": iso_dow == 7,
        "IsLeapYear": ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0),
        "IsWeekDay": iso_dow <= 5,
        "IsWeekEnd": iso_dow >= 6,
        "WeekStartDate": week_start,
        "WeekEndDate": week_end,
        "MonthStartDate": F.trunc(d, "month"),
        "MonthEndDate": F.last_day(d),
        "Has53Weeks": F.weekofyear(dec28) == 53,
    }
    spine = date_spine(spark, start, end)
    return spine.select(d, *[c.alias(n) for n, c in cols.items()])


CALENDAR_ATTRIBUTES = ("CalYear", "CalMonth", "CalWeek", "CalQuarter")


def calendar_attribute(name: str, d: Column) -> Column:
    """The calendar rule for one attribute (same rules as ``calendar_date_dim``)."""
    rules = {
        "CalYear": lambda x: F.year(x).cast("long"),
        "CalMonth": lambda x: F.month(x).cast("long"),
        "CalWeek": lambda x: F.weekofyear(x).cast("long"),
        "CalQuarter": lambda x: F.quarter(x).cast("long"),
    }
    return rules[name](d)


def add_calendar_attributes(
    df: DataFrame, calendar: DataFrame | None, date_col: str, names: Mapping[str, str], limit: int,
    start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Bring calendar attributes ``{attribute: output name}`` for ``date_col``.

    With ``calendar=None`` the generated calendar is applied as expressions:
    the same values a left join to ``calendar_date_dim(start, end)`` gives
    (NULL outside the range), without a join. With a stored calendar table (one
    row per day) its own values are looked up by a left join, a broadcast after a
    size check.
    """
    if calendar is None:
        d = F.col(date_col)
        inside = d.between(F.lit(start), F.lit(end))
        return df.withColumns({o: F.when(inside, calendar_attribute(a, d)) for a, o in names.items()})
    alias = f"cal_{date_col}"
    cal = calendar.select(F.col("Date").alias(f"{alias}_date"), *[F.col(a).alias(o) for a, o in names.items()])
    return lookup_left_join(df, cal, [(F.col(date_col), f"{alias}_date")], df.columns[:5], limit).drop(f"{alias}_date")


# ---------------------------------------------------------------- holidays


def holidays_from_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    hol = tables["febraban_holiday"]
    name = next(c for c in hol.columns if c.lower() == "holidaydate")
    return hol.select(F.col(name).cast("date").alias("HolidayDate"))


def is_business_day(d: Column, holiday_flag: Column) -> Column:
    """Weekends (Sunday = 1, Saturday = 7) and holidays are not business days."""
    return ~F.dayofweek(d).isin(1, 7) & ~holiday_flag


def flag_business_days(days: DataFrame, holidays: DataFrame, date_col: str, limit: int) -> DataFrame:
    """Add ``is_business_day`` to a frame of dates (existence test on holidays)."""
    hol = broadcast_if_small(holidays.select(F.col("HolidayDate").alias("__hday")).distinct(), limit)
    marked = days.join(hol, days[date_col] == hol["__hday"], "left")
    return marked.select(
        *[days[c] for c in days.columns],
        is_business_day(days[date_col], F.col("__hday").isNotNull()).alias("is_business_day"),
    )


def business_days(
    spark: SparkSession, holidays: DataFrame, start: dt.date, end: dt.date, cfg: LedgerConfig
) -> DataFrame:
    """(date, is_business_day, previous_business_day, next_business_day) for
    every date of ``[start, end]`` that has a business day within the next
    ``business_day_horizon`` days (dates without one are left out).

    Instead of testing 30 candidates per date, every business day ``b`` names
    the dates ``b-1 .. b-30`` it can serve; a grouped MIN (partially aggregated
    before the shuffle) then picks the nearest for each date.
    """
    horizon = cfg.business_day_horizon
    flagged = flag_business_days(
        date_spine(spark, start, end + dt.timedelta(days=horizon), "date"), holidays, "date", cfg.broadcast_bytes
    )
    serving = flagged.where("is_business_day").select(
        F.col("date").alias("next_business_day"),
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"),
    ).select(F.date_sub("next_business_day", F.col("k")).alias("date"), "next_business_day")
    serving = serving.where(F.col("date").between(F.lit(start), F.lit(end)))
    nearest = serving.groupBy("date").agg(F.min("next_business_day").alias("next_business_day"))
    dated = flagged.where(F.col("date") <= F.lit(end)).join(nearest, "date", "inner")
    return _business_days_with_prev(dated, cfg).select(
        "date", "is_business_day", "previous_business_day", "next_business_day"
    )


def _with_prior_max(df: DataFrame, date_col: str, value: Column, out: str) -> DataFrame:
    year = F.year(F.col(date_col))
    within = F.max(value).over(
        Window.partitionBy(year).orderBy(F.col(date_col)).rowsBetween(Window.unboundedPreceding, -1)
    )
    keyed = df.withColumn("__y", year).withColumn("__v", value)
    per_year = keyed.groupBy("__y").agg(F.max("__v").alias("__ymax"))
    carry = per_year.select(
        "__y",
        F.max("__ymax").over(Window.orderBy("__y").rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
    )
    # one row per calendar year present: at most 9,999 rows whatever the data
    return (
        keyed.join(bounded_broadcast(carry, 9999, 64 << 20), "__y", "left")
        .withColumn(out, F.coalesce(within, F.col("__carry")))
        .drop("__y", "__v", "__carry")
    )


def _business_days_with_prev(dated: DataFrame, cfg: LedgerConfig) -> DataFrame:
    if cfg.previous_day_mode == "business":
        value = F.when(F.col("is_business_day"), F.col("date"))
    else:
        value = F.col("date")
    return _with_prior_max(dated, "date", value, "previous_business_day")


def business_day_table(tables: Mapping[str, DataFrame], spark: SparkSession, cfg: LedgerConfig) -> DataFrame:
    return business_days(spark, holidays_from_table(tables), cfg.calendar_start, cfg.calendar_end, cfg)


def business_day_rows_bound(cfg: LedgerConfig) -> int:
    return day_count(cfg.calendar_start, cfg.calendar_end)


def business_day_lookup(bdays: DataFrame) -> DataFrame:
    """One row per calendar date: the date itself when it is a business day
    (else the next one), and the stored previous business day."""
    return bdays.select(
        F.col("date").alias("__bd_date"),
        F.when(F.col("is_business_day"), F.col("date")).otherwise(F.col("next_business_day")).alias("__bd_next"),
        F.col("previous_business_day").alias("__bd_prev"),
    )


def _lookup(df: DataFrame, bdays: DataFrame, date_col: Column, value: str, out: str, cfg: LedgerConfig) -> DataFrame:
    # the same lookup frame for every use, so one broadcast serves all joins
    lk = bounded_broadcast(business_day_lookup(bdays), 64 * business_day_rows_bound(cfg), cfg.broadcast_bytes)
    return df.join(lk, date_col == lk["__bd_date"], "left").select(
        *[df[c] for c in df.columns], lk[value].alias(out)
    )


def add_next_business_day(df: DataFrame, bdays: DataFrame, date_col: Column, out: str, cfg: LedgerConfig) -> DataFrame:
    """``out`` = the date itself when it is a business day, else the next one;
    NULL for dates outside the business-day calendar."""
    return _lookup(df, bdays, date_col, "__bd_next", out, cfg)


def add_previous_business_day(df: DataFrame, bdays: DataFrame, date_col: Column, out: str, cfg: LedgerConfig) -> DataFrame:
    return _lookup(df, bdays, date_col, "__bd_prev", out, cfg)
