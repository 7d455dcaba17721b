"""Bank-holiday CSV: ``;``-separated with one header row (date column first)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted date layouts of the holiday file.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """``given`` (the text) and ``HolidayDate`` (NULL when it is unreadable) of every row."""
    raw = spark.read.csv(path, sep=";", header=True, inferSchema=False)
    first = raw.columns[0]
    col = next((c for c in raw.columns if c.lower() == "holidaydate"), first)
    text = F.trim(F.col(f"`{col}`"))
    return raw.select(text.alias("given"), F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS]).alias("HolidayDate"))


def load_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of the holiday files: ``read``, of which ``unreadable``, ``kept`` (distinct
    dates) and ``duplicate`` (further rows of a kept date); the last three add up to the first."""
    r = _parsed(spark, path).agg(
        F.count(F.lit(1)).alias("read"), F.count("HolidayDate").alias("dated"), F.count_distinct("HolidayDate").alias("kept")).first()
    return {"read": r["read"], "unreadable": r["read"] - r["dated"], "kept": r["kept"], "duplicate": r["dated"] - r["kept"]}


def load_holiday_csv(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Read holiday files into ``HolidayDate`` (one row per distinct date).

    Loads append files over time, so the same date can appear in several
    files; duplicates are removed on read. A row whose date cannot be read is an
    error: a lost holiday would become a business day. Returns the frame and its
    row count (the post-load check; ``load_counts`` has the rows read as well).
    """
    counts, read = load_counts(spark, path), _parsed(spark, path)
    if counts["unreadable"]:
        shown = [r["given"] for r in read.where("HolidayDate IS NULL").limit(5).collect()]
        raise ValueError(f"{counts['unreadable']} holiday rows without a readable date, such as {shown}")
    return read.select("HolidayDate").dropDuplicates(["HolidayDate"]), counts["kept"]


def write_holiday_csv(holidays: DataFrame, path: str, mode: str = "append") -> None:
    """Write holidays in the file layout the loader reads (appending by default)."""
    (
        holidays.select(F.date_format("HolidayDate", "yyyy-MM-dd").alias("HolidayDate"))
        .write.mode(mode)
        .option("sep", ";")
        .option("header", True)
        .csv(path)
    )
