"""Incremental holiday loading with Structured Streaming.

New ``;``-separated holiday files dropped into an inbox folder are appended to
the holiday table. Each date is kept once across all loads (streaming
de-duplication; the state is one entry per holiday date, a few per year).
Run with ``availableNow`` to process whatever has arrived and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payledger.sources import versioned
from payledger.sources.holidays import DATE_FORMATS


def start_holiday_feed(spark: SparkSession, inbox: str, table_path: str, checkpoint: str,
                       available_now: bool = True) -> StreamingQuery:
    raw = (
        spark.readStream.schema("HolidayDate string")
        .option("sep", ";")
        .option("header", True)
        .csv(inbox)
    )
    text = F.trim(F.col("HolidayDate"))
    parsed = raw.select(F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS]).alias("HolidayDate"))
    deduped = parsed.where(F.col("HolidayDate").isNotNull()).dropDuplicates(["HolidayDate"])
    writer = (
        deduped.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def feed_holiday_table(spark: SparkSession, inbox: str, root: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """New holiday files into the versioned holiday table that ``deploy`` reads
    (``<out>/FebrabanHoliday``), everything that has arrived, then stop.

    Each micro-batch is one upsert: a batch that is run again after a failure finds
    its dates in place. Rows without a readable date are kept in ``quarantine``, with
    the batch they came in, and do not stop the others."""
    raw = spark.readStream.schema("HolidayDate string").option("sep", ";").option("header", True).csv(inbox)
    text = F.trim(F.col("HolidayDate"))
    parsed = raw.select(F.col("HolidayDate").alias("given"), F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS]).alias("HolidayDate"))

    def load(batch: DataFrame, number: int) -> None:
        bad = batch.where("HolidayDate IS NULL").select("given")
        bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={number}")
        good = batch.where("HolidayDate IS NOT NULL").select("HolidayDate").distinct()
        if not good.isEmpty():
            versioned.upsert_table(batch.sparkSession, root, good, ["HolidayDate"])

    return parsed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
