"""stream_mtd: month-to-date event totals from a stream of timestamped events.

Events (wall-clock UTC timestamps) are aggregated into daily tumbling windows
per event type with a watermark. Late rows are dropped by Spark's stateful
aggregation, which checks them against the watermark of the previous
micro-batch (a one-batch lag). With a ledger folder the job keeps the rows read
of every epoch (an observed count, no second read of the source), and late rows
are those that reached no window. Updated windows are appended per micro-batch to an update
log (``batch_id=N``, idempotent overwrite); readers keep the newest version of
each (day, type) and roll days up to month-to-date with a window whose
partition is one type-month (at most 31 rows).
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def utc_event_time(ts_ntz):
    """Event-time instant of a wall-clock (TIMESTAMP_NTZ) value read as UTC.

    Built from date / time fields, so it does not depend on the session time
    zone; daily windows on it are UTC-aligned.
    """
    days = F.datediff(F.to_date(ts_ntz), F.lit("1970-01-01").cast("date")).cast("long")
    secs = days * 86400 + F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60
    micros = secs * 1_000_000 + (F.date_part(F.lit("SECOND"), ts_ntz) * 1_000_000).cast("long")
    return F.timestamp_micros(micros)


class InputLedger(StreamingQueryListener):
    """Writes the rows that one query read in each epoch, as observed by it. An epoch that runs again overwrites its count."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name
        self.last, self.ended = -1, False

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            epoch = event.progress.batchId
            self.spark.createDataFrame([(seen["n_read"],)], "n_read bigint").coalesce(1).write.mode("overwrite").parquet(os.path.join(self.folder, f"batch_id={epoch}"))
            self.last = max(self.last, epoch)

    def onQueryTerminated(self, event):
        self.ended = True


def rollup_with_ledger(spark: SparkSession, source: str, out_dir: str, checkpoint_dir: str, ledger_dir: str, wait_seconds: float = 120.0, **more) -> None:
    """Run the rollup over all available files and keep the rows read per epoch in ``ledger_dir``."""
    ledger = InputLedger(spark, ledger_dir, "rows_read")
    spark.streams.addListener(ledger)
    try:
        query = start_daily_rollup(spark, source, out_dir, checkpoint_dir, observed=ledger.name, **more)
        query.awaitTermination()
        last = query.lastProgress["batchId"] if query.lastProgress else -1
        stop = time.time() + wait_seconds
        while ledger.last < last and time.time() < stop:  # events arrive after the query's end
            time.sleep(0.05)
        if ledger.last < last:
            raise TimeoutError(f"epoch {last} of the rollup has no count in {ledger_dir}")
    finally:
        spark.streams.removeListener(ledger)


def late_rows(spark: SparkSession, ledger_dir: str, out_dir: str) -> DataFrame:
    """One row: rows read in all epochs, rows counted in windows, rows dropped by the watermark."""
    read = spark.read.parquet(ledger_dir).agg(F.sum("n_read").alias("n_read"))
    counted = latest_daily(spark, out_dir).agg(F.coalesce(F.sum("n_events"), F.lit(0)).cast("bigint").alias("n_counted"))
    return read.crossJoin(counted).select("n_read", "n_counted", (F.col("n_read") - F.col("n_counted")).alias("n_dropped"))  # one row each


def start_daily_rollup(spark: SparkSession, source: str, out_dir: str, checkpoint_dir: str,
                       watermark: str = "1 day", available_now: bool = True,
                       max_files_per_trigger: int | None = None, observed: str | None = None):
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source)
    if observed:
        events = events.observe(observed, F.count(F.lit(1)).alias("n_read"))
    daily = (events.withColumn("event_time", utc_event_time(F.col("ts")))
             .withWatermark("event_time", watermark)
             .groupBy(F.window("event_time", "1 day").alias("w"), "event_type")
             .agg(F.min(F.to_date("ts")).alias("day_start"), F.count(F.lit(1)).alias("n_events"),
                  F.sum(F.col("value").cast("decimal(12,2)")).alias("value_sum")))

    def sink(batch: DataFrame, epoch: int) -> None:
        (batch.select("day_start", "event_type", "n_events", "value_sum")
         .write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={epoch}")))

    writer = daily.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def dropped_by_watermark(spark: SparkSession, source: str, out_dir: str) -> int:
    """Late rows dropped by the watermark, once the query has taken all of ``source``.

    Every row either lands in a daily window of the output or was dropped, so
    this is the rows of the source files minus the events counted in the
    output. It needs no query progress, of which Spark keeps only the last batches.
    """
    seen = spark.read.schema(EVENTS_SCHEMA).parquet(source).count()
    counted = latest_daily(spark, out_dir).agg(F.sum("n_events")).first()[0] or 0
    return seen - int(counted)


def latest_daily(spark: SparkSession, out_dir: str) -> DataFrame:
    """Newest version of every (day, event type) in the update log."""
    log = spark.read.parquet(out_dir)
    newest = Window.partitionBy("day_start", "event_type").orderBy(F.col("batch_id").desc())
    return log.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "batch_id")


def month_to_date(spark: SparkSession, out_dir: str) -> DataFrame:
    daily = latest_daily(spark, out_dir)
    day = F.to_date("day_start")
    w = (Window.partitionBy("event_type", F.trunc(day, "month")).orderBy(day)
         .rowsBetween(Window.unboundedPreceding, 0))
    return daily.select(
        F.date_format(day, "yyyy-MM-dd").alias("event_date"), "event_type",
        F.col("n_events").cast("bigint").alias("n_events"), F.col("value_sum").cast("double").alias("value_sum"),
        F.sum("n_events").over(w).cast("bigint").alias("mtd_events"),
        F.sum("value_sum").over(w).cast("double").alias("mtd_value"))
