"""Streaming one-minute bars (the reference's incremental bar jobs).

Mapping of the reference's hand-made incremental job onto Structured
Streaming:
  * resume point per table/currency   -> the query checkpoint
  * newest (open) minute withheld     -> watermark of 0 s + append mode:
    a minute is emitted once a tick at/after its end has been seen
  * late ticks for emitted minutes    -> dropped by the watermark
  * per-currency bound                -> one query per currency
    (``currency=...``); with ``currency=None`` one query serves all
    currencies and the bound is the newest tick of any currency.

The event-time column must be ``TIMESTAMP`` for a watermark; zoneless
input is cast under the (UTC) session zone and buckets are cast back.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from ..operators.ohlc import (FUTURES_OHLC_COLUMNS, FUTURES_TICK_COLUMNS, INDEX_OHLC_COLUMNS,
                              futures_bar_aggs, index_bar_aggs, index_ticks)
from ..session import ensure_utc


_STARTING = threading.Lock()


def _event_time(df: DataFrame) -> tuple[DataFrame, object]:
    dtype = df.schema["timestamp"].dataType
    if isinstance(dtype, TimestampNTZType):
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return df.withWatermark("timestamp", "0 seconds"), dtype


def futures_bars_stream(future_trades: DataFrame, currency: str | None = None,
                        tie_break: str = "trade_id") -> DataFrame:
    """A1 over a streaming tick source; emits each minute once it is closed."""
    t = future_trades.select(*FUTURES_TICK_COLUMNS, tie_break)
    if currency is not None:
        t = t.where(F.col("currency") == currency)
    t, dtype = _event_time(t)
    bars = t.groupBy("instrument_name", "currency",
                     F.window("timestamp", "1 minute").alias("w")).agg(*futures_bar_aggs(tie_break))
    return bars.withColumn("bucket", F.col("w.start").cast(dtype)).select(*FUTURES_OHLC_COLUMNS)


def index_bars_stream(future_trades: DataFrame, option_trades: DataFrame,
                      currency: str | None = None, tie_break: str = "trade_id") -> DataFrame:
    """A2 over streaming futures + options ticks (a union of two streams)."""
    t = index_ticks(future_trades, option_trades, tie_break)
    if currency is not None:
        t = t.where(F.col("currency") == currency)
    t, dtype = _event_time(t)
    bars = t.groupBy("currency", F.window("timestamp", "1 minute").alias("w")) \
        .agg(*index_bar_aggs(tie_break))
    return bars.withColumn("bucket", F.col("w.start").cast(dtype)).select(*INDEX_OHLC_COLUMNS)


def start_to_parquet(bars: DataFrame, path: str, checkpoint: str,
                     available_now: bool = True, processing_time: str | None = None,
                     query_name: str | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Append closed bars to a Parquet table; restartable from ``checkpoint``.

    ``checkpoint`` must be on shared storage (e.g. below the cluster's
    ``spark.checkpoint.dir``) so a restarted driver resumes exactly.
    ``state_partitions`` fixes the number of state-store partitions of a
    new query (it cannot change later; a restart keeps the stored value);
    None uses the session's ``spark.sql.shuffle.partitions``.
    """
    w = (bars.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "1 minute")
    if state_partitions is None:
        return w.start()
    conf = bars.sparkSession.conf
    with _STARTING:          # the conf is the session's: one query starts at a time
        previous = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return w.start()     # the query copies the session conf when it starts
        finally:
            conf.set("spark.sql.shuffle.partitions", previous)


def start_term_structure(ticks: DataFrame, instruments: DataFrame, tick_path: str, path: str,
                         checkpoint: str, available_now: bool = True,
                         processing_time: str = "1 hour") -> StreamingQuery:
    """A3 as a stream: each micro-batch of futures ticks is stored (by trade
    id, so a repeated batch adds nothing) and the hours it touches are
    inserted if absent.  Restartable from ``checkpoint``.

    The tick table is partitioned by currency and day, and a batch only looks
    through the stored ticks and hours of its own range of time, so its cost
    does not grow with the history.
    """
    from ..operators.tables import DATE, TICK_PARTITIONS, read_table, write_if_absent
    from ..plans.incremental import update_futures_term_structure
    schema = ticks.schema
    dated = StructType([*schema.fields, StructField(DATE, DateType())])

    def store(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            write_if_absent(spark, batch, tick_path, ["trade_id"], schema, partition_by=TICK_PARTITIONS, within="timestamp")
            update_futures_term_structure(spark, read_table(spark, tick_path, dated), instruments, path, batch=batch)
        finally:
            batch.unpersist()

    w = ticks.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_stream_like(spark: SparkSession, batch: DataFrame, folder: str, pattern: str,
                     max_files: int = 1000) -> DataFrame:
    """A file stream over ``folder/pattern`` with the schema of ``batch``.

    A micro-batch takes at most ``max_files`` files, so a backlog is worked
    off in bounded steps.
    """
    ensure_utc(spark)
    return (spark.readStream.schema(batch.schema).option("basePath", folder)
            .option("maxFilesPerTrigger", max_files).parquet(f"{folder}/{pattern}"))
