"""Bars of all currencies from one stream, each currency closing its own minutes.

A watermark is one per query, so a bound per currency would need a query, and
a read of the source, per currency.  Here one query reads the source once;
every micro-batch joins the ticks of minutes that are still open, kept as a
small table, and

1. drops late ticks: those of a minute that their currency has closed;
2. moves each currency's bound to the minute of its newest tick;
3. writes the bars of the minutes before the bound, and
4. keeps the ticks from the bound on for the next batch - of each currency
   one minute, the newest, whatever the stream's length.

A batch writes only folders of its own number (bars ``batch=<n>``, open ticks
and bounds ``<n>``) from those of the number before.  So a batch that runs
again after a crash writes the same rows in the same places, and the
checkpoint's offsets plus these folders make the query restartable.  Rows
without a currency belong to no bound and drop out, as in the batch bars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.time import bucket
from ..operators.commits import Files
from ..operators.ohlc import FUTURES_TICK_COLUMNS, futures_ohlc_1min, index_bar_aggs, index_ticks
from ..session import ensure_utc


def _open(spark: SparkSession, state: str, number: int, ticks: StructType, bounds: StructType) -> tuple[DataFrame, DataFrame]:
    """Open ticks and bounds as they were after batch ``number`` (empty before the first)."""
    if number < 0:
        return spark.createDataFrame([], ticks), spark.createDataFrame([], bounds)
    return (spark.read.schema(ticks).parquet(f"{state}/{number}/ticks"),
            spark.read.schema(bounds).parquet(f"{state}/{number}/bounds"))


def start_closing(ticks: DataFrame, bars: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                  unit: str = "minute", available_now: bool = True,
                  processing_time: str = "1 minute") -> StreamingQuery:
    """Write ``bars`` of the closed minutes of a tick stream below ``path`` (read them with `read_bars`).

    ``bars`` makes bars of all the ticks it is given.  ``checkpoint`` must be
    on shared storage; the open ticks are kept below it.
    """
    ensure_utc(ticks.sparkSession)
    state = f"{checkpoint.rstrip('/')}-open"
    schema = ticks.schema
    bound_schema = StructType().add("currency", "string").add("bound", schema["timestamp"].dataType)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before, bounds = _open(spark, state, number - 1, schema, bound_schema)
        own = batch.withColumn("_bucket", bucket(batch, "timestamp", unit)).where("currency is not null and _bucket is not null")
        # one row per currency: Spark broadcasts it by its size
        fresh = own.join(bounds, "currency", "left").where(F.col("bound").isNull() | (F.col("_bucket") >= F.col("bound"))).drop("bound")
        both = before.withColumn("_bucket", bucket(before, "timestamp", unit)).unionByName(fresh.select(*schema.names, "_bucket")).persist()
        try:
            newest = both.groupBy("currency").agg(F.max("_bucket").alias("bound")).unionByName(bounds)
            newest = newest.groupBy("currency").agg(F.max("bound").alias("bound"))
            newest.write.mode("overwrite").parquet(f"{state}/{number}/bounds")
            newest = spark.read.schema(bound_schema).parquet(f"{state}/{number}/bounds")
            marked = both.join(newest, "currency")
            closed = marked.where(F.col("_bucket") < F.col("bound")).select(*schema.names)
            bars(closed).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")
            rest = marked.where(F.col("_bucket") >= F.col("bound")).select(*schema.names)
            rest.write.mode("overwrite").parquet(f"{state}/{number}/ticks")
        finally:
            both.unpersist()
        Files(spark, state).delete(f"{state}/{number - 2}")      # no batch that may run again reads it

    w = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_futures_bars(future_trades: DataFrame, path: str, checkpoint: str, tie_break: str = "trade_id",
                       **options) -> StreamingQuery:
    """A1 over a stream of futures ticks of all currencies."""
    ticks = future_trades.select(*FUTURES_TICK_COLUMNS, tie_break)
    return start_closing(ticks, lambda t: futures_ohlc_1min(t, closed_only=False, tie_break=tie_break), path, checkpoint, **options)


def start_index_bars(future_trades: DataFrame, option_trades: DataFrame, path: str, checkpoint: str,
                     tie_break: str = "trade_id", **options) -> StreamingQuery:
    """A2 over streams of futures and options ticks: the bound is that of both together."""
    ticks = index_ticks(future_trades, option_trades, tie_break)

    def bars(t: DataFrame) -> DataFrame:
        minutes = t.withColumn("bucket", bucket(t, "timestamp"))
        return minutes.groupBy("currency", "bucket").agg(*index_bar_aggs(tie_break))

    return start_closing(ticks, bars, path, checkpoint, **options)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """All bars that a closing stream has written."""
    return spark.read.parquet(path).drop("batch")
