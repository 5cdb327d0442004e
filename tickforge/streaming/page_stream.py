"""Ingest of landed pages as a stream.

The reference polls the exchange with a cursor.  Here the cursor is the
stream's checkpoint: every landed file of pages is read once, and a
micro-batch goes through the batch ingest of its feed, which normalises the
pages, numbers the rows in their order of arrival and appends those whose
trade id is not stored yet.  So pages that land again add nothing, and
neither does a micro-batch that runs again after a crash.  A batch looks
through the stored trades of its own range of time only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import ensure_utc

PAGE_SCHEMA = "page_no long, currency string, page string"


def read_page_stream(spark: SparkSession, folder: str, schema: str | StructType = PAGE_SCHEMA,
                     max_files: int = 1000) -> DataFrame:
    """Landed files of pages, one JSON row ``{page_no, currency, page}`` a line, oldest first."""
    ensure_utc(spark)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def start_ingest(page_stream: DataFrame, kind: str, path: str, checkpoint: str, ntz: bool = True,
                 available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Keep the table of a feed (a trade kind, or ``funding``) up to date with its landed pages.

    Trades are inserted by trade id; funding rows are appended after each
    currency's resume point.  ``checkpoint`` must be on shared storage.
    """
    from ..plans import ingest

    def run(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        if kind == "funding":
            ingest.ingest_funding(spark, batch, path, ntz=ntz)
        else:
            ingest.ingest_trades(spark, batch, kind, path, ntz=ntz, mode="by_trade_id")

    w = page_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
