"""Incremental update jobs: the reference's "aggregation phase" as Spark jobs.

Each job reads the stored aggregate to find where to resume, computes
only the new closed buckets from the tick tables, and writes them:

* bar tables (``ohlc_1min_futures``, ``ohlc_1min_index``): append, resume
  at ``max(bucket) + 1 minute`` per currency (else from the first tick);
* term structures: insert-if-absent on the table key.  What is recomputed:

  - ``exact=True`` all hours (the reference's behaviour);
  - ``exact=False`` each currency's hours from its newest stored one on;
    the same result unless late trades arrive;
  - ``batch=`` (the ticks just ingested): the hours that the batch touches
    and each currency's hours from its newest stored one on.  An hour that
    no new tick fell into gives the rows it gave before, so this equals
    ``exact=True`` while it scans only what changed.

All currencies are handled in one job, each with its own bound; one without
stored rows keeps all its ticks.  The bounds are collected (their number is
checked) and become a literal predicate that Parquet can push down and that
prunes a tick table partitioned by currency and day.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.time import as_text, truncate, ts_literal
from ..operators import ohlc, term_structure
from ..operators.tables import DATE, append, bounds_predicate, read_table, write_if_absent
from ..session import ensure_checkpoint_dir

MAX_RANGES = 500         # touched spans of hours per job; beyond it, one span per currency


def resume_filter(stored: DataFrame, step: timedelta, ts: str = "timestamp", by: str = "currency",
                  bucket: str = "bucket", dates: bool = False) -> Column | None:
    """Predicate keeping ticks at/after each currency's resume point.

    Currencies without stored rows keep all their ticks.  Returns None
    when nothing is stored yet.
    """
    dtype = stored.schema[bucket].dataType
    seconds = F.expr(f"INTERVAL {int(step.total_seconds())} SECOND")
    bounds = stored.groupBy(by).agg((F.max(bucket) + seconds).alias("_bound"))
    return bounds_predicate(bounds, by, "_bound", ts, dtype, dates=dates)


def _after(ticks: DataFrame, pred: Column | None) -> DataFrame:
    return ticks if pred is None else ticks.where(pred)


def update_futures_ohlc(spark: SparkSession, future_trades: DataFrame, path: str,
                        newest: DataFrame | None = None) -> None:
    """Append the new closed one-minute futures bars.

    ``newest`` (`tables.newest_ticks` of the tick table) closes them without
    a second read of the ticks.

    The resume bounds are collected literals, so the write plan does not
    read the table it appends to (no lineage cut needed).
    """
    schema = _with_ts(schemas.OHLC_1MIN_FUTURES, future_trades.schema["timestamp"].dataType)
    pred = resume_filter(read_table(spark, path, schema), timedelta(minutes=1), dates=DATE in future_trades.columns)
    append(ohlc.futures_ohlc_1min(_after(future_trades, pred), newest=newest), path, schema)


def update_index_ohlc(spark: SparkSession, future_trades: DataFrame, option_trades: DataFrame,
                      path: str, newest: DataFrame | None = None) -> None:
    """Append the new closed one-minute index bars (futures + options ticks).

    ``newest``: the newest ticks of both tables.
    """
    schema = _with_ts(schemas.OHLC_1MIN_INDEX, future_trades.schema["timestamp"].dataType)
    dates = DATE in future_trades.columns and DATE in option_trades.columns
    pred = resume_filter(read_table(spark, path, schema), timedelta(minutes=1), dates=dates)
    bars = ohlc.index_ohlc_1min(_after(future_trades, pred), _after(option_trades, pred), newest=newest)
    append(bars, path, schema)


def touched_hours(batch: DataFrame, dtype, ts: str = "timestamp", by: str = "currency",
                  dates: bool = False) -> Column:
    """Predicate of the hours that the batch's ticks fall into, as literal spans.

    Hours that follow each other are one span.  Beyond ``MAX_RANGES`` spans
    each currency gets a single one, from its first to its last hour.
    """
    from pyspark.sql import Window
    hours = batch.select(by, truncate(F.col(ts), "hour", dtype).alias("h")).distinct()
    w = Window.partitionBy(by).orderBy("h")
    starts = F.when(F.lag("h").over(w) + F.expr("INTERVAL 1 HOUR") == F.col("h"), 0).otherwise(1)
    spans = hours.withColumn("_new", starts).withColumn("_span", F.sum("_new").over(w))
    end = F.max("h") + F.expr("INTERVAL 1 HOUR")
    text = [as_text(F.min("h")).alias("low"), as_text(end).alias("high")]
    rows = spans.groupBy(by, "_span").agg(*text).limit(MAX_RANGES + 1).collect()
    if len(rows) > MAX_RANGES:
        rows = hours.groupBy(by).agg(*text).collect()      # one row per currency
    pred = F.lit(False)
    for r in rows:
        one = (F.col(by).eqNullSafe(F.lit(r[by])) & (F.col(ts) >= ts_literal(r["low"], dtype))
               & (F.col(ts) < ts_literal(r["high"], dtype)))
        if dates:
            one = one & F.col(DATE).between(F.lit(r["low"][:10]).cast("date"), F.lit(r["high"][:10]).cast("date"))
        pred = pred | one
    return pred


def _changed(ticks: DataFrame, stored: DataFrame, exact: bool, batch: DataFrame | None) -> Column | None:
    """The ticks whose hours have to be computed (None: all)."""
    if batch is None and exact:
        return None
    dtype, dates = ticks.schema["timestamp"].dataType, DATE in ticks.columns
    since = resume_filter(stored, timedelta(0), bucket="ts_hour", dates=dates)
    if since is None or batch is None:
        return since
    return since | touched_hours(batch, dtype, dates=dates)


def update_futures_term_structure(spark: SparkSession, future_trades: DataFrame,
                                  instruments: DataFrame, path: str, exact: bool = True,
                                  batch: DataFrame | None = None) -> int:
    ensure_checkpoint_dir(spark)
    schema = _with_ts(schemas.FUTURES_TERM_STRUCTURE, future_trades.schema["timestamp"].dataType, "ts_hour")
    since = _changed(future_trades, read_table(spark, path, schema), exact, batch)
    new = term_structure.futures_term_structure(future_trades, instruments, since=since)
    # (hour, currency, bucket, metric) is unique: the rows come from a groupBy + unpivot.
    return write_if_absent(spark, new, path, schemas.KEYS["futures_term_structure"], schema,
                           assume_unique=True, within="ts_hour")


def update_options_term_structure(spark: SparkSession, option_trades: DataFrame,
                                  instruments: DataFrame, path: str, exact: bool = True,
                                  batch: DataFrame | None = None) -> int:
    ensure_checkpoint_dir(spark)
    schema = _with_ts(schemas.OPTIONS_TERM_STRUCTURE, option_trades.schema["timestamp"].dataType, "ts_hour")
    since = _changed(option_trades, read_table(spark, path, schema), exact, batch)
    new = term_structure.options_term_structure(option_trades, instruments, since=since)
    return write_if_absent(spark, new, path, schemas.KEYS["options_term_structure"], schema,
                           assume_unique=True, within="ts_hour")


def make_aggregates(spark: SparkSession, future_trades: DataFrame, option_trades: DataFrame,
                    instruments: DataFrame, paths: dict[str, str], exact: bool = True,
                    batches: dict[str, DataFrame] | None = None,
                    newest: dict[str, DataFrame | None] | None = None) -> dict:
    """The whole aggregation phase, in the reference's order, all currencies.

    ``batches``: the ticks just ingested into future_trades and
    option_trades; with them the term structures scan only touched hours.
    ``newest``: the stored newest ticks of both tables, where they are noted.
    """
    batches, newest = batches or {}, newest or {}
    futures, options = newest.get("future_trades"), newest.get("option_trades")
    both = None if futures is None or options is None else futures.unionByName(options)
    return {
        "ohlc_1min_futures": update_futures_ohlc(spark, future_trades, paths["ohlc_1min_futures"], futures),
        "ohlc_1min_index": update_index_ohlc(spark, future_trades, option_trades,
                                             paths["ohlc_1min_index"], both),
        "futures_term_structure": update_futures_term_structure(
            spark, future_trades, instruments, paths["futures_term_structure"], exact,
            batches.get("future_trades")),
        "options_term_structure": update_options_term_structure(
            spark, option_trades, instruments, paths["options_term_structure"], exact,
            batches.get("option_trades")),
    }


def _with_ts(schema, dtype, name: str = "bucket"):
    """The table schema with its time column in the ticks' timestamp flavour."""
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(f.name, dtype if f.name == name else f.dataType, True)
                       for f in schema.fields])

