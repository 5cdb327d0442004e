"""One-minute bars: futures (A1), index (A2) and spot (A5).

Every operator handles all instruments and currencies in one plan; the
grouping keys (instrument, minute) spread a hot instrument over its
minutes, and partial (map-side) aggregation runs before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.numeric import ieee_div, ieee_ln, null_div, weighted_mean
from ..functions.ordering import first_by, last_by, sequence, time_order
from ..functions.time import bucket, ts_literal, ts_type
from .bounds import closed_by_own_max, keep_closed, newest_bounds
from .segments import Order, equal_segments, micros, ordered_to_the_end, text_keys

FUTURES_OHLC_COLUMNS = ["instrument_name", "currency", "bucket", "open", "high", "low",
                        "close", "volume", "n_orders", "pct_buys_count",
                        "pct_buys_volume", "vw_buy_price", "vw_sell_price", "vwap",
                        "vw_diff_index", "median_price"]
INDEX_OHLC_COLUMNS = ["currency", "bucket", "open", "high", "low", "close", "obs"]
SPOT_OHLC_COLUMNS = ["bucket", "instrument_name", "first_trade", "last_trade", "open",
                     "high", "low", "close", "vwap", "volume", "n_orders",
                     "realized_sq_vol", "realized_sq_vol_vw"]


def _since(df: DataFrame, since) -> DataFrame:
    """Keep ticks at/after a start bound.

    ``since`` is None, a literal timestamp (UTC; pushed down to the Parquet
    scan), or a DataFrame ``(currency, since)`` of per-currency bounds.
    """
    if since is None:
        return df
    if isinstance(since, DataFrame):
        return (df.join(since.select("currency", F.col("since").alias("_since")), "currency")
                .where(F.col("timestamp") >= F.col("_since")).drop("_since"))
    return df.where(F.col("timestamp") >= ts_literal(since, ts_type(df, "timestamp")))


def _closed(bars: DataFrame, newest: DataFrame | None, unit: str) -> DataFrame:
    """Without each currency's open bucket: by the stored newest ticks, or else by the bars' own."""
    return closed_by_own_max(bars, "bucket") if newest is None else keep_closed(bars, newest_bounds(newest, unit), "bucket")


def futures_bar_aggs(tie_break: str = "trade_id", median: str = "exact",
                     median_accuracy: int = 10000, order: list[Column] | None = None) -> list[Column]:
    """Aggregate expressions of a futures bar (shared by batch and stream).

    ``median="exact"`` is the interpolated median of the reference (its
    buffer holds one entry per distinct price of the minute);
    ``median="approx"`` uses ``percentile_approx`` (a fixed-size sketch;
    returns an observed price, no interpolation).
    """
    if median not in ("exact", "approx"):
        raise ValueError("median must be 'exact' or 'approx'")
    order = order or [F.col("timestamp"), *sequence(tie_break)]
    price, amount = F.col("price"), F.col("amount")
    buy, sell = F.col("direction") == "buy", F.col("direction") == "sell"
    buy_amount = F.sum(F.when(buy, amount).otherwise(F.lit(0)))
    sell_amount = F.sum(F.when(sell, amount).otherwise(F.lit(0)))
    n = F.count(F.lit(1))
    return [
        first_by("price", *order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last_by("price", *order).alias("close"),
        F.sum(amount).cast("double").alias("volume"),
        n.alias("n_orders"),
        ieee_div(F.count(F.when(buy, F.lit(1))) * F.lit(100.0), n).alias("pct_buys_count"),
        ieee_div(buy_amount * F.lit(100.0), F.sum(amount)).alias("pct_buys_volume"),
        null_div(F.sum(F.when(buy, price * amount).otherwise(F.lit(0.0))), buy_amount)
        .alias("vw_buy_price"),
        null_div(F.sum(F.when(sell, price * amount).otherwise(F.lit(0.0))), sell_amount)
        .alias("vw_sell_price"),
        weighted_mean(price, amount).alias("vwap"),
        ieee_div(F.sum(amount * (ieee_div(price, F.col("index_price")) - F.lit(1.0))),
                 F.sum(amount)).alias("vw_diff_index"),
        (F.median(price) if median == "exact"
         else F.percentile_approx(price, 0.5, median_accuracy)).alias("median_price"),
    ]


def index_bar_aggs(tie_break: str = "trade_id", order: list[Column] | None = None) -> list[Column]:
    order = order or [F.col("timestamp"), *sequence(tie_break)]
    return [
        first_by("index_price", *order).alias("open"),
        F.max("index_price").alias("high"),
        F.min("index_price").alias("low"),
        last_by("index_price", *order).alias("close"),
        F.count(F.lit(1)).alias("obs"),
    ]


FUTURES_TICK_COLUMNS = ["instrument_name", "currency", "timestamp", "price", "amount",
                        "index_price", "direction"]


def futures_ohlc_1min(future_trades: DataFrame, since=None, closed_only: bool = True,
                      tie_break: str = "trade_id", unit: str = "minute",
                      median: str = "exact", newest: DataFrame | None = None) -> DataFrame:
    """A1: per (instrument, currency, minute) bar with flow statistics.

    ``closed_only`` drops each currency's newest (still open) minute, known
    from ``newest`` (`tables.newest_ticks`) without reading the ticks again.
    Open/close use (timestamp, tie_break) as a total order.
    """
    t = _since(future_trades, since)
    t = t.select(*FUTURES_TICK_COLUMNS, tie_break, bucket(t, "timestamp", unit).alias("bucket"))
    bars = t.groupBy("instrument_name", "currency", "bucket").agg(
        *futures_bar_aggs(tie_break, median, order=time_order(t, "timestamp", tie_break)))
    if closed_only:
        bars = _closed(bars, newest, unit)
    return bars.select(*FUTURES_OHLC_COLUMNS)


def index_ticks(future_trades: DataFrame, option_trades: DataFrame,
                tie_break: str = "trade_id") -> DataFrame:
    cols = ["currency", "timestamp", "index_price", tie_break]
    return future_trades.select(*cols).unionByName(option_trades.select(*cols))


def index_ohlc_1min(future_trades: DataFrame, option_trades: DataFrame, since=None,
                    closed_only: bool = True, tie_break: str = "trade_id",
                    unit: str = "minute", newest: DataFrame | None = None) -> DataFrame:
    """A2: index price bars from the union of futures and options ticks.

    ``newest`` as for A1: the newest ticks of both tables.  With a whole number
    as tie-break the ticks go through hash aggregation alone.
    """
    t = _since(index_ticks(future_trades, option_trades, tie_break), since)
    t = t.withColumn("bucket", bucket(t, "timestamp", unit))
    bars = t.groupBy("currency", "bucket").agg(*index_bar_aggs(tie_break, time_order(t, "timestamp", tie_break)))
    if closed_only:
        bars = _closed(bars, newest, unit)
    return bars.select(*INDEX_OHLC_COLUMNS)


def _tick_order(ticks: DataFrame, tie_break: str) -> Order:
    """(timestamp, length and value of the id, hash of the row, copies) as whole numbers."""
    hashed = F.shiftrightunsigned("_row_hash", 1)
    if isinstance(ticks.schema[tie_break].dataType, IntegralType):
        value, whole = [F.coalesce(F.col(tie_break).cast("long"), F.lit(-1).cast("long"))], F.lit(True)
    else:
        value, whole = text_keys(tie_break), ordered_to_the_end(tie_break)
    # ids that their keys do not tell apart stay together
    tail = F.when(whole, hashed).otherwise(F.lit(0).cast("long"))
    length = F.coalesce(F.col("_tie_length").cast("long"), F.lit(-1).cast("long"))
    return Order([micros(F.col("timestamp")), length, *value, tail],
                 F.when(whole, F.col("_row_id")).otherwise(F.lit(-1).cast("long")))


def spot_ohlc_1min(spot_trades: DataFrame, fanout: bool = False,
                   tie_break: str = "trade_id", unit: str = "minute",
                   n_segments: int | None = None) -> DataFrame:
    """A5: spot bars with realized variance of 1-tick log returns.

    ``fanout=False`` gives the true per-minute values.  ``fanout=True``
    reproduces the reference view, whose many-to-many self join repeats
    every tick n times in a minute of n ticks: volume = n*sum(amount),
    n_orders = n*n and both variance sums are multiplied by n; OHLC, vwap
    and first/last trade are unchanged.  Both are computed in closed form
    - no self join, no n*n rows.

    The previous-tick return needs the ticks of a minute in order.  So that
    a hot (instrument, minute) cannot land in one task, time is cut into
    segments of equal row counts (`segments`; a hot instant by trade id, and
    copies of a tick in any order): the ticks are shuffled once, returns are
    computed inside each (segment, instrument, minute), every segment is
    summarised (partial sums, first and last tick), and the one return
    that crosses each segment boundary is added from a window over the
    summaries (a few rows per minute).
    """
    cols = ["instrument_name", "timestamp", "price", "amount", tie_break]
    t = spot_trades.select(*cols)
    # Total order of the ticks: (timestamp, tie_break by length and value), then a hash of the
    # whole row (deterministic among rows that differ), then a row id - so
    # that even a block of identical copies can be split (any order of
    # identical copies gives the same returns).
    t = t.select(*cols, bucket(t, "timestamp", unit).alias("bucket"), sequence(tie_break)[0].alias("_tie_length"),
                 F.xxhash64(*cols).alias("_row_hash"),
                 F.monotonically_increasing_id().alias("_row_id"))
    seq = ["timestamp", "_tie_length", tie_break, "_row_hash", "_row_id"]
    n_seg = n_segments or int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = equal_segments(t, _tick_order(t, tie_break), n_seg).attach(t)
    g = ["_seg", "instrument_name", "bucket"]
    order = F.struct(*seq)
    w = Window.partitionBy(*g).orderBy(*seq)
    t = t.withColumn("ret2", F.pow(ieee_ln(ieee_div(F.col("price"), F.lag("price").over(w))),
                                   F.lit(2.0)))
    price, amount, ret2 = F.col("price"), F.col("amount"), F.col("ret2")
    seg = t.groupBy(*g).agg(
        F.min("timestamp").alias("first_trade"),
        F.max("timestamp").alias("last_trade"),
        first_by("price", "timestamp", *sequence(tie_break)).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last_by("price", "timestamp", *sequence(tie_break)).alias("close"),
        F.sum(price * amount).alias("_pa"),
        F.sum(amount).cast("double").alias("_volume"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(ret2).alias("_rv"),
        F.sum(ret2 * amount).alias("_rv_amount"),
        F.count(ret2).alias("_n_ret"),
        F.min_by(price, order).alias("_first_px"),      # NULL prices included, like LAG
        F.min_by(amount, order).alias("_first_amount"),
        F.max_by(price, order).alias("_last_px"),
    )
    across = Window.partitionBy("instrument_name", "bucket").orderBy("_seg")
    seg = seg.withColumn("_b_ret2", F.pow(ieee_ln(ieee_div(
        F.col("_first_px"), F.lag("_last_px").over(across))), F.lit(2.0)))
    b = F.col("_b_ret2")
    bars = seg.groupBy("instrument_name", "bucket").agg(
        F.min("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"),
        first_by("open", "_seg").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        last_by("close", "_seg").alias("close"),
        ieee_div(F.sum("_pa"), F.sum("_volume")).alias("vwap"),
        F.sum("_volume").alias("_volume"),
        F.sum("_n").alias("_n"),
        F.sum(F.coalesce(F.col("_rv"), F.lit(0.0)) + F.coalesce(b, F.lit(0.0))).alias("_rv"),
        F.sum(F.coalesce(F.col("_rv_amount"), F.lit(0.0))
              + F.coalesce(b * F.col("_first_amount"), F.lit(0.0))).alias("_rv_amount"),
        F.sum(F.col("_n_ret") + F.when(b.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
        .alias("_n_ret"),
    )
    n = F.col("_n")
    has_ret = F.col("_n_ret") > 0
    rv = F.when(has_ret, F.col("_rv"))
    # Sum of ret2*amount/total over the ticks, with total = sum(amount).
    rv_vw = F.when(has_ret, ieee_div(F.col("_rv_amount"), F.col("_volume")))
    if fanout:
        bars = bars.select(
            "*",
            (F.col("_volume") * n).alias("volume"),
            (n * n).alias("n_orders"),
            (rv * n).alias("realized_sq_vol"),
            (rv_vw * n).alias("realized_sq_vol_vw"))
    else:
        bars = bars.select(
            "*",
            F.col("_volume").alias("volume"),
            n.alias("n_orders"),
            rv.alias("realized_sq_vol"),
            rv_vw.alias("realized_sq_vol_vw"))
    return bars.select(*SPOT_OHLC_COLUMNS)
