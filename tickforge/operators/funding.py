"""Realized funding per minute (A9) and per volume bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dead_band_funding, ieee_div, ieee_ln
from ..functions.time import ceil_minute, format_ts_text, last_minute_before, ts_literal, ts_type
from .bars import volume_bars

# The perpetuals the reference's funding view covers by
# default (the rule itself is general: ``<CCY>-PERPETUAL``).
PERPETUAL_SUFFIX = "-PERPETUAL"
DEFAULT_PERPETUALS = ["BTC-PERPETUAL", "ETH-PERPETUAL"]

FUNDING_COLUMNS = ["bucket", "currency", "diff", "funding"]
FUNDING_BAR_COLUMNS = ["instrument_name", "ts_start", "ts_end", "vwap", "n_trades",
                       "premium", "funding"]


def currency_of(name_col: str = "instrument_name") -> F.Column:
    """Currency = text before the first ``-`` of an instrument name."""
    return F.substring_index(F.col(name_col), "-", 1)


def realized_funding(futures_bars: DataFrame, index_bars: DataFrame,
                     perpetuals=tuple(DEFAULT_PERPETUALS)) -> DataFrame:
    """Premium ``ln(perp close / index close)`` and dead-banded funding.

    The perpetual is paired with its currency's index by an equi-join on
    (bucket, currency) - the reference's OR-of-pairs join condition
    rewritten so Spark can hash both sides on the full key.
    """
    f = futures_bars.where(F.col("instrument_name").endswith(PERPETUAL_SUFFIX))
    if perpetuals is not None:
        f = f.where(F.col("instrument_name").isin(*perpetuals))
    f = f.select("bucket", currency_of().alias("currency"), F.col("close").alias("_perp"))
    j = index_bars.select("bucket", "currency", F.col("close").alias("_index"))
    diff = ieee_ln(ieee_div(F.col("_perp"), F.col("_index")))
    return (f.join(j, ["bucket", "currency"], "inner")
            .select("bucket", "currency", diff.alias("diff"))
            .withColumn("funding", dead_band_funding(F.col("diff")))
            .select(*FUNDING_COLUMNS))


def _minutes_covered(start: str, end: str, dtype) -> F.Column:
    """Minute boundaries m with ``start <= m < end`` (NULL when none).

    A range join (``m >= start AND m < end``) plans as a nested loop; each
    candle is expanded to the minutes it covers and equi-joined instead.  Per
    instrument the candles are disjoint, so this is at most one row per
    instrument and minute.
    """
    first = ceil_minute(F.col(start), dtype)
    last = last_minute_before(F.col(end), dtype)
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MINUTE")))


def funding_volume_bars(future_trades: DataFrame, funding: DataFrame, volume_bin,
                        instruments=None, start=None, end=None,
                        ordered: bool = False, n_segments: int | None = None) -> DataFrame:
    """Volume bars with the premium and funding of the minutes they span.

    Minutes in the gap between one candle's last tick and the next
    candle's first tick, and the minute equal to ``ts_end``, belong to no
    candle (the reference's semantics).  Times are returned as text.

    One pass over the candles: each candle row is expanded to its minutes
    (``explode_outer`` keeps candles that cover none), left-joined with the
    funding minutes on (currency, minute) and summed back per candle; the
    candle's own columns ride along as grouping keys (they are constant
    per candle), so the tick-level plan is not evaluated twice.
    """
    candles = volume_bars(future_trades, volume_bin, instruments, start, end,
                          n_segments=n_segments)
    candles = candles.withColumn("currency", currency_of())
    fund = funding.select("bucket", "currency", "diff", "funding")
    dtype = ts_type(fund, "bucket")
    if start is not None:
        fund = fund.where(F.col("bucket") >= ts_literal(start, dtype))
    if end is not None:
        fund = fund.where(F.col("bucket") <= ts_literal(end, dtype))
    dtype = ts_type(candles, "ts_start")
    cols = ["instrument_name", "candle_id", "ts_start", "ts_end", "vwap", "n_trades", "currency"]
    ex = candles.select(*cols, F.explode_outer(_minutes_covered("ts_start", "ts_end", dtype))
                        .alias("bucket"))
    out = (ex.join(fund, ["currency", "bucket"], "left")
           .groupBy(*cols)
           .agg(F.sum("diff").alias("diff"), F.sum("funding").alias("funding")))
    if ordered:   # by start time, before the times become text
        out = out.orderBy("instrument_name", "ts_start")
    return out.select(
        "instrument_name",
        format_ts_text(F.col("ts_start")).alias("ts_start"),
        format_ts_text(F.col("ts_end")).alias("ts_end"),
        "vwap", "n_trades",
        F.coalesce(F.col("diff"), F.lit(0.0)).alias("premium"),
        F.coalesce(F.col("funding"), F.lit(0.0)).alias("funding"),
    )
