"""Hourly term structures: futures premium (A3) and option IV by delta (A4).

The reference computes each metric in its own UNION branch (four scans);
here one aggregation computes all metrics and `unpivot` turns the wide
row into the long (metric_type, metric_value) layout without another
scan or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import delta_bucket, futures_expiry_bucket, options_expiry_bucket
from ..functions.numeric import ieee_div, ieee_ln, norm_cdf, null_div
from ..functions.time import truncate, ts_literal, ts_type, year_fraction
from .bounds import currency_bounds, keep_closed

FUTURES_TS_COLUMNS = ["ts_hour", "currency", "expiry_bucket", "metric_type", "metric_value"]
OPTIONS_TS_COLUMNS = ["ts_hour", "currency", "delta_bucket", "expiry_bucket", "metric_type",
                      "metric_value"]

# Metric labels of the long term-structure tables.
FUTURES_METRICS = ["vw_APR", "avg_APR", "count", "volume"]
OPTIONS_METRICS = ["vw_iv", "avg_iv", "count", "volume"]


def _to_long(wide: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    wide = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(ids, metrics, "metric_type", "metric_value")


def _bound(since, dtype) -> Column:
    return since if isinstance(since, Column) else F.col("timestamp") >= ts_literal(since, dtype)


def _expirations(instruments: DataFrame) -> DataFrame:
    return instruments.select("instrument_name", F.col("expiration_timestamp").alias("_expiry"))


def futures_term_structure(future_trades: DataFrame, instruments: DataFrame,
                           closed_only: bool = True, since=None) -> DataFrame:
    """A3: hourly APR of dated futures vs index, by expiry bucket.

    ``T = (expiry - trade time) / 365d`` in whole seconds,
    ``apr = (price/index - 1) / T``.  The newest hour of each currency
    (by all its futures ticks, perpetuals included) is left out.
    ``since`` optionally keeps only the ticks at/after a bound, or those
    where a Column holds (incremental runs; whole hours); hours already
    stored are then skipped by insert-if-absent.
    """
    dtype = ts_type(future_trades, "timestamp")
    t = future_trades.where(~F.col("instrument_name").contains("PERPETUAL"))
    if since is not None:
        t = t.where(_bound(since, dtype))
    t = t.select("timestamp", "instrument_name", "currency", "price", "index_price", "amount")
    t = t.join(_expirations(instruments), "instrument_name")
    T = year_fraction(F.col("timestamp"), F.col("_expiry"))
    apr = ieee_div(ieee_div(F.col("price"), F.col("index_price")) - F.lit(1.0), F.col("T"))
    t = t.select(truncate(F.col("timestamp"), "hour", dtype).alias("ts_hour"),
                 "currency", "amount", "price", "index_price", T.alias("T"))
    t = t.select("ts_hour", "currency", "amount",
                 futures_expiry_bucket(F.col("T")).alias("expiry_bucket"),
                 apr.alias("apr"))
    amount, a = F.col("amount"), F.col("apr")
    wide = t.groupBy("ts_hour", "currency", "expiry_bucket").agg(
        ieee_div(F.sum(a * amount), F.sum(amount)).alias("vw_APR"),
        F.avg(a).alias("avg_APR"),
        F.count(F.lit(1)).alias("count"),
        F.sum(amount).alias("volume"),
    )
    if closed_only:
        wide = keep_closed(wide, currency_bounds(future_trades, "hour"), "ts_hour")
    return _to_long(wide, ["ts_hour", "currency", "expiry_bucket"], FUTURES_METRICS) \
        .select(*FUTURES_TS_COLUMNS)


def with_option_delta(df: DataFrame, index_price: str = "index_price", strike: str = "strike",
                      iv: str = "iv", t_years: str = "T", call_put: str = "call_put",
                      out: str = "delta") -> DataFrame:
    """Add the Black-Scholes delta (zero rate): N(d1) for calls, N(d1)-1 for puts.

    ``d1 = (ln(S/K) + iv^2/2 * T) / (iv * sqrt(T))``.  Built in steps so
    every intermediate is a column: each IEEE helper references its input
    several times, and nesting them as one expression would multiply the
    expression tree instead of evaluating each step once.
    """
    c = F.col
    df = df.withColumn("_lnr", ieee_ln(ieee_div(c(index_price), c(strike))))
    df = df.withColumn("_d1", ieee_div(c("_lnr") + F.lit(0.5) * F.pow(c(iv), F.lit(2.0)) * c(t_years),
                                       c(iv) * F.sqrt(c(t_years))))
    df = df.withColumn("_phi", norm_cdf(c("_d1")))
    df = df.withColumn(out, F.when(c(call_put) == "C", c("_phi"))
                       .when(c(call_put) == "P", c("_phi") - F.lit(1.0)))
    return df.drop("_lnr", "_d1", "_phi")


def options_term_structure(option_trades: DataFrame, instruments: DataFrame,
                           closed_only: bool = True, since=None) -> DataFrame:
    """A4: hourly implied volatility by |delta| bucket and expiry bucket.

    Strike and call/put come from the name ``CCY-EXPIRY-STRIKE-C|P``; T
    is measured from the *hour start* (not the trade time).
    """
    dtype = ts_type(option_trades, "timestamp")
    t = option_trades
    if since is not None:
        t = t.where(_bound(since, dtype))
    parts = F.split(F.col("instrument_name"), "-")
    t = t.select(
        truncate(F.col("timestamp"), "hour", dtype).alias("ts_hour"),
        "instrument_name", "currency",
        (F.col("iv") / F.lit(100.0)).alias("iv"),
        "amount",
        F.get(parts, 2).cast("double").alias("strike"),
        F.get(parts, 3).alias("call_put"),
        "index_price")
    t = t.join(_expirations(instruments), "instrument_name")
    T = year_fraction(F.col("ts_hour"), F.col("_expiry"))
    t = with_option_delta(t.withColumn("T", T))
    t = t.withColumn("abs_delta", F.abs(F.col("delta")))
    t = t.select("ts_hour", "currency", "iv", "amount",
                 delta_bucket(F.col("abs_delta")).alias("delta_bucket"),
                 options_expiry_bucket(F.col("T")).alias("expiry_bucket"))
    iv, amount = F.col("iv"), F.col("amount")
    wide = t.groupBy("ts_hour", "currency", "delta_bucket", "expiry_bucket").agg(
        null_div(F.sum(iv * amount), F.sum(amount)).alias("vw_iv"),
        F.avg(iv).alias("avg_iv"),
        F.count(F.lit(1)).alias("count"),
        F.sum(amount).alias("volume"),
    )
    if closed_only:
        wide = keep_closed(wide, currency_bounds(option_trades, "hour"), "ts_hour")
    return _to_long(wide, ["ts_hour", "currency", "delta_bucket", "expiry_bucket"],
                    OPTIONS_METRICS).select(*OPTIONS_TS_COLUMNS)
