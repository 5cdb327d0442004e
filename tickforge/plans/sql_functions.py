"""The three parameterised macros as SQL table functions.

After ``register_functions(spark, tables)``::

    SELECT * FROM futures_by_volume('BTC-PERPETUAL', TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-02 00:00:00', 100000)

A literal running sum over one instrument would be a window in one task.  The
functions read the stored rows by way of a view that numbers them with their
segment (`operators.segments`: equal row counts over time), so a body sums
ties and runs its window inside each segment and adds the sums of the
segments before - of which there are at most ``n_segments``, the only rows
that meet in one task.  The functions are temporary, as the views are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..operators.segments import Order, equal_segments, micros
from ..session import ensure_utc

TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSx"


def _ieee(a: str, b: str) -> str:
    """a / b in doubles, with infinities and NaN for a zero divisor."""
    return (f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / {b} "
            f"WHEN {a} = 0 OR isnan(CAST({a} AS DOUBLE)) THEN double('NaN') WHEN {a} > 0 THEN double('Infinity') ELSE double('-Infinity') END")


def _running(source: str, time: str, volume: str, extra: str) -> str:
    """CTEs up to ``cum``: points of one instrument in the range, with the running volume ``total``."""
    return f"""
WITH picked AS (SELECT * FROM {source} WHERE instrument_name = instr AND {time} >= start_ts AND {time} <= end_ts),
points AS (SELECT _seg, {time} AS at, sum({volume}) AS volume, {extra} FROM picked GROUP BY _seg, {time}),
inside AS (SELECT *, sum(volume) OVER (PARTITION BY _seg ORDER BY at) AS so_far FROM points),
segments AS (SELECT instrument_name, _seg, sum({volume}) AS volume FROM picked GROUP BY instrument_name, _seg),
offsets AS (SELECT _seg, coalesce(sum(volume) OVER (PARTITION BY instrument_name ORDER BY _seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM segments),
cum AS (SELECT inside.*, CAST(floor((so_far + before) / volume_bin) AS BIGINT) AS candle_id FROM inside JOIN offsets USING (_seg))"""


def _numbered(df: DataFrame, time: str, n: int | None, name: str) -> None:
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    equal_segments(df, Order([micros(F.col(time))]), n).attach(df).createOrReplaceTempView(name)


def register_functions(spark: SparkSession, tables: dict[str, DataFrame], n_segments: int | None = None) -> list[str]:
    """Register what ``tables`` allows; returns the functions' names.

    * ``futures_by_volume(instr, start_ts, end_ts, volume_bin)`` needs ``future_trades``;
    * ``ohlc_dollar_bars(...)`` needs ``ohlc_1min_futures``;
    * ``funding_volume_weighted(...)`` needs ``future_trades`` and the registered view
      ``funding_view`` (`sql_views.register_views`).

    The range is inclusive and is applied before the running sum.  The views
    are over the rows as they are now: register again after an update.
    """
    ensure_utc(spark)
    found = []

    def function(name: str, df: DataFrame, time: str, columns: str, body: str) -> None:
        kind = "TIMESTAMP_NTZ" if isinstance(df.schema[time].dataType, TimestampNTZType) else "TIMESTAMP"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(instr STRING, start_ts {kind}, end_ts {kind}, volume_bin DOUBLE) "
                  f"RETURNS TABLE ({columns.replace('TIME', kind)}) RETURN {body}")
        found.append(name)

    if "future_trades" in tables:
        ticks = tables["future_trades"]
        _numbered(ticks.select("instrument_name", "timestamp", "price", "amount"), "timestamp", n_segments, "future_trades_numbered")
        function("futures_by_volume", ticks, "timestamp", "ts_start TIME, ts_end TIME, candle_id BIGINT, vwap DOUBLE, n_trades BIGINT",
                 _running("future_trades_numbered", "timestamp", "amount", "sum(price * amount) AS paid, count(*) AS n") + f"""
SELECT min(at), max(at), candle_id, {_ieee('sum(paid)', 'sum(volume)')}, sum(n) FROM cum GROUP BY candle_id""")
    if "ohlc_1min_futures" in tables:
        minutes = tables["ohlc_1min_futures"]
        _numbered(minutes.select("instrument_name", "bucket", "high", "low", "close", "volume", "n_orders"), "bucket",
                  n_segments, "ohlc_1min_futures_numbered")
        function("ohlc_dollar_bars", minutes, "bucket",
                 "ts_start TIME, ts_end TIME, high DOUBLE, low DOUBLE, close DOUBLE, vwap DOUBLE, volume DOUBLE, n_orders BIGINT",
                 _running("ohlc_1min_futures_numbered", "bucket", "volume",
                          "max(high) AS high, min(low) AS low, max(close) AS close, sum(n_orders) AS n") + f"""
SELECT min(at), max(at), max(high), min(low), max_by(close, CASE WHEN close IS NOT NULL THEN at END),
       {_ieee('sum(close * volume)', 'sum(volume)')}, sum(volume), sum(n) FROM cum GROUP BY candle_id""")
    if "future_trades" in tables and spark.catalog.tableExists("funding_view"):
        function("funding_volume_weighted", tables["future_trades"], "timestamp",
                 "ts_start STRING, ts_end STRING, vwap DOUBLE, n_trades BIGINT, premium DOUBLE, funding DOUBLE", f"""
WITH candles AS (SELECT * FROM futures_by_volume(instr, start_ts, end_ts, volume_bin)),
edges AS (
  SELECT *, CASE WHEN date_trunc('minute', ts_start) = ts_start THEN ts_start ELSE date_trunc('minute', ts_start) + INTERVAL 1 MINUTE END AS low,
         date_trunc('minute', ts_end - INTERVAL 1 MICROSECOND) AS high FROM candles),
covered AS (
  SELECT * FROM edges LATERAL VIEW OUTER explode(CASE WHEN low <= high THEN sequence(low, high, INTERVAL 1 MINUTE) END) m AS minute),
rates AS (SELECT CAST(bucket AS TIMESTAMP) AS minute, diff, funding FROM funding_view
          WHERE currency = substring_index(instr, '-', 1) AND bucket >= start_ts AND bucket <= end_ts)
SELECT date_format(CAST(ts_start AS TIMESTAMP), '{TEXT}'), date_format(CAST(ts_end AS TIMESTAMP), '{TEXT}'), vwap, n_trades,
       coalesce(sum(diff), 0D), coalesce(sum(funding), 0D)
FROM covered c LEFT JOIN rates r ON CAST(c.minute AS TIMESTAMP) = r.minute
GROUP BY candle_id, ts_start, ts_end, vwap, n_trades""")
    return found
