"""Ordered results, previews and the optional filters of the bar operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars, funding, ohlc
from tickforge.sources import fixtures


@pytest.fixture(scope="module")
def ticks(spark, small_dir):
    return fixtures.load(spark, small_dir, "future_trades")


def test_ordered_bars(spark, small_dir, ticks):
    ids = [(r.instrument_name, r.candle_id) for r in bars.volume_bars(ticks, 700, ordered=True).collect()]
    assert ids == sorted(ids) and len(ids) > 10
    minute = ohlc.futures_ohlc_1min(ticks)
    starts = [(r.instrument_name, r.ts_start) for r in bars.ohlc_volume_bars(minute, 5000.0, ordered=True).collect()]
    assert starts == sorted(starts)
    fund = funding.realized_funding(minute, ohlc.index_ohlc_1min(ticks, fixtures.load(spark, small_dir, "option_trades")))
    out = [(r.instrument_name, r.ts_start) for r in funding.funding_volume_bars(ticks, fund, 1500, ordered=True).collect()]
    assert out == sorted(out)


def test_view_order_and_preview(ticks):
    top = ohlc.futures_ohlc_1min(ticks).orderBy("bucket", "instrument_name").limit(5).collect()
    rest = ohlc.futures_ohlc_1min(ticks).collect()
    assert top == sorted(rest, key=lambda r: (r.bucket, r.instrument_name))[:5]


def test_filters_come_before_the_running_sum(ticks):
    start, end = datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 8)
    part = ticks.where((F.col("timestamp") >= F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"))
                       & (F.col("timestamp") <= F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"))
                       & F.col("instrument_name").isin("BTC-PERPETUAL"))
    got = bars.volume_bars(ticks, 700, "BTC-PERPETUAL", start, end)
    want = bars.volume_bars(part, 700)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        bars.volume_bars(ticks, 0)
