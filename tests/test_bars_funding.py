"""Volume bars, the segmented running sum and funding bars."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import bars, funding
from tickforge.operators.scan import running_sum_points

T0 = datetime(2024, 1, 1, 0, 0)


def _ticks(spark, rows):
    data = [(str(i), T0 + timedelta(seconds=s), ins, p, p, a, 100.0, "buy", ins.split("-")[0])
            for i, (s, ins, p, a) in enumerate(rows)]
    df = spark.createDataFrame(data, schemas.FUTURE_TRADES)
    return df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz"))


def test_running_sum_equals_global_window(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        ins = rnd.choice(["BTC-PERPETUAL", "ETH-PERPETUAL", "BTC-29MAR24"])
        s = rnd.randint(0, 6 * 3600) // 7 * 7          # many equal timestamps
        rows.append((s, ins, 100.0, rnd.choice([None, 1, 5, 10, 50])))
    df = _ticks(spark, rows).select("trade_id", "instrument_name", "timestamp", "amount")
    for n_segments in (1, 3, 16):
        got = running_sum_points(df, ["instrument_name"], "timestamp", "amount", "cum", None, n_segments)
        w = Window.partitionBy("instrument_name").orderBy("timestamp")
        ref = df.withColumn("ref", F.sum("amount").over(w)).select("instrument_name", "timestamp", "ref").distinct()
        joined = got.join(ref, ["instrument_name", "timestamp"])
        assert joined.count() == got.count() == ref.count()
        assert joined.where(~F.col("cum").eqNullSafe(F.col("ref"))).count() == 0


def test_running_sum_leaves_no_files_and_shuffles_ticks_once(spark, small_dir, tmp_path):
    import os
    from urllib.parse import urlparse

    from tickforge.session import ensure_checkpoint_dir
    from tickforge.sources import fixtures
    root = urlparse(ensure_checkpoint_dir(spark)).path
    before = sorted(os.walk(root))
    out = bars.volume_bars(fixtures.load(spark, small_dir, "future_trades"), 700, n_segments=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    out.collect()
    assert sorted(os.walk(root)) == before
    assert plan.count("REPARTITION_BY_NUM") == 1             # the ticks, by (segment, instrument)
    # what else is shuffled has been summed by segment or candle before
    assert plan.count("Exchange hashpartitioning") <= 5


def test_volume_bar_boundaries(spark):
    # amounts 4, 6 (cum 10 = bin -> next candle), 3, 3 at the same time
    rows = [(1, "BTC-PERPETUAL", 10.0, 4), (2, "BTC-PERPETUAL", 20.0, 6),
            (3, "BTC-PERPETUAL", 30.0, 3), (3, "BTC-PERPETUAL", 40.0, 3)]
    out = sorted(bars.volume_bars(_ticks(spark, rows), 10).collect(), key=lambda r: r.candle_id)
    assert [(r.candle_id, r.n_trades) for r in out] == [(0, 1), (1, 3)]
    assert out[1].vwap == pytest.approx((20 * 6 + 30 * 3 + 40 * 3) / 12)
    # ids may skip: one big tick jumps two candles
    rows = [(1, "ETH-PERPETUAL", 1.0, 25), (2, "ETH-PERPETUAL", 1.0, 1)]
    ids = sorted(r.candle_id for r in bars.volume_bars(_ticks(spark, rows), 10).collect())
    assert ids == [2]


def test_volume_bars_range_restarts_sum(spark):
    rows = [(1, "BTC-PERPETUAL", 1.0, 6), (100, "BTC-PERPETUAL", 1.0, 6)]
    full = bars.volume_bars(_ticks(spark, rows), 10).collect()
    assert sorted(r.candle_id for r in full) == [0, 1]
    part = bars.volume_bars(_ticks(spark, rows), 10, start=T0 + timedelta(seconds=50)).collect()
    assert [r.candle_id for r in part] == [0]


def test_one_trade_candle_has_zero_funding(spark):
    rows = [(1, "BTC-PERPETUAL", 10.0, 20), (200, "BTC-PERPETUAL", 10.0, 20)]
    fund = spark.createDataFrame([(T0 + timedelta(minutes=m), "BTC", 0.01, 0.001) for m in range(5)],
                                 "bucket timestamp_ntz, currency string, diff double, funding double")
    out = funding.funding_volume_bars(_ticks(spark, rows), fund, 10).collect()
    assert len(out) == 2 and all(r.premium == 0.0 and r.funding == 0.0 for r in out)
    assert out[0].ts_start.endswith("+00")


def test_ohlc_volume_bars(spark):
    mb = spark.createDataFrame(
        [("BTC-PERPETUAL", T0 + timedelta(minutes=m), 10.0 + m, 5.0, 7.0 + m, 4.0, 2) for m in range(5)],
        "instrument_name string, bucket timestamp_ntz, high double, low double, close double, "
        "volume double, n_orders long")
    out = sorted(bars.ohlc_volume_bars(mb, 8.0).collect(), key=lambda r: r.ts_start)
    assert [r.volume for r in out] == [4.0, 8.0, 8.0]
    assert out[1].close == 9.0 and out[1].high == 12.0 and out[1].n_orders == 4


def test_bars_partition_ticks_and_conserve_volume(spark, small_dir):
    from tickforge.operators import ohlc
    from tickforge.sources import fixtures
    ft = fixtures.load(spark, small_dir, "future_trades")
    vb = bars.volume_bars(ft, 700, n_segments=5)
    per_instr = {r.instrument_name: (r.n, r.a) for r in
                 ft.groupBy("instrument_name").agg(F.count("*").alias("n"),
                                                   F.sum("amount").alias("a")).collect()}
    got = {r.instrument_name: r.n for r in
           vb.groupBy("instrument_name").agg(F.sum("n_trades").alias("n")).collect()}
    assert got == {k: v[0] for k, v in per_instr.items()}            # every tick in one candle
    # candles of one instrument are disjoint and ordered like their ids
    w = Window.partitionBy("instrument_name").orderBy("candle_id")
    overlap = vb.withColumn("prev_end", F.lag("ts_end").over(w)).where(F.col("ts_start") <= F.col("prev_end"))
    assert overlap.count() == 0
    minute = ohlc.futures_ohlc_1min(ft)
    ob = bars.ohlc_volume_bars(minute, 5000.0, n_segments=3)
    assert ob.agg(F.sum("volume")).first()[0] == minute.agg(F.sum("volume")).first()[0]
    assert ob.agg(F.sum("n_orders")).first()[0] == minute.agg(F.sum("n_orders")).first()[0]
