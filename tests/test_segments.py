"""Segments of equal row counts: even whatever the spread of times, in order, one tick shuffle."""

import random
import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import bars, ohlc
from tickforge.operators.segments import Order, equal_segments, micros
from tickforge.sources import fixtures

T0 = datetime(2024, 1, 1)


def _times(spark, micro_expr, n):
    return spark.range(n).select(F.timestamp_micros(F.expr(micro_expr).cast("long")).alias("ts"), F.col("id"))


def _sizes(df, n):
    order = Order([micros(F.col("ts"))])
    out = equal_segments(df, order, n).attach(df)
    assert out.columns == [*df.columns, "_seg"]
    rows = out.groupBy("_seg").agg(F.count("*").alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("_seg").collect()
    assert all(a.high < b.low for a, b in zip(rows, rows[1:], strict=False))        # in order, instants whole
    return [r.n for r in rows]


def test_twenty_thousand_segments_of_two_million_instants(spark):
    df = _times(spark, "1704067200000000 + id * 37", 2_000_000)
    at = time.monotonic()
    segments = equal_segments(df, Order([micros(F.col("ts"))]), 20_000)
    out = segments.attach(df)
    histogram = time.monotonic() - at
    at = time.monotonic()
    out._jdf.queryExecution().executedPlan()
    assert time.monotonic() - at < 5 and histogram < 60
    sizes = [r.n for r in out.groupBy("_seg").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2_000_000 and max(sizes) <= 200 and len(sizes) >= 10_000


@pytest.mark.parametrize("spread", [
    "1704067200000000 + id",                                                        # even
    "case when id = 0 then 1 when id = 1 then 253402300799000000 else 1704067200000000 + id end",   # two outliers
    "cast(1704067200000000 + exp(id / 500D) as bigint)",                            # bursts
])
def test_segments_are_even_whatever_the_spread(spark, spread):
    sizes = _sizes(_times(spark, spread, 20_000), 50)
    assert sum(sizes) == 20_000
    if "exp" not in spread:              # there many rows share an instant, which is not split
        assert max(sizes) <= 800 and len(sizes) >= 25


def test_nulls_come_first_and_little_input(spark):
    df = spark.createDataFrame([(None, 0), (T0, 1), (T0 + timedelta(days=9), 2)], "ts timestamp, id int")
    got = {r.id: r._seg for r in equal_segments(df, Order([micros(F.col("ts"))]), 4).attach(df).collect()}
    assert got[0] == -1 and got[1] < got[2]
    empty = df.limit(0)
    assert equal_segments(empty, Order([micros(F.col("ts"))]), 4).attach(empty).count() == 0
    assert {r._seg for r in equal_segments(df, Order([micros(F.col("ts"))]), 1).attach(df).collect()} == {0}


def test_rows_unseen_by_the_histogram_stop_the_job(spark):
    df = _times(spark, "1704067200000000 + id * 1000", 100)
    segments = equal_segments(df, Order([micros(F.col("ts"))]), 10)
    with pytest.raises(Exception, match="input changed"):
        segments.attach(_times(spark, "1804067200000000 + id", 5)).collect()


def _spot(spark, rows):
    st = spark.createDataFrame(rows, schemas.SPOT_TRADES)
    return st.withColumn("timestamp", st["timestamp"].cast("timestamp_ntz"))


@pytest.mark.parametrize("long_ids", [False, True])
def test_hot_instant_is_split_by_trade_id(spark, long_ids):
    """All ticks share one instant; their order is that of the ids (length, then text)."""
    rnd = random.Random(4)
    ids = rnd.sample(range(10**12), 600) + list(range(300))
    names = [("x" * 60 if long_ids else "") + str(i) for i in ids]
    data = [(name, T0 + timedelta(seconds=5), "BTC_USDT", 100 + rnd.random(), 1.0, float(rnd.randrange(1, 4)), 0.0, "buy") for name in names]
    st = _spot(spark, data).repartition(5)
    t = st.select("*", F.length("trade_id").alias("_tie_length"), F.xxhash64(*st.columns).alias("_row_hash"),
                  F.monotonically_increasing_id().alias("_row_id"))
    out = equal_segments(t, ohlc._tick_order(t, "trade_id"), 30).attach(t)
    segs = out.groupBy("_seg").agg(F.count("*").alias("n"), F.min(F.struct("_tie_length", "trade_id")).alias("low"),
                                   F.max(F.struct("_tie_length", "trade_id")).alias("high")).orderBy("_seg").collect()
    assert all(a.high < b.low for a, b in zip(segs, segs[1:], strict=False))
    if not long_ids:
        assert len(segs) > 15 and max(r.n for r in segs) <= 60
    got = ohlc.spot_ohlc_1min(st, n_segments=30).first()
    w = Window.partitionBy("instrument_name").orderBy(F.length("trade_id"), "trade_id")
    want = st.withColumn("r", F.pow(F.log(F.col("price") / F.lag("price").over(w)), 2)).agg(F.sum("r")).first()[0]
    assert got.realized_sq_vol == pytest.approx(want, rel=1e-10) and got.n_orders == 900


def test_ids_as_numbers(spark):
    data = [(i, T0 + timedelta(seconds=5), "BTC_USDT", 100.0 + i % 7, 1.0) for i in range(500)]
    st = spark.createDataFrame(data, "seq long, timestamp timestamp_ntz, instrument_name string, price double, amount double").repartition(4)
    got = ohlc.spot_ohlc_1min(st, tie_break="seq", n_segments=9).first()
    one = ohlc.spot_ohlc_1min(st, tie_break="seq", n_segments=1).first()
    assert got.realized_sq_vol == pytest.approx(one.realized_sq_vol) and (got.open, got.close) == (one.open, one.close) == (100.0, 102.0)


def _tick_exchanges(plan, column):
    """Exchanges whose rows still hold single ticks (their trade id)."""
    return len(re.findall(r"Exchange (?:hash|range)partitioning\(_seg", plan)), plan.count("Exchange rangepartitioning")


def test_spot_ticks_are_shuffled_once(spark, small_dir):
    out = ohlc.spot_ohlc_1min(fixtures.load(spark, small_dir, "spot_trades"), n_segments=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert _tick_exchanges(plan, "trade_id") == (1, 0)


def test_volume_bars_with_many_segments_equal_few(spark, small_dir):
    ft = fixtures.load(spark, small_dir, "future_trades")
    many, few = (sorted(map(tuple, bars.volume_bars(ft, 700, n_segments=n).select("instrument_name", "candle_id", "n_trades").collect()))
                 for n in (200, 1))
    assert many == few and len(many) > 3
