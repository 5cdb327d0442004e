"""Hand-computed cases for the one-minute bars."""

import math
from datetime import datetime, timedelta

import pytest

from tickforge import schemas
from tickforge.operators import ohlc
from tickforge.operators.tables import conform

T0 = datetime(2024, 1, 1, 0, 0)


def _ft(spark, rows):
    """rows: (trade_id, seconds, instrument, price, amount, index, direction, currency)."""
    data = [(tid, T0 + timedelta(seconds=s), ins, p, p, a, ix, d, c)
            for tid, s, ins, p, a, ix, d, c in rows]
    schema = schemas.FUTURE_TRADES
    df = spark.createDataFrame(data, schema)
    return df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz"))


def test_futures_bar_golden(spark):
    rows = [
        ("1", 1, "BTC-PERPETUAL", 100.0, 10, 100.0, "buy", "BTC"),
        ("3", 5, "BTC-PERPETUAL", 110.0, 30, 100.0, "buy", "BTC"),
        ("2", 5, "BTC-PERPETUAL", 90.0, 20, 100.0, "sell", "BTC"),   # tie on time: id "2" < "3"
        ("4", 70, "BTC-PERPETUAL", 105.0, 10, 100.0, "buy", "BTC"),  # newest minute: open
    ]
    out = ohlc.futures_ohlc_1min(_ft(spark, rows)).collect()
    assert len(out) == 1
    b = out[0]
    assert b.bucket == T0 and b.open == 100.0 and b.close == 110.0
    assert b.high == 110.0 and b.low == 90.0 and b.volume == 60.0 and b.n_orders == 3
    assert b.pct_buys_count == pytest.approx(200.0 / 3)
    assert b.pct_buys_volume == pytest.approx(40 * 100.0 / 60)
    assert b.vw_buy_price == pytest.approx((100 * 10 + 110 * 30) / 40)
    assert b.vw_sell_price == pytest.approx(90.0)
    assert b.vwap == pytest.approx((1000 + 3300 + 1800) / 60)
    assert b.median_price == 100.0


def test_no_sells_and_zero_volume(spark):
    rows = [("1", 1, "ETH-PERPETUAL", 100.0, 0, 100.0, "buy", "ETH"),
            ("2", 2, "ETH-PERPETUAL", 102.0, 0, 100.0, "buy", "ETH"),
            ("3", 61, "ETH-PERPETUAL", 102.0, 5, 100.0, "buy", "ETH")]
    b = ohlc.futures_ohlc_1min(_ft(spark, rows)).first()
    assert b.vw_sell_price is None and b.vw_buy_price is None     # NULLIF -> NULL
    assert math.isnan(b.vwap) and math.isnan(b.pct_buys_volume)   # 0/0 -> NaN


def test_open_skips_null_price(spark):
    rows = [("1", 1, "BTC-X", None, 10, 100.0, "buy", "BTC"),
            ("2", 2, "BTC-X", 101.0, 10, 100.0, "buy", "BTC"),
            ("3", 3, "BTC-X", None, 10, 100.0, "buy", "BTC"),
            ("9", 90, "BTC-X", 1.0, 1, 1.0, "buy", "BTC")]
    b = ohlc.futures_ohlc_1min(_ft(spark, rows)).first()
    assert b.open == 101.0 and b.close == 101.0 and b.n_orders == 3


def test_open_bucket_cut_per_currency(spark):
    rows = [("1", 1, "BTC-X", 1.0, 1, 1.0, "buy", "BTC"),
            ("2", 65, "BTC-X", 1.0, 1, 1.0, "buy", "BTC"),
            ("3", 1, "ETH-X", 1.0, 1, 1.0, "buy", "ETH"),
            ("4", 200, "ETH-X", 1.0, 1, 1.0, "buy", "ETH")]
    got = sorted((r.currency, r.bucket) for r in ohlc.futures_ohlc_1min(_ft(spark, rows)).collect())
    assert got == [("BTC", T0), ("ETH", T0)]
    assert ohlc.futures_ohlc_1min(_ft(spark, rows), closed_only=False).count() == 4


def test_since_bound(spark):
    rows = [("1", 1, "BTC-X", 1.0, 1, 1.0, "buy", "BTC"),
            ("2", 65, "BTC-X", 2.0, 1, 1.0, "buy", "BTC"),
            ("3", 125, "BTC-X", 3.0, 1, 1.0, "buy", "BTC")]
    got = ohlc.futures_ohlc_1min(_ft(spark, rows), since=T0 + timedelta(minutes=1)).collect()
    assert [r.open for r in got] == [2.0]


def test_index_bars_union(spark):
    ft = _ft(spark, [("1", 1, "BTC-X", 1.0, 1, 500.0, "buy", "BTC"),
                     ("5", 100, "BTC-X", 1.0, 1, 1.0, "buy", "BTC")])
    od = [("2", T0 + timedelta(seconds=2), "BTC-X-1-C", 0.1, 50.0, 0.1, 1.0, 400.0, "buy", "BTC")]
    ot = spark.createDataFrame(od, schemas.OPTION_TRADES)
    ot = ot.withColumn("timestamp", ot["timestamp"].cast("timestamp_ntz"))
    b = ohlc.index_ohlc_1min(ft, ot).first()
    assert (b.open, b.close, b.high, b.low, b.obs) == (500.0, 400.0, 500.0, 400.0, 2)


def test_spot_fanout_closed_form(spark):
    data = [("1", T0 + timedelta(seconds=1), "BTC_USDT", 100.0, 100.0, 1.0, 0.0, "buy"),
            ("2", T0 + timedelta(seconds=2), "BTC_USDT", 110.0, 110.0, 2.0, 0.0, "buy"),
            ("3", T0 + timedelta(seconds=3), "BTC_USDT", 99.0, 99.0, 3.0, 0.0, "sell")]
    st = spark.createDataFrame(data, schemas.SPOT_TRADES)
    st = st.withColumn("timestamp", st["timestamp"].cast("timestamp_ntz"))
    r1, r2 = math.log(110 / 100) ** 2, math.log(99 / 110) ** 2
    true = ohlc.spot_ohlc_1min(st).first()
    fan = ohlc.spot_ohlc_1min(st, fanout=True).first()
    assert true.n_orders == 3 and fan.n_orders == 9
    assert true.volume == 6.0 and fan.volume == 18.0
    assert true.realized_sq_vol == pytest.approx(r1 + r2)
    assert fan.realized_sq_vol == pytest.approx(3 * (r1 + r2))
    assert true.realized_sq_vol_vw == pytest.approx((r1 * 2 + r2 * 3) / 6)
    assert fan.realized_sq_vol_vw == pytest.approx(3 * (r1 * 2 + r2 * 3) / 6)
    assert true.vwap == fan.vwap and true.open == 100.0 and true.close == 99.0


def test_spot_single_tick_has_null_variance(spark):
    data = [("1", T0, "ETH_USDT", 100.0, 100.0, 1.0, 0.0, "buy")]
    st = conform(spark.createDataFrame(data, schemas.SPOT_TRADES), schemas.SPOT_TRADES)
    r = ohlc.spot_ohlc_1min(st).first()
    assert r.realized_sq_vol is None and r.realized_sq_vol_vw is None and r.n_orders == 1


@pytest.mark.parametrize("n_segments", [1, 5, 13])
def test_spot_hot_minute_split_across_segments(spark, n_segments):
    import random
    rnd = random.Random(11)
    data = []
    for i in range(2000):                       # one hot minute, plus a quiet one
        ms = rnd.randint(0, 59999) // 3 * 3     # equal timestamps, ordered by trade_id
        price = None if i == 77 else 100.0 + rnd.random() * 10
        data.append((f"{i:05d}", T0 + timedelta(milliseconds=ms), "BTC_USDT", price, price,
                     rnd.choice([0.5, 1.0, 2.0]), 0.0, "buy"))
    data.append(("99999", T0 + timedelta(minutes=1, seconds=5), "BTC_USDT", 101.0, 101.0, 1.0, 0.0, "buy"))
    st = spark.createDataFrame(data, schemas.SPOT_TRADES)
    st = st.withColumn("timestamp", st["timestamp"].cast("timestamp_ntz"))
    got = {r.bucket: r for r in ohlc.spot_ohlc_1min(st, n_segments=n_segments).collect()}
    hot = sorted((r for r in data if r[1] < T0 + timedelta(minutes=1)), key=lambda r: (r[1], r[0]))
    rv, rva, tot = 0.0, 0.0, sum(r[5] for r in hot)
    for prev, cur in zip(hot, hot[1:]):
        if prev[3] is not None and cur[3] is not None:
            r2 = math.log(cur[3] / prev[3]) ** 2
            rv, rva = rv + r2, rva + r2 * cur[5]
    b = got[T0]
    assert b.n_orders == 2000 and b.volume == pytest.approx(tot)
    assert b.realized_sq_vol == pytest.approx(rv, rel=1e-12)
    assert b.realized_sq_vol_vw == pytest.approx(rva / tot, rel=1e-12)
    assert b.open == next(r[3] for r in hot if r[3] is not None)
    assert b.close == hot[-1][3]
    assert got[T0 + timedelta(minutes=1)].realized_sq_vol is None


def test_approx_median_option(spark):
    rows = [(str(i), 1 + i, "BTC-X", float(p), 1, 1.0, "buy", "BTC")
            for i, p in enumerate([5, 1, 3, 9, 7])] + [("9", 90, "BTC-X", 1.0, 1, 1.0, "buy", "BTC")]
    b = ohlc.futures_ohlc_1min(_ft(spark, rows), median="approx").first()
    assert b.median_price == 5.0
    with pytest.raises(ValueError):
        ohlc.futures_ohlc_1min(_ft(spark, rows), median="mean")


def test_spot_block_of_copies_is_split(spark):
    data = [("1", T0 + timedelta(seconds=1), "BTC_USDT", 100.0, 100.0, 1.0, 0.0, "buy")]
    data += [("2", T0 + timedelta(seconds=2), "BTC_USDT", 110.0, 110.0, 1.0, 0.0, "buy")] * 3000
    data += [("3", T0 + timedelta(seconds=3), "BTC_USDT", 99.0, 99.0, 1.0, 0.0, "buy")]
    st = spark.createDataFrame(data, schemas.SPOT_TRADES).repartition(6)
    st = st.withColumn("timestamp", st["timestamp"].cast("timestamp_ntz"))
    r = ohlc.spot_ohlc_1min(st, n_segments=7).first()
    assert r.n_orders == 3002
    assert r.realized_sq_vol == pytest.approx(math.log(1.1) ** 2 + math.log(99 / 110) ** 2)


def test_zoned_timestamps_stay_zoned(spark):
    rows = [("1", T0 + timedelta(seconds=1), "BTC-X", 1.0, 1.0, 1, 1.0, "buy", "BTC"),
            ("2", T0 + timedelta(seconds=90), "BTC-X", 2.0, 2.0, 1, 1.0, "buy", "BTC")]
    ft = spark.createDataFrame(rows, schemas.FUTURE_TRADES)           # TIMESTAMP (UTC session)
    out = ohlc.futures_ohlc_1min(ft)
    assert out.schema["bucket"].dataType.typeName() == "timestamp"
    assert out.first().bucket == T0
