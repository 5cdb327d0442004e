"""One stream of all currencies, each closing its own minutes."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import ohlc
from tickforge.streaming import closing_stream
from tickforge.streaming.ohlc_stream import read_stream_like

T0 = datetime(2024, 1, 1)


def _file(spark, folder, number, rows):
    """rows: (id, seconds, instrument, currency, price) as one more file of the source."""
    data = [(str(i), T0 + timedelta(seconds=s), name, p, p, 1, 100.0, "buy", ccy) for i, s, name, ccy, p in rows]
    df = spark.createDataFrame(data, schemas.FUTURE_TRADES)
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).coalesce(1)
    df.write.parquet(f"{folder}/tmp{number}")
    part = next((folder / f"tmp{number}").glob("*.parquet"))
    shutil.copy(part, folder / f"ticks-{number:03d}.parquet")
    return df


def _run(spark, folder, out):
    one = spark.read.parquet(str(folder / "ticks-000.parquet"))
    stream = read_stream_like(spark, one, str(folder), "ticks-*.parquet", max_files=1)
    closing_stream.start_futures_bars(stream, f"{out}/bars", f"{out}/checkpoint").awaitTermination()
    return closing_stream.read_bars(spark, f"{out}/bars")


def _same(got, want):
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_currencies_far_apart_equal_the_batch_bars(spark, tmp_path):
    """BTC is hours ahead of ETH and SOL starts late; every batch is out of order across currencies."""
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    files = [[(1, 7200, "BTC-X", "BTC", 1.0), (2, 7230, "BTC-X", "BTC", 5.0), (3, 5, "ETH-X", "ETH", 2.0), (4, 7262, "BTC-X", "BTC", 3.0)],
             [(5, 30, "ETH-X", "ETH", 7.0), (6, 65, "ETH-X", "ETH", 8.0), (7, 7265, "BTC-Y", "BTC", 9.0), (8, 1, "SOL-X", "SOL", 4.0)],
             [(9, 130, "ETH-X", "ETH", 1.5), (10, 100, "ETH-Y", "ETH", 2.5), (11, 7325, "BTC-X", "BTC", 6.0), (12, 61, "SOL-X", "SOL", 4.5),
              (13, 62, "SOL-X", None, 4.5)]]
    for k, rows in enumerate(files):
        _file(spark, src, k, rows)
    got = _run(spark, src, out)
    assert len([f for f in (out / "bars").iterdir() if f.name.startswith("batch=")]) == 3
    want = ohlc.futures_ohlc_1min(spark.read.parquet(f"{src}/ticks-*.parquet"))
    assert {r.currency for r in want.collect()} == {"BTC", "ETH", "SOL"}
    _same(got, want)
    # the open ticks are those of each currency's newest minute, kept for two batches
    assert sorted(f.name for f in (out / "checkpoint-open").iterdir()) == ["1", "2"]
    left = spark.read.parquet(f"{out}/checkpoint-open/2/ticks").collect()
    assert sorted(r.trade_id for r in left) == ["11", "12", "9"]


def test_late_ticks_are_dropped_by_their_own_currency(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    _file(spark, src, 0, [(1, 10, "BTC-X", "BTC", 1.0), (2, 70, "BTC-X", "BTC", 2.0), (3, 10, "ETH-X", "ETH", 1.0)])
    _file(spark, src, 1, [(4, 20, "BTC-X", "BTC", 99.0), (5, 20, "ETH-X", "ETH", 3.0), (6, 75, "ETH-X", "ETH", 3.0), (7, 130, "BTC-X", "BTC", 1.0)])
    got = {(r.currency, r.bucket): (r.n_orders, r.high) for r in _run(spark, src, out).collect()}
    assert got == {("BTC", T0): (1, 1.0), ("BTC", T0 + timedelta(minutes=1)): (1, 2.0), ("ETH", T0): (2, 3.0)}


def test_restart_and_a_batch_that_runs_again(spark, tmp_path, monkeypatch):
    """The job dies after the bars of a batch are written; the next start repeats that batch."""
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    _file(spark, src, 0, [(1, 10, "BTC-X", "BTC", 1.0), (2, 70, "BTC-X", "BTC", 2.0)])
    _run(spark, src, out)
    _file(spark, src, 1, [(3, 80, "BTC-X", "BTC", 5.0), (4, 130, "BTC-X", "BTC", 6.0), (5, 10, "ETH-X", "ETH", 1.0)])
    with monkeypatch.context() as m:
        def crash(self, path):
            raise OSError("lost")
        m.setattr(closing_stream.Files, "delete", crash)
        with pytest.raises(Exception, match="lost"):
            _run(spark, src, out)
    _file(spark, src, 2, [(6, 200, "BTC-X", "BTC", 7.0), (7, 70, "ETH-X", "ETH", 2.0)])
    got = _run(spark, src, out)
    _same(got, ohlc.futures_ohlc_1min(spark.read.parquet(f"{src}/ticks-*.parquet")))
    assert _run(spark, src, out).count() == got.count()          # nothing new: nothing happens
