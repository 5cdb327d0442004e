"""Structured Streaming bars: closed minutes only, restart from checkpoint, late ticks dropped."""

from datetime import datetime, timedelta

from tickforge import schemas
from tickforge.streaming.ohlc_stream import futures_bars_stream, start_to_parquet

T0 = datetime(2024, 1, 1)


def _write(spark, path, rows):
    data = [(tid, T0 + timedelta(seconds=s), "BTC-PERPETUAL", p, p, 1, 100.0, "buy", "BTC")
            for tid, s, p in rows]
    df = spark.createDataFrame(data, schemas.FUTURE_TRADES)
    df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz")).coalesce(1) \
        .write.mode("append").parquet(path)


def _run(spark, src, out, ckpt):
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = start_to_parquet(futures_bars_stream(stream, "BTC"), out, ckpt)
    q.awaitTermination()
    return {r.bucket: r for r in spark.read.parquet(out).collect()}


def test_stream_emits_closed_minutes_and_resumes(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(spark, src, [("1", 5, 10.0), ("2", 65, 11.0), ("3", 130, 12.0), ("4", 200, 13.0)])
    first = _run(spark, src, out, ckpt)
    assert sorted(first) == [T0, T0 + timedelta(minutes=1), T0 + timedelta(minutes=2)]
    # more ticks: one late for minute 1 (already emitted), others close minute 3
    _write(spark, src, [("5", 70, 99.0), ("6", 210, 14.0), ("7", 250, 15.0)])
    second = _run(spark, src, out, ckpt)
    assert sorted(second) == [T0 + timedelta(minutes=m) for m in range(4)]
    m1 = second[T0 + timedelta(minutes=1)]
    assert m1.n_orders == 1 and m1.high == 11.0                # late tick ignored
    m3 = second[T0 + timedelta(minutes=3)]
    assert (m3.open, m3.close, m3.n_orders) == (13.0, 14.0, 2)   # tick at 250 s: minute 4, still open


def test_one_query_for_all_currencies_closes_on_any_currency(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [("b1", T0 + timedelta(seconds=5), "BTC-PERPETUAL", 1.0, 1.0, 1, 1.0, "buy", "BTC"),
            ("b2", T0 + timedelta(seconds=300), "BTC-PERPETUAL", 2.0, 2.0, 1, 1.0, "buy", "BTC"),
            ("e1", T0 + timedelta(seconds=70), "ETH-PERPETUAL", 3.0, 3.0, 1, 1.0, "buy", "ETH")]
    df = spark.createDataFrame(rows, schemas.FUTURE_TRADES)
    df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz")).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema

    def run(currency, name):
        out, ckpt = str(tmp_path / f"{name}_out"), str(tmp_path / f"{name}_ckpt")
        stream = spark.readStream.schema(schema).parquet(src)
        start_to_parquet(futures_bars_stream(stream, currency), out, ckpt).awaitTermination()
        return sorted((r.currency, r.bucket) for r in spark.read.parquet(out).collect())

    # ETH's only minute is its newest: withheld by its own watermark ...
    assert run("ETH", "eth") == []
    # ... but closed by BTC's later tick when one query serves all currencies.
    assert run(None, "all") == [("BTC", T0), ("ETH", T0 + timedelta(minutes=1))]


def test_term_structure_stream_over_out_of_order_files(spark, small_dir, tmp_path):
    """Four files, one a batch, out of order, with a restart and a repeated file:
    the stored hours are those of one job over all ticks."""
    from pyspark.sql import functions as F

    from tickforge.operators.term_structure import futures_term_structure
    from tickforge.sources import fixtures
    from tickforge.streaming.ohlc_stream import read_stream_like, start_term_structure
    ft = fixtures.load(spark, small_dir, "future_trades").where("not (currency = 'SOL' and hour(timestamp) < 4)")
    ins = fixtures.load(spark, small_dir, "instruments")
    src = tmp_path / "src"
    parts = {0: (0, 3), 1: (6, 9), 2: (3, 6), 3: (9, 24), 4: (9, 24)}

    def land(k):
        low, high = parts[k]
        hour = F.hour("timestamp")
        ft.where((hour >= low) & (hour < high)).coalesce(1).write.mode("append").parquet(str(src))

    def run():
        stream = read_stream_like(spark, ft, str(src), "part-*.parquet", max_files=1)
        start_term_structure(stream, ins, str(tmp_path / "ticks"), str(tmp_path / "hours"), str(tmp_path / "ckpt")).awaitTermination()

    land(0)
    land(1)
    run()
    land(2)
    land(3)
    land(4)
    run()
    assert spark.read.parquet(str(tmp_path / "ticks")).count() == ft.count()
    # sums of doubles may differ in the last bits: the ticks were added in another order
    got, want = (df.withColumn("metric_value", F.round("metric_value", 6)) for df in (
        spark.read.parquet(str(tmp_path / "hours")), futures_term_structure(ft, ins)))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
