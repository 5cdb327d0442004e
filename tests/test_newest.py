"""Stored newest ticks, and first/last by a time and number of fixed width."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.functions.ordering import first_by, last_by, time_order
from tickforge.operators import ohlc, tables
from tickforge.plans import catalog, incremental, ingest
from tickforge.sources import fixtures, pages

T = datetime(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df):
    """The columns of each scan of ticks."""
    return [c for c in re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(df)) if "newest#" not in c]


def test_futures_bars_scan_the_ticks_once(spark, small_dir):
    assert len(_scans(catalog.QUERIES["stored_futures_ohlc"](spark, small_dir))) == 1


def test_index_bars_hash_the_ticks_and_scan_each_table_once(spark, small_dir):
    df = catalog.QUERIES["stored_index_ohlc"](spark, small_dir)
    assert len(_scans(df)) == 2
    plan = _plan(df)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan
    assert not re.search(r"\bSort\b", plan)


def test_fixed_width_order_equals_the_struct(spark):
    rows = [("a", T, 5, 1.0), ("a", T, -3, 2.0), ("a", T, None, 3.0), ("a", T, 2**63 - 1, 4.0), ("a", T, 7, None),
            ("b", datetime(1969, 12, 31), 2**63 - 1, 1.0), ("b", datetime(1970, 1, 1), -2**63, 2.0), ("b", datetime(9999, 12, 31), 0, 3.0),
            ("c", None, 1, 1.0), ("d", T, None, 8.0)]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz, n long, v double")
    order = time_order(df, "ts", "n")
    assert len(order) == 1 and len(time_order(df.withColumn("n", F.col("n").cast("string")), "ts", "n")) == 3
    got = {r.g: (r.f, r.l) for r in df.groupBy("g").agg(first_by("v", *order).alias("f"), last_by("v", *order).alias("l")).collect()}
    assert got == {"a": (3.0, 4.0), "b": (1.0, 3.0), "c": (None, None), "d": (8.0, 8.0)}


def test_numbers_and_texts_give_the_same_bars(spark, small_dir):
    ft = fixtures.load(spark, small_dir, "future_trades")
    by_text = ohlc.futures_ohlc_1min(ft).select("instrument_name", "bucket", "open", "close")
    by_number = ohlc.futures_ohlc_1min(ft.withColumn("n", F.col("trade_id").cast("long")), tie_break="n")
    assert sorted(map(tuple, by_text.collect())) == sorted(map(tuple, by_number.select(*by_text.columns).collect()))


def _tick(i, minute, currency="BTC"):
    return (str(i), datetime(2024, 1, 1, 0, minute, 1), f"{currency}-X", 1.0, 1.0, 1, 1.0, "buy", currency)


def test_a_crash_before_the_note_closes_no_minute_early(spark, tmp_path, monkeypatch):
    schema, path = ingest.table_schema("future_trades"), str(tmp_path / "t")
    dtype = schema["timestamp"].dataType

    def add(*rows):
        some = spark.createDataFrame(list(rows), schema)
        tables.append(some, path, schema, tables.TICK_PARTITIONS)
        tables.note_newest(tables.read_table(spark, path, schema), some, path)

    def closed():
        bars = ohlc.futures_ohlc_1min(tables.read_table(spark, path, schema), newest=tables.newest_ticks(spark, path, dtype))
        return sorted((r.currency, r.bucket.minute) for r in bars.collect())
    assert tables.newest_ticks(spark, path, dtype) is None
    add(_tick(1, 0), _tick(2, 1), _tick(3, 0, "ETH"))
    assert closed() == [("BTC", 0)]
    with monkeypatch.context() as m:
        m.setattr(tables, "replace_table", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError, match="crash"):
            add(_tick(4, 2), _tick(5, 1, "ETH"))
    assert closed() == [("BTC", 0)]
    add(_tick(6, 3))                                   # an older note only waits
    assert closed() == [("BTC", 0), ("BTC", 1), ("BTC", 2)]
    add(_tick(7, 1), _tick(8, 4, "ETH"))               # late ticks do not take the bound back
    assert closed() == [("BTC", 0), ("BTC", 1), ("BTC", 2), ("ETH", 0), ("ETH", 1)]


def test_a_table_without_a_note_is_read_whole_once(spark, tmp_path):
    schema, path = ingest.table_schema("future_trades"), str(tmp_path / "t")
    tables.append(spark.createDataFrame([_tick(1, 5), _tick(2, 7, "ETH")], schema), path, schema, tables.TICK_PARTITIONS)
    more = spark.createDataFrame([_tick(3, 6)], schema)
    tables.append(more, path, schema, tables.TICK_PARTITIONS)
    tables.note_newest(tables.read_table(spark, path, schema), more, path)
    got = tables.newest_ticks(spark, path, schema["timestamp"].dataType).collect()
    assert sorted((r.currency, r.newest.minute) for r in got) == [("BTC", 6), ("ETH", 7)]


def test_ingest_notes_and_the_update_uses_it(spark, small_dir, tmp_path):
    ft, ot = (fixtures.load(spark, small_dir, n) for n in ("future_trades", "option_trades"))
    paths = {}
    for name, kind, ticks in (("future_trades", "future", ft), ("option_trades", "option", ot)):
        paths[name] = str(tmp_path / name)
        landed = pages.render_trade_pages(ticks, kind)
        landed = landed.select(F.col("_currency").alias("currency"), "page")
        ingest.ingest_trades(spark, landed, kind, paths[name])
    stored = {n: tables.read_table(spark, p, ingest.table_schema(n, dated=True)) for n, p in paths.items()}
    newest = {n: tables.newest_ticks(spark, p, ft.schema["timestamp"].dataType) for n, p in paths.items()}
    for n, ticks in (("future_trades", ft), ("option_trades", ot)):
        want = {r[0]: r[1] for r in ticks.groupBy("currency").agg(F.max("timestamp")).collect()}
        assert {r.currency: r.newest for r in newest[n].collect()} == want
    incremental.update_index_ohlc(spark, *stored.values(), str(tmp_path / "bars"), newest["future_trades"].unionByName(newest["option_trades"]))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    want = ohlc.index_ohlc_1min(ft, ot)
    assert bars.count() == want.count() and want.select("currency", "bucket", "obs").exceptAll(bars.select("currency", "bucket", "obs")).count() == 0
