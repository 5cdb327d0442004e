"""Streaming ingest of landed pages, and keyed inserts that look through the batch's range only."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge.operators import tables
from tickforge.plans import ingest
from tickforge.streaming import page_stream

T0 = datetime(2024, 1, 1)


def _page(number, ids, ccy="BTC"):
    trades = [{"trade_id": str(i), "timestamp": 1704067200000 + 1000 * i, "instrument_name": f"{ccy}-X", "price": 1.0, "mark_price": 1.0,
               "amount": 2.0, "index_price": 1.0, "direction": "buy"} for i in ids]
    return {"page_no": number, "currency": ccy, "page": json.dumps({"result": {"trades": trades}})}


def _land(folder, name, pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))


def _run(spark, tmp_path):
    stream = page_stream.read_page_stream(spark, str(tmp_path / "landed"), max_files=1)
    page_stream.start_ingest(stream, "future", str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    stored = tables.read_table(spark, str(tmp_path / "t"), ingest.table_schema("future_trades", dated=True, numbered=True))
    return [(r.ingest_seq, r.trade_id, r.currency) for r in stored.orderBy("ingest_seq").collect()]


def test_relanded_pages_and_restarts_add_nothing(spark, tmp_path, monkeypatch):
    landed = tmp_path / "landed"
    _land(landed, "a.json", [_page(1, [1, 2]), _page(2, [3])])
    assert _run(spark, tmp_path) == [(1, "1", "BTC"), (2, "2", "BTC"), (3, "3", "BTC")]
    _land(landed, "b.json", [_page(2, [3]), _page(3, [2, 5, 4])])
    real = ingest.append
    with monkeypatch.context() as m:          # the job dies when the batch's rows are stored
        def crash(*args, **kwargs):
            real(*args, **kwargs)
            raise OSError("lost")
        m.setattr(ingest, "append", crash)
        with pytest.raises(Exception, match="lost"):
            _run(spark, tmp_path)
    got = _run(spark, tmp_path)
    assert got == [(1, "1", "BTC"), (2, "2", "BTC"), (3, "3", "BTC"), (4, "5", "BTC"), (5, "4", "BTC")]
    _land(landed, "c.json", [_page(9, [1, 5], "BTC"), _page(10, [70], "ETH")])
    assert _run(spark, tmp_path) == [*got, (6, "70", "ETH")]


def test_insert_looks_through_the_batchs_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = ingest.table_schema("future_trades")
    rows = [(str(i), T0 + timedelta(hours=6 * i), "BTC-X", 1.0, 1.0, 1, 1.0, "buy", "BTC") for i in range(40)]
    all_rows = spark.createDataFrame(rows, schema)
    tables.append(all_rows.where("trade_id <> '33'"), path, schema, tables.TICK_PARTITIONS)
    batch = all_rows.where("cast(trade_id as int) between 31 and 35")
    stored = tables.read_table(spark, path, ingest.table_schema("future_trades", dated=True))
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    plan = tables.within_range(stored, batch, "timestamp")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "trade_date" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert tables.write_if_absent(spark, batch, path, ["trade_id"], schema, partition_by=tables.TICK_PARTITIONS, within="timestamp") == 1
    assert tables.write_if_absent(spark, batch, path, ["trade_id"], schema, partition_by=tables.TICK_PARTITIONS, within="timestamp") == 0
    assert tables.read_table(spark, path, schema).count() == 40
    assert tables.write_if_absent(spark, batch.limit(0), path, ["trade_id"], schema, partition_by=tables.TICK_PARTITIONS, within="timestamp") == 0
