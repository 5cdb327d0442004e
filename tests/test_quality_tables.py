"""Dedup, duplicate reports, insert-if-absent, resume points, term structures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import quality, tables, term_structure

T0 = datetime(2024, 1, 1, 0, 0)


def test_dedup_hot_key_and_null_key(spark):
    rows = [(1, "a", 3)] * 500 + [(1, "a", 1), (2, "b", 1), (None, "n1", 2), (None, "n0", 2)]
    df = spark.createDataFrame(rows, "k int, v string, seq int")
    got = sorted(quality.dedup_by_key(df, ["k"], ["seq", "v"]).collect(), key=lambda r: str(r.k))
    assert [(r.k, r.v, r.seq) for r in got] == [(1, "a", 1), (2, "b", 1), (None, "n0", 2)]


def test_duplicate_rows_null_never_matches(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, v int")
    assert sorted(r.v for r in quality.duplicate_rows(df, ["k"]).collect()) == [3, 4]
    groups = {r.k: r.dups for r in quality.duplicate_groups(df, ["k"]).collect()}
    assert groups == {None: 2, 1: 2}                          # NULL keys do form a group here


def test_insert_if_absent_semantics(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "x1"), (2, "x0")], "k int, v string")
    out = tables.insert_if_absent(existing, batch, ["k"], ["v"])
    assert sorted(out.collect()) == [(1, "old"), (2, "x0")]
    again = tables.insert_if_absent(out, batch, ["k"], ["v"])   # idempotent
    assert sorted(again.collect()) == sorted(out.collect())


def test_insert_rejects_null_key(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(None, "bad")], "k int, v string")
    with pytest.raises(Exception, match="NULL value in key"):
        tables.insert_if_absent(existing, batch, ["k"]).collect()


def test_write_if_absent_roundtrip(spark, tmp_path):
    path = str(tmp_path / "ts")
    schema = schemas.FUTURES_TERM_STRUCTURE
    rows = [(T0, "BTC", "2w", "count", 1.0), (T0, "BTC", "2w", "volume", 10.0)]
    df = spark.createDataFrame(rows, schema)
    key = schemas.KEYS["futures_term_structure"]
    assert tables.write_if_absent(spark, df, path, key, schema) == 2
    more = spark.createDataFrame(rows + [(T0, "ETH", "2w", "count", 3.0)], schema)
    assert tables.write_if_absent(spark, more, path, key, schema) == 1
    assert spark.read.parquet(path).count() == 3


def test_replace_table_reading_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string").write.parquet(path)
    tables.replace_table(quality.dedup_by_key(spark.read.parquet(path), ["k"]), path)
    assert sorted(spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_resume_points(spark):
    df = spark.createDataFrame([("BTC", T0)], "currency string, timestamp timestamp_ntz")
    got = {r.currency: r.resume_ts for r in tables.resume_points(df, ["BTC", "ETH"]).collect()}
    assert got["BTC"] == T0 + timedelta(milliseconds=1)
    assert got["ETH"] == tables.DEFAULT_START


def _instr(spark, rows):
    data = [(n, 0.5, 0.0, "m", "BTC", "USD", 0.0, "future", e, T0, "USD", 1.0, "BTC")
            for n, e in rows]
    df = spark.createDataFrame(data, schemas.INSTRUMENTS)
    return df.withColumn("expiration_timestamp", df["expiration_timestamp"].cast("timestamp_ntz"))


def test_futures_term_structure_edge_T(spark):
    exp = T0 + timedelta(hours=1)
    ins = _instr(spark, [("BTC-A", T0 + timedelta(seconds=30)), ("BTC-B", exp),
                         ("BTC-PERPETUAL", datetime(1970, 1, 1, 0, 0, 1))])
    data = [("1", T0 + timedelta(seconds=30), "BTC-A", 101.0, 101.0, 1, 100.0, "buy", "BTC"),  # T=0
            ("2", T0 + timedelta(seconds=40), "BTC-A", 101.0, 101.0, 1, 100.0, "buy", "BTC"),  # T<0
            ("3", T0 + timedelta(seconds=50), "BTC-PERPETUAL", 1.0, 1.0, 1, 1.0, "buy", "BTC"),
            ("4", T0 + timedelta(hours=2), "BTC-B", 1.0, 1.0, 1, 1.0, "buy", "BTC")]
    ft = spark.createDataFrame(data, schemas.FUTURE_TRADES)
    ft = ft.withColumn("timestamp", ft["timestamp"].cast("timestamp_ntz"))
    out = {(r.expiry_bucket, r.metric_type): r.metric_value
           for r in term_structure.futures_term_structure(ft, ins).collect()}
    assert out[("2w", "count")] == 2.0 and out[("2w", "volume")] == 2.0   # perpetual excluded
    assert out[("2w", "avg_APR")] == float("inf") or out[("2w", "avg_APR")] != out[("2w", "avg_APR")]


def test_options_unknown_flag_and_delta(spark):
    exp = T0 + timedelta(days=30)
    ins = _instr(spark, [("BTC-X-100-C", exp), ("BTC-X-100-P", exp), ("BTC-X-100-Q", exp)])
    data = [(str(i), T0 + timedelta(minutes=1), n, 0.1, 50.0, 0.1, 2.0, 100.0, "buy", "BTC")
            for i, n in enumerate(["BTC-X-100-C", "BTC-X-100-P", "BTC-X-100-Q"])]
    data.append(("9", T0 + timedelta(hours=3), "BTC-X-100-C", 0.1, 50.0, 0.1, 1.0, 100.0, "buy", "BTC"))
    ot = spark.createDataFrame(data, schemas.OPTION_TRADES)
    ot = ot.withColumn("timestamp", ot["timestamp"].cast("timestamp_ntz"))
    out = term_structure.options_term_structure(ot, ins).where(F.col("metric_type") == "count")
    got = {r.delta_bucket: r.metric_value for r in out.collect()}
    # ATM call delta ~0.52, put ~-0.48 -> both 0.4-0.6; unknown flag -> NULL delta -> 0.8-1
    assert got == {"0.4-0.6": 2.0, "0.8-1": 1.0}
