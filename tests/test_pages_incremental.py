"""Page normalisers from landed files, ingest slice, table jobs, incremental split."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import ohlc, tables
from tickforge.plans import incremental, maintenance
from tickforge.sources import fixtures, pages

T0 = datetime(2024, 1, 1)
MS0 = 1704067200000


def _write_lines(path, docs):
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_trade_pages_from_landed_files(spark, tmp_path):
    trades = [{"trade_id": "7", "timestamp": MS0 + 1500, "instrument_name": "BTC-PERPETUAL",
               "price": 100.0, "mark_price": 100.5, "amount": 2.5, "index_price": 99.0,
               "direction": "buy", "tick_direction": 3, "liquidation": "M"},      # extra fields
              {"trade_id": "8", "timestamp": MS0 + 2000, "instrument_name": "BTC-PERPETUAL",
               "price": 101.0, "mark_price": 101.0, "amount": 3.5, "index_price": 99.0,
               "direction": "sell"}]
    p = tmp_path / "page.json"
    _write_lines(p, [{"result": {"trades": trades}}, {"result": {"trades": []}}])
    raw = pages.read_pages(spark, str(p)).withColumn("currency", F.lit("BTC"))
    rows = sorted(pages.normalize_trades(raw, "future").collect())
    assert [r.amount for r in rows] == [2, 4]                 # half-to-even: 2.5 -> 2, 3.5 -> 4
    assert rows[0].timestamp == T0 + timedelta(milliseconds=1500)
    assert rows[0].currency == "BTC" and rows[0].mark_price == 100.5
    assert pages.normalize_trades(raw, "future").columns == schemas.FUTURE_TRADES.names
    spot = pages.normalize_trades(raw, "spot")
    assert spot.columns == schemas.SPOT_TRADES.names and spot.first().amount == 2.5


def test_instrument_pages_sentinel_and_rank(spark):
    rec = {f: None for f in schemas.INSTRUMENTS.names}
    perp = dict(rec, instrument_name="BTC-PERPETUAL", kind="future",
                expiration_timestamp=32503708800000, creation_timestamp=MS0, tick_size=0.5)
    live = dict(perp, tick_size=1.0)
    doc = [(0, json.dumps({"result": [perp]})), (1, json.dumps({"result": [live]}))]
    df = spark.createDataFrame(doc, "source_rank int, page string")
    r = pages.normalize_instruments(df).collect()
    assert len(r) == 1 and r[0].tick_size == 0.5               # expired listing applied first
    assert r[0].expiration_timestamp == datetime(1970, 1, 1, 0, 0, 1)


def test_ingest_slice(spark):
    df = spark.createDataFrame([("BTC", T0), ("BTC", T0 + timedelta(hours=1)), ("ETH", T0),
                                ("SOL", T0)], "currency string, timestamp timestamp_ntz")
    resume = spark.createDataFrame([("BTC", T0 + timedelta(minutes=1)), ("ETH", T0)],
                                   "currency string, resume_ts timestamp_ntz")
    got = sorted(tables.ingest_slice(df, resume, end=T0 + timedelta(hours=2)).collect())
    # SOL has nothing stored yet: all of its rows are new
    assert got == [("BTC", T0 + timedelta(hours=1)), ("ETH", T0), ("SOL", T0)]
    later = tables.ingest_slice(df, resume, default_start=T0 + timedelta(minutes=5)).collect()
    assert ("SOL", T0) not in later and ("ETH", T0) in later


def test_dedup_table_job(spark, tmp_path):
    path = str(tmp_path / "funding")
    fr = fixtures.load(spark, "/root/testdata/sf0.001", "funding_rates")
    fr.write.parquet(path)
    before = maintenance.funding_duplicates(spark, path).count()
    assert before > 0
    maintenance.dedup_funding_table(spark, path)
    assert maintenance.funding_duplicates(spark, path).count() == 0
    assert spark.read.parquet(path).count() == fr.select("timestamp", "currency").distinct().count()


@pytest.mark.parametrize("cut_minutes", [37, 200, 455])
def test_incremental_split_equals_one_shot(spark, tmp_path, cut_minutes):
    ft = fixtures.load(spark, "/root/testdata/sf0.001", "future_trades")
    cut = T0 + timedelta(minutes=cut_minutes, seconds=17)
    path = str(tmp_path / f"bars{cut_minutes}")
    incremental.update_futures_ohlc(spark, ft.where(F.col("timestamp") < F.lit(cut)), path)
    incremental.update_futures_ohlc(spark, ft, path)
    incremental.update_futures_ohlc(spark, ft, path)          # re-run adds nothing
    got = spark.read.parquet(path)
    want = ohlc.futures_ohlc_1min(ft)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_register_views_sql(spark):
    from tickforge.plans.sql_views import register_views
    d = "/root/testdata/sf0.001"
    ft = fixtures.load(spark, d, "future_trades")
    ot = fixtures.load(spark, d, "option_trades")
    names = register_views(spark, {
        "future_trades": ft,
        "ohlc_1min_futures": ohlc.futures_ohlc_1min(ft),
        "ohlc_1min_index": ohlc.index_ohlc_1min(ft, ot),
        "spot_trades": fixtures.load(spark, d, "spot_trades")})
    assert {"funding_view", "spot_1min_ohlc"} <= set(names)
    assert spark.sql("SELECT * FROM ohlc_1min_index WHERE currency = 'BTC' LIMIT 100").count() > 0
    assert spark.sql("SELECT currency, count(*) FROM funding_view GROUP BY currency").count() == 2
    assert spark.sql("SELECT max(n_orders) FROM spot_1min_ohlc").first()[0] > 1


@pytest.mark.parametrize("mode", ["resume", "by_trade_id"])
def test_update_from_landed_pages(spark, tmp_path, mode):
    """Landed pages (text files) -> ingest -> aggregation phase; re-landing adds nothing."""
    from tickforge.plans import ingest
    d = "/root/testdata/sf0.001"
    ft = fixtures.load(spark, d, "future_trades")
    ot = fixtures.load(spark, d, "option_trades")
    ins = fixtures.load(spark, d, "instruments")
    land = {}
    for kind, df in [("future", ft), ("option", ot)]:
        p = str(tmp_path / f"landed_{kind}")
        pages.render_trade_pages(df, kind).select(F.to_json(F.struct(
            F.col("_currency").alias("currency"), "page")).alias("v")).write.text(p)
        raw = spark.read.text(p).select(F.from_json("value", "currency string, page string").alias("r"))
        land[kind] = raw.select("r.currency", "r.page")
    land["instruments"] = pages.render_instrument_pages(ins)
    paths = {t: str(tmp_path / t) for t in schemas.TABLES}
    ingest.update(spark, land, paths, mode=mode)
    ingest.update(spark, land, paths, mode=mode)          # same pages again: nothing new
    stored = spark.read.parquet(paths["future_trades"])
    assert stored.count() == ft.count()
    assert spark.read.parquet(paths["instruments"]).count() == ins.count()
    bars = spark.read.parquet(paths["ohlc_1min_futures"])
    assert bars.count() == ohlc.futures_ohlc_1min(stored).count()
    ts = spark.read.parquet(paths["options_term_structure"])
    assert ts.count() > 0 and ts.select(*schemas.KEYS["options_term_structure"]).distinct().count() == ts.count()


def test_cli_setup_and_update(spark, tmp_path):
    from tickforge import __main__ as cli
    d = "/root/testdata/sf0.001"
    landed, tbl = tmp_path / "landed", str(tmp_path / "tables")
    cli.setup(spark, tbl)
    assert spark.read.parquet(f"{tbl}/ohlc_1min_futures").count() == 0
    ft = fixtures.load(spark, d, "future_trades")
    pages.render_trade_pages(ft, "future").select(
        F.to_json(F.struct(F.col("_currency").alias("currency"), "page")).alias("v")
    ).write.text(str(landed / "future"))
    pages.render_trade_pages(fixtures.load(spark, d, "option_trades"), "option").select(
        F.to_json(F.struct(F.col("_currency").alias("currency"), "page")).alias("v")
    ).write.text(str(landed / "option"))
    pages.render_instrument_pages(fixtures.load(spark, d, "instruments")).select(
        F.to_json(F.struct("source_rank", "page")).alias("v")).write.text(str(landed / "instruments"))
    cli.update(spark, str(landed), tbl, "resume")
    assert spark.read.parquet(f"{tbl}/future_trades").count() == ft.count()
    assert spark.read.parquet(f"{tbl}/ohlc_1min_futures").count() == ohlc.futures_ohlc_1min(ft).count()


def test_ingest_funding_twice_adds_nothing(spark, tmp_path):
    from tickforge.plans import ingest
    fr = fixtures.load(spark, "/root/testdata/sf0.001", "funding_rates")
    landed = pages.render_funding_pages(fr)
    path = str(tmp_path / "funding_rates")
    ingest.ingest_funding(spark, landed, path)
    first = spark.read.parquet(path).count()
    ingest.ingest_funding(spark, landed, path)
    assert first == fr.count() and spark.read.parquet(path).count() == first
