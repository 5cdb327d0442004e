"""Faults found by probing: driver zone, lost and repeated rows, ties, crashes."""

import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import bars, ohlc, quality, tables
from tickforge.plans import incremental, ingest
from tickforge.sources import fixtures, pages

T0 = datetime(2024, 1, 1)


@pytest.fixture(params=["America/New_York", "Asia/Tokyo"])
def driver_zone(request):
    """The driver's own zone is not UTC while the test runs."""
    before = os.environ.get("TZ")
    os.environ["TZ"] = request.param
    time.tzset()
    yield request.param
    if before is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = before
    time.tzset()


def _flavour(df, ntz):
    return df if ntz else df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


@pytest.mark.parametrize("ntz", [True, False])
def test_bars_split_in_any_driver_zone(spark, small_dir, tmp_path, driver_zone, ntz):
    ft = _flavour(fixtures.load(spark, small_dir, "future_trades"), ntz)
    path = str(tmp_path / "bars")
    cut = F.lit("2024-01-01 03:00:00").cast(ft.schema["timestamp"].dataType)
    incremental.update_futures_ohlc(spark, ft.where(F.col("timestamp") < cut), path)
    incremental.update_futures_ohlc(spark, ft, path)
    got, want = spark.read.parquet(path), ohlc.futures_ohlc_1min(ft)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


@pytest.mark.parametrize("ntz", [True, False])
def test_ranges_are_utc_in_any_driver_zone(spark, small_dir, driver_zone, ntz):
    ft = _flavour(fixtures.load(spark, small_dir, "future_trades"), ntz)
    zoned = datetime(2024, 1, 1, 7, tzinfo=timezone.utc)
    want = ft.where(F.unix_micros(F.col("timestamp").cast("timestamp")) >= int(zoned.timestamp() * 1e6)).count()
    assert want > 0
    for start in (datetime(2024, 1, 1, 7), "2024-01-01 07:00:00", zoned):
        assert bars.volume_bars(ft, 700, start=start).agg(F.sum("n_trades")).first()[0] == want


def test_unreadable_table_is_an_error(spark, small_dir, tmp_path):
    ft = fixtures.load(spark, small_dir, "future_trades")
    path = tmp_path / "bars"
    incremental.update_futures_ohlc(spark, ft, str(path))
    n = spark.read.parquet(str(path)).count()
    good = [f for f in os.listdir(path) if f.endswith(".parquet")]
    (path / "part-99999-broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        incremental.update_futures_ohlc(spark, ft, str(path))
    (path / "part-99999-broken.parquet").unlink()
    assert [f for f in os.listdir(path) if f.endswith(".parquet")] == good and spark.read.parquet(str(path)).count() == n


def test_first_batch_by_trade_id_is_reduced(spark, small_dir, tmp_path):
    one = fixtures.load(spark, small_dir, "future_trades").limit(1)
    page = pages.render_trade_pages(one, "future").select(F.col("_currency").alias("currency"), "page")
    path = str(tmp_path / "t")
    ingest.ingest_trades(spark, page.unionByName(page), "future", path, mode="by_trade_id")
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("bad", ["{", '{"result": {}}', None, '{"result": {"trades": [{"price": "x"}]}}'])
def test_malformed_page_stops_the_job(spark, bad):
    rows = [("BTC", '{"result": {"trades": []}}'), ("BTC", bad)]
    df = spark.createDataFrame(rows, "currency string, page string")
    with pytest.raises(Exception):
        pages.normalize_trades(df, "future").collect()
    assert [r.page for r in pages.bad_pages(df, "future").collect()] == [bad]


def test_ids_are_ordered_as_numbers(spark):
    rows = [(i, T0, "BTC-PERPETUAL", p, p, 1, p, "buy", "BTC") for i, p in (("10", 2.0), ("9", 1.0), ("11", 3.0))]
    rows.append(("12", T0 + timedelta(minutes=5), "BTC-PERPETUAL", 1.0, 1.0, 1, 1.0, "buy", "BTC"))
    df = spark.createDataFrame(rows, schemas.FUTURE_TRADES)
    r = ohlc.futures_ohlc_1min(df).first()
    assert (r.open, r.close) == (1.0, 3.0)
    spot = df.drop("currency").withColumn("amount", F.col("amount").cast("double"))
    assert [(x.open, x.close) for x in ohlc.spot_ohlc_1min(spot).orderBy("bucket").collect()][0] == (1.0, 3.0)


def test_late_ticks_recompute_only_touched_hours(spark, small_dir, tmp_path):
    ft = fixtures.load(spark, small_dir, "future_trades")
    ins = fixtures.load(spark, small_dir, "instruments")
    late = F.xxhash64("trade_id") % 7 == 0
    tables_ = {}
    for how in ("exact", "batch"):
        path = str(tmp_path / how)
        incremental.update_futures_term_structure(spark, ft.where(~late & (F.col("currency") != "SOL")), ins, path)
        more = {"batch": ft.where(late | (F.col("currency") == "SOL"))} if how == "batch" else {}
        incremental.update_futures_term_structure(spark, ft, ins, path, **more)
        tables_[how] = spark.read.parquet(path)
    assert tables_["exact"].count() == tables_["batch"].count() > 0
    assert tables_["exact"].exceptAll(tables_["batch"]).count() == 0


def test_touched_hours_reach_the_scan(spark, small_dir, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    ft = fixtures.load(spark, small_dir, "future_trades")
    path = str(tmp_path / "ticks")
    schema = ingest.table_schema("future_trades")
    tables.append(ft, path, schema, ingest.partitions_of("future_trades"))
    stored = tables.read_table(spark, path, ingest.table_schema("future_trades", dated=True))
    assert stored.count() == ft.count()
    batch = stored.where("currency = 'BTC'").orderBy("timestamp").limit(3)
    pred = incremental.touched_hours(batch, stored.schema["timestamp"].dataType, dates=True)
    plan = stored.where(pred)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "trade_date" in scan.split("PushedFilters")[0] and "GreaterThanOrEqual(timestamp" in scan
    resume = incremental.resume_filter(ohlc.futures_ohlc_1min(ft), timedelta(minutes=1), dates=True)
    plan = stored.where(resume)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "trade_date" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]


def test_crash_while_replacing_keeps_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string").write.parquet(path)
    fails = spark.read.parquet(path).where(F.raise_error(F.lit("lost")).isNull())
    with pytest.raises(Exception):
        tables.replace_table(fails, path)
    assert spark.read.parquet(path).count() == 2
    tables.replace_table(quality.dedup_by_key(spark.read.parquet(path), ["k"]), path, ["k"])
    assert spark.read.parquet(path).count() == 1 and os.path.isdir(f"{path}/k=1")
    assert os.listdir(tmp_path) == ["t"]


def test_update_before_any_feed_has_landed(spark, tmp_path):
    paths = {t: str(tmp_path / t) for t in schemas.TABLES}
    ingest.update(spark, {}, paths)
    assert tables.read_table(spark, paths["ohlc_1min_futures"], ingest.table_schema("ohlc_1min_futures")).count() == 0


def test_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tickforge import session
    none = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(getConf=lambda: {}, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)), master="yarn")
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))
