"""Replacing stored tables in one commit, and rows numbered in their order of arrival."""

import pytest
from pyspark.sql import functions as F

from tickforge.operators import commits, quality, tables
from tickforge.plans import ingest, maintenance
from tickforge.sources import fixtures, pages

OLD, NEW = [(1, "a"), (1, "b"), (2, "c")], [(1, "a"), (2, "c")]


class Crash(Exception):
    pass


def _crashing(monkeypatch, at, after):
    """The file system fails at its call number ``at``, before or after doing it."""
    done = {"n": 0, "armed": True}
    for name in ("delete", "rename", "create"):
        real = getattr(commits.Files, name)

        def call(self, *args, real=real):
            if done["armed"]:
                done["n"] += 1
                if done["n"] == at and not after:
                    raise Crash
                real(self, *args)
                if done["n"] == at:
                    raise Crash
            else:
                real(self, *args)
        monkeypatch.setattr(commits.Files, name, call)
    return done


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("at", range(1, 7))
def test_crash_at_every_step_gives_the_old_or_the_new_table(spark, tmp_path, monkeypatch, at, after):
    path = str(tmp_path / "t")
    spark.createDataFrame(OLD, "k int, v string").write.parquet(path)
    schema = spark.read.parquet(path).schema
    done = _crashing(monkeypatch, at, after)
    try:
        tables.replace_table(quality.dedup_by_key(tables.read_table(spark, path, schema), ["k"]), path)
        crashed = False
    except Crash:
        crashed = True
    done["armed"] = False
    got = sorted(map(tuple, tables.read_table(spark, path, schema).collect()))
    assert got in (OLD, NEW) and (crashed or got == NEW)
    if at > 1:
        assert got == NEW                # the commit itself is the first step after the write
    commits.finish(spark, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == got
    assert [f.name for f in tmp_path.iterdir()] == ["t"]
    tables.append(spark.createDataFrame([(9, "z")], schema), path, schema)
    assert tables.read_table(spark, path, schema).count() == len(got) + 1


def test_a_folder_moved_in_part_is_not_the_table(spark, tmp_path, monkeypatch):
    """A store that renames file by file is cut off half way: the marker tells the whole folder."""
    path = str(tmp_path / "t")
    spark.createDataFrame(OLD, "k int, v string").write.parquet(path)
    schema = spark.read.parquet(path).schema

    def half(self, old, new):
        (tmp_path / "t").mkdir()
        part = next(f for f in (tmp_path / old.rsplit("/", 1)[1]).iterdir() if f.suffix == ".parquet")
        (tmp_path / "t" / part.name).write_bytes(part.read_bytes())
        raise Crash
    with monkeypatch.context() as m:
        m.setattr(commits.Files, "rename", half)
        with pytest.raises(Crash):
            tables.replace_table(spark.createDataFrame(NEW, schema).repartition(3), path)
    assert sorted(map(tuple, tables.read_table(spark, path, schema).collect())) == NEW
    with pytest.raises(OSError, match="open commit"):
        tables.replace_table(spark.createDataFrame(OLD, schema), path)
    commits.finish(spark, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == NEW


def test_first_replace_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not tables.table_exists(spark, path)
    tables.replace_table(spark.createDataFrame(NEW, "k int, v string"), path, ["k"])
    assert tables.table_exists(spark, path) and spark.read.parquet(path).count() == 2 and (tmp_path / "none" / "k=1").is_dir()


def test_numbers_have_no_gaps_and_follow_the_order(spark):
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id").repartition(7)
    got = tables.number_rows(df, 40, [F.col("a"), F.col("id")]).orderBy("a", "id").collect()
    assert [r.ingest_seq for r in got] == list(range(41, 1041))
    assert tables.number_rows(df.limit(0), 40, [F.col("a")]).count() == 0


def test_two_ingests_are_numbered_on(spark, small_dir, tmp_path):
    path = str(tmp_path / "f")
    feed = fixtures.load(spark, small_dir, "funding_feed").withColumnRenamed("ingest_seq", "page_no")
    some = feed.where("page_no % 3 = 0")
    n = some.count()
    ingest.ingest_funding(spark, pages.render_funding_pages(some), path, mode="append")
    ingest.ingest_funding(spark, pages.render_funding_pages(some.drop("page_no")), path)      # nothing new
    ingest.ingest_funding(spark, pages.render_funding_pages(feed), path, mode="append")
    stored = tables.read_table(spark, path, ingest.table_schema("funding_rates", dated=True, numbered=True))
    total = n + feed.count()
    assert sorted(r[0] for r in stored.select("ingest_seq").collect()) == list(range(1, total + 1))
    assert (tmp_path / "f" / "currency=BTC").is_dir()
    before = {(r.timestamp, r.currency): r for r in stored.orderBy(F.desc("ingest_seq")).collect()}
    maintenance.dedup_funding_table(spark, path)
    after = tables.read_table(spark, path, ingest.table_schema("funding_rates", dated=True, numbered=True)).collect()
    assert {(r.timestamp, r.currency): r for r in after} == before and len(after) == len(before)
    assert maintenance.funding_duplicates(spark, path).count() == 0


@pytest.mark.parametrize("mode", ["resume", "by_trade_id"])
def test_trades_are_numbered_by_page_and_position(spark, tmp_path, mode):
    def record(i, ms):
        return f'{{"trade_id":"{i}","timestamp":{ms},"instrument_name":"BTC-X","price":1,"mark_price":1,"amount":1,"index_price":1,"direction":"buy"}}'
    rows = [(2, "BTC", '{"result":{"trades":[' + record(5, 1000) + "," + record(4, 9000) + "]}}"),
            (1, "BTC", '{"result":{"trades":[' + record(7, 8000) + "]}}")]
    path = str(tmp_path / "t")
    for more in (rows, [(3, "BTC", '{"result":{"trades":[' + record(4, 9000) + "," + record(8, 9500) + "]}}")]):
        out = ingest.ingest_trades(spark, spark.createDataFrame(more, "page_no int, currency string, page string"), "future", path, mode=mode)
        assert out.columns == ingest.table_schema("future_trades").names
    stored = tables.read_table(spark, path, ingest.table_schema("future_trades", dated=True, numbered=True))
    assert [(r.ingest_seq, r.trade_id) for r in stored.orderBy("ingest_seq").collect()] == [(1, "7"), (2, "5"), (3, "4"), (4, "8")]
