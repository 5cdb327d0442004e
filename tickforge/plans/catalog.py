"""Query catalog: every operator as a (spark, sf_dir) -> DataFrame job over
the driver tables; the equivalent DuckDB SQL is in `oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions.time import as_text, ts_literal
from ..operators import bars, funding, ohlc, quality, tables, term_structure
from ..sources import fixtures as fx
from ..sources import pages
from ..session import ensure_utc
from . import oracles

# Parameters of the registered queries (the reference's macros take them
# as arguments; these are the values the catalog runs with).
VOLUME_BIN_TICKS = 2500          # futures amount per tick volume bar
VOLUME_BIN_MINUTES = 25000.0     # futures volume per minute-bar volume bar
FUNDING_VOLUME_BIN = 1500        # futures amount per funding volume bar
LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_EXISTING_BEFORE = "1995-06-17"   # rows shipped before form the stored table
CURRENCIES = ["ETH", "BTC"]              # expected even before they have a row
RANGE_INSTRUMENTS = ["BTC-PERPETUAL", "ETH-PERPETUAL", "SOL-PERPETUAL", "BTC-29MAR24"]
RANGE_START, RANGE_END = "2024-01-01 02:30:00", "2024-01-01 09:15:05"     # inclusive, UTC


def _t(spark, sf_dir, name):
    return fx.load(spark, sf_dir, name)


# ----------------------------------------------------------------------------
# Spark side


def q_futures_ohlc_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.futures_ohlc_1min(_t(spark, sf_dir, "future_trades"))


def q_index_ohlc_1min(spark, sf_dir):
    return ohlc.index_ohlc_1min(_t(spark, sf_dir, "future_trades"),
                                _t(spark, sf_dir, "option_trades"))


def q_spot_ohlc_1min(spark, sf_dir):
    return ohlc.spot_ohlc_1min(_t(spark, sf_dir, "spot_trades"), fanout=False)


def q_spot_ohlc_1min_fanout(spark, sf_dir):
    return ohlc.spot_ohlc_1min(_t(spark, sf_dir, "spot_trades"), fanout=True)


def _funding_minutes(spark, sf_dir):
    ft = _t(spark, sf_dir, "future_trades")
    ot = _t(spark, sf_dir, "option_trades")
    return funding.realized_funding(ohlc.futures_ohlc_1min(ft), ohlc.index_ohlc_1min(ft, ot))


def q_realized_funding(spark, sf_dir):
    return _funding_minutes(spark, sf_dir)


def q_volume_bars(spark, sf_dir):
    return bars.volume_bars(_t(spark, sf_dir, "future_trades"), VOLUME_BIN_TICKS)


def q_ohlc_volume_bars(spark, sf_dir):
    minute = ohlc.futures_ohlc_1min(_t(spark, sf_dir, "future_trades"))
    return bars.ohlc_volume_bars(minute, VOLUME_BIN_MINUTES)


def q_funding_volume_bars(spark, sf_dir):
    return funding.funding_volume_bars(_t(spark, sf_dir, "future_trades"),
                                       _funding_minutes(spark, sf_dir), FUNDING_VOLUME_BIN)


def q_volume_bars_ranged(spark, sf_dir):
    return bars.volume_bars(_t(spark, sf_dir, "future_trades"), VOLUME_BIN_TICKS, RANGE_INSTRUMENTS,
                            RANGE_START, RANGE_END)


def q_ohlc_volume_bars_ranged(spark, sf_dir):
    minute = ohlc.futures_ohlc_1min(_t(spark, sf_dir, "future_trades"))
    return bars.ohlc_volume_bars(minute, VOLUME_BIN_MINUTES, RANGE_INSTRUMENTS, RANGE_START, RANGE_END)


def q_funding_volume_bars_ranged(spark, sf_dir):
    return funding.funding_volume_bars(_t(spark, sf_dir, "future_trades"), _funding_minutes(spark, sf_dir),
                                       FUNDING_VOLUME_BIN, RANGE_INSTRUMENTS, RANGE_START, RANGE_END)


def _macro(spark, sf_dir, function, volume_bin, *, minutes=False, funding_rates=False):
    """The macro as a SQL table function, once for each instrument of the ranged queries."""
    from .sql_functions import register_functions
    ensure_utc(spark)
    ft = _t(spark, sf_dir, "future_trades")
    if funding_rates:
        _funding_minutes(spark, sf_dir).createOrReplaceTempView("funding_view")
    register_functions(spark, {"ohlc_1min_futures": ohlc.futures_ohlc_1min(ft)} if minutes else {"future_trades": ft})
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS instrument_name, * FROM {function}('{name}', TIMESTAMP_NTZ '{RANGE_START}', "
        f"TIMESTAMP_NTZ '{RANGE_END}', {volume_bin})" for name in RANGE_INSTRUMENTS))


def q_sql_futures_by_volume(spark, sf_dir):
    return _macro(spark, sf_dir, "futures_by_volume", VOLUME_BIN_TICKS)


def q_sql_ohlc_dollar_bars(spark, sf_dir):
    return _macro(spark, sf_dir, "ohlc_dollar_bars", VOLUME_BIN_MINUTES, minutes=True)


def q_sql_funding_volume_weighted(spark, sf_dir):
    return _macro(spark, sf_dir, "funding_volume_weighted", FUNDING_VOLUME_BIN, funding_rates=True)


def q_futures_term_structure(spark, sf_dir):
    return term_structure.futures_term_structure(_t(spark, sf_dir, "future_trades"),
                                                 _t(spark, sf_dir, "instruments"))


def q_options_term_structure(spark, sf_dir):
    return term_structure.options_term_structure(_t(spark, sf_dir, "option_trades"),
                                                 _t(spark, sf_dir, "instruments"))


def q_dedup_by_key(spark, sf_dir):
    return quality.dedup_by_key(_t(spark, sf_dir, "lineitem"), LINEITEM_KEY)


def q_dedup_funding(spark, sf_dir):
    """The first stored row of a key: the feed carries its ingest sequence."""
    return quality.dedup_by_key(_t(spark, sf_dir, "funding_feed"), ["timestamp", "currency"], ["ingest_seq"])


def q_dedup_stored_funding(spark, sf_dir):
    """Two ingests into one stored feed, the second with all pages again, then the dedup job:
    the row that arrived first stays, with its number."""
    from ..session import scratch_path
    from . import ingest, maintenance
    path = scratch_path(spark, "dedup_stored_funding")
    feed = _t(spark, sf_dir, "funding_feed").withColumnRenamed("ingest_seq", "page_no")
    for some in (feed.where("page_no % 2 = 0"), feed):
        ingest.ingest_funding(spark, pages.render_funding_pages(some), path, mode="append")
    maintenance.dedup_funding_table(spark, path)
    return tables.read_table(spark, path, ingest.table_schema("funding_rates", dated=True, numbered=True)).drop(tables.DATE)


def q_duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(_t(spark, sf_dir, "funding_rates"), ["timestamp", "currency"])


def q_duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(_t(spark, sf_dir, "lineitem"), LINEITEM_KEY)


def _lineitem_existing(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    stored = li.where(F.col("l_shipdate") < F.to_timestamp_ntz(F.lit(LINEITEM_EXISTING_BEFORE)))
    return quality.dedup_by_key(stored, LINEITEM_KEY), li


def q_insert_if_absent(spark, sf_dir):
    existing, batch = _lineitem_existing(spark, sf_dir)
    return tables.insert_if_absent(existing, batch, LINEITEM_KEY)


def q_resume_points(spark, sf_dir):
    ensure_utc(spark)
    out = None
    for name in ("future_trades", "option_trades"):
        r = tables.resume_points(_t(spark, sf_dir, name), CURRENCIES)
        r = r.select(F.lit(name).alias("table_name"), "currency", "resume_ts")
        out = r if out is None else out.unionByName(r)
    spot = tables.resume_points(_t(spark, sf_dir, "spot_trades"), by=None)
    spot = spot.select(F.lit("spot_trades").alias("table_name"),
                       F.lit(None).cast("string").alias("currency"), "resume_ts")
    return out.unionByName(spot)


def q_normalize_trades(spark, sf_dir):
    """Round trip: trades rendered as exchange pages (JSON text), parsed back."""
    ft = _t(spark, sf_dir, "future_trades")
    page_text = pages.render_trade_pages(ft, kind="future")
    return pages.normalize_trades(page_text, kind="future", currency_col="_currency")


def q_normalize_combo_trades(spark, sf_dir):
    page_text = pages.render_trade_pages(_t(spark, sf_dir, "future_trades"), kind="future_combo")
    return pages.normalize_trades(page_text, kind="future_combo", currency_col="_currency")


def q_normalize_option_trades(spark, sf_dir):
    ot = _t(spark, sf_dir, "option_trades")
    page_text = pages.render_trade_pages(ot, kind="option")
    return pages.normalize_trades(page_text, kind="option", currency_col="_currency")


def q_normalize_spot_trades(spark, sf_dir):
    st = _t(spark, sf_dir, "spot_trades")
    return pages.normalize_trades(pages.render_trade_pages(st, kind="spot"), kind="spot",
                                  currency_col=None)


def q_normalize_funding(spark, sf_dir):
    fr = _t(spark, sf_dir, "funding_rates")
    return pages.normalize_funding(pages.render_funding_pages(fr))


def q_ingest_slice(spark, sf_dir):
    """Landed futures ticks still to ingest, given a store holding the first half."""
    ft = _t(spark, sf_dir, "future_trades")
    stored = ft.where(F.col("timestamp") < _midpoint(ft))
    resume = tables.resume_points(stored, CURRENCIES)
    return tables.ingest_slice(ft, resume)


def q_normalize_instruments(spark, sf_dir):
    ins = _t(spark, sf_dir, "instruments")
    return pages.normalize_instruments(pages.render_instrument_pages(ins))


def _events_stream(spark, sf_dir):
    from ..streaming.ohlc_stream import read_stream_like
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    return fx.map_events(read_stream_like(spark, batch, sf_dir, "event[s].parquet"))


def q_stream_futures_ohlc(spark, sf_dir):
    """One streaming query; each currency closes its own minutes."""
    from ..session import scratch_path
    from ..streaming.closing_stream import read_bars, start_futures_bars
    root = scratch_path(spark, "stream_futures_ohlc")
    start_futures_bars(fx.future_trades_from(_events_stream(spark, sf_dir)), f"{root}/bars", f"{root}/checkpoint").awaitTermination()
    return read_bars(spark, f"{root}/bars")


def q_stream_futures_ohlc_all(spark, sf_dir):
    """One streaming query for all currencies: a minute closes once a tick of
    any currency at/after its end is seen (one read of the source)."""
    from ..session import scratch_path
    from ..streaming.ohlc_stream import futures_bars_stream, start_to_parquet
    ft = fx.future_trades_from(_events_stream(spark, sf_dir))
    root = scratch_path(spark, "stream_futures_ohlc_all")
    start_to_parquet(futures_bars_stream(ft), f"{root}/data", f"{root}/checkpoint",
                     state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(f"{root}/data")


def q_stream_index_ohlc(spark, sf_dir):
    from ..session import scratch_path
    from ..streaming.closing_stream import read_bars, start_index_bars
    ev = _events_stream(spark, sf_dir)
    root = scratch_path(spark, "stream_index_ohlc")
    start_index_bars(fx.future_trades_from(ev), fx.option_trades_from(ev), f"{root}/bars", f"{root}/checkpoint").awaitTermination()
    return read_bars(spark, f"{root}/bars")


def q_stream_term_structure(spark, sf_dir):
    """Ticks streamed into a stored table, its hours inserted if absent batch by batch."""
    from ..session import scratch_path
    from ..streaming.ohlc_stream import start_term_structure
    root = scratch_path(spark, "stream_term_structure")
    ticks = fx.future_trades_from(_events_stream(spark, sf_dir))
    start_term_structure(ticks, _t(spark, sf_dir, "instruments"), f"{root}/ticks", f"{root}/hours",
                         f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/hours")


def q_stream_ingest_trades(spark, sf_dir):
    """Pages landed in three lots, the later ones with pages that had landed before; the stream is
    started for the first lot and started again for the others."""
    from ..session import scratch_path
    from ..streaming.page_stream import read_page_stream, start_ingest
    from . import ingest
    root = scratch_path(spark, "stream_ingest_trades")
    ft = _t(spark, sf_dir, "future_trades")
    landed = pages.render_trade_pages(ft, "future").select(
        F.get_json_object("page", "$.result.trades[0].trade_id").cast("long").alias("page_no"),
        F.col("_currency").alias("currency"), "page")
    lots = [landed.where("page_no % 3 = 0"), landed.where("page_no % 3 < 2"), landed.where("page_no % 3 > 0")]
    for n, runs in ((0, True), (1, False), (2, True)):
        lots[n].write.mode("append").json(f"{root}/landed")
        if runs:
            start_ingest(read_page_stream(spark, f"{root}/landed"), "future", f"{root}/trades", f"{root}/checkpoint").awaitTermination()
    schema = ingest.table_schema("future_trades", dated=True, numbered=True)
    return tables.read_table(spark, f"{root}/trades", schema).drop(tables.DATE, tables.SEQUENCE)


def _midpoint(df):
    """The middle of the ticks' time span, as a literal of their type."""
    middle = df.agg((F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).alias("m"))
    return ts_literal(middle.select(as_text(F.col("m"))).first()[0], df.schema["timestamp"].dataType)


def _incremental(spark, sf_dir, name, run, first=None):
    """Run an update job on some of the ticks (those before the midpoint), then on all."""
    from ..session import scratch_path
    path = scratch_path(spark, name)
    ft, ot = _t(spark, sf_dir, "future_trades"), _t(spark, sf_dir, "option_trades")
    early = F.col("timestamp") < _midpoint(ft)
    early = early if first is None else early & first
    run(ft.where(early), ot.where(early), path)
    run(ft, ot, path)
    return spark.read.parquet(path)


def q_incremental_new_currency(spark, sf_dir):
    """A currency that the first run has not seen keeps all its earlier hours."""
    from . import incremental as inc
    ins = _t(spark, sf_dir, "instruments")
    return _incremental(spark, sf_dir, "incremental_new_currency",
                        lambda ft, ot, p: inc.update_futures_term_structure(spark, ft, ins, p, exact=False),
                        F.col("currency") != "ETH")


def q_incremental_rerun_idempotent(spark, sf_dir):
    """A run over ticks already processed adds nothing."""
    from . import incremental as inc

    def twice(ft, ot, path):
        inc.update_futures_ohlc(spark, ft, path)
        inc.update_futures_ohlc(spark, ft, path)
    return _incremental(spark, sf_dir, "incremental_rerun_idempotent", twice)


def q_incremental_futures_ohlc(spark, sf_dir):
    from . import incremental as inc
    return _incremental(spark, sf_dir, "incremental_futures_ohlc",
                        lambda ft, ot, p: inc.update_futures_ohlc(spark, ft, p))


def q_incremental_index_ohlc(spark, sf_dir):
    from . import incremental as inc
    return _incremental(spark, sf_dir, "incremental_index_ohlc",
                        lambda ft, ot, p: inc.update_index_ohlc(spark, ft, ot, p))


def q_incremental_futures_term_structure(spark, sf_dir):
    from . import incremental as inc
    ins = _t(spark, sf_dir, "instruments")
    return _incremental(spark, sf_dir, "incremental_futures_term_structure",
                        lambda ft, ot, p: inc.update_futures_term_structure(
                            spark, ft, ins, p, exact=False))


def q_incremental_options_term_structure(spark, sf_dir):
    from . import incremental as inc
    ins = _t(spark, sf_dir, "instruments")
    return _incremental(spark, sf_dir, "incremental_options_term_structure",
                        lambda ft, ot, p: inc.update_options_term_structure(
                            spark, ot, ins, p, exact=True))


def _stored_ticks(spark, sf_dir, name, table):
    """The ticks stored by two appends, the newest ones noted after each, and that note."""
    from ..session import scratch_path
    from . import ingest
    ticks, path = _t(spark, sf_dir, table), scratch_path(spark, name)
    middle = _midpoint(ticks)
    stored = None
    for some in (ticks.where(F.col("timestamp") < middle), ticks.where(F.col("timestamp") >= middle)):
        tables.append(some, path, ingest.table_schema(table), tables.TICK_PARTITIONS)
        stored = tables.read_table(spark, path, ingest.table_schema(table, dated=True))
        tables.note_newest(stored, some, path)
    return stored, tables.newest_ticks(spark, path, stored.schema["timestamp"].dataType)


def _numbered_ids(ticks):
    """Ids that are whole numbers, as such: the tie-break of fixed width."""
    return ticks.withColumn("trade_no", F.col("trade_id").cast("long"))


def q_stored_futures_ohlc(spark, sf_dir):
    """Bars of a stored table: one scan, the open minute known from the stored newest ticks."""
    ft, newest = _stored_ticks(spark, sf_dir, "stored_futures", "future_trades")
    return ohlc.futures_ohlc_1min(_numbered_ids(ft), tie_break="trade_no", newest=newest)


def q_stored_index_ohlc(spark, sf_dir):
    ft, of_futures = _stored_ticks(spark, sf_dir, "stored_futures", "future_trades")
    ot, of_options = _stored_ticks(spark, sf_dir, "stored_options", "option_trades")
    return ohlc.index_ohlc_1min(_numbered_ids(ft), _numbered_ids(ot), tie_break="trade_no",
                                newest=of_futures.unionByName(of_options))


def _incremental_batch(spark, sf_dir, name, ticks, update):
    """The update job as `ingest.update` runs it: only the hours that the new ticks touch."""
    from ..session import scratch_path
    path = scratch_path(spark, name)
    ins = _t(spark, sf_dir, "instruments")
    middle = _midpoint(ticks)
    early = ticks.where(F.col("timestamp") < middle)
    update(spark, early, ins, path, exact=False, batch=early)
    update(spark, ticks, ins, path, exact=False, batch=ticks.where(F.col("timestamp") >= middle))
    return tables.read_table(spark, path)


def q_incremental_futures_term_structure_batch(spark, sf_dir):
    from . import incremental as inc
    return _incremental_batch(spark, sf_dir, "futures_hours", _t(spark, sf_dir, "future_trades"), inc.update_futures_term_structure)


def q_incremental_options_term_structure_batch(spark, sf_dir):
    from . import incremental as inc
    return _incremental_batch(spark, sf_dir, "options_hours", _t(spark, sf_dir, "option_trades"), inc.update_options_term_structure)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "futures_ohlc_1min": q_futures_ohlc_1min,
    "index_ohlc_1min": q_index_ohlc_1min,
    "spot_ohlc_1min": q_spot_ohlc_1min,
    "spot_ohlc_1min_fanout": q_spot_ohlc_1min_fanout,
    "realized_funding": q_realized_funding,
    "volume_bars": q_volume_bars,
    "volume_bars_ranged": q_volume_bars_ranged,
    "ohlc_volume_bars": q_ohlc_volume_bars,
    "ohlc_volume_bars_ranged": q_ohlc_volume_bars_ranged,
    "funding_volume_bars": q_funding_volume_bars,
    "funding_volume_bars_ranged": q_funding_volume_bars_ranged,
    "sql_futures_by_volume": q_sql_futures_by_volume,
    "sql_ohlc_dollar_bars": q_sql_ohlc_dollar_bars,
    "sql_funding_volume_weighted": q_sql_funding_volume_weighted,
    "futures_term_structure": q_futures_term_structure,
    "options_term_structure": q_options_term_structure,
    "dedup_by_key": q_dedup_by_key,
    "dedup_funding": q_dedup_funding,
    "dedup_stored_funding": q_dedup_stored_funding,
    "duplicate_groups": q_duplicate_groups,
    "duplicate_rows": q_duplicate_rows,
    "insert_if_absent": q_insert_if_absent,
    "resume_points": q_resume_points,
    "normalize_trades": q_normalize_trades,
    "normalize_combo_trades": q_normalize_combo_trades,
    "normalize_option_trades": q_normalize_option_trades,
    "normalize_instruments": q_normalize_instruments,
    "normalize_spot_trades": q_normalize_spot_trades,
    "normalize_funding": q_normalize_funding,
    "ingest_slice": q_ingest_slice,
    "stream_futures_ohlc": q_stream_futures_ohlc,
    "stream_futures_ohlc_all": q_stream_futures_ohlc_all,
    "stream_index_ohlc": q_stream_index_ohlc,
    "stream_term_structure": q_stream_term_structure,
    "stream_ingest_trades": q_stream_ingest_trades,
    "stored_futures_ohlc": q_stored_futures_ohlc,
    "stored_index_ohlc": q_stored_index_ohlc,
    "incremental_new_currency": q_incremental_new_currency,
    "incremental_rerun_idempotent": q_incremental_rerun_idempotent,
    "incremental_futures_ohlc": q_incremental_futures_ohlc,
    "incremental_index_ohlc": q_incremental_index_ohlc,
    "incremental_futures_term_structure": q_incremental_futures_term_structure,
    "incremental_options_term_structure": q_incremental_options_term_structure,
    "incremental_futures_term_structure_batch": q_incremental_futures_term_structure_batch,
    "incremental_options_term_structure_batch": q_incremental_options_term_structure_batch,
}


def oracle_sql() -> dict[str, str]:
    import sys
    return oracles.oracle_sql(sys.modules[__name__])
