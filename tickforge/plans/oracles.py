"""DuckDB SQL of every catalog query, over the driver's tables.

Written from the operators' definitions (SURVEY section 2): ticks are ranked
explicitly for first and last values, the newest (open) bucket comes from a
window over the currency, the hourly tables aggregate once and are unpivoted.
Equal times are ordered by trade id, a shorter id first.
"""

from __future__ import annotations

from ..functions.labels import (DELTA_EDGES, DELTA_ELSE, FUTURES_EXPIRY_EDGES, FUTURES_EXPIRY_ELSE,
                                OPTIONS_EXPIRY_EDGES, OPTIONS_EXPIRY_ELSE, right_closed_sql)
from ..functions.numeric import norm_cdf_sql
from ..sources import fixtures as fx

TICK_ORDER = "timestamp, length(trade_id), trade_id"


def with_views(views, *blocks) -> str:
    """WITH clause: the fixture views (derived from ``events``) then ``blocks``;
    ``views=None`` leaves the tick tables to the caller (edge-case tests)."""
    head = [] if views is None else [fx.duckdb_views(*views)]
    return "WITH " + ",\n".join([*head, *(b.strip() for b in blocks)]) + "\n"


def ranked(name: str, source: str, value: str, by: str, newest_by: str = "PARTITION BY currency") -> str:
    """Ticks with their minute, place from either end among non-null values, and the open minute."""
    group = f"{by}, date_trunc('minute', timestamp), {value} IS NULL"
    return f"""
{name} AS (
  SELECT *, date_trunc('minute', timestamp) AS bucket,
    {value} IS NOT NULL AND row_number() OVER (PARTITION BY {group} ORDER BY {TICK_ORDER}) = 1 AS is_first,
    {value} IS NOT NULL AND row_number() OVER (PARTITION BY {group}
      ORDER BY timestamp DESC, length(trade_id) DESC, trade_id DESC) = 1 AS is_last,
    max(date_trunc('minute', timestamp)) OVER ({newest_by}) AS open_minute
  FROM {source})"""


def futures_minutes(newest_by: str = "PARTITION BY currency") -> str:
    return ranked("future_ticks", "future_trades", "price", "instrument_name, currency", newest_by) + """,
future_minutes AS (
  SELECT instrument_name, currency, bucket,
    max(price) FILTER (WHERE is_first) AS open, max(price) AS high, min(price) AS low,
    max(price) FILTER (WHERE is_last) AS close,
    sum(amount)::DOUBLE AS volume, count(*) AS n_orders,
    count(*) FILTER (WHERE direction = 'buy') * 100.0::DOUBLE / count(*) AS pct_buys_count,
    sum(if(direction = 'buy', amount, 0)) * 100.0::DOUBLE / sum(amount) AS pct_buys_volume,
    sum(if(direction = 'buy', price * amount, 0)) / nullif(sum(if(direction = 'buy', amount, 0)), 0) AS vw_buy_price,
    sum(if(direction = 'sell', price * amount, 0)) / nullif(sum(if(direction = 'sell', amount, 0)), 0) AS vw_sell_price,
    sum(price * amount) / sum(amount) AS vwap,
    sum((price / index_price - 1) * amount) / sum(amount) AS vw_diff_index,
    quantile_cont(price, 0.5) AS median_price
  FROM future_ticks WHERE currency IS NOT NULL AND bucket < open_minute
  GROUP BY ALL)"""


def index_minutes() -> str:
    both = """(
    SELECT currency, timestamp, trade_id, index_price FROM option_trades
    UNION ALL BY NAME
    SELECT currency, timestamp, trade_id, index_price FROM future_trades)"""
    return ranked("index_ticks", both, "index_price", "currency") + """,
index_minutes AS (
  SELECT currency, bucket, max(index_price) FILTER (WHERE is_first) AS open, max(index_price) AS high,
    min(index_price) AS low, max(index_price) FILTER (WHERE is_last) AS close, count(*) AS obs
  FROM index_ticks WHERE currency IS NOT NULL AND bucket < open_minute
  GROUP BY ALL)"""


def funding_minutes() -> str:
    """Premium of the two default perpetuals and its funding outside a dead band of 2.5 bp, by 480 minutes."""
    return """
premiums AS (
  SELECT m.bucket, i.currency, ln(m.close / i.close) AS diff
  FROM future_minutes m JOIN index_minutes i
    ON i.bucket = m.bucket AND i.currency = split_part(m.instrument_name, '-', 1)
  WHERE m.instrument_name IN ('BTC-PERPETUAL', 'ETH-PERPETUAL')),
funding_minutes AS (
  SELECT *, (greatest(0.00025, diff) + least(-0.00025, diff)) / 480 AS funding FROM premiums)"""


def spot_sql(fanout: bool, views=("spot_trades",)) -> str:
    """Spot minutes; ``fanout`` pairs every tick with every tick of its minute, as the view's joins do."""
    ticks = ranked("spot_ticks", "spot_trades", "price", "instrument_name", "") + f""",
moves AS (
  SELECT *, pow(ln(price / lag(price) OVER (PARTITION BY instrument_name, bucket ORDER BY {TICK_ORDER})), 2) AS move,
    sum(amount) OVER (PARTITION BY instrument_name, bucket) AS minute_amount
  FROM spot_ticks)"""
    pairs = "moves t JOIN moves r USING (instrument_name, bucket)" if fanout else "moves t"
    r = "r" if fanout else "t"
    return with_views(views, ticks) + f"""
SELECT bucket, instrument_name, min(t.timestamp) AS first_trade, max(t.timestamp) AS last_trade,
  max(t.price) FILTER (WHERE t.is_first) AS open, max(t.price) AS high, min(t.price) AS low,
  max(t.price) FILTER (WHERE t.is_last) AS close,
  sum(t.price * t.amount) / sum(t.amount) AS vwap, sum(t.amount) AS volume, count(*) AS n_orders,
  sum({r}.move) AS realized_sq_vol, sum({r}.move * {r}.amount / {r}.minute_amount) AS realized_sq_vol_vw
FROM {pairs} GROUP BY bucket, instrument_name"""


def candles(volume_bin, where: str = "true") -> str:
    """Tick volume bars: the running amount, cut into multiples of the bin."""
    return f"""
numbered AS (
  SELECT *, floor(sum(amount) OVER (PARTITION BY instrument_name ORDER BY timestamp) / {volume_bin})::BIGINT AS candle_id
  FROM future_trades WHERE {where}),
candles AS (
  SELECT instrument_name, candle_id, min(timestamp) AS ts_start, max(timestamp) AS ts_end,
    sum(price * amount) / sum(amount) AS vwap, count(*) AS n_trades
  FROM numbered GROUP BY ALL)"""


def minute_candles(volume_bin, where: str = "true") -> str:
    return f"""
numbered_minutes AS (
  SELECT *, floor(sum(volume) OVER (PARTITION BY instrument_name ORDER BY bucket) / {volume_bin}) AS candle_id
  FROM future_minutes WHERE {where})""" + "", """
SELECT instrument_name, min(bucket) AS ts_start, max(bucket) AS ts_end, max(high) AS high, min(low) AS low,
  last(close ORDER BY bucket) FILTER (WHERE close IS NOT NULL) AS close,
  sum(volume * close) / sum(volume) AS vwap, sum(volume) AS volume, sum(n_orders)::BIGINT AS n_orders
FROM numbered_minutes GROUP BY instrument_name, candle_id"""


def funding_candles(where: str = "true") -> str:
    """Each candle with the funding minutes from its first tick to before its last."""
    return f"""
SELECT c.instrument_name, strftime(c.ts_start, '%Y-%m-%d %H:%M:%S.%f') || '+00' AS ts_start,
  strftime(c.ts_end, '%Y-%m-%d %H:%M:%S.%f') || '+00' AS ts_end, c.vwap, c.n_trades,
  coalesce(sum(f.diff), 0) AS premium, coalesce(sum(f.funding), 0) AS funding
FROM candles c LEFT JOIN (SELECT * FROM funding_minutes WHERE {where}) f
  ON split_part(c.instrument_name, '-', 1) = f.currency AND f.bucket >= c.ts_start AND f.bucket < c.ts_end
GROUP BY c.instrument_name, c.candle_id, c.ts_start, c.ts_end, c.vwap, c.n_trades"""


def _closed_hours(table: str) -> str:
    return (f"(SELECT *, date_trunc('hour', timestamp) AS ts_hour, "
            f"max(date_trunc('hour', timestamp)) OVER (PARTITION BY currency) AS open_hour FROM {table})")


def _long(keys: str, metrics: list[str]) -> str:
    names = ", ".join(f'"{m}"' for m in metrics)
    return f"SELECT {keys}, metric_type, metric_value FROM wide UNPIVOT INCLUDE NULLS (metric_value FOR metric_type IN ({names}))"


def futures_hours(views=("future_trades", "instruments")) -> str:
    rows = f"""
dated AS (
  SELECT h.ts_hour, h.currency, h.amount, h.price / h.index_price - 1 AS premium,
    date_diff('second', h.timestamp, i.expiration_timestamp) / 31536000.0::DOUBLE AS years
  FROM {_closed_hours('future_trades')} h JOIN instruments i USING (instrument_name)
  WHERE h.ts_hour < h.open_hour AND NOT contains(instrument_name, 'PERPETUAL')),
wide AS (
  SELECT ts_hour, currency, {right_closed_sql('years', FUTURES_EXPIRY_EDGES, FUTURES_EXPIRY_ELSE)} AS expiry_bucket,
    sum(premium / years * amount) / sum(amount) AS "vw_APR", avg(premium / years) AS "avg_APR",
    count(*)::DOUBLE AS "count", sum(amount)::DOUBLE AS volume
  FROM dated GROUP BY ALL)"""
    return with_views(views, rows) + _long("ts_hour, currency, expiry_bucket", ["vw_APR", "avg_APR", "count", "volume"])


def options_hours(views=("option_trades", "instruments")) -> str:
    moneyness = "(ln(spot / strike) + 0.5 * pow(sigma, 2) * years) / (sigma * sqrt(years))"
    rows = f"""
quotes AS (
  SELECT h.ts_hour, h.currency, h.amount, h.iv / 100 AS sigma, h.index_price AS spot,
    split_part(h.instrument_name, '-', 3)::DOUBLE AS strike, split_part(h.instrument_name, '-', 4) AS side,
    date_diff('second', h.ts_hour, i.expiration_timestamp) / 31536000.0::DOUBLE AS years
  FROM {_closed_hours('option_trades')} h JOIN instruments i USING (instrument_name)
  WHERE h.ts_hour < h.open_hour),
priced AS (SELECT *, {norm_cdf_sql(moneyness)} AS n_d1 FROM quotes),
sized AS (SELECT *, abs(CASE side WHEN 'C' THEN n_d1 WHEN 'P' THEN n_d1 - 1 END) AS delta_size FROM priced),
wide AS (
  SELECT ts_hour, currency, {right_closed_sql('delta_size', DELTA_EDGES, DELTA_ELSE)} AS delta_bucket,
    {right_closed_sql('years', OPTIONS_EXPIRY_EDGES, OPTIONS_EXPIRY_ELSE)} AS expiry_bucket,
    sum(sigma * amount) / nullif(sum(amount), 0) AS vw_iv, avg(sigma) AS avg_iv,
    count(*)::DOUBLE AS "count", sum(amount)::DOUBLE AS volume
  FROM sized GROUP BY ALL)"""
    return with_views(views, rows) + _long("ts_hour, currency, delta_bucket, expiry_bucket", ["vw_iv", "avg_iv", "count", "volume"])


def first_rows(source: str, columns: list[str], keys: list[str], order: str) -> str:
    return (f"SELECT {', '.join(columns)} FROM {source} "
            f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")


LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
FUNDING = ["timestamp", "index_price", "prev_index_price", "interest_8h", "interest_1h", "instrument_name", "currency"]


def page_json(fields: list[str]) -> str:
    """The record as the page's JSON text, times in milliseconds."""
    parts = [f"'{f}', epoch_ms(timestamp)" if f == "timestamp" else f"'{f}', {f}" for f in fields]
    return f"json_object({', '.join(parts)})"


def parsed_trades(view: str, fields: list[str], kinds: dict[str, str], currency: bool) -> str:
    """Trade pages built as JSON text and read back with JSON functions."""
    def read(f):
        value = f"(page ->> '$.result.trades[0].{f}')"
        return f"make_timestamp({value}::BIGINT * 1000) AS timestamp" if f == "timestamp" else f"{value}::{kinds.get(f, 'DOUBLE')} AS {f}"
    own = ["currency"] if currency else []
    return with_views([view], f"""
pages AS (
  SELECT {', '.join([*own, ''])} json_object('result', json_object('trades', json_array({page_json(fields)})))::VARCHAR AS page
  FROM {view})""") + f"SELECT {', '.join([*map(read, fields), *own])} FROM pages"


def oracle_sql(p) -> dict[str, str]:
    """``p``: the parameters of the queries (the catalog module)."""
    ticks = ["future_trades", "option_trades"]
    names = ", ".join(f"'{n}'" for n in p.RANGE_INSTRUMENTS)

    def ranged(ts):
        return f"instrument_name IN ({names}) AND {ts} BETWEEN TIMESTAMP '{p.RANGE_START}' AND TIMESTAMP '{p.RANGE_END}'"

    bars_of = "SELECT instrument_name, ts_start, ts_end, candle_id, vwap, n_trades FROM candles"
    minutes, whole = minute_candles(p.VOLUME_BIN_MINUTES)
    ranged_minutes, _ = minute_candles(p.VOLUME_BIN_MINUTES, ranged("bucket"))
    order = ", ".join(f"{c} NULLS FIRST" for c in LINEITEM if c not in p.LINEITEM_KEY)
    text = {f: "VARCHAR" for f in ("trade_id", "instrument_name", "direction")}
    fields = ["trade_id", "timestamp", "instrument_name", "price", "mark_price", "amount", "index_price", "direction"]
    options = [*fields[:4], "iv", *fields[4:]]
    stored = f"l_shipdate < TIMESTAMP '{p.LINEITEM_EXISTING_BEFORE}'"
    out = {
        "futures_ohlc_1min": with_views(["future_trades"], futures_minutes()) + "SELECT * FROM future_minutes",
        "index_ohlc_1min": with_views(ticks, index_minutes()) + "SELECT * FROM index_minutes",
        "spot_ohlc_1min": spot_sql(False),
        "spot_ohlc_1min_fanout": spot_sql(True),
        "realized_funding": with_views(ticks, futures_minutes(), index_minutes(), funding_minutes()) + "SELECT * FROM funding_minutes",
        "volume_bars": with_views(["future_trades"], candles(p.VOLUME_BIN_TICKS)) + bars_of,
        "volume_bars_ranged": with_views(["future_trades"], candles(p.VOLUME_BIN_TICKS, ranged("timestamp"))) + bars_of,
        "ohlc_volume_bars": with_views(["future_trades"], futures_minutes(), minutes) + whole,
        "ohlc_volume_bars_ranged": with_views(["future_trades"], futures_minutes(), ranged_minutes) + whole,
        "funding_volume_bars": with_views(ticks, futures_minutes(), index_minutes(), funding_minutes(),
                                          candles(p.FUNDING_VOLUME_BIN)) + funding_candles(),
        "funding_volume_bars_ranged": with_views(
            ticks, futures_minutes(), index_minutes(), funding_minutes(), candles(p.FUNDING_VOLUME_BIN, ranged("timestamp")))
        + funding_candles(f"bucket BETWEEN TIMESTAMP '{p.RANGE_START}' AND TIMESTAMP '{p.RANGE_END}'"),
        "futures_term_structure": futures_hours(),
        "options_term_structure": options_hours(),
        "dedup_by_key": first_rows("lineitem", LINEITEM, p.LINEITEM_KEY, order),
        "dedup_funding": with_views(["funding_feed"]) + first_rows("funding_feed", [*FUNDING, "ingest_seq"],
                                                                     ["timestamp", "currency"], "ingest_seq"),
        "dedup_stored_funding": with_views(["funding_feed"], """
early AS (SELECT * FROM funding_feed WHERE ingest_seq % 2 = 0),
stored AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY ingest_seq) AS ingest_seq) FROM early
  UNION ALL
  SELECT * REPLACE ((SELECT count(*) FROM early) + row_number() OVER (ORDER BY ingest_seq) AS ingest_seq) FROM funding_feed)""")
        + first_rows("stored", [*FUNDING, "ingest_seq"], ["timestamp", "currency"], "ingest_seq"),
        "duplicate_groups": with_views(["funding_rates"]) + """
SELECT timestamp, currency, count(*) AS dups FROM funding_rates GROUP BY ALL HAVING dups > 1""",
        "duplicate_rows": """
SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
        "insert_if_absent": f"""
SELECT {', '.join(LINEITEM)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY {', '.join(p.LINEITEM_KEY)} ORDER BY ({stored}) IS TRUE DESC, {order}) = 1""",
        "resume_points": with_views([*ticks, "spot_trades"], """
expected AS (SELECT unnest(['BTC', 'ETH']) AS currency),
newest AS (
  SELECT 'future_trades' AS table_name, currency, max(timestamp) AS t FROM future_trades GROUP BY ALL
  UNION ALL SELECT 'option_trades', currency, max(timestamp) FROM option_trades GROUP BY ALL
  UNION ALL SELECT 'future_trades', currency, NULL FROM expected
  UNION ALL SELECT 'option_trades', currency, NULL FROM expected
  UNION ALL SELECT 'spot_trades', NULL, max(timestamp) FROM spot_trades)""") + """
SELECT table_name, currency, coalesce(max(t) + INTERVAL 1 MILLISECOND, TIMESTAMP '2022-10-01') AS resume_ts
FROM newest GROUP BY ALL""",
        "normalize_trades": parsed_trades("future_trades", fields, text | {"amount": "INTEGER"}, True),
        "normalize_combo_trades": parsed_trades("future_trades", fields, text | {"amount": "INTEGER"}, True),
        "normalize_option_trades": parsed_trades("option_trades", options, text, True),
        "normalize_spot_trades": parsed_trades("spot_trades", fields, text, False),
        "normalize_instruments": with_views(["instruments"]) + """
SELECT * REPLACE (if(kind = 'option', 0.0, taker_commission)::DOUBLE AS taker_commission) FROM instruments""",
        "normalize_funding": with_views(["funding_rates"], f"""
pages AS (SELECT instrument_name, json_object('result', json_array({page_json(FUNDING[:5])}))::VARCHAR AS page FROM funding_rates)""")
        + "SELECT make_timestamp((page ->> '$.result[0].timestamp')::BIGINT * 1000) AS timestamp, "
        + ", ".join(f"(page ->> '$.result[0].{f}')::DOUBLE AS {f}" for f in FUNDING[1:5])
        + ", instrument_name, split_part(instrument_name, '-', 1) AS currency FROM pages",
        "ingest_slice": with_views(["future_trades"], """
halves AS (
  SELECT *, timestamp < (min(timestamp) OVER () + (max(timestamp) OVER () - min(timestamp) OVER ()) / 2) AS is_stored
  FROM future_trades)""") + """
SELECT * EXCLUDE (is_stored) FROM halves
QUALIFY timestamp >= coalesce(max(timestamp) FILTER (WHERE is_stored) OVER (PARTITION BY currency) + INTERVAL 1 MILLISECOND,
                              TIMESTAMP '2022-10-01')""",
        "stream_futures_ohlc_all": with_views(["future_trades"], futures_minutes("")) + "SELECT * FROM future_minutes",
    }
    # Streams and incremental runs must equal the batch operators on the
    # same closed buckets.
    for a, b in [("stored_futures_ohlc", "futures_ohlc_1min"),
                 ("stored_index_ohlc", "index_ohlc_1min"),
                 ("stream_futures_ohlc", "futures_ohlc_1min"),
                 ("stream_index_ohlc", "index_ohlc_1min"),
                 ("stream_term_structure", "futures_term_structure"),
                 ("incremental_futures_ohlc", "futures_ohlc_1min"),
                 ("incremental_index_ohlc", "index_ohlc_1min"),
                 ("incremental_new_currency", "futures_term_structure"),
                 ("incremental_rerun_idempotent", "futures_ohlc_1min"),
                 ("incremental_futures_term_structure", "futures_term_structure"),
                 ("incremental_options_term_structure", "options_term_structure"),
                 ("incremental_futures_term_structure_batch", "futures_term_structure"),
                 ("incremental_options_term_structure_batch", "options_term_structure"),
                 # pages that land again add nothing
                 ("stream_ingest_trades", "normalize_trades"),
                 # the macros as SQL functions equal the ranged operators
                 ("sql_ohlc_dollar_bars", "ohlc_volume_bars_ranged"),
                 ("sql_funding_volume_weighted", "funding_volume_bars_ranged"),
                 ("sql_futures_by_volume", "volume_bars_ranged")]:
        out[a] = out[b]
    return out
