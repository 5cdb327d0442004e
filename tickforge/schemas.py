"""Typed table schemas and key lists.

Column order is part of the contract: stored tables are appended by
position in the reference, so every writer here selects ``schema.names``
before writing.
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, I, L, TS = StringType(), DoubleType(), IntegerType(), LongType(), TimestampType()

FUNDING_RATES = _s(("timestamp", TS), ("index_price", D), ("prev_index_price", D),
                   ("interest_8h", D), ("interest_1h", D),
                   ("instrument_name", S), ("currency", S))

FUTURE_TRADES = _s(("trade_id", S), ("timestamp", TS), ("instrument_name", S),
                   ("price", D), ("mark_price", D), ("amount", I),
                   ("index_price", D), ("direction", S), ("currency", S))

FUT_COMBO_TRADES = FUTURE_TRADES

OPTION_TRADES = _s(("trade_id", S), ("timestamp", TS), ("instrument_name", S),
                   ("price", D), ("iv", D), ("mark_price", D), ("amount", D),
                   ("index_price", D), ("direction", S), ("currency", S))

SPOT_TRADES = _s(("trade_id", S), ("timestamp", TS), ("instrument_name", S),
                 ("price", D), ("mark_price", D), ("amount", D),
                 ("index_price", D), ("direction", S))

INSTRUMENTS = _s(("instrument_name", S), ("tick_size", D), ("taker_commission", D),
                 ("settlement_period", S), ("settlement_currency", S),
                 ("quote_currency", S), ("maker_commission", D), ("kind", S),
                 ("expiration_timestamp", TS), ("creation_timestamp", TS),
                 ("counter_currency", S), ("contract_size", D), ("base_currency", S))

OHLC_1MIN_FUTURES = _s(("instrument_name", S), ("currency", S), ("bucket", TS),
                       ("open", D), ("high", D), ("low", D), ("close", D),
                       ("volume", D), ("n_orders", L), ("pct_buys_count", D),
                       ("pct_buys_volume", D), ("vw_buy_price", D),
                       ("vw_sell_price", D), ("vwap", D), ("vw_diff_index", D),
                       ("median_price", D))

OHLC_1MIN_INDEX = _s(("currency", S), ("bucket", TS), ("open", D), ("high", D),
                     ("low", D), ("close", D), ("obs", L))

FUTURES_TERM_STRUCTURE = _s(("ts_hour", TS), ("currency", S), ("expiry_bucket", S),
                            ("metric_type", S), ("metric_value", D))

OPTIONS_TERM_STRUCTURE = _s(("ts_hour", TS), ("currency", S), ("delta_bucket", S),
                            ("expiry_bucket", S), ("metric_type", S),
                            ("metric_value", D))

TABLES = {
    "funding_rates": FUNDING_RATES,
    "future_trades": FUTURE_TRADES,
    "fut_combo_trades": FUT_COMBO_TRADES,
    "option_trades": OPTION_TRADES,
    "spot_trades": SPOT_TRADES,
    "instruments": INSTRUMENTS,
    "ohlc_1min_futures": OHLC_1MIN_FUTURES,
    "ohlc_1min_index": OHLC_1MIN_INDEX,
    "futures_term_structure": FUTURES_TERM_STRUCTURE,
    "options_term_structure": OPTIONS_TERM_STRUCTURE,
}

# Primary keys (insert-if-absent keys); other tables are keyless.
KEYS = {
    "instruments": ["instrument_name"],
    "futures_term_structure": ["ts_hour", "currency", "expiry_bucket", "metric_type"],
    "options_term_structure": ["ts_hour", "currency", "delta_bucket",
                               "expiry_bucket", "metric_type"],
}

# Dedup key of the funding feed (duplicates arise from re-downloads).
FUNDING_DEDUP_KEY = ["timestamp", "currency"]
