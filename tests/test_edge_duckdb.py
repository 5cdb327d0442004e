"""Edge cases the driver data never hits, checked against DuckDB itself.

The oracle SQL of the catalog is run in DuckDB on hand-made tick tables
(zero volume, zero index price, NULL prices, one-sided flow, T = 0, T < 0,
unknown option flag) and compared with the Spark operators on the same rows.
"""

import math
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest

from oracle_compare import compare
from tickforge import schemas
from tickforge.operators import ohlc, term_structure
from tickforge.plans import oracles

T0 = datetime(2024, 1, 1)


def _spark_df(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    for f in schema.fields:
        if f.dataType.typeName() == "timestamp":
            df = df.withColumn(f.name, df[f.name].cast("timestamp_ntz"))
    return df


def _duck(tables: dict):
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        pdf = pd.DataFrame(rows, columns=schema.names)
        con.register(f"_{name}", pdf)
        cols = []
        for f in schema.fields:
            t = {"string": "VARCHAR", "double": "DOUBLE", "integer": "INTEGER",
                 "long": "BIGINT", "timestamp": "TIMESTAMP"}[f.dataType.typeName()]
            cols.append(f"CAST({f.name} AS {t}) AS {f.name}")
        con.execute(f"CREATE TABLE {name} AS SELECT {', '.join(cols)} FROM _{name}")
    return con


def _trade(tid, sec, ins, price, amount, index, direction, ccy="BTC"):
    return (tid, T0 + timedelta(seconds=sec), ins, price, price, amount, index, direction, ccy)


FUT_ROWS = [
    _trade("1", 1, "BTC-PERPETUAL", 100.0, 0, 100.0, "buy"),        # zero-volume minute
    _trade("2", 2, "BTC-PERPETUAL", 101.0, 0, 100.0, "buy"),
    _trade("3", 61, "BTC-PERPETUAL", None, 5, 100.0, "sell"),       # NULL price first
    _trade("4", 62, "BTC-PERPETUAL", 99.0, 5, 0.0, "sell"),         # zero index price
    _trade("5", 63, "BTC-PERPETUAL", 98.0, 5, 100.0, "sell"),       # sells only
    _trade("6", 121, "BTC-29MAR24", 100.0, 3, 100.0, "buy"),
    _trade("7", 121, "BTC-29MAR24", 102.0, 3, 100.0, "sell"),       # equal timestamps
    _trade("8", 400, "BTC-29MAR24", 1.0, 1, 1.0, "buy"),            # closes the others
]


def test_futures_bars_edge_cases_match_duckdb(spark):
    s = ohlc.futures_ohlc_1min(_spark_df(spark, FUT_ROWS, schemas.FUTURE_TRADES)).toPandas()
    con = _duck({"future_trades": (FUT_ROWS, schemas.FUTURE_TRADES)})
    o = con.execute(oracles.with_views(None, oracles.futures_minutes()) + "SELECT * FROM future_minutes").df()
    assert compare(s, o) is None
    zero = s[s.bucket == T0].iloc[0]
    assert math.isnan(zero.vwap) and math.isnan(zero.pct_buys_volume)


def _instr(rows):
    return [(n, 0.5, 0.0, "m", "BTC", "USD", 0.0, "future", e, T0, "USD", 1.0, "BTC")
            for n, e in rows]


def test_futures_term_structure_edge_T_matches_duckdb(spark):
    ins = _instr([("BTC-A", T0 + timedelta(seconds=30)), ("BTC-B", T0 + timedelta(days=40)),
                  ("BTC-PERPETUAL", datetime(1970, 1, 1, 0, 0, 1))])
    rows = [_trade("1", 30, "BTC-A", 101.0, 1, 100.0, "buy"),       # T = 0
            _trade("2", 40, "BTC-A", 99.0, 2, 100.0, "buy"),        # T < 0
            _trade("3", 50, "BTC-B", 100.0, 1, 100.0, "buy"),       # apr 0
            _trade("4", 55, "BTC-PERPETUAL", 1.0, 1, 1.0, "buy"),
            _trade("9", 7300, "BTC-B", 1.0, 1, 1.0, "buy")]
    s = term_structure.futures_term_structure(
        _spark_df(spark, rows, schemas.FUTURE_TRADES),
        _spark_df(spark, ins, schemas.INSTRUMENTS)).toPandas()
    con = _duck({"future_trades": (rows, schemas.FUTURE_TRADES),
                 "instruments": (ins, schemas.INSTRUMENTS)})
    o = con.execute(oracles.futures_hours(views=None)).df()
    assert compare(s, o) is None


def test_options_term_structure_edge_cases_match_duckdb(spark):
    exp = T0 + timedelta(hours=1)
    names = ["BTC-X-100-C", "BTC-X-100-P", "BTC-X-100-Q", "BTC-X-0-C"]
    ins = _instr([(n, exp) for n in names] + [("BTC-Y-100-C", T0)])
    rows = [(str(i), T0 + timedelta(minutes=1), n, 0.1, 50.0, 0.1, 2.0, 100.0, "buy", "BTC")
            for i, n in enumerate(names)]
    rows.append(("7", T0 + timedelta(minutes=2), "BTC-Y-100-C", 0.1, 0.0, 0.1, 1.0, 100.0, "buy", "BTC"))
    rows.append(("8", T0 + timedelta(minutes=3), "BTC-X-100-C", 0.1, 60.0, 0.1, 0.0, 100.0, "buy", "BTC"))
    rows.append(("9", T0 + timedelta(hours=3), "BTC-X-100-C", 0.1, 50.0, 0.1, 1.0, 100.0, "buy", "BTC"))
    s = term_structure.options_term_structure(
        _spark_df(spark, rows, schemas.OPTION_TRADES),
        _spark_df(spark, ins, schemas.INSTRUMENTS)).toPandas()
    con = _duck({"option_trades": (rows, schemas.OPTION_TRADES),
                 "instruments": (ins, schemas.INSTRUMENTS)})
    o = con.execute(oracles.options_hours(views=None)).df()
    assert compare(s, o) is None


def test_realized_funding_edge_cases_match_duckdb(spark):
    from tickforge.operators import funding
    ft_rows = [
        _trade("1", 1, "BTC-PERPETUAL", 100.01, 1, 100.0, "buy"),     # inside the dead band
        _trade("2", 61, "BTC-PERPETUAL", 103.0, 1, 100.0, "buy"),     # outside
        _trade("3", 121, "BTC-PERPETUAL", None, 1, 100.0, "buy"),     # NULL close -> NULL diff
        _trade("4", 181, "BTC-PERPETUAL", 97.0, 1, 100.0, "buy"),
        _trade("9", 400, "BTC-29MAR24", 1.0, 1, 100.0, "buy")]
    opt_rows = [("o1", T0 + timedelta(seconds=400), "BTC-X-1-C", 0.1, 50.0, 0.1, 1.0, 100.0, "buy", "BTC")]
    ft = _spark_df(spark, ft_rows, schemas.FUTURE_TRADES)
    ot = _spark_df(spark, opt_rows, schemas.OPTION_TRADES)
    s = funding.realized_funding(ohlc.futures_ohlc_1min(ft), ohlc.index_ohlc_1min(ft, ot)).toPandas()
    con = _duck({"future_trades": (ft_rows, schemas.FUTURE_TRADES),
                 "option_trades": (opt_rows, schemas.OPTION_TRADES)})
    sql = oracles.with_views(None, oracles.futures_minutes(), oracles.index_minutes(), oracles.funding_minutes())
    o = con.execute(sql + "SELECT * FROM funding_minutes").df()
    assert compare(s, o) is None
    null_minute = s[s.bucket == T0 + timedelta(minutes=2)].iloc[0]
    assert pd.isna(null_minute["diff"]) and null_minute.funding == 0.0


@pytest.mark.parametrize("fanout", [False, True])
def test_spot_edge_cases_match_duckdb(spark, fanout):
    rows = [("1", T0 + timedelta(seconds=1), "BTC_USDT", 100.0, 100.0, 0.0, 0.0, "buy"),
            ("2", T0 + timedelta(seconds=2), "BTC_USDT", 101.0, 101.0, 0.0, 0.0, "buy"),   # zero volume
            ("3", T0 + timedelta(seconds=70), "BTC_USDT", 101.0, 101.0, 1.0, 0.0, "buy"),  # one tick
            ("5", T0 + timedelta(seconds=130), "ETH_USDT", 10.0, 10.0, 1.0, 0.0, "buy"),
            ("4", T0 + timedelta(seconds=130), "ETH_USDT", 11.0, 11.0, 2.0, 0.0, "sell"),  # equal time
            ("6", T0 + timedelta(seconds=140), "ETH_USDT", 12.0, 12.0, 1.0, 0.0, "sell")]
    s = ohlc.spot_ohlc_1min(_spark_df(spark, rows, schemas.SPOT_TRADES), fanout=fanout,
                            n_segments=3).toPandas()
    con = _duck({"spot_trades": (rows, schemas.SPOT_TRADES)})
    o = con.execute(oracles.spot_sql(fanout, views=None)).df()
    assert compare(s, o) is None


def test_volume_bars_ties_at_boundary_match_duckdb(spark):
    rows = [_trade(str(i), sec, "BTC-PERPETUAL", 100.0 + i, amt, 100.0, "buy")
            for i, (sec, amt) in enumerate([(1, 4), (2, 3), (2, 3), (3, 10), (4, 1), (4, 9), (5, 2)])]
    from tickforge.operators import bars
    s = bars.volume_bars(_spark_df(spark, rows, schemas.FUTURE_TRADES), 10, n_segments=4).toPandas()
    con = _duck({"future_trades": (rows, schemas.FUTURE_TRADES)})
    o = con.execute(oracles.with_views(None, oracles.candles(10))
                    + "SELECT instrument_name, ts_start, ts_end, candle_id, vwap, n_trades FROM candles").df()
    assert compare(s, o) is None
