"""The macros as SQL table functions."""

import re

import pytest

from tickforge.operators import bars, funding, ohlc
from tickforge.plans import catalog
from tickforge.plans.sql_functions import register_functions
from tickforge.plans.sql_views import register_views
from tickforge.sources import fixtures


@pytest.fixture(scope="module")
def registered(spark, small_dir):
    ft, ot = (fixtures.load(spark, small_dir, n) for n in ("future_trades", "option_trades"))
    tables = {"future_trades": ft, "ohlc_1min_futures": ohlc.futures_ohlc_1min(ft), "ohlc_1min_index": ohlc.index_ohlc_1min(ft, ot)}
    register_views(spark, tables)
    names = register_functions(spark, tables, n_segments=7)
    assert names == ["futures_by_volume", "ohlc_dollar_bars", "funding_volume_weighted"]
    return tables


ARGS = f"'BTC-PERPETUAL', TIMESTAMP_NTZ '{catalog.RANGE_START}', TIMESTAMP_NTZ '{catalog.RANGE_END}'"
RANGE = (["BTC-PERPETUAL"], catalog.RANGE_START, catalog.RANGE_END)


def _rows(df, skip=()):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.drop(*skip).collect())


def test_functions_equal_the_operators(spark, registered):
    ft, minutes = registered["future_trades"], registered["ohlc_1min_futures"]
    got = spark.sql(f"SELECT * FROM futures_by_volume({ARGS}, 700)")
    assert got.columns == ["ts_start", "ts_end", "candle_id", "vwap", "n_trades"]
    assert _rows(got) == _rows(bars.volume_bars(ft, 700, *RANGE), ["instrument_name"]) != []
    got = spark.sql(f"SELECT * FROM ohlc_dollar_bars({ARGS}, 900)")
    assert got.columns == ["ts_start", "ts_end", "high", "low", "close", "vwap", "volume", "n_orders"]
    assert _rows(got) == _rows(bars.ohlc_volume_bars(minutes, 900, *RANGE), ["instrument_name"]) != []
    got = spark.sql(f"SELECT * FROM funding_volume_weighted({ARGS}, 700)")
    assert got.columns == ["ts_start", "ts_end", "vwap", "n_trades", "premium", "funding"]
    want = funding.funding_volume_bars(ft, spark.table("funding_view"), 700, *RANGE)
    assert _rows(got) == _rows(want, ["instrument_name"]) != []


def test_functions_combine_with_sql(spark, registered):
    n = spark.sql(f"SELECT count(*) AS n, sum(n_trades) AS t FROM futures_by_volume({ARGS}, 700) WHERE vwap > 0").first()
    assert n.n > 1 and n.t > n.n
    assert spark.sql("SELECT * FROM futures_by_volume('NOBODY', TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2025-01-01 00:00:00', 5)").count() == 0


def test_no_window_over_all_rows(spark, registered):
    plan = spark.sql(f"SELECT * FROM futures_by_volume({ARGS}, 700)")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    inside = re.findall(r"windowspecdefinition\((\w+)", plan)
    assert any(w.startswith("_seg") for w in inside)
