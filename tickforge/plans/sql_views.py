"""SQL access: the stored tables and the two derived views as temp views.

After ``register_views(spark, tables)`` the reference's SQL keeps working,
e.g. ``SELECT * FROM ohlc_1min_index WHERE currency = 'BTC' LIMIT 100`` or
``SELECT * FROM funding_view``.  The views are lazy DataFrame plans (the
scalable operators), not SQL re-statements.  The three parameterised
macros are SQL table functions too (`sql_functions.register_functions`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.funding import realized_funding
from ..operators.ohlc import spot_ohlc_1min
from ..session import ensure_utc


def register_views(spark: SparkSession, tables: dict[str, DataFrame],
                   spot_fanout: bool = True) -> list[str]:
    """Register ``tables`` by name, plus ``funding_view`` (needs
    ``ohlc_1min_futures`` and ``ohlc_1min_index``) and ``spot_1min_ohlc``
    (needs ``spot_trades``; ``spot_fanout`` keeps the reference's values).
    Returns the registered view names."""
    ensure_utc(spark)
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    if "ohlc_1min_futures" in tables and "ohlc_1min_index" in tables:
        realized_funding(tables["ohlc_1min_futures"], tables["ohlc_1min_index"]) \
            .createOrReplaceTempView("funding_view")
        names.append("funding_view")
    if "spot_trades" in tables:
        spot_ohlc_1min(tables["spot_trades"], fanout=spot_fanout) \
            .createOrReplaceTempView("spot_1min_ohlc")
        names.append("spot_1min_ohlc")
    return names
