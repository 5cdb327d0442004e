"""Market-data tables derived from the driver tables (events, lineitem).

The driver ships no tick data, so the tick tables are *mapped* from the
``events`` table: every event becomes one futures or one options trade
and one spot trade, so the tick tables grow with ``events`` and no row is
dropped.  The same mapping is written twice, once as Spark Columns and
once as DuckDB SQL text (the oracle side), and the two are kept side by
side here so they cannot drift apart.

Mapping (per event):
  * currency ``SOL`` for every eleventh ``user_id``, else ``BTC`` for an
    even one and ``ETH`` for an odd one
  * event time compressed 60x around 2024-01-01 (30 days -> 12 hours), so a
    minute holds several ticks, and cut to 5 seconds, so ticks share a time
    while their ids differ in value and length
  * ``event_id % 3 < 2`` -> futures trade, else options trade
  * futures name ``CCY-PERPETUAL`` when ``user_id % 5 >= 3``, else
    ``CCY-<expiry>``; options name ``CCY-<expiry>-<strike>-<C|P>``
  * spot trade ``CCY_USDT`` for every event
  * funding feed: every event, stamped with its (compressed) minute, so a
    (minute, currency) key repeats and the dedup tools have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import ensure_utc

# Fixed values of the fixture mapping.
ORIGIN_US = 1704067200000000          # 2024-01-01 00:00:00 UTC in microseconds
STEP_US = 5000000                     # ticks' times are whole steps
TIME_COMPRESSION = 60
EXPIRY_CODES = ["02JAN24", "05JAN24", "12JAN24", "26JAN24", "29MAR24", "28JUN24", "27DEC24"]
EXPIRY_TIMES = ["2024-01-02 08:00:00", "2024-01-05 08:00:00", "2024-01-12 08:00:00",
                "2024-01-26 08:00:00", "2024-03-29 08:00:00", "2024-06-28 08:00:00",
                "2024-12-27 08:00:00"]
STRIKES = [900, 950, 1000, 1100, 1300]
PERPETUAL_EXPIRY = "1970-01-01 00:00:01"
CREATION_TIME = "2023-01-01 08:00:00"
BUY_EVENT_TYPES = ["purchase", "click"]


def _case(key: Column, values) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(key == i, F.lit(v)) if out is None else out.when(key == i, F.lit(v))
    return out


def _ntz(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the shared derived columns (lazy; pruned by Catalyst)."""
    ensure_utc(spark)
    return map_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def map_events(ev: DataFrame) -> DataFrame:
    """The shared derived columns; works on a batch or a streaming ``events``."""
    ts = F.timestamp_micros(F.expr(
        f"(unix_micros(cast(ts AS timestamp)) - {ORIGIN_US}) div {TIME_COMPRESSION} div {STEP_US} * {STEP_US} + {ORIGIN_US}"
    )).cast("timestamp_ntz")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("event_id"),
        F.col("user_id"),
        F.col("value"),
        ts.alias("ts2"),
        F.when(F.col("user_id") % 11 == 0, "SOL").when(F.col("user_id") % 2 == 0, "BTC").otherwise("ETH").alias("ccy"),
        _case(eid % 7, EXPIRY_CODES).alias("exp_code"),
        _case(eid % 7, EXPIRY_TIMES).alias("exp_text"),
        F.when(F.col("event_type").isin(*BUY_EVENT_TYPES), "buy").otherwise("sell").alias("dir"),
        (F.lit(1000) + eid % 97).cast("double").alias("idx"),
        (eid % 3 < 2).alias("is_future"),
    )


def _future_name() -> Column:
    return F.when(F.col("user_id") % 5 >= 3, F.concat(F.col("ccy"), F.lit("-PERPETUAL"))) \
        .otherwise(F.concat_ws("-", F.col("ccy"), F.col("exp_code")))


def _option_name() -> Column:
    strike = _case(F.col("event_id") % 5, [str(k) for k in STRIKES])
    cp = F.when(F.col("user_id") % 3 == 0, "P").otherwise("C")
    return F.concat_ws("-", F.col("ccy"), F.col("exp_code"), strike, cp)


def future_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return future_trades_from(events_base(spark, sf_dir))


def future_trades_from(ev: DataFrame) -> DataFrame:
    ev = ev.where(F.col("is_future"))
    price = F.col("value") + F.lit(1000.0)
    return ev.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("ts2").alias("timestamp"),
        _future_name().alias("instrument_name"),
        price.alias("price"),
        price.alias("mark_price"),
        (F.lit(10) * (F.lit(1) + F.col("event_id") % 50)).cast("int").alias("amount"),
        F.col("idx").alias("index_price"),
        F.col("dir").alias("direction"),
        F.col("ccy").alias("currency"),
    )


def option_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_trades_from(events_base(spark, sf_dir))


def option_trades_from(ev: DataFrame) -> DataFrame:
    ev = ev.where(~F.col("is_future"))
    price = F.col("value") / F.lit(1000.0)
    return ev.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("ts2").alias("timestamp"),
        _option_name().alias("instrument_name"),
        price.alias("price"),
        (F.lit(30) + F.col("event_id") % 90).cast("double").alias("iv"),
        price.alias("mark_price"),
        ((F.lit(1) + F.col("event_id") % 50).cast("double") / F.lit(10.0)).alias("amount"),
        F.col("idx").alias("index_price"),
        F.col("dir").alias("direction"),
        F.col("ccy").alias("currency"),
    )


def spot_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_trades_from(events_base(spark, sf_dir))


def spot_trades_from(ev: DataFrame) -> DataFrame:
    price = F.col("value") + F.lit(1000.0)
    return ev.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("ts2").alias("timestamp"),
        F.concat(F.col("ccy"), F.lit("_USDT")).alias("instrument_name"),
        price.alias("price"),
        price.alias("mark_price"),
        ((F.lit(1) + F.col("event_id") % 50).cast("double") / F.lit(10.0)).alias("amount"),
        F.col("idx").alias("index_price"),
        F.col("dir").alias("direction"),
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per traded futures/options name (a distinct over events)."""
    ev = events_base(spark, sf_dir)
    name = F.when(F.col("is_future"), _future_name()).otherwise(_option_name())
    perp = name.endswith("-PERPETUAL")
    kind = F.when(F.col("is_future"), "future").otherwise("option")
    expiry = F.when(perp, _ntz(PERPETUAL_EXPIRY)).otherwise(F.to_timestamp_ntz(F.col("exp_text")))
    base = ev.select(name.alias("instrument_name"), kind.alias("kind"),
                     F.col("ccy").alias("ccy"), expiry.alias("expiration_timestamp"),
                     perp.alias("perp")).distinct()
    return base.select(
        "instrument_name",
        F.lit(0.5).alias("tick_size"),
        F.lit(0.0005).alias("taker_commission"),
        F.when(F.col("perp"), "perpetual").otherwise("month").alias("settlement_period"),
        F.col("ccy").alias("settlement_currency"),
        F.lit("USD").alias("quote_currency"),
        F.lit(0.0).alias("maker_commission"),
        "kind",
        "expiration_timestamp",
        _ntz(CREATION_TIME).alias("creation_timestamp"),
        F.lit("USD").alias("counter_currency"),
        F.when(F.col("kind") == "future", 10.0).otherwise(1.0).alias("contract_size"),
        F.col("ccy").alias("base_currency"),
    )


def funding_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funding feed as stored: ``ingest_seq`` is the order of arrival."""
    ev = events_base(spark, sf_dir)
    minute = F.date_trunc("minute", F.col("ts2")).cast("timestamp_ntz")
    return ev.select(
        minute.alias("timestamp"),
        F.col("value").alias("index_price"),
        F.col("idx").alias("prev_index_price"),
        (F.col("value") / F.lit(10000.0)).alias("interest_8h"),
        (F.col("value") / F.lit(80000.0)).alias("interest_1h"),
        F.concat(F.col("ccy"), F.lit("-PERPETUAL")).alias("instrument_name"),
        F.col("ccy").alias("currency"),
        F.col("event_id").alias("ingest_seq"),
    )


def funding_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funding_feed(spark, sf_dir).drop("ingest_seq")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


LOADERS = {
    "future_trades": future_trades,
    "option_trades": option_trades,
    "spot_trades": spot_trades,
    "instruments": instruments,
    "funding_rates": funding_rates,
    "funding_feed": funding_feed,
    "lineitem": lineitem,
}


_PLANS: dict = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The lazy DataFrame of a fixture table (plans are reused per session).

    Only the logical plan is memoized - no data is cached - so repeated
    queries skip rebuilding the same expressions on the driver.
    """
    ensure_utc(spark)
    jss = spark._jsparkSession
    key = (id(jss), sf_dir, name)
    hit = _PLANS.get(key)
    if hit is None or hit[0] is not jss:     # the entry holds its session: ids cannot be reused
        hit = _PLANS[key] = (jss, LOADERS[name](spark, sf_dir))
    return hit[1]


# ---------------------------------------------------------------------------
# The same mapping as DuckDB SQL (oracle side).  ``events`` and ``lineitem``
# are views the driver registers.


def _sql_case(key: str, values) -> str:
    return "CASE " + " ".join(f"WHEN {key} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_SQL_EV = f"""
ev AS (
  SELECT event_id, user_id, value,
    make_timestamp((epoch_us(ts) - {ORIGIN_US}) // {TIME_COMPRESSION} // {STEP_US} * {STEP_US} + {ORIGIN_US}) AS ts2,
    CASE WHEN user_id % 11 = 0 THEN 'SOL' WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS ccy,
    {_sql_case('event_id % 7', EXPIRY_CODES)} AS exp_code,
    {_sql_case('event_id % 7', EXPIRY_TIMES)} AS exp_text,
    CASE WHEN event_type IN ({", ".join(repr(t) for t in BUY_EVENT_TYPES)}) THEN 'buy' ELSE 'sell' END AS dir,
    CAST(1000 + event_id % 97 AS DOUBLE) AS idx,
    event_id % 3 < 2 AS is_future
  FROM events
)"""

_SQL_FUT_NAME = ("CASE WHEN user_id % 5 >= 3 THEN ccy || '-PERPETUAL' "
                 "ELSE ccy || '-' || exp_code END")
_SQL_OPT_NAME = ("ccy || '-' || exp_code || '-' || "
                 + _sql_case("event_id % 5", [str(k) for k in STRIKES])
                 + " || '-' || CASE WHEN user_id % 3 = 0 THEN 'P' ELSE 'C' END")

_SQL_VIEWS = {
    "future_trades": f"""
future_trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, ts2 AS timestamp,
    {_SQL_FUT_NAME} AS instrument_name,
    value + 1000.0 AS price, value + 1000.0 AS mark_price,
    CAST(10 * (1 + event_id % 50) AS INTEGER) AS amount,
    idx AS index_price, dir AS direction, ccy AS currency
  FROM ev WHERE is_future
)""",
    "option_trades": f"""
option_trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, ts2 AS timestamp,
    {_SQL_OPT_NAME} AS instrument_name,
    value / 1000.0 AS price, CAST(30 + event_id % 90 AS DOUBLE) AS iv,
    value / 1000.0 AS mark_price,
    CAST(1 + event_id % 50 AS DOUBLE) / 10.0 AS amount,
    idx AS index_price, dir AS direction, ccy AS currency
  FROM ev WHERE NOT is_future
)""",
    "spot_trades": """
spot_trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, ts2 AS timestamp,
    ccy || '_USDT' AS instrument_name,
    value + 1000.0 AS price, value + 1000.0 AS mark_price,
    CAST(1 + event_id % 50 AS DOUBLE) / 10.0 AS amount,
    idx AS index_price, dir AS direction
  FROM ev
)""",
    "instruments": f"""
instruments AS (
  SELECT instrument_name, 0.5::DOUBLE AS tick_size, 0.0005::DOUBLE AS taker_commission,
    CASE WHEN perp THEN 'perpetual' ELSE 'month' END AS settlement_period,
    ccy AS settlement_currency, 'USD' AS quote_currency, 0.0::DOUBLE AS maker_commission,
    kind, expiration_timestamp, TIMESTAMP '{CREATION_TIME}' AS creation_timestamp,
    'USD' AS counter_currency,
    CASE WHEN kind = 'future' THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS contract_size,
    ccy AS base_currency
  FROM (
    SELECT DISTINCT
      CASE WHEN is_future THEN {_SQL_FUT_NAME} ELSE {_SQL_OPT_NAME} END AS instrument_name,
      CASE WHEN is_future THEN 'future' ELSE 'option' END AS kind,
      ccy,
      CASE WHEN is_future AND user_id % 5 >= 3 THEN TIMESTAMP '{PERPETUAL_EXPIRY}'
           ELSE CAST(exp_text AS TIMESTAMP) END AS expiration_timestamp,
      is_future AND user_id % 5 >= 3 AS perp
    FROM ev
  )
)""",
    "funding_rates": """
funding_rates AS (
  SELECT date_trunc('minute', ts2) AS timestamp, value AS index_price,
    idx AS prev_index_price, value / 10000.0 AS interest_8h,
    value / 80000.0 AS interest_1h, ccy || '-PERPETUAL' AS instrument_name,
    ccy AS currency
  FROM ev
)""",
}


_SQL_VIEWS["funding_feed"] = _SQL_VIEWS["funding_rates"].replace(
    "funding_rates AS", "funding_feed AS").replace("ccy AS currency", "ccy AS currency, event_id AS ingest_seq")


def duckdb_views(*names: str) -> str:
    """``ev AS (...), future_trades AS (...), ...`` for a WITH clause."""
    parts = [_SQL_EV] + [_SQL_VIEWS[n] for n in names]
    return ",".join(parts)


SCHEMAS = {
    "future_trades": schemas.FUTURE_TRADES,
    "option_trades": schemas.OPTION_TRADES,
    "spot_trades": schemas.SPOT_TRADES,
    "instruments": schemas.INSTRUMENTS,
    "funding_rates": schemas.FUNDING_RATES,
}
