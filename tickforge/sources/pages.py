"""Exchange page normalisers.

The reference downloads JSON pages over HTTP and converts them row by row
in pandas.  Here the pages are *landed* files (or any DataFrame holding
the page text), parsed with an explicit schema, exploded and projected
by Spark - the download loop itself is not part of the library.

A page that is not valid JSON of its shape, or lacks its list, stops the job;
`bad_pages` lists such pages, so that they can be set aside on purpose.

Page shapes (only the fields the reference reads are declared; others
are ignored by the explicit schema):
  trades:      {"result": {"trades": [ {...trade...}, ... ]}}
  funding:     {"result": [ {timestamp, index_price, prev_index_price,
                             interest_8h, interest_1h}, ... ]}
  instruments: {"result": [ {13 instrument fields}, ... ]}
Timestamps are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

from .. import schemas
from ..operators.quality import dedup_by_key

# Fixed value: expiration sent for perpetual instruments is far in the
# future; anything above this many epoch-ms is stored as 1 second after
# the epoch.
PERPETUAL_MS_THRESHOLD = 30000000000000
PERPETUAL_STORED_MS = 1000
# Value the exchange sends for a perpetual's expiration (year 3000).
PERPETUAL_SENT_MS = 32503708800000

_TRADE_FIELDS = {
    "future": ["trade_id", "timestamp", "instrument_name", "price", "mark_price", "amount",
               "index_price", "direction"],
    "option": ["trade_id", "timestamp", "instrument_name", "price", "iv", "mark_price",
               "amount", "index_price", "direction"],
    "spot": ["trade_id", "timestamp", "instrument_name", "price", "mark_price", "amount",
             "index_price", "direction"],
}
_TRADE_FIELDS["future_combo"] = _TRADE_FIELDS["future"]
_TARGET = {"future": schemas.FUTURE_TRADES, "future_combo": schemas.FUT_COMBO_TRADES,
           "option": schemas.OPTION_TRADES, "spot": schemas.SPOT_TRADES}

_WIRE_TYPES = {"trade_id": StringType(), "timestamp": LongType(), "instrument_name": StringType(),
               "direction": StringType()}


def _wire(fields) -> StructType:
    return StructType([StructField(f, _WIRE_TYPES.get(f, DoubleType()), True) for f in fields])


TRADE_PAGE = StructType([StructField("result", StructType([
    StructField("trades", ArrayType(_wire(sorted(set(_TRADE_FIELDS["option"])))), True)]), True)])

FUNDING_FIELDS = ["timestamp", "index_price", "prev_index_price", "interest_8h", "interest_1h"]
FUNDING_PAGE = StructType([StructField("result", ArrayType(_wire(FUNDING_FIELDS)), True)])

_INSTR_WIRE = StructType([
    StructField(f.name, LongType() if f.name.endswith("_timestamp") else f.dataType, True)
    for f in schemas.INSTRUMENTS.fields])
INSTRUMENT_PAGE = StructType([StructField("result", ArrayType(_INSTR_WIRE), True)])


def ms_to_ts(ms: Column, ntz: bool = False) -> Column:
    """Epoch milliseconds to timestamp."""
    ts = F.timestamp_millis(ms)
    return ts.cast("timestamp_ntz") if ntz else ts


def expiry_ms_to_ts(ms: Column, ntz: bool = False) -> Column:
    """Perpetual sentinel, then S5."""
    return ms_to_ts(F.when(ms > F.lit(PERPETUAL_MS_THRESHOLD), F.lit(PERPETUAL_STORED_MS))
                    .otherwise(ms), ntz)


def _records(page_col: str, schema: StructType, path: list[str]) -> Column:
    """The page's list of records; a malformed page is an error, not an empty list."""
    found = F.from_json(F.col(page_col), schema, {"mode": "FAILFAST"})
    for name in path:
        found = found[name]
    return F.when(found.isNotNull(), found).otherwise(
        F.raise_error(F.concat(F.lit("malformed page: "), F.coalesce(F.substring(F.col(page_col), 1, 200), F.lit("null")))))


def bad_pages(pages: DataFrame, kind: str, page_col: str = "page") -> DataFrame:
    """The rows whose page the normaliser of ``kind`` would stop at.

    ``kind``: a trade kind, ``funding`` or ``instruments``.
    """
    schema, path = {"funding": (FUNDING_PAGE, ["result"]), "instruments": (INSTRUMENT_PAGE, ["result"])}.get(
        kind, (TRADE_PAGE, ["result", "trades"]))
    marked = StructType([*schema.fields, StructField("_corrupt", StringType(), True)])
    parsed = F.from_json(F.col(page_col), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    found = parsed
    for name in path:
        found = found[name]
    return pages.where(F.col(page_col).isNull() | parsed["_corrupt"].isNotNull() | found.isNull())


def read_pages(spark: SparkSession, path: str, column: str = "page") -> DataFrame:
    """Landed page files, one JSON document per line, as a text column."""
    return spark.read.text(path).withColumnRenamed("value", column)


PAGE_NO, POSITION = "_page_no", "_position"


def _arrival(pages: DataFrame, keep: bool) -> tuple[list[Column], list[str]]:
    """The columns of a record's order of arrival: its page's number (``page_no``), its place in the page."""
    if not keep:
        return [], []
    if "page_no" not in pages.columns:
        raise ValueError("the order of arrival needs the pages' numbers (page_no)")
    return [F.col("page_no").cast("long").alias(PAGE_NO)], [PAGE_NO, POSITION]


def normalize_trades(pages: DataFrame, kind: str, page_col: str = "page",
                     currency_col: str | None = "currency", ntz: bool = True,
                     arrival: bool = False) -> DataFrame:
    """Trade pages to typed rows of the kind's table.

    ``currency_col`` names the page-level column holding the currency the
    page was requested for (not used for spot, which has no currency).
    Futures amounts are rounded half-to-even to int, as the reference's
    engine casts a double.  ``arrival`` keeps the order of arrival as two
    columns.
    """
    target = _TARGET[kind]
    numbers, kept = _arrival(pages, arrival)
    parsed = pages.select(
        *([F.col(currency_col).alias("_ccy")] if currency_col and kind != "spot" else []), *numbers,
        F.posexplode(_records(page_col, TRADE_PAGE, ["result", "trades"])).alias(POSITION, "t"))
    cols = []
    for f in target.fields:
        if f.name == "currency":
            cols.append(F.col("_ccy").alias("currency"))
        elif f.name == "timestamp":
            cols.append(ms_to_ts(F.col("t.timestamp"), ntz).alias("timestamp"))
        elif f.name == "amount" and kind in ("future", "future_combo"):
            cols.append(F.bround(F.col("t.amount")).cast("int").alias("amount"))
        else:
            cols.append(F.col(f"t.{f.name}").cast(f.dataType).alias(f.name))
    return parsed.select(*cols, *kept)


def normalize_funding(pages: DataFrame, page_col: str = "page",
                      instrument_col: str = "instrument_name", ntz: bool = True,
                      arrival: bool = False) -> DataFrame:
    """Funding pages of one perpetual each to ``funding_rates`` rows (``arrival``: see `normalize_trades`)."""
    numbers, kept = _arrival(pages, arrival)
    parsed = pages.select(F.col(instrument_col).alias("_instr"), *numbers,
                          F.posexplode(_records(page_col, FUNDING_PAGE, ["result"])).alias(POSITION, "r"))
    return parsed.select(
        ms_to_ts(F.col("r.timestamp"), ntz).alias("timestamp"),
        F.col("r.index_price").alias("index_price"),
        F.col("r.prev_index_price").alias("prev_index_price"),
        F.col("r.interest_8h").alias("interest_8h"),
        F.col("r.interest_1h").alias("interest_1h"),
        F.col("_instr").alias("instrument_name"),
        F.substring_index(F.col("_instr"), "-", 1).alias("currency"), *kept)


def normalize_instruments(pages: DataFrame, page_col: str = "page",
                          rank_col: str = "source_rank", ntz: bool = True) -> DataFrame:
    """S3: instrument pages (expired listing rank 0, live listing rank 1).

    Pages are applied in rank order and the first row per instrument wins
    (insert-if-absent semantics), decided by (rank, page number, position).
    ``page_no`` is the order in which pages were landed; without such a
    column the page's text decides.
    """
    number = F.col("page_no") if "page_no" in pages.columns else F.col(page_col)
    parsed = pages.select(F.col(rank_col).alias("_rank"), number.alias("_pg"),
                          F.posexplode(_records(page_col, INSTRUMENT_PAGE, ["result"]))
                          .alias("_pos", "r"))
    cols = []
    for f in schemas.INSTRUMENTS.fields:
        c = F.col(f"r.{f.name}")
        cols.append((expiry_ms_to_ts(c, ntz) if f.name.endswith("_timestamp") else c)
                    .alias(f.name))
    rows = parsed.select(*cols, "_rank", "_pg", "_pos")
    first = dedup_by_key(rows, ["instrument_name"], ["_rank", "_pg", "_pos"])
    return first.select(*schemas.INSTRUMENTS.names)


# ---------------------------------------------------------------------------
# Tables as landed pages, one record a page, to give the normalisers input
# that grows with the driver tables: no grouping, no count.


def _epoch_ms(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def _record(fields) -> Column:
    return F.struct(*[(_epoch_ms(F.col(f)) if f == "timestamp" else F.col(f)).alias(f) for f in fields])


def render_trade_pages(trades: DataFrame, kind: str) -> DataFrame:
    """``(_currency, page)`` rows; ``_currency`` is the requested currency."""
    page = F.struct(F.struct(F.array(_record(_TRADE_FIELDS[kind])).alias("trades")).alias("result"))
    ccy = F.col("currency") if "currency" in trades.columns else F.lit(None).cast("string")
    return trades.select(ccy.alias("_currency"), F.to_json(page).alias("page"))


def render_funding_pages(funding: DataFrame) -> DataFrame:
    """``(instrument_name, page)`` rows, one perpetual per page, and their ``page_no`` if given."""
    number = [c for c in ("page_no",) if c in funding.columns]
    return funding.select("instrument_name", *number, F.to_json(F.struct(F.array(_record(FUNDING_FIELDS)).alias("result"))).alias("page"))


def render_instrument_pages(instruments: DataFrame) -> DataFrame:
    """Expired listing (rank 0: options, of no taker commission) and live
    listing (rank 1: all names), so that the rank decides for the options."""
    def ms(name):
        v = _epoch_ms(F.col(name))
        return F.when(F.col(name) == F.lit("1970-01-01 00:00:01").cast(
            instruments.schema[name].dataType), F.lit(PERPETUAL_SENT_MS)).otherwise(v)

    def listing(rows, rank):
        rec = F.struct(*[(ms(f) if f.endswith("_timestamp") else F.col(f)).alias(f) for f in schemas.INSTRUMENTS.names])
        return rows.select(F.lit(rank).alias("source_rank"), F.to_json(F.struct(F.array(rec).alias("result"))).alias("page"))

    expired = instruments.where(F.col("kind") == "option").withColumn("taker_commission", F.lit(0.0))
    return listing(expired, 0).unionByName(listing(instruments, 1))
