"""Ingest jobs: landed exchange pages -> stored tables (the ``update`` command).

The reference downloads pages over HTTP and appends them one page at a
time.  Here the pages are already landed (files of one JSON page per
line); a job normalises all of them at once, keeps only the rows after
each table's resume point (so re-landed pages do not duplicate rows),
numbers them in their order of arrival (``ingest_seq``) and
appends, or inserts by key for the instruments dimension.  ``update``
chains the ingest with the aggregation phase, like the reference's
``main.py update``.

Tick tables are partitioned by currency and day (``trade_date``, derived
from the timestamp), so resuming jobs prune to the days they need.  Times
given without a zone are UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.ordering import sequence
from ..functions.time import ts_literal
from ..operators.commits import finish
from ..operators.tables import (DATE, SEQUENCE, TICK_PARTITIONS, append, ingest_slice, last_number,
                                newest_ticks, note_newest, number_rows, read_table, resume_points, rows_to_insert, within_range, write_if_absent)
from ..session import ensure_checkpoint_dir
from ..sources import pages
from .incremental import make_aggregates

_KIND_TABLE = {"future": "future_trades", "future_combo": "fut_combo_trades",
               "option": "option_trades", "spot": "spot_trades"}


def table_schema(name: str, ntz: bool = True, dated: bool = False, numbered: bool = False):
    """The stored schema: zoneless times with ``ntz``; ``dated`` adds the partition
    column, ``numbered`` the order of arrival."""
    from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampNTZType, TimestampType
    found = StructType([StructField(f.name, TimestampNTZType() if ntz and isinstance(
        f.dataType, TimestampType) else f.dataType, True) for f in schemas.TABLES[name].fields])
    found = found.add(SEQUENCE, LongType()) if numbered else found
    return found.add(DATE, DateType()) if dated else found


def partitions_of(name: str) -> list[str]:
    """Partition columns of a tick table (spot trades have no currency)."""
    return [c for c in TICK_PARTITIONS if c == DATE or c in schemas.TABLES[name].names]


def arrival(rows: DataFrame, schema, otherwise: list) -> list:
    """The order in which a batch's rows arrived.

    By page number and place in the page where the landed pages are numbered;
    else by ``otherwise``, as feeds are requested in order of time.  Rows
    equal in that are ordered by a hash, so a repeated job numbers alike.
    """
    known = [pages.PAGE_NO, pages.POSITION] if pages.PAGE_NO in rows.columns else otherwise
    return [*(F.col(c) if isinstance(c, str) else c for c in known), F.xxhash64(*schema.names)]


def _numbered(rows: DataFrame, schema, last: int, otherwise: list) -> DataFrame:
    """Rows of the schema and their number of arrival, the lineage cut."""
    extra = [c for c in (pages.PAGE_NO, pages.POSITION) if c in rows.columns]
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
    return number_rows(typed, last, arrival(typed, schema, otherwise)).drop(*extra)


def ingest_trades(spark: SparkSession, landed: DataFrame, kind: str, path: str,
                  currencies: list[str] | None = None, end: datetime | None = None,
                  currency_col: str | None = "currency", ntz: bool = True,
                  mode: str = "resume") -> DataFrame:
    """Normalise trade pages of ``kind``, append the rows not stored yet and return them.

    ``landed`` has a ``page`` column (and, except for spot, the currency the
    page was requested for).

    * ``mode="resume"``: rows after the stored table's resume point
      (``max(timestamp) + 1 ms`` per currency, one global point for spot) -
      the reference's cursor; a trade in the same millisecond as the last
      stored one is skipped, as there.
    * ``mode="by_trade_id"``: insert-if-absent on ``trade_id``; exact for
      overlapping pages, in the first batch too.  The stored side of the anti join is limited to
      the batch's time range (a collected literal bound, pushed down).
    """
    if mode not in ("resume", "by_trade_id"):
        raise ValueError("mode must be 'resume' or 'by_trade_id'")
    ensure_checkpoint_dir(spark)
    name = _KIND_TABLE[kind]
    schema = table_schema(name, ntz)
    finish(spark, path)
    rows = pages.normalize_trades(landed, kind, currency_col=None if kind == "spot" else currency_col,
                                  ntz=ntz, arrival="page_no" in landed.columns)
    dtype = rows.schema["timestamp"].dataType
    if end is not None:
        rows = rows.where(F.col("timestamp") <= ts_literal(end, dtype))
    stored = read_table(spark, path, table_schema(name, ntz, dated=True, numbered=True))
    last = last_number(stored)
    if mode == "resume":
        by = None if kind == "spot" else "currency"
        seen = resume_points(stored, by=by) if by else stored.groupBy().agg(
            F.max("timestamp").alias("_mx")).where("_mx is not null").select(
            (F.col("_mx") + F.expr("INTERVAL 1 MILLISECOND")).alias("resume_ts"))
        rows = ingest_slice(rows, seen, end, by=by)
    else:
        stored = within_range(stored, rows, "timestamp")       # a re-landed trade keeps its time
        first = None if pages.PAGE_NO not in rows.columns else [pages.PAGE_NO, pages.POSITION]
        rows = rows_to_insert(stored, rows, ["trade_id"], first)
    # What is stored now is also what the aggregation phase recomputes from;
    # numbering cuts the lineage, as the plan may read the table it appends to.
    rows = _numbered(rows, schema, last, ["timestamp", *sequence("trade_id")])
    append(rows, path, table_schema(name, ntz, numbered=True), partitions_of(name))
    if "currency" in schema.names:
        note_newest(read_table(spark, path, table_schema(name, ntz)), rows, path)
    return rows.select(*schema.names)


def ingest_funding(spark: SparkSession, landed: DataFrame, path: str,
                   currencies: list[str] | None = None, end: datetime | None = None,
                   ntz: bool = True, mode: str = "resume") -> None:
    """Funding pages (``instrument_name``, ``page``) appended with their order of arrival.

    * ``mode="resume"``: rows after each currency's resume point;
    * ``mode="append"``: every landed row, also one stored before, as the
      reference's feed does on each run (`maintenance.dedup_funding_table`
      then keeps the row that arrived first).
    """
    if mode not in ("resume", "append"):
        raise ValueError("mode must be 'resume' or 'append'")
    ensure_checkpoint_dir(spark)
    finish(spark, path)
    rows = pages.normalize_funding(landed, ntz=ntz, arrival="page_no" in landed.columns)
    schema = table_schema("funding_rates", ntz)
    stored = read_table(spark, path, table_schema("funding_rates", ntz, dated=True, numbered=True))
    if mode == "resume":
        rows = ingest_slice(rows, resume_points(stored), end)
    elif end is not None:
        rows = rows.where(F.col("timestamp") <= ts_literal(end, rows.schema["timestamp"].dataType))
    rows = _numbered(rows, schema, last_number(stored), ["timestamp", "currency"])
    append(rows, path, table_schema("funding_rates", ntz, numbered=True), partitions_of("funding_rates"))


def ingest_instruments(spark: SparkSession, landed: DataFrame, path: str,
                       ntz: bool = True) -> int:
    """Instrument pages (``source_rank``, ``page``) inserted if absent by name."""
    rows = pages.normalize_instruments(landed, ntz=ntz)
    ensure_checkpoint_dir(spark)
    schema = table_schema("instruments", ntz)
    return write_if_absent(spark, rows, path, schemas.KEYS["instruments"], schema,
                           assume_unique=True)


def update(spark: SparkSession, landed: dict[str, DataFrame], paths: dict[str, str],
           currencies: list[str] | None = None, end: datetime | None = None,
           exact: bool = False, mode: str = "resume", ntz: bool = True) -> None:
    """Ingest every landed feed, then run the aggregation phase.

    ``landed`` keys: ``future``, ``future_combo``, ``option``, ``spot``
    (trade pages), ``funding`` and ``instruments``; any may be missing, also
    from the first run on.  ``paths`` names the table folders (schemas.TABLES
    keys).  ``exact=True`` recomputes all hours of the term structures, else
    only those that the new ticks touch.
    """
    batches = {}
    for kind in ("future", "future_combo", "option", "spot"):
        if kind in landed:
            name = _KIND_TABLE[kind]
            batches[name] = ingest_trades(spark, landed[kind], kind, paths[name], currencies, end,
                                          ntz=ntz, mode=mode)
    if "funding" in landed:
        ingest_funding(spark, landed["funding"], paths["funding_rates"], currencies, end, ntz)
    if "instruments" in landed:
        ingest_instruments(spark, landed["instruments"], paths["instruments"], ntz)
    ft, ot = (read_table(spark, paths[n], table_schema(n, ntz, dated=True)) for n in ("future_trades", "option_trades"))
    names = ("future_trades", "option_trades")
    none = {n: t.limit(0) for n, t in zip(names, (ft, ot), strict=True)}
    newest = {n: newest_ticks(spark, paths[n], ft.schema["timestamp"].dataType) for n in names}
    make_aggregates(spark, ft, ot, read_table(spark, paths["instruments"], table_schema("instruments", ntz)),
                    paths, exact, None if exact else none | batches, newest)
