"""First/last value by time with a deterministic tie-break.

The reference's ``arg_min(price, timestamp)`` is insertion-order
dependent on equal timestamps; here the order is always a total order
(timestamp first, then a tie-break column such as ``trade_id`` or a
stored ``ingest_seq``).  Ids are numbers in text: a shorter one comes
first, so that "9" is before "10".  Rows whose value is NULL are skipped,
as in the reference engine.

A tie-break of whole numbers (`ingest_seq`) is packed with the time into one
decimal of fixed width, which hash aggregation can keep in place; a text one
needs a struct, for which Spark falls back to object hashing or sorting.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def sequence(tie_break: str) -> list[Column]:
    """Order of ids (text or number): by length, then by value."""
    return [F.length(F.col(tie_break).cast("string")), F.col(tie_break)]


def time_order(df: DataFrame, ts: str, tie_break: str) -> list[Column]:
    """Order of the rows by time, then by ``tie_break``: one column where it is a whole number."""
    if not isinstance(df.schema[tie_break].dataType, IntegralType):
        return [F.col(ts), *sequence(tie_break)]
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    # a time's numbers take 2^64 values; one without a number comes first
    number = F.coalesce(F.col(tie_break).cast("long"), F.lit(-(1 << 63))).cast("decimal(19,0)")
    return [(micros * F.lit(Decimal(1 << 64)) + number).cast("decimal(38,0)")]


def _key(value: Column, order) -> Column:
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    key = order[0] if len(order) == 1 else F.struct(*order)
    return F.when(value.isNotNull() & order[0].isNotNull(), key)


def first_by(value, *order) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, _key(v, order))


def last_by(value, *order) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.max_by(v, _key(v, order))
