"""Time buckets and differences.

Bucket helpers keep the input's timestamp flavour: zoneless
``TIMESTAMP_NTZ`` input gives NTZ buckets, ``TIMESTAMP`` gives
``TIMESTAMP``.  All arithmetic assumes the session zone is UTC
(`tickforge.session.ensure_utc`).
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Fixed value: seconds in a 365-day year, the reference's year fraction.
SECONDS_PER_YEAR = 31536000.0


def ts_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


def ts_literal(value, dtype: DataType) -> Column:
    """A point in time as a literal of the column's own type.

    ``value`` is UTC text, a datetime (without a zone: UTC) or a Column.  It
    goes through text, so the driver's own time zone never shifts it, and it
    is folded to a constant that scans can use.
    """
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif isinstance(value, date):
        value = f"{value.isoformat()} 00:00:00"
    return F.lit(str(value)).cast(dtype)


def as_text(col: Column) -> Column:
    """The time as UTC text, to be collected: `ts_literal` reads it back."""
    return col.cast("string")


def truncate(col: Column, unit: str, dtype: DataType) -> Column:
    """Start of the ``unit`` ('minute', 'hour', ...) containing ``col``.

    ``date_trunc`` always returns TIMESTAMP; cast back so NTZ input stays
    NTZ (exact under a UTC session).
    """
    out = F.date_trunc(unit, col)
    return out.cast(dtype) if isinstance(dtype, TimestampNTZType) else out


def bucket(df: DataFrame, name: str, unit: str = "minute") -> Column:
    return truncate(F.col(name), unit, ts_type(df, name))


def epoch_seconds(col: Column) -> Column:
    """Whole seconds since the epoch (floor), for TIMESTAMP or NTZ input."""
    return F.unix_seconds(col.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    Same as the reference's ``date_diff('second', start, end)``:
    ``00.9 -> 01.1`` counts 1 (Spark's ``timestampdiff`` would say 0).
    """
    return epoch_seconds(end) - epoch_seconds(start)


def year_fraction(start: Column, end: Column) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(SECONDS_PER_YEAR)


def plus(col: Column, interval: str) -> Column:
    """``col + INTERVAL <interval>``, e.g. ``plus(c, '1 MINUTE')``."""
    return col + F.expr(f"INTERVAL {interval}")


def format_ts_text(col: Column) -> Column:
    """``2024-01-01 00:00:05.678901+00``: microseconds and UTC offset."""
    return F.date_format(col.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSSx")


def ceil_minute(col: Column, dtype: DataType) -> Column:
    """Smallest minute boundary >= col."""
    t = truncate(col, "minute", dtype)
    return F.when(t == col, t).otherwise(plus(t, "1 MINUTE"))


def last_minute_before(col: Column, dtype: DataType) -> Column:
    """Largest minute boundary strictly < col."""
    return truncate(plus(col, "-1 MICROSECOND"), "minute", dtype)
