"""Per-currency time bounds ("the last bucket is still open").

A bar is only final once a later tick of the same currency exists, so
each aggregate keeps buckets strictly before the bucket of the newest
tick of its currency.  The bound table has one row per currency; Spark
broadcasts it by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import truncate, ts_type


def currency_bounds(ticks: DataFrame, unit: str, ts: str = "timestamp",
                    by: str = "currency", name: str = "_bound") -> DataFrame:
    """``(currency, start of the newest tick's bucket)``, one row per currency."""
    dtype = ts_type(ticks, ts)
    return (ticks.groupBy(by)
            .agg(F.max(ts).alias("_mx"))
            .select(by, truncate(F.col("_mx"), unit, dtype).alias(name)))


def newest_bounds(newest: DataFrame, unit: str, by: str = "currency", name: str = "_bound") -> DataFrame:
    """The bounds from stored newest times (``by``, newest), a value's greatest one where it has several."""
    dtype = ts_type(newest, "newest")
    return (newest.groupBy(by).agg(F.max("newest").alias("_mx"))
            .select(by, truncate(F.col("_mx"), unit, dtype).alias(name)))


def keep_closed(rows: DataFrame, bounds: DataFrame, bucket_col: str,
                by: str = "currency", name: str = "_bound") -> DataFrame:
    """Rows whose bucket lies before their currency's bound.

    ``ts < bucket(max ts)`` is the same as ``bucket(ts) < bucket(max ts)``
    because the bound is bucket aligned, so the filter can run on the
    (much smaller) aggregated rows.  Rows with a NULL currency drop out,
    like the reference's ``currency = ?`` filter.
    """
    return (rows.join(bounds, by, "inner")
            .where(F.col(bucket_col) < F.col(name))
            .drop(name))


def closed_by_own_max(rows: DataFrame, bucket_col: str, by: str = "currency") -> DataFrame:
    """Drop each currency's newest bucket, using the aggregated rows themselves.

    Valid when every tick of the currency lands in some row of ``rows``
    (then ``max(bucket) = bucket(max ts)``).  Only the bucket column is
    needed for the maxima, one row per currency, but the plan reads the
    ticks once more for it; a caller that knows the newest tick from what is
    stored beside the table uses `newest_bounds` and `keep_closed`.
    """
    mx = rows.groupBy(by).agg(F.max(bucket_col).alias("_bound"))
    return keep_closed(rows, mx, bucket_col, by)
