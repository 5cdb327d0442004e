"""Data-quality tools: duplicate reports (A10, A11) and keyed dedup.

Skew: a single key may hold a third of all rows.  Dedup is therefore an
aggregation (``min_by`` of the row under a total order) rather than a
``row_number()`` window: the map-side partial aggregate collapses a hot
key to one row per input partition before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Keep the first row per key.

    ``order_by`` is the total order that decides "first" (an ingest
    sequence column in a real table; Spark has no physical row id).  When
    omitted, all non-key columns in schema order are used, which is a
    total order up to fully identical rows.  NULL keys form one group, as
    in the reference.  Ascending order, NULLs first.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by else others
    if not others:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row"))
    return out.select(*keys, "_row.*").select(*df.columns)


def duplicate_groups(df: DataFrame, keys: list[str], count_name: str = "dups") -> DataFrame:
    """A10: keys that occur more than once, with their count (NULL keys form a group)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key is duplicated; a NULL key never matches.

    A semi join against the (aggregated) duplicated keys; a hot key on
    the probe side is split across tasks by AQE's skew-join handling.
    """
    dup_keys = duplicate_groups(df, keys).select(*keys)
    for k in keys:
        dup_keys = dup_keys.where(F.col(k).isNotNull())
    return df.join(dup_keys, keys, "left_semi").select(*df.columns)
