"""Running sums that no hot group can skew.

A window ``PARTITION BY instrument ORDER BY ts`` sends every row of one
instrument to one task; a hot perpetual can hold a third of all rows.  Here
time is cut into *segments*:

1. a histogram of the order column gives segments of equal row counts
   (`segments.equal_segments`); a row finds its segment ``_seg`` by a join
   with the small table of cells;
2. the rows are shuffled once, by (segment, key); peers are summed and an
   ordinary window runs inside each - at most a segment's rows in one task;
3. the sums of the segments before are added from a table of one row per
   (segment, key), so a key's own window has at most ``n_segments`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import Order, equal_segments, micros


def running_sum_points(rows: DataFrame, partition_by: list[str], order_col: str, value_col: str,
                       out: str, aggs: list[Column] | None = None,
                       n_segments: int | None = None) -> DataFrame:
    """``sum(value) OVER (PARTITION BY p ORDER BY order_col)`` per point.

    A point is a distinct (p, order_col): in the default RANGE frame equal
    order values share one running value.  ``aggs`` are the point's other
    aggregates; ``value_col`` becomes the point's sum.  NULL while no
    non-NULL value has been seen yet, as in SQL.
    """
    n = n_segments or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seg = equal_segments(rows, Order([micros(F.col(order_col))]), n).attach(rows)
    # Keys without nulls: the offsets are then joined on the shuffle's own keys.
    part = [f"_part{i}" for i in range(len(partition_by))]
    seg = seg.withColumns({p: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit(""))
                           for p, k in zip(part, partition_by, strict=True)})
    keys = ["_seg", *part]
    points = seg.repartition(n, *keys).groupBy(*keys, *partition_by, order_col).agg(
        F.sum(value_col).alias(value_col), *(aggs or []))
    local = points.withColumn("_local", F.sum(value_col).over(Window.partitionBy(*keys).orderBy(order_col)))
    totals = seg.groupBy(*keys).agg(F.sum(value_col).alias("_seg_total"))
    before = (Window.partitionBy(*part).orderBy("_seg")
              .rowsBetween(Window.unboundedPreceding, -1))
    # one row per (segment, key)
    offsets = totals.select(*keys, F.sum("_seg_total").over(before).alias("_offset"))
    joined = local.join(offsets, keys)
    s, o = F.col("_local"), F.col("_offset")
    total = F.when(s.isNull() & o.isNull(), F.lit(None)).otherwise(
        F.coalesce(o, F.lit(0)) + F.coalesce(s, F.lit(0)))
    return joined.withColumn(out, total).drop(*keys, "_local", "_offset")
