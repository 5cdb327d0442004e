"""Segments of equal row counts over an ordered table, whatever its skew.

Ordered scans (running sums, the previous row) are cut into segments that
can be worked on side by side.  The cuts come from a histogram, not from a
sample, so a segment never holds more than twice its even share:

1. the span of the first order key is divided into ``CELLS`` cells for each
   segment wanted, and the rows of every cell are counted (a small grouped
   sum; the driver gets the cells, at most twice ``CELLS * n``);
2. a cell with more rows than a segment should have is divided again, over
   the span of its own values, and one that holds a single value by the next
   order key - so a hot instant is split by trade id, and identical rows, in
   any order, by ``free``;
3. the leaves, in order, are dealt to segments by the rows before them.

`Segments.attach` gives every row its segment by equi-joins on the cell with
these tables, one join a level (one for evenly spread times); they are
broadcast, as their size depends on the number of segments only.  A row whose
first key is null belongs to segment -1, before all others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 8                # cells for each even share of rows
ID_BYTES, ID_PARTS = 7, 8    # a text id is ordered by its first 56 bytes, 7 to a key


def micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def text_keys(name: str) -> list[Column]:
    """Whole numbers that order texts of equal length as their bytes do."""
    raw = F.coalesce(F.col(name), F.lit("")).cast("binary")
    return [F.coalesce(F.conv(F.hex(F.substring(raw, 1 + k * ID_BYTES, ID_BYTES)), 16, 10).cast("long"), F.lit(-1).cast("long"))
            for k in range(ID_PARTS)]


def ordered_to_the_end(name: str) -> Column:
    """Whether `text_keys` tell a text from every other of its length."""
    return F.octet_length(F.coalesce(F.col(name), F.lit(""))) <= ID_BYTES * ID_PARTS


@dataclass
class Order:
    """Whole-number keys of the row order; rows equal in all of them are copies if ``free`` is not negative."""
    keys: list[Column]
    free: Column | None = None

    def key(self, col: Column, present: set[int]) -> Column:
        """The value of key number ``col``, which is one of ``present``."""
        out = None
        for k in sorted(present):
            if k < len(self.keys):
                out = F.when(col == k, self.keys[k]) if out is None else out.when(col == k, self.keys[k])
            elif self.free is not None:
                spread = F.when(self.free < 0, F.lit(0).cast("long")).otherwise(F.pmod(self.free, F.col("_cells")))
                out = F.when(col == k, spread) if out is None else out.when(col == k, spread)
        return F.lit(None).cast("long") if out is None else out


@dataclass
class Level:
    """node, cell -> its segment, or the node to go on from and how its cells are found."""
    table: pa.Table
    present: set[int]        # keys that the nodes of this level are divided by


@dataclass
class Segments:
    order: Order
    root: tuple[int, int]    # first value and width of the first level's cells
    levels: list[Level]

    def _located(self, df: DataFrame, levels: list[Level]) -> DataFrame:
        """df with ``_seg`` where known, else the node (``_node``) and its division."""
        spark = df.sparkSession
        out = df.withColumns({"_seg": F.lit(None).cast("long"), "_node": F.lit(0).cast("long"), "_col": F.lit(0).cast("long"),
                              "_start": F.lit(self.root[0]).cast("long"), "_width": F.lit(self.root[1]).cast("long"),
                              "_cells": F.lit(0).cast("long")})
        for level in levels:
            own = spark.createDataFrame(level.table)
            out = out.withColumn("_cell", self._cell(level.present))
            same = (F.col("l._node") == F.col("t.at")) & (F.col("l._cell") == F.col("t.cell"))
            kept = [F.col(f"l.`{c}`") for c in df.columns]
            out = out.alias("l").join(F.broadcast(own).alias("t"), same, "left").select(
                *kept, F.coalesce("l._seg", "t.seg").alias("_seg"), F.col("t.node").alias("_node"), F.col("t.col").alias("_col"),
                F.col("t.start").alias("_start"), F.col("t.width").alias("_width"), F.col("t.cells").alias("_cells"))
        return out

    def _cell(self, present: set[int]) -> Column:
        return F.call_function("div", self.order.key(F.col("_col"), present) - F.col("_start"), F.col("_width"))

    def attach(self, df: DataFrame, name: str = "_seg") -> DataFrame:
        """df with the segment number of each row."""
        if not self.levels:
            return df.withColumn(name, F.lit(0).cast("long"))
        out = self._located(df, self.levels)
        lost = F.raise_error(F.lit("a row that the histogram has not seen: the input changed between two reads")).cast("long")
        seg = F.when(self.order.keys[0].isNull(), F.lit(-1).cast("long")).otherwise(F.coalesce("_seg", lost))
        seg = F.coalesce(seg, F.lit(-1).cast("long"))         # never null, as its joins may rely on
        return out.select(*[F.col(f"`{c}`") for c in df.columns], seg.alias(name))


def equal_segments(df: DataFrame, order: Order, n: int) -> Segments:
    """Some ``n`` segments of ``df`` in the given order, each at most twice the even share."""
    none = Segments(order, (0, 1), [])
    if n < 2:
        return none
    first = order.keys[0]
    total, low, high = df.agg(F.count(first), F.min(first), F.max(first)).first()
    if not total:
        return none
    even = -(-total // n)

    def width(low, high, rows):
        return max(1, -(-(int(high) - int(low) + 1) // (CELLS * -(-int(rows) // even))))

    found = Segments(order, (int(low), width(low, high, total)), [])
    last = len(order.keys) - (order.free is None)        # the last key's number
    col_of, paths, present = np.zeros(1, np.int64), np.zeros((1, 0), np.int64), {0}
    free_cells = np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray, int, np.ndarray]] = []      # path, rows, level, place in its table
    raw: list[dict] = []
    while True:
        there = found._located(df, found.levels).where(F.col("_node").isNotNull())
        if not found.levels:
            there = there.where(first.isNotNull())
        key, after = order.key(F.col("_col"), present), order.key(F.col("_col") + 1, {p + 1 for p in present if p + 1 < len(order.keys)})
        hist = (there.select("_node", found._cell(present).alias("cell"), key.alias("k"), after.alias("x"))
                .groupBy("_node", "cell").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"),
                                              F.min("x").alias("next_low"), F.max("x").alias("next_high")).toArrow())
        node, cell, rows, low, high = (hist.column(k).to_numpy() for k in ("_node", "cell", "n", "low", "high"))
        next_low, next_high = (hist.column(k).fill_null(0).to_numpy() for k in ("next_low", "next_high"))
        free = col_of[node] == len(order.keys) if len(node) else np.zeros(0, bool)
        if free.any():                       # any cell may come up when the rows are read again
            node, cell, rows, low, high, next_low, next_high = _all_cells(
                free_cells, node, cell, rows, low, high, next_low, next_high, free)
            free = col_of[node] == len(order.keys)
        col = col_of[node]
        heavy = (rows > even) & ~free & ((low < high) | (col < last))
        level = {"at": node, "cell": cell, "seg": np.full(len(node), -1), "node": np.full(len(node), -1), "col": np.zeros(len(node), np.int64),
                 "start": np.zeros(len(node), np.int64), "width": np.ones(len(node), np.int64), "cells": np.zeros(len(node), np.int64)}
        level["node"][heavy] = np.arange(heavy.sum())
        for i in np.flatnonzero(heavy):
            if low[i] < high[i]:
                level["col"][i], level["start"][i], level["width"][i] = col[i], low[i], width(low[i], high[i], rows[i])
            elif col[i] + 1 < len(order.keys):
                level["col"][i], level["start"][i], level["width"][i] = col[i] + 1, next_low[i], width(next_low[i], next_high[i], rows[i])
            else:
                level["col"][i], level["cells"][i] = len(order.keys), CELLS * -(-int(rows[i]) // even)
        own = np.hstack([paths[node], cell[:, None]])
        light = np.flatnonzero(~heavy)
        leaves.append((own[light], rows[light], len(raw), light))
        raw.append(level)
        found.levels.append(Level(_table(level), set(present)))
        if not heavy.any():
            break
        paths, col_of, free_cells = own[heavy], level["col"][heavy], level["cells"][heavy]
        present = set(col_of.tolist())
    depth = max(p.shape[1] for p, *_ in leaves)
    path = np.vstack([np.hstack([p, np.full((len(p), depth - p.shape[1]), -1)]) for p, *_ in leaves])
    rows = np.concatenate([r for _, r, *_ in leaves])
    in_order = np.lexsort(path.T[::-1])
    seg = np.empty(len(rows), np.int64)
    seg[in_order] = (np.cumsum(rows[in_order]) - rows[in_order]) // even
    at = 0
    for p, _, k, places in leaves:
        raw[k]["seg"][places] = seg[at:at + len(p)]
        at += len(p)
    found.levels = [Level(_table(t), level.present) for t, level in zip(raw, found.levels, strict=True)]
    return found


def _all_cells(cells, node, cell, rows, low, high, next_low, next_high, free):
    """The histogram with the empty cells of freely dealt nodes, rows spread evenly."""
    kept = [a[~free] for a in (node, cell, rows, low, high, next_low, next_high)]
    more = [[] for _ in kept]
    for i in np.unique(node[free]):
        n, share = int(cells[i]), int(rows[(node == i) & free].sum())
        each = np.full(n, share // n)
        each[:share % n] += 1
        zero = np.zeros(n, np.int64)
        for out, part in zip(more, (np.full(n, i), np.arange(n), each, zero, zero, zero, zero), strict=True):
            out.append(part)
    return [np.concatenate([a, *b]) for a, b in zip(kept, more, strict=True)]


def _table(level: dict) -> pa.Table:
    def some(name):
        return pa.array(level[name].astype(np.int64), mask=level[name] < 0)
    return pa.table({"at": pa.array(level["at"].astype(np.int64)), "cell": pa.array(level["cell"].astype(np.int64)), "seg": some("seg"),
                     "node": some("node"), **{k: pa.array(level[k].astype(np.int64)) for k in ("col", "start", "width", "cells")}})
