"""Importance resampling towards a target distribution (operator 13).

1. Word n-grams are hashed into a fixed number of buckets and counted over
   all documents and over all target texts: a task counts into an array and
   sends it once.
2. A bucket's gain is the scaled log ratio of its smoothed shares.  The gains
   are one array; a document's weight is the floored mean of its features'
   entries.  Adding Gumbel noise from a hash of the id makes the greatest
   scores a sample without replacement.
3. The exact cutoff among the scores is found by weighted median-of-medians
   selection: blocks of each partition give the median of their remaining
   keys, the medians weighted by the blocks' remaining sizes give a pivot,
   and what lies on its wrong side - a quarter at least - is discarded.  A
   round is one job, which also finds both sides' next medians.  The keys
   left are written again whenever they have shrunk to a quarter; when
   ``LAST`` or fewer are left the driver reads the cutoff off them.
4. The winners alone are sorted (by ranges) and numbered.

The order is score (falling), id (rising, null last) and a number of the
written row, so it has no ties and repeated rows are ranked one by one.  A
null text, or one without words, has no features and weight 0.  Very long
texts are taken apart in blocks.  A null id is hashed as an empty one.
Columns besides id and text are not read; an empty table of documents gives
an empty result, and without target texts every target count is 0.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

BUCKETS = 10_000
SHARE, LEAST_WORDS, SEED = 10, 20, 2024
BLOCK_ROWS = 1 << 18     # keys whose median a task takes together
LAST = 4096              # remaining keys that the driver orders itself
FEATURES_TOGETHER = 1 << 18
LONG_WORD = 64           # bytes; longer words are hashed anew each time
# 0-9, a-z and all bytes from 0x80 on belong to words, A-Z is lower-cased.
WORD_BYTES = bytes(c if c in b"0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else c + 32 if 65 <= c <= 90 else 32
                   for c in range(256))


class BucketOf(dict):
    """word -> bucket of its UTF-8 bytes."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        b = zlib.crc32(word) % self.buckets
        if len(word) <= LONG_WORD:
            if len(self) >= C.WORD_MEMORY:
                self.clear()
            self[word] = b
        return b


def features(text: bytes, width: int, memory: BucketOf) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of the features, block by block."""
    held: list[bytes] = []
    for block in C.blocks(text.translate(WORD_BYTES)):
        new = block.split()
        parts = [np.fromiter(map(memory.__getitem__, new), np.int64, len(new))]
        words = held + new
        for k in range(2, width + 1):
            first = max(len(held) - k + 1, 0)
            grams = [zlib.crc32(b" ".join(words[i:i + k])) % memory.buckets for i in range(first, len(words) - k + 1)]
            parts.append(np.array(grams, np.int64))
        held = words[1 - width:] if width > 1 else []
        yield len(new), np.concatenate(parts)


def bucket_counts(texts: DataFrame, text_col: str, width: int, buckets: int) -> np.ndarray:
    """How many features each bucket holds, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, total, held, n = BucketOf(buckets), np.zeros(buckets, np.int64), [], 0
        for batch in C.slices(batches):
            for text in batch.column(0).to_pylist():
                for _, found in features(text, width, memory):
                    held.append(found)
                    n += len(found)
                    if n > FEATURES_TOGETHER:
                        total += np.bincount(np.concatenate(held), minlength=buckets)
                        held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    parts = texts.select(C.as_binary(text_col).alias("text")).mapInArrow(C.tidy(run), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of smoothed target to source shares, one a bucket."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_words, n_features and weight of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = BucketOf(len(gain))
        for batch in C.slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                n_words = n = total = 0
                for words, found in features(text, width, memory):
                    n_words, n, total = n_words + words, n + len(found), total + int(gain[found].sum())
                rows.append((n_words, n, total // n if n else 0))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_words", "n_features", "weight"])

    source = docs.select(docs[id_col].alias("id"), C.as_binary(text_col).alias("text"))
    return source.mapInArrow(C.tidy(run), C.fields("id", docs.schema[id_col].dataType, "n_words long, n_features long, weight long"))


def gumbel(id_col: Column, seed: int) -> Column:
    """The scaled Gumbel noise of an id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# -- selection

KEYS = ["k0", "k1", "k2"]


def with_keys(scored: DataFrame) -> DataFrame:
    """The columns whose rising order is the order of the draw."""
    if isinstance(scored.schema["id"].dataType, T.IntegralType):
        own = F.coalesce(F.col("id").cast("long"), F.lit(2**63 - 1))
    else:
        own = F.coalesce(F.col("id").cast("string"), F.lit("\U0010ffff"))
    return scored.withColumns({"k0": -F.col("score"), "k1": own, "k2": F.col("row")})


def before(key: tuple, same: bool = False) -> Column:
    """Whether a row's key lies before ``key`` (or is it)."""
    out = F.lit(same)
    for name, value in reversed(list(zip(KEYS, key, strict=True))):
        out = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & out)
    return (F.col(KEYS[0]) <= F.lit(key[0])) & out        # the first part reaches the scan


def after(key: tuple) -> Column:
    return (F.col(KEYS[0]) >= F.lit(key[0])) & ~before(key, True)


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and median key of every block's rows on each side of the pivot."""
    held, n = [], 0

    def found(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches)
        rows = []
        for side in (-1, 0, 1):
            part = t.filter(pc.equal(t.column("side"), side))
            if part.num_rows:
                order = pc.sort_indices(part, sort_keys=[(k, "ascending") for k in KEYS])
                middle = part.take(order.slice((part.num_rows - 1) // 2, 1)).select(KEYS)
                rows.append(pa.table({"side": pa.array([side], pa.int32()), "n": pa.array([part.num_rows], pa.int64()),
                                      **{k: middle.column(k) for k in KEYS}}))
        return pa.concat_tables(rows).combine_chunks().to_batches()[0]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield found(held)
                held, n = [], 0
    if n:
        yield found(held)


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The key at which half of the weight is reached."""
    medians, half, seen = sorted(medians), sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, n: int, rank: int) -> tuple:
    """The ``rank``-th smallest of the ``n`` keys (1 <= rank <= n), exactly."""
    kind = keys.schema["k1"].dataType
    shape = T.StructType([T.StructField("side", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("k0", T.LongType()),
                          T.StructField("k1", kind), T.StructField("k2", T.LongType())])
    left, stored, pivot = keys.select(*KEYS), n, None
    while n > LAST:
        side = F.lit(0) if pivot is None else F.when(before(pivot), -1).when(before(pivot, True), 0).otherwise(1)
        rows = left.withColumn("side", side.cast("int")).mapInArrow(C.tidy(_medians), shape).collect()
        by = {s: [((r.k0, r.k1, r.k2), r.n) for r in rows if r.side == s] for s in (-1, 0, 1)}
        if pivot is None:
            pivot = weighted_median(by[0])
            continue
        below = sum(r[1] for r in by[-1])
        if rank == below + 1:
            return pivot
        if rank <= below:
            left, n, rest = left.where(before(pivot)), below, by[-1]
        else:
            left, rank, rest = left.where(after(pivot)), rank - below - 1, by[1]
            n = sum(r[1] for r in rest)
        pivot = weighted_median(rest)
        if n * 4 <= stored and n > LAST:
            left, stored = C.written(left, "keys"), n
    return sorted(tuple(r) for r in left.collect())[rank - 1]          # at most LAST rows


def numbered(winners: DataFrame) -> DataFrame:
    """``winners`` with their rank in the order of the keys, from 1."""
    n = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = winners.repartitionByRange(n, *KEYS).sortWithinPartitions(*KEYS)
    ordered = C.written(ordered.withColumn("place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("place", 33)               # of the sort, and the place within it
    starts, at = [], 0
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):      # one row a partition
        starts.append((r[0], at))
        at += r[1]
    offsets = winners.sparkSession.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ordered.withColumn("part", part.cast("long")).join(F.broadcast(offsets), "part").withColumn("rank", rank)


def resample(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = BUCKETS, share: int = SHARE,
             least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row.

    Features are runs of 1 to ``width`` words.  Of the rows with at least
    ``least_words`` words, ``share`` percent (rounded down) are drawn.
    """
    gain = gains(bucket_counts(docs, text_col, width, buckets), bucket_counts(target, target_text, width, buckets))
    scored = weighed(docs, gain, width, id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = with_keys(C.written(scored.withColumn("row", F.monotonically_increasing_id()), "scored"))
    open_to = F.col("n_words") >= least_words
    n = scored.where(open_to).count()
    drawn = n * share // 100
    out = ["id", "n_words", "n_features", "weight", "score"]
    named = F.col("id").alias(id_col)
    if not drawn:
        return scored.select(named, *out[1:], F.lit(None).cast("long").alias("rank"))
    last = cutoff(scored.where(open_to), n, drawn)
    wins = open_to & before(last, True)
    winners = numbered(scored.where(wins).select(*out, *KEYS)).select(named, *out[1:], "rank")
    return winners.unionByName(scored.where(~wins).select(named, *out[1:], F.lit(None).cast("long").alias("rank")))
