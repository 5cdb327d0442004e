"""SimHash near-duplicates by pigeonring filtering (operator 11).

1. Every text gets a 64-bit fingerprint: a bit is 1 if more than half of its
   word shingles' XXH64 values (repeats included) have it.  Texts with one
   fingerprint are one class, so copies never meet in pairs.
2. The 64 bits form a ring of ``bits + 1`` segments.  If two fingerprints
   differ in at most ``bits`` bits, some segment starts a chain in which the
   first ``k`` segments together differ in at most ``k * bits / (bits + 1)``
   bits, that is ``k - 1``, for every ``k``: the first segment is equal and of
   the second at most one bit differs, so one of its halves is equal too.
   Classes are posted under (start, half, equal bits) and meet only there.
3. Within a list every pair runs along its chain, budget by budget; the last
   budget is the full Hamming check.  Links are emitted as a spanning forest,
   not as pairs.  A list beyond ``BLOCK_ROWS`` is dealt in blocks, and every
   two blocks meet in a task of their own.
4. The forests' components give each document its group.

A text with fewer words than a shingle is one shingle; a null text, or one
without words, has the fingerprint zero and is linked like any other.  A
very long text is taken apart a block at a time.  Rows with a null id link
other rows but cannot name a group: they get the smallest id they reach, or
null.  Repeated rows are copies of each other.  Only the id and the text are
read, so clashing names do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .neardup import components

SEED = 42                # of XXH64
BLOCK_ROWS = 4096        # classes of a list in one block
ROWS_TOGETHER = 1 << 16  # rows of short lists that are compared at once


def fingerprint(text: bytes, width: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for block in C.blocks(text.lower()):
        words = held + block.split()
        if len(words) < width:
            held = words
            continue
        line, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
        shingles = [line[a:b - 1] for a, b in zip([0, *ends], ends[width - 1:], strict=False)]
        ones += _ones(shingles)
        n += len(shingles)
        held = words[len(words) - width + 1:]
    if not n and held:
        ones, n = _ones([b" ".join(held)]), 1
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _ones(shingles: list[bytes]) -> np.ndarray:
    """How many of the hashes have each bit, highest bit first."""
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
    found = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        found += np.unpackbits(hashes[at:at + 8192], axis=1).sum(0, dtype=np.int64)
    return found


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (the fingerprint's 64 bits as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            prints = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    source = docs.select(docs[id_col].alias("id"), C.as_binary(text_col).alias("text"))
    return source.mapInArrow(C.tidy(run), C.fields("id", docs.schema[id_col].dataType, "fp long"))


def segments(bits: int) -> list[tuple[int, int]]:
    """First bit and width of each of the ring's ``bits + 1`` segments."""
    edges = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _cut(first: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def postings(classes: DataFrame, bits: int) -> DataFrame:
    """(list, fp): a class under each start of a chain and each half of the segment after it."""
    ring, keys = segments(bits), []
    for start, (first, width) in enumerate(ring):
        after, length = ring[(start + 1) % len(ring)]
        for place, (a, w) in enumerate(((after, length // 2), (after + length // 2, length - length // 2))):
            own = F.lit((2 * start + place) << 48).cast("long")
            keys.append(own.bitwiseOR(F.shiftleft(_cut(first, width), 16)).bitwiseOR(_cut(a, w)))
    return classes.select(F.explode(F.array(*keys)).alias("list"), "fp")


def chain_masks(bits: int) -> np.ndarray:
    """[start, k]: the bits of the first k + 1 segments of the chain from ``start``."""
    ring = [np.uint64(((1 << w) - 1) << a) for a, w in segments(bits)]
    return np.array([np.bitwise_or.accumulate(ring[s:] + ring[:s]) for s in range(len(ring))], np.uint64)


def forest(lists: np.ndarray, fps: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within equal ``lists`` (sorted), found offset by offset."""
    masks, n = chain_masks(bits), len(fps)
    label, a, b = np.arange(n), [], []
    left, step = np.arange(n), 0
    while True:
        step += 1
        left = left[left + step < n]
        left = left[lists[left] == lists[left + step]]
        if not len(left):
            return np.array(a, np.int64), np.array(b, np.int64)
        i = left[label[left] != label[left + step]]
        differ = fps[i] ^ fps[i + step]
        for k in range(1, bits + 1):        # the chain's budgets; the last is the whole ring
            alive = np.bitwise_count(differ & masks[starts[i], k]) <= k
            i, differ = i[alive], differ[alive]
        if not len(i):
            continue
        for x in i.tolist():
            y, x = x + step, int(x)
            ends = []
            for z in (x, y):
                while label[z] != z:
                    z = int(label[z])
                ends.append(z)
            if ends[0] != ends[1]:
                label[max(ends)] = min(ends)
                a.append(x)
                b.append(y)
        while (label != (up := label[label])).any():
            label = up


def _forests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def links(rows: np.ndarray) -> pa.RecordBatch:
            new = (rows[:3, 1:] != rows[:3, :-1]).any(0) if rows.shape[1] else np.zeros(0, bool)
            fps = rows[3].view(np.uint64)
            a, b = forest(np.r_[0, np.cumsum(new)], fps, rows[0] >> 49, bits)
            return pa.RecordBatch.from_arrays([pa.array(rows[3][a]), pa.array(rows[3][b])], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns]))
            n += batch.num_rows
            if n >= ROWS_TOGETHER:
                rows = np.ascontiguousarray(np.concatenate(held, 1))
                last = np.flatnonzero((rows[:3] != rows[:3, -1:]).any(0))
                cut = int(last[-1]) + 1 if len(last) else 0       # the last list may go on
                if cut:
                    yield links(np.ascontiguousarray(rows[:, :cut]))
                held, n = [rows[:, cut:]], rows.shape[1] - cut
        if n:
            yield links(np.ascontiguousarray(np.concatenate(held, 1)))
    return run


def links(classes: DataFrame, bits: int) -> DataFrame:
    """Edges (a, b) between fingerprints at most ``bits`` apart, enough to connect each group."""
    posted = postings(classes, bits)
    sizes = posted.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (posted.join(sizes, "list")
           .withColumn("blocks", F.ceil(F.col("size") / BLOCK_ROWS))
           .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
           .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .select("list", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "fp"))
    keys = ["list", "low", "high"]
    return met.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(C.tidy(_forests(bits)), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, fp and component_id (the smallest id of the group) of every row.

    Rows are linked when their fingerprints differ in at most ``bits`` bits
    (0 to 20).
    """
    if not 0 <= bits <= 20:
        raise ValueError("bits must be from 0 to 20")
    rows = C.written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    classes = C.written(rows.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    if not bits:
        named = classes.select("fp", F.col("rep").alias("component"))
    else:
        groups = components(links(classes, bits)).select(F.col("node").alias("fp"), "label")
        linked = classes.join(groups, "fp")
        names = linked.groupBy("label").agg(F.min("rep").alias("least"))
        linked = linked.join(names, "label").select("fp", "least")
        named = classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component"))
    # one row a class on the right; a class with very many rows is split by AQE's skew join
    found = rows.join(named, "fp", "left")
    return found.select(F.col("id").alias(id_col), "fp", F.col("component").alias("component_id"))


def as_hex(fp: Column) -> Column:
    """The 16 lowercase hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
