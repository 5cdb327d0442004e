"""MinHash near-duplicates by a signature-coordinate inverted join (operator 7).

1. Every text's shingle set is sketched: a 128-bit fingerprint of the set and
   a signature of ``COORDINATES`` minima.  Texts with one fingerprint are one
   class; copies never meet in pairs.
2. A class is posted under its (coordinate, value) pairs.  Two sets at the
   threshold agree in at least ``matches`` coordinates but for a chance of
   ``MISS``, so they share one of the ``COORDINATES - matches + 1``
   pairs that are rarest in either: only this prefix is joined, and pairs
   that a passage spreads over the corpus stay out of it.
3. Within a posting list, collisions are counted over the whole signatures;
   classes with ``matches`` or more are linked, by a spanning forest rather
   than by all pairs.  A list beyond ``BLOCK_ROWS`` is dealt in blocks, and
   every two blocks meet in a task of their own.
4. The forests' components hold all pairs above the match threshold.  In
   each, the links are confirmed on the full shingle sets: exact
   intersections of all its pairs, in blocks, again reduced to a forest.
5. Components of the confirmed links give each document its group.

Components are found by alternating large and small stars over written
tables, so neither links nor components pass through the driver or one task.

A text with fewer words than a shingle is one shingle; a null text, or one
without words, is empty and linked with nothing.  Rows with a null id take
part and link other rows, but cannot name a group: they are kept only if no
row of their group has an id.  Repeated rows are copies of each other.  Only the id and the
text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import common as C

COORDINATES, MISS = 40, 2e-5   # signature length; chance that a pair at the threshold is not met
BLOCK_ROWS = 1024            # classes of a posting list or group in one block
BLOCK_SHINGLES = 400_000     # shingles of a group in one block
SMALL = 48                   # lists up to this size are compared many at a time
BROADCAST_BYTES = 16 << 20   # of ids (as text, and 48 each besides) that may be broadcast; more go by a shuffle
_RNG = np.random.Generator(np.random.PCG64(20240607))
_FLIP = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def matches(percent: int) -> int:
    """The most equal coordinates that a pair at the threshold has but for a chance of MISS."""
    p, tail = percent / 100, 0.0
    for t in range(COORDINATES + 1):
        tail += math.comb(COORDINATES, t) * p ** t * (1 - p) ** (COORDINATES - t)
        if tail > MISS:
            return max(t, 1)
    return COORDINATES


class WordHashes(dict):
    def __missing__(self, word):
        n = self[word] = xxhash.xxh3_64_intdigest(word)
        return n


def shingle_set(text: bytes, width: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(memory) > C.WORD_MEMORY:
        memory.clear()
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    key = h[:len(h) - width + 1].copy()
    for k in range(1, width):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
        key += h[k:len(h) - width + 1 + k]
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(32)
    return np.unique(key)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of each non-empty set, one row a set."""
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    at = 0
    while at < len(sets):      # some 200,000 shingles at a time
        to, n = at, 0
        while to < len(sets) and (to == at or n + len(sets[to]) <= 200_000):
            n += len(sets[to])
            to += 1
        flat = np.concatenate(sets[at:to])
        starts = np.cumsum([0, *(len(s) for s in sets[at:to - 1])])
        for c in range(COORDINATES):
            out[at:to, c] = np.minimum.reduceat((((flat ^ _FLIP[c]) * _TIMES[c]) >> np.uint64(32)).astype(np.uint32), starts)
        at = to
    return out


def sketch(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, fingerprint (16 bytes; null if empty) and signature of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in C.slices(batches):
            sets = [shingle_set(t, width, memory) for t in batch.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            prints, sigs = [None] * len(sets), [None] * len(sets)
            for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                prints[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                sigs[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(sigs, pa.binary())], names=["id", "n", "fp", "sig"])

    source = docs.select(docs[id_col].alias("id"), C.as_binary(text_col).alias("text"))
    return source.mapInArrow(C.tidy(run), C.fields("id", docs.schema[id_col].dataType, "n long, fp binary, sig binary"))


def _rows_of(column, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _postings(classes: DataFrame) -> DataFrame:
    """(pair, fp): each class under its coordinate-value pairs."""
    def run(batches):
        coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            if batch.num_rows:
                values = _rows_of(batch.column(1), COORDINATES, np.uint32)
                which = np.repeat(np.arange(batch.num_rows), COORDINATES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((coordinate | values.astype(np.int64)).ravel()), batch.column(0).take(pa.array(which))],
                    names=["pair", "fp"])

    return classes.select("fp", "sig").mapInArrow(C.tidy(run), "pair long, fp binary")


def components_of(linked: np.ndarray) -> np.ndarray:
    """The smallest member of each row's component in a symmetric link matrix."""
    label = np.arange(len(linked))
    np.fill_diagonal(linked, True)
    while True:
        new = np.where(linked, label[None, :], len(linked)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _groups(batches, keys: int):
    """Runs of rows with equal leading columns, as tables, from sorted batches."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if not held.num_rows:
            continue
        change = np.zeros(held.num_rows, bool)
        for k in range(keys):
            col = held.column(k).combine_chunks()
            if pa.types.is_binary(col.type):
                col = col.dictionary_encode()
                col = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).indices
            v = col.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if len(starts):        # all but the last run are whole
            last = int(starts[-1])
            yield held.slice(0, last), np.r_[0, starts[:-1], last]
            held = held.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        change = np.zeros(held.num_rows, bool)
        yield held, np.array([0, held.num_rows])


def _edges(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _collisions(needed: int):
    def run(batches):
        """Spanning forests of the classes of a list that agree in as many coordinates as needed."""
        pairs_of = {m: np.triu_indices(m, 1) for m in range(2, SMALL + 1)}
        for table, bounds in _groups(batches, 3):
            fps = table.column("fp").to_pylist()
            sig = _rows_of(table.column("sig"), COORDINATES, np.uint32)
            sizes = np.diff(bounds)
            seen: dict[bytes, bytes] = {}     # a forest over the whole batch of lists
            rows: list[tuple[bytes, bytes]] = []

            def root(x):
                while (up := seen.get(x, x)) != x:
                    seen[x] = x = seen.get(up, up)
                return x

            def link(x, y):
                x, y = root(x), root(y)
                if x != y:
                    x, y = min(x, y), max(x, y)
                    seen[y] = x
                    rows.append((x, y))

            for m in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
                left, right = pairs_of[int(m)]
                first = bounds[:-1][sizes == m]
                step = max(1, 50_000 // len(left))
                for at in range(0, len(first), step):
                    i = (first[at:at + step, None] + left).ravel()
                    j = (first[at:at + step, None] + right).ravel()
                    agree = np.zeros(len(i), np.int8)
                    for c in range(COORDINATES):   # skip what can no longer reach the threshold
                        agree += sig[i, c] == sig[j, c]
                        if c == COORDINATES // 2:
                            alive = agree + (COORDINATES - 1 - c) >= needed
                            i, j, agree = i[alive], j[alive], agree[alive]
                    for x, y in zip(i[agree >= needed], j[agree >= needed], strict=True):
                        link(fps[x], fps[y])
            for k in np.flatnonzero(sizes > SMALL):
                a, b = bounds[k], bounds[k + 1]
                s = np.ascontiguousarray(sig[a:b].T)
                agree = np.zeros((b - a, b - a), np.int8)
                for c in range(COORDINATES):
                    agree += s[c][:, None] == s[c][None, :]
                for x, y in enumerate(components_of(agree >= needed)):
                    link(fps[a + x], fps[a + y])
            yield _edges(rows)
    return run


def _confirm(percent: int):
    def run(batches):
        """Spanning forests of the exact links within a block (or two) of a group."""
        for table, bounds in _groups(batches, 3):
            fps, sets = table.column("fp").to_pylist(), table.column("set").to_pylist()
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    own = [np.frombuffer(x, np.uint64) for x in sets[a:b]]
                    for x, y in enumerate(components_of(exact_links(own, percent))):
                        if x != y:
                            rows.append((min(fps[a + x], fps[a + y]), max(fps[a + x], fps[a + y])))
            yield _edges(rows)
    return run


def exact_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets have 100 * intersection >= percent * union."""
    n = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = 100 * both >= percent * (n.sum() - both)
        return np.array([[True, hit], [hit, True]])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = times[column] > 1                 # a shingle of one set joins nothing
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    both = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T                  # counts up to 4096: exact
    both = both.astype(np.int64)
    return 100 * both >= percent * (n[:, None] + n[None, :] - both)


def _block_pairs(rows: DataFrame, blocks) -> DataFrame:
    """Each row once for every block that its own block meets."""
    return (rows.withColumn("__nb", blocks)
            .withColumn("__own", F.pmod(F.xxhash64("fp"), F.col("__nb")).cast("int"))
            .withColumn("__with", F.explode(F.sequence(F.lit(0), (F.col("__nb") - 1).cast("int"))))
            .withColumn("low", F.least("__own", "__with")).withColumn("high", F.greatest("__own", "__with"))
            .drop("__nb", "__own", "__with"))


def _in_groups(rows: DataFrame, run, keys: list[str]) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(C.tidy(run), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of ``edges``.

    Alternating large and small stars: every round is a grouped minimum and a
    join, and is written; a round that changes nothing is the last.
    """
    edges = C.written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours move to the smallest neighbour
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # small star: a node's smaller neighbours move to the smallest of them
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).unionByName(
            down.select(F.col("m").alias("x"), F.col("b").alias("y"))).where("x <> y")
        edges = C.written(small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        after = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(roots)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id of the group) and kept of every row.

    Rows are linked when 100 * intersection >= percent * union of their sets
    of ``width``-word shingles.
    """
    rows = C.written(sketch(docs, width, id_col, text_col), "sketch")
    classes = C.written(rows.where("fp is not null").groupBy("fp").agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig")), "classes")
    groups = components(_confirmed(docs, classes, width, percent, id_col, text_col))
    named = groups.join(classes.select(F.col("fp").alias("node"), "rep"), "node")
    names = named.groupBy("label").agg(F.min("rep").alias("component"))
    linked = named.join(names, "label").select(F.col("node").alias("fp"), "component")
    of_class = classes.select("fp", "rep").join(linked, "fp", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    found = rows.select("id", "n", "fp").join(of_class, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))


def _broadcast_if_small(ids: DataFrame, id_col: str) -> DataFrame:
    """``ids`` to be broadcast if they are at most BROADCAST_BYTES, else as they are."""
    size = ids.agg(F.sum(F.coalesce(F.octet_length(F.col(id_col).cast("string")), F.lit(0)) + 48)).first()[0] or 0
    return F.broadcast(ids) if size <= BROADCAST_BYTES else ids


def _confirmed(docs, classes, width, percent, id_col, text_col) -> DataFrame:
    """Edges (a, b) between class fingerprints whose sets are linked, enough to connect each group."""
    spark = docs.sparkSession
    needed = matches(percent)
    postings = _postings(classes)
    common = postings.groupBy("pair").agg(F.count("*").alias("df")).where("df > 1")
    mine = Window.partitionBy("fp")
    # pairs that no other class has come first in the prefix and join nothing
    prefix = (postings.join(common, "pair")
              .withColumns({"__n": F.count("*").over(mine), "__k": F.row_number().over(mine.orderBy("df", "pair"))})
              .where(F.col("__k") + (COORDINATES - F.col("__n")) <= COORDINATES - needed + 1).select("pair", "fp"))
    prefix = C.written(prefix, "prefix")
    lists = prefix.groupBy("pair").agg(F.count("*").alias("size")).where("size > 1")
    met = prefix.join(lists, "pair").join(classes.select("fp", "sig"), "fp")
    met = _block_pairs(met, F.ceil(F.col("size") / BLOCK_ROWS)).select("pair", "low", "high", "fp", "sig")
    alike = C.written(components(_in_groups(met, _collisions(needed), ["pair", "low", "high"])), "alike")

    # the full sets of the classes that have a candidate
    wanted = alike.select(F.col("node").alias("fp"), "label").join(classes.select("fp", "rep"), "fp")
    wanted = C.written(wanted.select("label", F.col("fp").alias("want"), "rep"), "wanted")
    text = docs.select(docs[id_col].alias("rep"), C.as_binary(text_col).alias("text"))
    sets = text.join(_broadcast_if_small(wanted, "rep"), "rep").select("label", "want", "text")

    def full_sets(batches):
        memory = WordHashes()
        for batch in C.slices(batches):
            own = [shingle_set(t, width, memory) for t in batch.column("text").to_pylist()]
            prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in own]
            columns = [pa.array(prints, pa.binary()), pa.array([len(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())]
            if "want" not in batch.schema.names:
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "n", "set"])
                continue
            same = [f == w for f, w in zip(prints, batch.column("want").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *columns], names=["label", "fp", "n", "set"]).filter(pa.array(same))

    sets = sets.mapInArrow(C.tidy(full_sets), "label binary, fp binary, n long, set binary")
    nameless = wanted.where("rep is null")
    if nameless.limit(1).count():        # classes without any id are found by their fingerprints
        unnamed = text.where("rep is null").select("text").mapInArrow(C.tidy(full_sets), "fp binary, n long, set binary")
        unnamed = unnamed.join(nameless.select("label", F.col("want").alias("fp")), "fp").dropDuplicates(["fp"])
        sets = sets.unionByName(unnamed.select("label", "fp", "n", "set"))
    sets = C.written(sets, "sets")
    sizes = sets.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    groups = _block_pairs(sets.join(sizes, "label"), F.col("blocks")).select("label", "low", "high", "fp", "set")
    return _in_groups(groups, _confirm(percent), ["label", "low", "high"])


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one for each id, columns unchanged.

    Rows with a null id cannot be named and stay.  Of rows that share a kept
    id the greatest stays.
    """
    found = near_duplicates(docs, width, percent, id_col, text_col).groupBy(F.col(id_col).alias("__id")).agg(
        F.max("kept").alias("kept"), F.count("*").alias("rows"))
    found = C.written(found.where("__id is not null and (not kept or rows > 1)"), "dropped")
    again = found.agg(F.coalesce(F.sum((F.col("kept")).cast("int")), F.lit(0))).first()[0]
    rest = docs.join(_broadcast_if_small(found.select("__id"), "__id"), docs[id_col] == F.col("__id"), "left_anti")
    if not again:
        return rest
    repeated = found.where("kept").select("__id")
    row = F.struct(*(docs[c] for c in docs.columns))
    one = docs.join(repeated, docs[id_col] == F.col("__id")).groupBy("__id").agg(F.max(row).alias("__row")).select("__row.*")
    return rest.unionByName(one)
