"""Hashed maximum-entropy language model (operator 1).

P(word | history) = P(class | history) * P(word | class).

The first factor is a softmax over ``CLASSES`` classes.  Its features are the
previous word, the two previous words as a pair, and the word before the
previous one alone (skip); each is hashed to one of ``BUCKETS`` rows of weights.
The second factor is a product of two-way choices down a Huffman tree of the
class's head words and one leaf for all its other words.  Each choice is a
maximum-entropy model of the same three features, hashed together with the
node to one of at most ``SLOTS`` weights (fewer for few tokens; those of
nearby nodes side by side), and of a
prior: the closed form without history, the smoothed relative frequency.  In
the leaf of other words that closed form is all, with one place for the words
not seen in training.  Frequent words are classes of their own; the others
are classed by their last two bytes, so a word never seen has a class too.
All probabilities of a history add up to one.

Training: every task walks its documents once, with mini-batches of gradient
steps on the sparse rows that a batch touches, starting from the shared
weights; the tasks' rows are averaged by how often each was used, in two
levels of sums, and are the next round's shared weights.  Scoring is one pass
of sparse numpy batches.

Counts are kept for every word of the training texts.  Words frequent enough
to be among ``HEAD`` are looked up in a broadcast table (at most ``HEAD``
words of at most ``HEAD_BYTES`` bytes, whatever the corpus); all others are
joined by word.  A word over ``HEAD_BYTES`` is represented by a digest.

Null or empty texts are the end token alone.  A null id belongs to the
training texts.  Repeated rows count and are scored each by itself.  Ties in
frequency go to the smaller word.  Only the id and text columns are read, so
clashing names do not matter; an empty table gives an empty result; with no
training text every word is unknown.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CLASSES, SINGLE, SUFFIX = 40, 18, 16     # classes; words, and endings, with a class of their own
BUCKETS = 1 << 15
HEAD, HEAD_BYTES = 1 << 18, 48
ENDINGS = 1 << 10                        # hash values of a rare word's ending, as a context
COUNTED_WORDS = 400_000                  # distinct words that a task holds before it hands on their counts
SLICE_ROWS = 4 * C.ROWS_AT_ONCE          # texts whose words are told apart together
PACK = 1 << 8                            # more than there are classes
ROUNDS, RATE, BATCH = 1, 1.0, 16384
LARGE = 80                               # log scores beyond it have no 32-bit exponential
BLOCK = 128                              # buckets sent together
SLOTS, SLOT_BLOCK = 1 << 21, 1 << 13     # weights of the choices at most; slots sent together
LEVELS = 4                               # of a tree, whose choices have their weights side by side: a cache line of 2 ** LEVELS
CHOICE_RATE, CHOICE_BATCH = 0.2, 1 << 16  # step size; tokens of a step with SLOTS weights, fewer with fewer
CHOICE_PART, DENSE_PART, CLASS_PART = 1 << 12, 1 << 15, 1 << 11   # tokens, weights and tokens handled at a time, in the processor's cache
SALTS = 16
TASK_TOKENS = 2_000_000                  # of a training task, where the input is dealt finer: each sends its weights
END = b""                                # the end token; no word is empty


def key_of(word: bytes) -> bytes:
    """The word, or a digest that no word can be (it begins with a space), with the word's ending."""
    return word if len(word) <= HEAD_BYTES else b" " + hashlib.blake2b(word, digest_size=32).digest() + word[-2:]


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of binary texts without nulls: each token's place among the distinct ones, these, and the number of tokens per text."""
    codes, distinct, sizes = C.split_words(pc.ascii_lower(texts.view(pa.string())).view(pa.binary()))
    if END not in distinct:
        distinct.append(END)
    sizes = sizes + 1
    words = np.ones(sizes.sum(), bool)
    words[np.cumsum(sizes) - 1] = False
    tokens = np.full(len(words), distinct.index(END), np.int64)
    tokens[words] = codes
    return tokens, distinct, sizes


class Vocabulary:
    """Numbers, classes and counts of the head words; numbers and classes of all others."""

    def __init__(self, words: list[bytes], counts: np.ndarray, own_endings: list[bytes], single: int = SINGLE,
                 classes: int = CLASSES):
        self.words, self.counts, self.single, self.classes = words, counts, single, classes
        self.own = {e: single + i for i, e in enumerate(own_endings)}
        self.rest = single + len(own_endings)
        self.ready = False

    def ending_class(self, ending: bytes) -> int:
        found = self.own.get(ending)
        return self.rest + xxhash.xxh3_64_intdigest(ending) % (self.classes - self.rest) if found is None else found

    def prepare(self) -> Vocabulary:
        """Builds the lookup (on the worker: it is not sent)."""
        if not self.ready:
            n = len(self.words)
            classes = [i if i < self.single else self.ending_class(w[-2:]) for i, w in enumerate(self.words)]
            self.packed = _Packed(self, n)
            self.packed.update(zip(self.words, (np.arange(n) * PACK + np.array(classes, np.int64)).tolist(), strict=True))
            self.ready = True
        return self

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("words", "counts", "single", "classes", "own", "rest")} | {"ready": False}

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context number, class, whether outside the head) of each word."""
        packed = np.fromiter(map(self.packed.__getitem__, words), np.int64, len(words))
        ids = packed // PACK
        return ids, (packed & (PACK - 1)).astype(np.int32), ids >= len(self.words)


class _Packed(dict):
    """head word -> number * PACK + class; other words by their ending, not remembered."""

    def __init__(self, vocabulary: Vocabulary, first: int):
        self.vocabulary, self.first, self.endings = vocabulary, first, {}

    def __missing__(self, word: bytes) -> int:
        ending = word[-2:]
        found = self.endings.get(ending)
        if found is None:
            found = self.endings[ending] = ((self.first + xxhash.xxh3_64_intdigest(ending) % ENDINGS) * PACK
                                            + self.vocabulary.ending_class(ending))
        return found


def groups_of_choices(above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each node (``above``: the choice above it, -1 for a root): the top node of its group of ``LEVELS`` levels,
    whose weights for a feature lie side by side, and its spot there, from 1 to 2 ** LEVELS - 1."""
    depth, at, up = np.zeros(len(above), np.int64), np.flatnonzero(above >= 0), above[above >= 0] >> 1
    while len(at):
        depth[at] += 1
        at, up = at[above[up] >= 0], above[up][above[up] >= 0] >> 1
    groups, spots = np.arange(len(above)), np.ones(len(above), np.int64)
    for d in range(1, depth.max(initial=0) + 1):
        if d % LEVELS:
            at = np.flatnonzero(depth == d)
            groups[at], spots[at] = groups[above[at] >> 1], 2 * spots[above[at] >> 1] + (above[at] & 1)
    return groups.astype(np.int32), spots.astype(np.uint32)


class Trees:
    """The Huffman tree of each class of many words: leaves are its head words and, numbered after all
    head words, one for the class's other words."""

    def __init__(self, classes: np.ndarray, counts: np.ndarray, single: int, rest: np.ndarray):
        """``classes`` and ``counts`` of the head words; ``rest``: by class, the mass of its other words."""
        n = len(classes)
        self.n, self.single = n, single
        members = np.argsort(classes[single:], kind="stable") + single
        starts = np.searchsorted(classes[members], np.arange(len(rest) + 1))
        up = np.full(n + len(rest), -1, np.int64)      # code of the choice above a leaf: node * 2 + side
        above, odds = [], []                           # the same of a node; log of side 1's mass over side 0's
        for c in range(single, len(rest)):
            own = np.r_[members[starts[c]:starts[c + 1]], n + c]
            mass = np.r_[counts[own[:-1]] + 1.0, rest[c]]
            order = np.argsort(mass, kind="stable")
            own, mass = own[order].tolist(), mass[order].tolist()
            first, merged, i, k = len(above), [], 0, 0
            for m in range(len(own) - 1):
                two = []
                for side in (0, 1):
                    if k >= len(merged) or (i < len(own) and mass[i] <= merged[k]):
                        up[own[i]] = (first + m) * 2 + side
                        two.append(mass[i])
                        i += 1
                    else:
                        above[first + k] = (first + m) * 2 + side
                        two.append(merged[k])
                        k += 1
                merged.append(two[0] + two[1])
                above.append(-1)
                odds.append(two[1] / two[0])
        above = np.array(above, np.int64)
        self.groups, self.spots = groups_of_choices(above)
        self.odds = np.log(np.array(odds)).astype(np.float32)
        leaves, codes, at = [], [], np.flatnonzero(up >= 0)
        now = up[at]
        while len(at):
            leaves.append(at)
            codes.append(now)
            now = above[now >> 1]
            at, now = at[now >= 0], now[now >= 0]
        leaves = np.concatenate([np.empty(0, np.int64), *leaves])
        codes = np.concatenate([np.empty(0, np.int64), *codes])
        order = np.argsort(leaves, kind="stable")
        self.codes, self.ready = codes[order].astype(np.int32), False
        self.at = np.searchsorted(leaves[order], np.arange(n + len(rest) + 1))

    def leaves(self, ids: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return np.where(ids < self.n, ids, self.n + cls)

    def prepare(self) -> Trees:
        """Of each choice: the hash of its node's group and the node's spot there, 1 or -1 for its side, and the
        prior's log odds of that side (on the worker: they are not sent)."""
        if not self.ready:
            node = self.codes >> 1
            self.salts = self.groups[node].astype(np.uint32) * np.uint32(0x9E3779B1)
            self.salts ^= self.salts >> np.uint32(15)
            self.places = self.spots[node]
            self.signs = ((self.codes & 1) * 2 - 1).astype(np.float32)
            self.priors = self.odds[node] * self.signs
            self.ready = True
        return self

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("salts", "places", "signs", "priors")} | {"ready": False}

    def choices(self, leaves: np.ndarray):
        """(token, place in the tables of choices) of all choices on the ways to the tokens' leaves, token by token."""
        first = self.at[leaves]
        depth = self.at[leaves + 1] - first
        token = np.repeat(np.arange(len(leaves)), depth)
        place = np.take(first - (np.cumsum(depth) - depth), token, mode="clip")
        place += np.arange(len(token))
        return token, place


def slots_for(tokens: int) -> int:
    """Weights of the choices: one for two tokens, a power of two, from 2**12 to ``SLOTS``."""
    return min(SLOTS, 1 << max(12, (tokens // 2).bit_length()))


def batch_for(slots: int) -> int:
    """Tokens of a training step: few tokens in all take small steps, so as to take several."""
    return max(1 << 10, CHOICE_BATCH * slots // SLOTS)


def slots_of(hashes: np.ndarray, token: np.ndarray, place: np.ndarray, trees: Trees, slots: int):
    """For each feature, the slot of each choice: the feature and the group tell the 2 ** LEVELS slots side by side
    (and their order), so that the choices on the way to a leaf are near each other in memory."""
    salts, spots = np.take(trees.salts, place, mode="clip"), np.take(trees.places, place, mode="clip")
    for h in hashes:
        out = np.take(h, token, mode="clip")
        out ^= salts
        out *= np.uint32(0x85EBCA6B)
        out >>= np.uint32(32 - slots.bit_length() + 1)
        out ^= spots
        yield out.astype(np.intp)


def chosen(weights: np.ndarray, trees: Trees, slots, place: np.ndarray):
    """Log odds of the side taken at each choice, and the choices' signs."""
    z = None
    for s in slots:
        w = np.take(weights, s, mode="clip")
        z = w if z is None else np.add(z, w, out=z)
    signs = np.take(trees.signs, place, mode="clip")
    z *= signs
    z += np.take(trees.priors, place, mode="clip")
    return z, signs


def in_lines(weights: np.ndarray) -> np.ndarray:
    """A copy whose groups of 2 ** LEVELS each are one cache line of 64 bytes."""
    room = np.empty(len(weights) + 16, np.float32)
    first = -(room.ctypes.data // 4) % 16
    room[first:first + len(weights)] = weights
    return room[first:first + len(weights)]


class ChoiceTrainer:
    """Gradient steps on one task's choices, from the shared weights."""

    def __init__(self, weights: np.ndarray, trees: Trees, rate: float = CHOICE_RATE):
        # new arrays, no plain copies: np.add.at is slow with the dtype object of an unpickled array, which its results would keep
        self.weights, self.trees, self.rate = in_lines(weights), trees.prepare(), rate
        self.scale = np.ones(len(weights), np.float32)     # one and the sums of squared gradients
        self.total = in_lines(np.zeros(len(weights), np.float32))

    def step(self, hashes: np.ndarray, leaves: np.ndarray) -> None:
        for at in range(0, len(leaves), CHOICE_PART):
            token, place = self.trees.choices(leaves[at:at + CHOICE_PART])
            slots = list(slots_of(hashes[:, at:at + CHOICE_PART], token, place, self.trees, len(self.weights)))
            z, signs = chosen(self.weights, self.trees, slots, place)
            np.clip(z, -30, 30, out=z)
            np.exp(z, out=z)
            z += 1
            np.divide(signs, z, out=z)
            for s in slots:
                np.add.at(self.total, s, z)
        for at in range(0, len(self.weights), DENSE_PART):
            total, scale = self.total[at:at + DENSE_PART], self.scale[at:at + DENSE_PART]
            scale += total * total
            total *= self.rate
            total /= np.sqrt(scale)
            self.weights[at:at + DENSE_PART] += total
            total.fill(0)


def choice_log_probability(weights: np.ndarray, trees: Trees, hashes: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Natural log of P(leaf | class, history) of each token."""
    trees.prepare()
    out = np.empty(len(leaves))
    for at in range(0, len(leaves), CHOICE_PART):
        part = leaves[at:at + CHOICE_PART]
        token, place = trees.choices(part)
        z, _ = chosen(weights, trees, slots_of(hashes[:, at:at + CHOICE_PART], token, place, trees, len(weights)), place)
        # log of 1 / (1 + exp(-z))
        logs = np.abs(z)
        np.negative(logs, out=logs)
        np.exp(logs, out=logs)
        np.log1p(logs, out=logs)
        np.subtract(np.minimum(z, 0, out=z), logs, out=z)
        out[at:at + CHOICE_PART] = np.bincount(token, z, len(part))
    return out


def features(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The three feature rows of each token (``place``: the token's number in its text), and the features' 32-bit hashes."""
    def back(k):
        out = np.zeros(len(ids), np.uint64)
        out[k:] = ids[:-k] + 1
        out[place < k] = 0
        return out

    one, two = back(1), back(2)
    rows = (one * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1),
            (one * np.uint64(0x9E3779B97F4A7C15) ^ (two + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(2),
            two * np.uint64(0x94D049BB133111EB) + np.uint64(3))
    out, hashes = np.empty((len(rows), len(ids)), np.int32), np.empty((len(rows), len(ids)), np.uint32)
    for k, r in enumerate(rows):
        r ^= r >> np.uint64(32)
        r *= np.uint64(0xD6E8FEB86659FD93)
        out[k] = r >> np.uint64(64 - BUCKETS.bit_length() + 1)
        hashes[k] = r >> np.uint64(8) & np.uint64(0xFFFFFFFF)
    return out, hashes


def exponentials(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, out: np.ndarray):
    """Log scores (less their largest, where they are large), and into ``out`` their exponentials."""
    z = np.take(weights, rows[0], axis=0, mode="clip")
    for r in rows[1:]:
        np.take(weights, r, axis=0, out=out, mode="clip")
        z += out
    z += bias
    if z.size and (z.max() > LARGE or z.min() < -LARGE):
        z -= z.max(1, keepdims=True)
    return z, np.exp(z, out=out)


def class_log_probability(weights, bias, rows, cls) -> np.ndarray:
    """Natural log of P(class | history) of each token."""
    out = np.empty(len(cls))
    buffer, ones = np.empty((CLASS_PART, len(bias)), np.float32), np.ones(len(bias), np.float32)
    for at in range(0, len(cls), CLASS_PART):
        part = cls[at:at + CLASS_PART]
        z, e = exponentials(weights, bias, rows[:, at:at + CLASS_PART], buffer[:len(part)])
        out[at:at + CLASS_PART] = z[np.arange(len(part)), part] - np.log(e @ ones)
    return out


def sums_of_rows(data: np.ndarray, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``at`` of ``data``: of the first ``times[0]``, the next ``times[1]``, and so on (none is 0).

    Rows are added in pairs until each sum is one row; returns the sums as they are ready, and which ones they are."""
    out, order = np.empty((len(times), data.shape[1]), data.dtype), []
    which, ready = np.arange(len(times)), 0
    while len(which):
        last = np.cumsum(times) - 1
        one = times == 1
        single = last[one]
        np.take(data, at[single], axis=0, out=out[ready:ready + len(single)], mode="clip")
        ready += len(single)
        order.append(which[one])
        many = ~one
        odd = (times & 1 == 1) & many
        extra = last[odd]
        left = np.ones(len(at), bool)
        left[single] = False
        left[extra] = False
        more = np.take(data, at[extra], axis=0, mode="clip")
        paired = at[left]
        which, times, odd = which[many], times[many] >> 1, odd[many]
        pairs = np.take(data, paired[0::2], axis=0, mode="clip")
        pairs += np.take(data, paired[1::2], axis=0, mode="clip")
        pairs[(np.cumsum(times) - 1)[odd]] += more
        data, at = pairs, np.arange(len(pairs))
    return out, np.concatenate([np.empty(0, np.int64), *order])


class Trainer:
    """Gradient steps on one task's tokens, from the shared weights."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, rate: float = RATE):
        self.weights, self.bias, self.rate = weights.copy(), bias, rate
        self.scale = np.full(len(weights), 1e-3, np.float32)   # sums of squared gradients
        self.used = np.zeros(len(weights), np.float32)
        self.buffer, self.ones = np.empty((BATCH, len(bias)), np.float32), np.ones(len(bias), np.float32)

    def step(self, rows: np.ndarray, cls: np.ndarray) -> None:
        n = len(cls)
        p = self.buffer[:n] if n <= BATCH else np.empty((n, len(self.bias)), np.float32)
        for at in range(0, n, CLASS_PART):
            _, part = exponentials(self.weights, self.bias, rows[:, at:at + CLASS_PART], p[at:at + CLASS_PART])
            part /= (part @ self.ones)[:, None]
        p[np.arange(n), cls] -= 1            # expected less seen classes
        flat = rows.ravel()
        order = np.argsort(flat.astype(np.uint16), kind="stable")   # BUCKETS fit 16 bits
        ordered = flat[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        touched, times = ordered[starts], np.diff(np.r_[starts, len(flat)])
        gradient, ready = sums_of_rows(p, order % n, times)
        touched, times = touched[ready], times[ready]
        self.scale[touched] += np.einsum("ij,ij->i", gradient, gradient)
        gradient *= (self.rate / np.sqrt(self.scale[touched]))[:, None]
        now = np.take(self.weights, touched, axis=0, mode="clip")
        now -= gradient
        self.weights[touched] = now
        self.used[touched] += times


_SHARED: dict[str, Vocabulary] = {}


def _vocabulary(key: str, shared) -> Vocabulary:
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = shared.value.prepare()
    return _SHARED[key]


def _texts(batches: Iterator[pa.RecordBatch], column: str, vocabulary: Vocabulary):
    """Arrow batches in parts of some 100,000 tokens: (batch part, tokens per text, token's place among the
    slice's distinct words, these words, their (context number, class, whether outside the head))."""
    for part in C.text_slices(batches, column, SLICE_ROWS):
        tokens, distinct, sizes = tokens_of(part.column(column))
        encoded = vocabulary.encode(distinct)
        ends = np.cumsum(sizes)
        at = start = 0
        while at < len(sizes):
            group = at // C.ROWS_AT_ONCE * C.ROWS_AT_ONCE + C.ROWS_AT_ONCE
            stop = min(len(sizes), group, int(np.searchsorted(ends, start + 100_000, side="right")) + 1)
            yield part.slice(at, stop - at), sizes[at:stop], tokens[start:ends[stop - 1]], distinct, encoded
            at, start = stop, int(ends[stop - 1])


def _places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (key), ending and count c of the tokens of ``texts`` (one binary column)."""
    def summed(parts):
        return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

    def out(table):
        words = table["word"].combine_chunks()
        long = np.flatnonzero(pc.greater(pc.binary_length(words), HEAD_BYTES).to_numpy(zero_copy_only=False))
        if len(long):
            words = words.to_numpy(zero_copy_only=False)
            words[long] = [key_of(w) for w in words[long].tolist()]
            words = pa.array(words, pa.binary())
        return pa.RecordBatch.from_arrays([words, table["c"].combine_chunks()], names=["word", "c"])

    def run(batches):
        parts, held = [], 0
        for batch in C.text_slices(batches, 0, SLICE_ROWS):
            tokens, distinct, _ = tokens_of(batch.column(0))
            parts.append(pa.table([pa.array(distinct, pa.binary()), pa.array(np.bincount(tokens, minlength=len(distinct)))], names=["word", "c"]))
            held += len(distinct)
            if held > 2 * COUNTED_WORDS:
                parts = [summed(parts)]
                held = parts[0].num_rows
                if held > COUNTED_WORDS:
                    yield out(parts.pop())
                    held = 0
        if parts:
            yield out(summed(parts))

    return (texts.mapInArrow(C.tidy(run), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
            .select("word", F.substring("word", -2, 2).alias("ending"), "c"))


def _sum_blocks(size: int):
    """Sums of the partial weights by block; rows with places have only those of a block's ``size`` slots."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sent = batch.column("places").to_pylist() if "places" in batch.schema.names else [None] * batch.num_rows
            for block, places, data in zip(batch.column("block").to_pylist(), sent, batch.column("data").to_pylist(), strict=True):
                got = np.frombuffer(data, np.float32)
                if places is not None:
                    if block not in sums:
                        sums[block] = np.zeros(2 * size)
                    sums[block].reshape(size, 2)[np.frombuffer(places, np.uint16)] += got.reshape(-1, 2)
                elif block in sums:
                    sums[block] += got
                else:
                    sums[block] = got.astype(np.float64)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "data"])
    return run


def train(texts: DataFrame, vocabulary, key: str, bias: np.ndarray, trees, slots: int, rounds: int = ROUNDS,
          rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and of the choices after ``rounds`` passes over all of ``texts`` (one binary column)."""
    spark = texts.sparkSession
    weights, choices = np.zeros((BUCKETS, len(bias)), np.float32), np.zeros(slots, np.float32)
    width, size, batch = len(bias), min(slots, SLOT_BLOCK), batch_for(slots)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((weights, bias, choices))

        def walk(batches, shared=shared):
            trainer = None
            for _, sizes, tokens, _, (numbers, classes, _) in _texts(batches, "text", _vocabulary(key, vocabulary)):
                if trainer is None:
                    now, bias, then = shared.value
                    trainer, chooser = Trainer(now, bias, rate), ChoiceTrainer(then, trees.value)
                ids, cls = np.take(numbers, tokens), np.take(classes, tokens)
                rows, hashes = features(ids, _places(sizes))
                for at in range(0, len(cls), BATCH):
                    trainer.step(rows[:, at:at + BATCH], cls[at:at + BATCH])
                leaves = chooser.trees.leaves(ids, cls)
                for at in range(0, len(cls), batch):
                    chooser.step(hashes[:, at:at + batch], leaves[at:at + batch])
            if trainer is None:
                return
            salt = TaskContext.get().partitionId() % SALTS

            def sent(block, used, values, places=None):
                if used.any():
                    data = np.column_stack([used, values * used[:, None]]).astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([places], pa.binary()),
                         pa.array([data.tobytes()], pa.binary())], names=["block", "salt", "places", "data"])

            for block in range(BUCKETS // BLOCK):
                part = slice(block * BLOCK, (block + 1) * BLOCK)
                yield from sent(block, trainer.used[part], trainer.weights[part])
            for block in range(slots // size):       # numbered below 0
                part = slice(block * size, (block + 1) * size)
                used = chooser.scale[part] - 1
                some = np.flatnonzero(used)
                if 5 * len(some) < 4 * size:         # only those touched, of 10 bytes instead of 8
                    yield from sent(-1 - block, used[some], chooser.weights[part][some, None], some.astype(np.uint16).tobytes())
                else:
                    yield from sent(-1 - block, used, chooser.weights[part, None])

        partial = texts.mapInArrow(C.tidy(walk), "block int, salt int, places binary, data binary").repartition(parts, "block", "salt")
        total = partial.mapInArrow(_sum_blocks(size), "block int, data binary").repartition(parts, "block").mapInArrow(
            _sum_blocks(size), "block int, data binary")
        weights, choices = weights.copy(), choices.copy()
        for r in total.collect():       # the model: BUCKETS rows of bounded width, and the slots
            if r.block >= 0:
                into, data = weights[r.block * BLOCK:(r.block + 1) * BLOCK], np.frombuffer(r.data, np.float32).reshape(BLOCK, width + 1)
            else:
                into, data = choices[(-1 - r.block) * size:-r.block * size, None], np.frombuffer(r.data, np.float32).reshape(size, 2)
            some = data[:, 0] > 0
            into[some] = data[some, 1:] / data[some, :1]
    return weights, choices


def score(docs: DataFrame, is_training, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
          head: int = HEAD) -> DataFrame:
    """Train on the rows where ``is_training`` holds and score all rows.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10 probabilities of the whole text).
    """
    spark = docs.sparkSession
    text = C.as_binary(text_col).alias("text")
    training = docs.where(is_training).select(text)
    counts = C.written(word_counts(training), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    # the most frequent words: from the eighth of an octave where at most ``head`` are left
    octave = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    short = F.octet_length("word") <= HEAD_BYTES
    steps = counts.where(short).groupBy(octave.alias("o")).agg(F.count("*").alias("n")).orderBy(F.desc("o")).collect()
    lowest, left = 10 ** 6, head
    for r in steps:
        if r.n > left:
            break
        lowest, left = r.o, left - r.n
    top = counts.where(short & (octave >= lowest)).select("word", "c").toArrow()
    words, seen = top["word"].to_pylist(), top["c"].to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-int(seen[i]), words[i]))
    words, seen = [words[i] for i in order], seen[order]
    single = min(SINGLE, len(words))

    # endings: at most 65,793 of them; the classes' totals without the words that are classes
    endings = {bytes(r.ending): [r.c, r.n] for r in
               counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    for w, c in zip(words[:single], seen[:single].tolist(), strict=True):
        endings[w[-2:]][0] -= c
        endings[w[-2:]][1] -= 1
    own = sorted(endings, key=lambda e: (-endings[e][0], e))[:SUFFIX]
    vocab = Vocabulary(words, seen, own, single)
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for i in range(single):
        tokens[i] = seen[i]
    for e, (c, k) in endings.items():
        tokens[vocab.ending_class(e)] += c
        types[vocab.ending_class(e)] += k
    classes = np.array([i if i < single else vocab.ending_class(w[-2:]) for i, w in enumerate(words)], np.int64)
    in_head = np.bincount(classes, np.asarray(seen, float) + 1, CLASSES)
    rest = tokens + types + 1 - in_head     # mass of a class's words outside the head
    rest[:single] = 1
    room = np.log10(rest)                   # of P(word | class, not in the head)
    bias = np.log(tokens + 1).astype(np.float32)
    shared_vocab, key = spark.sparkContext.broadcast(vocab), uuid.uuid4().hex
    trees, slots = spark.sparkContext.broadcast(Trees(classes, np.asarray(seen), single, rest)), slots_for(n)
    training = training.coalesce(max(spark.sparkContext.defaultParallelism, n // TASK_TOKENS))
    weights, choices = (train(training, shared_vocab, key, bias, trees, slots, rounds) if n else
                        (np.zeros((BUCKETS, CLASSES), np.float32), np.zeros(slots, np.float32)))
    model = spark.sparkContext.broadcast((weights, bias, room, choices))
    log_all = float(np.log10(n + v + 1))

    def run(batches):
        vocab = _vocabulary(key, shared_vocab)
        weights, bias, room, choices = model.value
        choices = in_lines(choices)
        log_count = np.log10(vocab.counts + 1.0)
        rid = (TaskContext.get().partitionId()) << 33
        for batch, sizes, tokens, distinct, (numbers, classes, outside) in _texts(batches, "text", vocab):
            ids, cls, away = numbers[tokens], classes[tokens], outside[tokens]
            rows, hashes = features(ids, _places(sizes))
            in_class = class_log_probability(weights, bias, rows, cls)
            in_class += choice_log_probability(choices, trees.value, hashes, trees.value.leaves(ids, cls))
            in_class /= np.log(10)
            known = ~away
            own = np.zeros(len(ids))
            own[known] = log_count[ids[known]]
            word_part = np.where(known, 0, -room[cls])
            starts = np.cumsum(sizes) - sizes
            sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), own, in_class + word_part)]
            # the distinct words outside the head of each text, and how often
            text_of = np.repeat(np.arange(len(sizes)), sizes)
            pairs, times = np.unique(text_of[away] * len(distinct) + tokens[away], return_counts=True)
            rare, which = np.unique(pairs % len(distinct), return_inverse=True)
            keys = pa.array([key_of(distinct[k]) for k in rare.tolist()], pa.binary()).take(pa.array(which))
            offsets = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(distinct)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(len(sizes))), batch.column("id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                 *map(pa.array, sums), pa.ListArray.from_arrays(offsets, keys),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                names=["rid", "id", "held_out", "n_tokens", "known", "own", "part", "rare", "times"])
            rid += len(sizes)

    source = docs.select(docs[id_col].alias("id"), text, (~is_training).alias("held_out"))
    kinds = C.T.StructType([C.T.StructField("rid", C.T.LongType()), C.T.StructField("id", docs.schema[id_col].dataType),
                            *C.T._parse_datatype_string("held_out boolean, n_tokens long, known long, own double, part double, "
                                                        "rare array<binary>, times array<long>").fields])
    scored = C.written(source.mapInArrow(C.tidy(run), kinds), "lm-scored")
    # words outside the head: their counts come by a join, summed per text
    pairs = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "rid", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    rest = pairs.join(counts.where(~short | (octave < lowest)).select("word", "c"), "word").groupBy("rid").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("log_c"))
    more, log_c = F.coalesce("more", F.lit(0)), F.coalesce("log_c", F.lit(0.0))
    return scored.drop("rare", "times").join(rest, "rid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + more).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("own") + log_c - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("part") + log_c).alias("score"))
