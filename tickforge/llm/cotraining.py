"""Co-trained quality classifier (operator 9).

Two logistic classifiers see a document by different views: its text (hashed
words and binned text statistics) and its metadata (any columns besides the
text, binned).  Both are first fitted on a bounded labelled sample.  In each
round either view labels those of all other documents that it is sure of
(a calibrated probability beyond ``CONFIDENT``), those examples join the other
view's training set, and both are fitted again.  Last, the two views' log odds
are combined by a small logistic model on a part of the labelled sample that
no view was trained on, which calibrates them; a view that tells nothing gets
no weight.  All documents are scored in one pass without a shuffle.

The documents outside the sample stay in Spark, those whose label the sample
does not take too: their hashed features are written
once, tasks count the slots of what the views are sure of, and the views are
fitted by quasi-Newton steps whose gradients tasks sum over all examples, in
whole numbers, so that no result depends on how the input is split.  Together
the pseudo-labelled examples weigh at most as much as the labelled ones, at
any number of documents.

A document counts as good if its quality label is 1 and it is not labelled
toxic.  Only the labelled sample (``LABELLED`` documents, those with the
smallest id hashes, at most ``SAMPLE_BYTES`` of text) reaches the driver, as
hashed features.  Texts beyond ``LONG_TEXT`` bytes are taken last, so a few
very long ones never crowd out the rest; the first ``LEAST`` of a class come
before everything.  If the documents have labels of both classes but the
sample does not, training stops with an error.  Words count only when they
are linked to the label beyond chance (|z| >= ``MIN_Z``), so long texts do
not add up noise.

Null or empty texts have no words and are scored by their statistics; null
metadata is a value of its own.  Null labels are ignored, a document
labelled twice is good if half its labels or more are good.  Rows without an
id are unlabelled.  Without both
kinds of labels every document gets the share of good labels (1 without
labels) and is kept.  Ties in the sample's order go to the smaller id.
Repeated rows are scored each by itself; extra columns are carried through
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import common as C
from .quality_rules import FEATURES

BITS = 18
LABELLED, SAMPLE_BYTES = 12000, 96 << 20
LONG_TEXT, LEAST = 1 << 16, 50
ROUNDS, CONFIDENT = 2, 0.97
EVALUATIONS, HISTORY = 12, 5     # of a round's objective: one Spark job each
L2 = 1e-3
UNIT = 1 << 24           # gradients are summed as whole numbers of 1 / UNIT
MIN_Z, MIN_DOCS = 4.5, 6
THRESHOLD = 0.5          # of the calibrated probability of being good
SLICE_ROWS = 4 * C.ROWS_AT_ONCE  # texts whose words are told apart together
METADATA = ("lang", "source", "n_chars")


class WordSlots(dict):
    """lower-cased word -> feature slot."""

    def __missing__(self, word):
        n = self[word] = xxhash.xxh3_64_intdigest(word) & ((1 << BITS) - 1)
        return n


def _slot(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode(), seed=7) & ((1 << BITS) - 1)


def _bins(stats: dict[str, int]) -> list[int]:
    """A slot for each statistic's bin: eighths of an octave for ratios, octaves for counts."""
    out = []
    for name, top, below in FEATURES:
        if below is None:
            out.append(_slot(f"{name}={stats[top].bit_length()}"))
        else:
            ratio = stats[top] / max(stats[below], 1)
            out.append(_slot(f"{name}={min(int(ratio * 20), 80)}"))
    return out


def text_features(text: bytes, slots: WordSlots, memory: C.WordNumbers) -> np.ndarray:
    """Distinct feature slots of a whole text."""
    words = text.lower().split()
    if len(slots) > C.WORD_MEMORY:
        slots.clear()
    ids = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
    extra = _bins(dict(zip(C.STAT_NAMES, C.text_stats(text, memory), strict=True)))
    return np.unique(np.concatenate([ids, np.array(extra, np.int64)]))


def text_rows(texts: pa.Array) -> Rows:
    """text_features of many binary texts without nulls: the words of all are told apart, lower-cased and hashed once."""
    codes, distinct, sizes = C.split_words(texts)
    codes = codes.astype(np.int64)
    lower = pc.ascii_lower(pa.array(distinct, pa.binary()).view(pa.string())).view(pa.binary()).to_pylist()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) & ((1 << BITS) - 1) for w in lower), np.int64, len(lower))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    of = _distinct(owner * max(len(distinct), 1) + codes) // max(len(distinct), 1)
    n_distinct = np.bincount(of, minlength=len(sizes)).tolist()
    ends = np.cumsum(sizes)
    extra = [_bins(dict(zip(C.STAT_NAMES, C.stats_of(t, codes[e - n:e], d), strict=True)))
             for t, n, e, d in zip(texts.to_pylist(), sizes.tolist(), ends.tolist(), n_distinct, strict=True)]
    extra = np.array(extra, np.int64).reshape(len(sizes), len(FEATURES)) + (np.arange(len(sizes)) << BITS)[:, None]
    found = _distinct(np.append(owner << BITS | hashed[codes], extra))
    return Rows((found & ((1 << BITS) - 1)).astype(np.int32), np.bincount(found >> BITS, minlength=len(sizes)))


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order (by sorting: np.unique hashes, which is slower here)."""
    keys = np.sort(keys)
    return keys[np.diff(keys, prepend=-1) != 0]


def metadata_features(values: dict) -> np.ndarray:
    """One slot per column: its value, numbers by quarter octaves."""
    out = []
    for name, v in values.items():
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            out.append(_slot(f"meta {name}={v!r}"))
        elif not np.isfinite(float(v)):
            out.append(_slot(f"meta {name}=not finite"))
        else:
            out.append(_slot(f"meta {name}={int(np.sign(v))}:{int(4 * np.log2(1 + abs(float(v))))}"))
    return np.unique(np.array(out, np.int64))


@dataclass
class Linear:
    """Logistic model over chosen slots."""
    weights: np.ndarray      # of all slots, 0 where unused
    bias: float

    def logit(self, slots: np.ndarray) -> float:
        return float(self.bias + self.weights[slots].sum())

    def logits(self, rows: Rows | list[np.ndarray]) -> np.ndarray:
        """Of many rows by one lookup."""
        rows = rows if isinstance(rows, Rows) else Rows.of(rows)
        return self.bias + np.bincount(rows.owner, self.weights[rows.flat], len(rows))


class Rows:
    """Rows of slots one after another, as Arrow holds them."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate(rows) if rows else np.zeros(0, np.int32), np.array([len(r) for r in rows], np.int64))

    @classmethod
    def stored(cls, column: pa.BinaryArray) -> Rows:
        """From a column of 32-bit numbers' bytes, without nulls."""
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1]
        flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data and len(column) else np.zeros(0, np.uint8)
        return cls(flat.view(np.int32), np.diff(ends).astype(np.int64) // 4)

    def __len__(self):
        return len(self.sizes)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def take(self, mask: np.ndarray) -> Rows:
        return Rows(self.flat[np.repeat(mask, self.sizes)], self.sizes[mask])

    def mapped(self, places: np.ndarray) -> Rows:
        """Each entry's place, without those that have none (-1)."""
        at = places[self.flat]
        return Rows(at[at >= 0], np.bincount(self.owner[at >= 0], minlength=len(self)))

    def bytes(self) -> list[bytes]:
        data, ends = self.flat.astype(np.int32).tobytes(), np.append(0, np.cumsum(self.sizes)) * 4
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _linked(n: np.ndarray, good: np.ndarray, share: float, words_only_by_z: bool) -> np.ndarray:
    """Slots linked to the label beyond chance (all that occur often enough, for metadata).

    ``n`` and ``good``: of each slot, the examples and the good ones; ``share`` of good ones in all.
    """
    if not words_only_by_z:
        return np.flatnonzero(n > 0)
    z = (good - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return np.flatnonzero((n >= MIN_DOCS) & (np.abs(z) >= MIN_Z))


def slot_counts(rows: Rows, y: np.ndarray) -> np.ndarray:
    """Rows of class 0 and 1 that hold each slot; last, all rows of the class."""
    out = np.zeros((2, (1 << BITS) + 1), np.int64)
    own = np.repeat(y, rows.sizes)
    for c in (0, 1):
        out[c, :-1] = np.bincount(rows.flat[own == c], minlength=1 << BITS)
        out[c, -1] = (y == c).sum()
    return out


def fit(rows: list[np.ndarray], y: np.ndarray, by_z: bool, steps: int = 300, l2: float = L2) -> Linear:
    """Full-batch gradient steps (Adam) on the chosen slots."""
    counts = slot_counts(Rows.of(rows), y)[:, :-1].astype(float)
    chosen = _linked(counts.sum(0), counts[1], y.mean(), by_z)
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    flat = place[np.concatenate(rows)]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[flat >= 0]
    flat = flat[flat >= 0]
    w, b = np.zeros(len(chosen)), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        error = _sigmoid(b + np.bincount(owner, w[flat], len(rows))) - y
        g = np.bincount(flat, error[owner], len(chosen)) / len(rows) + l2 * w
        gb = error.mean()
        m, v, mb, vb = .9 * m + .1 * g, .99 * v + .01 * g * g, .9 * mb + .1 * gb, .99 * vb + .01 * gb * gb
        rate = 0.1 / (1 + t / 100)
        w -= rate * (m / (1 - .9 ** t)) / (np.sqrt(v / (1 - .99 ** t)) + 1e-8)
        b -= rate * (mb / (1 - .9 ** t)) / (np.sqrt(vb / (1 - .99 ** t)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[chosen] = w
    return Linear(weights, b)


def _combine(logits: np.ndarray, y: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights (>= 0) of the views' log odds and a bias."""
    x = np.column_stack([np.clip(logits, -12, 12), np.ones(len(y))])
    w = np.array([1.0] * logits.shape[1] + [0.0])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) / len(y) + 1e-3 * np.append(w[:-1] - 0.5, 0)
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class CoTrained:
    text: Linear | None
    meta: Linear | None
    mix: np.ndarray
    metadata: tuple[str, ...]
    prior: float = 1.0
    exchanged: tuple[int, ...] = ()

    def probability(self, text_logit, meta_logit):
        if self.text is None:
            return np.full(len(text_logit), self.prior)
        x = np.column_stack([np.clip(text_logit, -12, 12), np.clip(meta_logit, -12, 12), np.ones(len(text_logit))])
        return _sigmoid(x @ self.mix)


def believed(text_rows, meta_rows, models, scales) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each view, which rows the other view is sure of, and their classes."""
    sure = []
    for model, scale, rows in zip(models, scales, (text_rows, meta_rows), strict=True):
        p = _sigmoid(np.clip(model.logits(rows), -12, 12) * scale[0] + scale[1])
        sure.append(((p >= CONFIDENT) | (p <= 1 - CONFIDENT), (p > 0.5).astype(np.int64)))
    clash = sure[0][0] & sure[1][0] & (sure[0][1] != sure[1][1])     # they disagree: neither is believed
    return [(sure[1 - k][0] & ~clash, sure[1 - k][1]) for k in (0, 1)]


def believed_counts(text_rows: Rows, meta_rows: Rows, models, scales) -> np.ndarray:
    """slot_counts of either view's new examples."""
    views = (text_rows, meta_rows)
    return np.stack([slot_counts(views[k].take(pick), guess[pick])
                     for k, (pick, guess) in enumerate(believed(text_rows, meta_rows, models, scales))])


def examples(text_rows: Rows, meta_rows: Rows, models, scales, places) -> list[tuple[Rows, np.ndarray]]:
    """For each view, its new examples by the places of the chosen slots, and their classes."""
    views = (text_rows, meta_rows)
    return [(views[k].take(pick).mapped(places[k]), guess[pick])
            for k, (pick, guess) in enumerate(believed(text_rows, meta_rows, models, scales))]


def pulls(x: np.ndarray, bias: int, rows: Rows, y: np.ndarray) -> tuple[np.ndarray, int]:
    """Sums of one view's gradients and losses over examples, in whole units."""
    owner = rows.owner
    z = np.clip(x[bias] + np.bincount(owner, x[rows.flat], len(rows)), -35, 35)
    error = np.rint((_sigmoid(z) - y) * UNIT)
    grad = np.bincount(rows.flat, error[owner], len(x)).astype(np.int64)
    grad[bias] += int(error.sum())
    return grad, int(np.rint((np.logaddexp(0, z) - y * z) * UNIT).sum())


def both_pulls(x, biases, made) -> np.ndarray:
    """Gradients of both views' examples, then the two losses."""
    grads, losses = zip(*(pulls(x, b, rows, y) for b, (rows, y) in zip(biases, made, strict=True)), strict=True)
    return np.append(grads[0] + grads[1], losses)


class LocalPool:
    """Unlabelled rows in memory."""

    def __init__(self, text_rows, meta_rows):
        self.views = Rows.of(text_rows), Rows.of(meta_rows)

    def counts(self, models, scales) -> np.ndarray:
        return believed_counts(*self.views, models, scales)

    def settle(self, models, scales, places) -> None:
        self.made = examples(*self.views, models, scales, places)

    def pulls(self, x, biases) -> np.ndarray:
        return both_pulls(x, biases, self.made)


class SparkPool:
    """Unlabelled documents as a table of hashed features (t, m), each round's examples as another."""

    def __init__(self, features: DataFrame):
        self.features, self.made = features, None
        self.sc = features.sparkSession.sparkContext

    def counts(self, models, scales) -> np.ndarray:
        shared = self.sc.broadcast((models, scales))

        def run(batches):
            total = np.zeros((2, 2, (1 << BITS) + 1), np.int64)
            for batch in batches:
                total += believed_counts(Rows.stored(batch.column("t")), Rows.stored(batch.column("m")), *shared.value)
            found = np.nonzero(total)
            names = ["view", "class", "slot", "n"]
            yield from pa.table([pa.array(v, pa.int64()) for v in (*found, total[found])], names=names).to_batches(1 << 16)

        got = self.features.mapInArrow(C.tidy(run), "view long, class long, slot long, n long").groupBy("view", "class", "slot").agg(
            F.sum("n").alias("n")).toArrow()     # at most 4 * (2 ** BITS + 1) rows
        out = np.zeros((2, 2, (1 << BITS) + 1), np.int64)
        out[got["view"].to_numpy(), got["class"].to_numpy(), got["slot"].to_numpy()] = got["n"].to_numpy()
        shared.unpersist()
        return out

    def settle(self, models, scales, places) -> None:
        shared = self.sc.broadcast((models, scales, places))

        def run(batches):
            for batch in batches:
                made = examples(Rows.stored(batch.column("t")), Rows.stored(batch.column("m")), *shared.value)
                for k, (rows, y) in enumerate(made):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), k, np.int32)), pa.array(y.astype(np.int32)), pa.array(rows.bytes(), pa.binary())],
                        names=["view", "y", "at"])

        self.made = C.written(self.features.mapInArrow(C.tidy(run), "view int, y int, at binary"), "cotrain-examples")

    def pulls(self, x, biases) -> np.ndarray:
        shared = self.sc.broadcast(x)

        def run(batches):
            total = np.zeros(len(shared.value) + 2, np.int64)
            for batch in batches:
                view, y, rows = batch.column("view").to_numpy(), batch.column("y").to_numpy(), Rows.stored(batch.column("at"))
                total += both_pulls(shared.value, biases, [(rows.take(view == k), y[view == k]) for k in (0, 1)])
            found = np.flatnonzero(total)
            yield from pa.table([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())],
                                names=["place", "sum"]).to_batches(1 << 16)

        got = self.made.mapInArrow(run, "place long, sum long").groupBy("place").agg(F.sum("sum").alias("sum")).toArrow()
        out = np.zeros(len(x) + 2, np.int64)
        out[got["place"].to_numpy()] = got["sum"].to_numpy()
        shared.unpersist()
        return out


def minimise(value, x: np.ndarray, curvature: np.ndarray, evaluations: int = EVALUATIONS) -> np.ndarray:
    """Limited-memory quasi-Newton steps from ``x``; ``value`` gives objective and gradient.

    ``curvature``: a first guess of the objective's second derivative in each direction.
    """
    loss, grad = value(x)
    pairs, left, rate = [], evaluations - 1, 1.0
    while left > 0 and np.abs(grad).max() > 1e-6:
        q, back = grad.copy(), []
        for s, d in reversed(pairs):
            a = (s @ q) / (s @ d)
            q -= a * d
            back.append(a)
        scale = 1.0
        if pairs:
            s, d = pairs[-1]
            scale = (s @ d) / (d @ (d / curvature))
        q = scale * q / curvature
        for (s, d), a in zip(pairs, reversed(back), strict=True):
            q += s * (a - (d @ q) / (s @ d))
        new = x - rate * q
        new_loss, new_grad = value(new)
        left -= 1
        if not new_loss < loss:          # too far: the same way again, shorter
            rate /= 4
            continue
        s, d = new - x, new_grad - grad
        if s @ d > 1e-12:
            pairs = [*pairs, (s, d)][-HISTORY:]
        x, loss, grad, rate = new, new_loss, new_grad, 1.0
    return x


def refit(models: list[Linear], scales, views, y: np.ndarray, pool) -> tuple[list[Linear], int]:
    """Both views fitted to the labelled rows and to what the other view is sure of; the number of such examples."""
    seen = pool.counts(models, scales)
    new = seen[:, :, -1].sum(1)
    if not new.sum():
        return models, 0
    weight = [min(1.0, len(y) / max(int(n), 1)) for n in new]
    labelled = [Rows.of(v) for v in views]
    chosen, places, at = [], [], 0
    for k in (0, 1):
        counts = slot_counts(labelled[k], y) + weight[k] * seen[k]
        share = counts[1, -1] / counts[:, -1].sum()
        chosen.append(_linked(counts[:, :-1].sum(0), counts[1, :-1], share, words_only_by_z=k == 0))
        place = np.full(1 << BITS, -1)
        place[chosen[k]] = at + np.arange(len(chosen[k]))
        places.append(place)
        at += len(chosen[k]) + 1
    biases = (len(chosen[0]), at - 1)
    pool.settle(models, scales, places)
    x = np.concatenate([np.append(m.weights[c], m.bias) for m, c in zip(models, chosen, strict=True)])
    labelled = [labelled[k].mapped(places[k]) for k in (0, 1)]
    total = [len(y) + weight[k] * int(new[k]) for k in (0, 1)]
    part = [slice(0, biases[0] + 1), slice(biases[0] + 1, at)]
    penalty = np.full(at, L2)
    penalty[list(biases)] = 0

    def value(x):
        pooled, out, grad = pool.pulls(x, biases) / UNIT, 0.0, penalty * x
        own = both_pulls(x, biases, [(rows, y) for rows in labelled]) / UNIT
        for k in (0, 1):
            grad[part[k]] += (own[part[k]] + weight[k] * pooled[part[k]]) / total[k]
            out += (own[at + k] + weight[k] * pooled[at + k]) / total[k]
        return out + (penalty * x * x).sum() / 2, grad

    curvature = np.full(at, L2)
    for k in (0, 1):
        flat, owner = labelled[k].flat, labelled[k].owner
        p = _sigmoid(x[biases[k]] + np.bincount(owner, x[flat], len(y)))
        curvature += np.bincount(flat, (p * (1 - p))[owner], at) / len(y)
        curvature[biases[k]] += (p * (1 - p)).mean()
    x = minimise(value, x, curvature)
    out = []
    for k in (0, 1):
        weights = np.zeros(1 << BITS)
        weights[chosen[k]] = x[part[k]][:-1]
        out.append(Linear(weights, float(x[biases[k]])))
    return out, int(new.sum())


def co_train(text_rows, meta_rows, y, metadata, pool=None) -> CoTrained:
    """``y``: 1 good, 0 bad, -1 unlabelled (or in ``pool``); every fifth labelled row calibrates."""
    labelled = np.flatnonzero(y >= 0)
    if len(labelled) < 10 or len(set(y[labelled])) < 2:
        return CoTrained(None, None, np.zeros(3), metadata, float(y[labelled].mean()) if len(labelled) else 1.0)
    held = labelled[4::5]
    train = np.setdiff1d(labelled, held)
    if len(set(y[train])) < 2 or len(set(y[held])) < 2:
        held = train = labelled
    if pool is None:
        free = np.flatnonzero(y < 0)
        pool = LocalPool([text_rows[i] for i in free], [meta_rows[i] for i in free])
    views = [[rows[i] for i in train] for rows in (text_rows, meta_rows)]
    kept = [[rows[i] for i in held] for rows in (text_rows, meta_rows)]
    models = [fit(views[k], y[train].astype(float), by_z=k == 0) for k in (0, 1)]
    exchanged = []
    for _ in range(ROUNDS):      # a view is calibrated on the held part before it is trusted
        scales = [_combine(models[k].logits(kept[k])[:, None], y[held].astype(float)) for k in (0, 1)]
        models, n = refit(models, scales, views, y[train], pool)
        if not n:
            break
        exchanged.append(n)
    logits = np.column_stack([models[k].logits(kept[k]) for k in (0, 1)])
    return CoTrained(models[0], models[1], _combine(logits, y[held].astype(float)), metadata,
                     float(y[labelled].mean()), tuple(exchanged))


def _features(batches: Iterator[pa.RecordBatch], metadata: tuple[str, ...]):
    """(batch, text slots, metadata slots) of batches with __text and __meta."""
    for batch in C.text_slices(batches, "__text", SLICE_ROWS):
        metas = batch.column("__meta").to_pylist()
        yield (batch, text_rows(batch.column("__text")),
               Rows.of([metadata_features({n: m[f"m{k}"] for k, n in enumerate(metadata)}) for m in metas]))


def _meta_struct(docs: DataFrame, metadata: tuple[str, ...]):
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    kinds = dict(docs.dtypes)
    return F.struct(F.lit(0).alias("m"), *((docs[n] if kinds[n] in numeric else docs[n].cast("string")).alias(f"m{k}")
                                           for k, n in enumerate(metadata)))


def marks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """__id and __good (1 or 0) of all labelled ids."""
    good = F.when(labels["quality"].isNull() & labels["toxic"].isNull(), None).otherwise(
        (F.coalesce(labels["quality"], F.lit(1)) == 1) & (F.coalesce(labels["toxic"], F.lit(0)) == 0))
    marked = labels.select(labels[id_col].alias("__id"), good.cast("int").alias("__good")).where("__id is not null and __good is not null")
    return marked.groupBy("__id").agg((F.avg("__good") >= 0.5).cast("int").alias("__good"))


def sample_ids(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               labelled: int = LABELLED) -> DataFrame:
    """__id and __good of the labelled documents to be fitted on (see the module text)."""
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text"))
    # one row an id, with the bytes of its longest text
    sizes = rows.where("__id is not null").groupBy("__id").agg(F.max(F.coalesce(F.octet_length("__text"), F.lit(0))).alias("__size"))
    sized = sizes.join(marks(docs, labels, id_col), "__id").withColumn("__h", F.xxhash64("__id"))
    long = F.when(F.col("__size") > LONG_TEXT, F.col("__size")).otherwise(0)     # the longest last: it crowds out no other
    classes = {r[0] for r in sized.select("__good").distinct().collect()}
    sized = C.written(sized.orderBy(long, "__h", "__id").limit(labelled), "cotrain-sample")
    # at most ``labelled`` rows: a running sum over them keeps the text within SAMPLE_BYTES
    own = F.row_number().over(Window.partitionBy("__good").orderBy(long, "__h", "__id"))
    ranked = sized.withColumn("__first", (own <= LEAST).cast("int"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("__first"), long, "__h", "__id")
    chosen = ranked.withColumn("__sum", F.sum("__size").over(order)).where((F.col("__sum") <= SAMPLE_BYTES) | (F.col("__first") == 1))
    if classes - {r[0] for r in chosen.select("__good").distinct().collect()}:
        raise ValueError("the sample lacks a class that the labels have: raise `labelled` or SAMPLE_BYTES")
    return chosen.select("__id", "__good")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          metadata: tuple[str, ...] = METADATA, labelled: int = LABELLED) -> CoTrained:
    """Fit both views on a bounded labelled sample and on all unlabelled documents."""
    metadata = tuple(n for n in metadata if n in docs.columns)
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text"),
                       _meta_struct(docs, metadata).alias("__meta"))
    kind = rows.schema["__id"].dataType

    def extract(batches):
        for batch, texts, metas in _features(batches, metadata):
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"),
                 *(pa.array(rows.bytes(), pa.binary()) for rows in (texts, metas))],
                names=["id", "t", "m"])

    def features(of: DataFrame) -> DataFrame:
        return of.mapInArrow(C.tidy(extract), C.fields("id", kind, "t binary, m binary"))

    chosen = sample_ids(docs, labels, id_col, text_col, labelled)
    sample = features(rows.join(F.broadcast(chosen), "__id")
                      .groupBy("__id").agg(F.max(F.struct(C.as_binary("__text").alias("t"), F.col("__meta").alias("m"))).alias("r"))
                      .select("__id", F.col("r.t").alias("__text"), F.col("r.m").alias("__meta")))
    got = sample.join(F.broadcast(chosen), F.col("id") == F.col("__id")).withColumn("h", F.xxhash64("id")).collect()
    got.sort(key=lambda r: (r["h"], r["id"]))
    texts, metas = ([np.frombuffer(r[c], np.int32) for r in got] for c in ("t", "m"))
    y = np.array([r["__good"] for r in got], np.int64)
    if len(set(y.tolist())) < 2:
        return co_train(texts, metas, y, metadata)
    # all documents but those of the sample, which is small enough to be broadcast: no text is shuffled
    free = features(rows.join(F.broadcast(chosen.select("__id")), "__id", "left_anti")
                    .select("__id", C.as_binary("__text").alias("__text"), "__meta"))
    return co_train(texts, metas, y, metadata, SparkPool(C.written(free.select("t", "m"), "cotrain-features")))


def score(docs: DataFrame, model: CoTrained, carry, text_col: str = "text") -> DataFrame:
    """``carry`` (a column), p_text, p_meta, p_good and kept of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        weights = None if m.text is None else m.text.weights
        made = _features(batches, m.metadata) if weights is not None else ((b, None, None) for b in C.slices(batches))
        for batch, texts, metas in made:
            n = batch.num_rows
            lt, lm = np.zeros(n), np.zeros(n)
            if weights is not None:
                lt, lm = m.text.logits(texts), m.meta.logits(metas)
            p = m.probability(lt, lm)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__carry"), pa.array(_sigmoid(lt)), pa.array(_sigmoid(lm)), pa.array(p),
                 pa.array(p >= THRESHOLD if weights is not None else np.ones(n, bool))],
                names=["__carry", "p_text", "p_meta", "p_good", "kept"])

    source = docs.select(carry.alias("__carry"), C.as_binary(text_col).alias("__text"),
                         _meta_struct(docs, model.metadata).alias("__meta"))
    return source.mapInArrow(C.tidy(run), C.fields("__carry", source.schema["__carry"].dataType,
                                           "p_text double, p_meta double, p_good double, kept boolean"))


def filter_documents(docs: DataFrame, model: CoTrained, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns unchanged."""
    row = F.struct(*(docs[n] for n in docs.columns))
    return score(docs, model, row, text_col).where("kept").select("__carry.*")
