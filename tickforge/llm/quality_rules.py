"""Learned decision lists over text statistics (operator 8).

Sequential covering: a rule is a conjunction of thresholds on statistics.
It is grown on one part of the labelled sample by FOIL's information gain,
pruned from its end on the other part, kept if it is precise enough there,
and what it covers leaves the sample before the next rule is grown.  The
ordered list is emitted as one Spark CASE expression, so the verdict on all
documents is a native expression over the statistics columns.

Only the labelled sample (at most ``SAMPLE`` documents, the ones with the
smallest hash of their id) reaches the driver, as statistics.  The statistics
of all documents are counted over whole texts, one pass, no shuffle.

Null or empty texts have zero counts (and so fail the base rule); a null id
stays null and takes no label.  Labels that are null are ignored; a document
labelled twice counts as good if half its labels or more are good.  With no
labels there are no rules and only the base rule rejects.  Ties between
conditions go to the first feature in ``FEATURES`` and the lowest threshold.
Repeated rows are judged each by itself.  Only the id and text columns are
read, so clashing names do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 8000            # labelled documents that reach the driver at most
CUTS = 48                # thresholds tried per feature (quantiles of the sample)
MAX_RULES, MAX_TERMS = 24, 4
PRECISION = 0.9          # on the pruning part
MIN_COVER = 5            # bad documents a rule must cover on the growing part
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50   # the base rule

# Ratios of counts, as (name, numerator, denominator); same formula in numpy and Spark.
FEATURES = (
    ("symbols_per_word", "n_symbols", "n_words"),
    ("upper_per_letter", "n_upper", "n_letters"),
    ("dup_lines_per_line", "n_dup_lines", "n_lines"),
    ("repeat_per_word", "n_repeat_words", "n_words"),
    ("distinct_per_word", "n_distinct_words", "n_words"),
    ("chars_per_word", "word_chars", "n_words"),
    ("digits_per_char", "n_digits", "word_chars"),
    ("bangs_per_word", "n_bangs", "n_words"),
    ("words", "n_words", None),
)


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool          # value > cut, else value <= cut
    cut: float

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    terms: tuple[Term, ...]
    precision: float
    covered: int

    def __str__(self):
        return " and ".join(map(str, self.terms))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and STAT_NAMES of every row, over the whole text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = C.WordNumbers()
        for batch in C.slices(batches):
            rows = [C.text_stats(t, memory) for t in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [()] * len(C.STAT_NAMES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                             names=[id_col, *C.STAT_NAMES])

    return docs.select(docs[id_col], C.as_binary(text_col).alias("text")).mapInArrow(
        C.tidy(count), C.fields(id_col, docs.schema[id_col].dataType, ", ".join(f"{n} long" for n in C.STAT_NAMES)))


def _feature_arrays(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: stats[top] / np.maximum(stats[below], 1) if below else stats[top].astype(float)
            for name, top, below in FEATURES}


def _feature_column(name: str) -> Column:
    top, below = next((t, b) for n, t, b in FEATURES if n == name)
    value = F.col(top).cast("double")
    return value / F.greatest(F.col(below), F.lit(1)) if below else value


def _holds(term: Term, x: dict[str, np.ndarray]) -> np.ndarray:
    return x[term.feature] > term.cut if term.above else x[term.feature] <= term.cut


def _grow(x, bad, cuts) -> list[Term]:
    """Adds the term of greatest FOIL gain until only bad documents are covered."""
    inside, terms = np.ones(len(bad), bool), []
    while len(terms) < MAX_TERMS:
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for name, values in x.items():
            order = np.searchsorted(cuts[name], values[inside], side="left")   # cuts below the value
            hits = np.bincount(order, weights=bad[inside], minlength=len(cuts[name]) + 1)
            every = np.bincount(order, minlength=len(cuts[name]) + 1)
            low_p, low_n = np.cumsum(hits)[:-1], np.cumsum(every - hits)[:-1]  # value <= cut
            for above in (False, True):
                p, n = (p0 - low_p, n0 - low_n) if above else (low_p, low_n)
                gain = p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - math.log2(p0 / (p0 + n0)))
                gain[p < MIN_COVER] = -1
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best_gain:
                    best, best_gain = Term(name, above, float(cuts[name][k])), gain[k]
        if best is None:
            break
        terms.append(best)
        inside &= _holds(best, x)
    return terms


def _prune(terms, x, bad) -> tuple[list[Term], float]:
    """The shortest beginning of the conjunction that is worth most on the pruning part."""
    best, worth, precision = terms, -2.0, 0.0
    inside = np.ones(len(bad), bool)
    for k, term in enumerate(terms, 1):
        inside &= _holds(term, x)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if p + n and (p - n) / (p + n) > worth + 1e-12:
            best, worth, precision = terms[:k], (p - n) / (p + n), p / (p + n)
    return best, precision


def learn(stats: dict[str, np.ndarray], bad: np.ndarray, precision: float = PRECISION) -> list[Rule]:
    """The ordered rules that reject, from labelled statistics (see module text)."""
    x = _feature_arrays(stats)
    cuts = {}
    for name, values in x.items():
        marks = np.unique(values)
        if len(marks) > CUTS:
            marks = np.unique(np.quantile(values, np.linspace(0, 1, CUTS), method="lower"))
        cuts[name] = (marks[:-1] + marks[1:]) / 2 if len(marks) > 1 else marks[:0]
    part = np.arange(len(bad)) % 3 == 2      # rows come in order of a hash
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < MAX_RULES:
        g, v = left & ~part, left & part
        terms = _grow({k: a[g] for k, a in x.items()}, bad[g], cuts)
        if not terms:
            break
        terms, exact = _prune(terms, {k: a[v] for k, a in x.items()}, bad[v])
        inside = left.copy()
        for term in terms:
            inside &= _holds(term, x)
        if exact < precision or not (inside & bad).any():
            break
        rules.append(Rule(tuple(terms), exact, int(inside.sum())))
        left &= ~inside
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, 0 if none does."""
    if not rules:
        return F.lit(0)
    out = None
    for k, rule in enumerate(rules, 1):
        holds = None
        for t in rule.terms:
            value = _feature_column(t.feature)
            one = value > F.lit(t.cut) if t.above else value <= F.lit(t.cut)
            holds = one if holds is None else holds & one
        out = F.when(holds, F.lit(k)) if out is None else out.when(holds, F.lit(k))
    return out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, good: Column, id_col: str = "doc_id",
                    text_col: str = "text", size: int = SAMPLE) -> DataFrame:
    """id, text and ``good`` (0 or 1) of at most ``size`` labelled ids of ``docs``.

    The ids with the smallest hash are taken; the list is bounded by ``size``
    and small enough to broadcast.
    """
    wanted = (labels.select(labels[id_col].alias("__id"), good.cast("int").alias("__good"))
              .where("__id is not null and __good is not null")
              .groupBy("__id").agg(F.avg("__good").alias("__share")))
    present = docs.select(docs[id_col].alias("__id")).distinct()
    wanted = (wanted.join(present, "__id", "left_semi")
              .orderBy(F.xxhash64("__id"), "__id").limit(size)
              .select("__id", (F.col("__share") >= 0.5).cast("int").alias("__good")))
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text"))
    return rows.join(F.broadcast(wanted), "__id")


def learn_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               size: int = SAMPLE) -> list[Rule]:
    """Rules from the quality labels of a bounded sample of documents."""
    sample = labelled_sample(docs, labels, labels["quality"], id_col, text_col, size)
    stats = statistics(sample.select(F.struct("__id", "__good").alias("__key"), "__text"), "__key", "__text")
    # a repeated id is one example: its smallest counts
    rows = (stats.groupBy("__key").agg(*(F.min(n).alias(n) for n in C.STAT_NAMES))
            .where(~base_failed()).orderBy(F.xxhash64("__key.__id"), "__key").collect())
    if not rows:
        return []
    values = {n: np.array([r[n] for r in rows], np.int64) for n in C.STAT_NAMES}
    return learn(values, np.array([r["__key"]["__good"] == 0 for r in rows]))


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds base_failed, rule (number of the rule that rejects, 0: none) and kept."""
    failed = base_failed()
    return stats.withColumns({"base_failed": failed, "rule": rule_number(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))


def filter_documents(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rule and the decision list keep, columns unchanged."""
    names = docs.columns
    renamed = docs.select(F.struct(*(docs[n] for n in names)).alias("__row"), docs[text_col].alias("__text"))
    return judge(statistics(renamed, "__row", "__text"), rules).where("kept").select("__row.*")
