"""Quality rules, co-training, token counts, packing and the language model."""

import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tickforge.llm import common as C
from tickforge.llm import cotraining, maxent_lm, packing, quality_rules, queries, token_counts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def as_key(r, cols):
    return sorted(((r[c] is None, r[c]) for c in cols), key=str)


# -- quality rules


def brute_stats(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_statistics_against_brute_force(odd_docs, odd_rows):
    got = quality_rules.statistics(odd_docs).collect()
    assert sorted(map(str, [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got])) == \
        sorted(map(str, [(r[0], *brute_stats(r[1])) for r in odd_rows]))


def test_repeated_words_beyond_the_word_numbers():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 6, 400) + (1 << 22)
    assert C.repeated_words(ids) == C.repeated_words(ids - (1 << 22)) > 0


def test_rules_are_learned_and_judged(spark, odd_docs, odd_labels):
    rng = np.random.default_rng(0)
    n = 3000
    stats = {k: np.full(n, 100) for k in C.STAT_NAMES}
    stats["n_symbols"] = rng.integers(0, 100, n)
    stats["n_upper"] = rng.integers(0, 100, n)
    bad = (stats["n_symbols"] > 60) | ((stats["n_upper"] > 50) & (stats["n_symbols"] > 30))
    rules = quality_rules.learn(stats, bad)
    assert len(rules) >= 2
    x = quality_rules._feature_arrays(stats)
    hit = np.zeros(n, bool)
    for r in rules:
        one = np.ones(n, bool)
        for t in r.terms:
            one &= quality_rules._holds(t, x)
        hit |= one
    assert (hit == bad).mean() > 0.95
    df = spark.createDataFrame([tuple(int(stats[k][i]) for k in C.STAT_NAMES) for i in range(300)], ", ".join(f"{k} long" for k in C.STAT_NAMES))
    assert [r.rule > 0 for r in quality_rules.judge(df, rules).collect()] == hit[:300].tolist()
    assert quality_rules.learn(stats, np.zeros(n, bool)) == []
    kept = quality_rules.filter_documents(odd_docs, quality_rules.learn_from(odd_docs, odd_labels))
    assert kept.columns == odd_docs.columns
    judged = quality_rules.judge(quality_rules.statistics(odd_docs), []).where("kept").count()
    assert 0 < kept.count() <= judged


def test_rules_without_labels_or_rows(no_docs, odd_docs, odd_labels):
    assert quality_rules.learn_from(odd_docs, odd_labels.limit(0)) == []
    assert quality_rules.learn_from(no_docs, odd_labels) == []
    assert quality_rules.filter_documents(no_docs, []).count() == 0


# -- co-training


def test_co_training_scores_every_row(odd_docs, odd_labels, no_docs):
    model = cotraining.train(odd_docs, odd_labels)
    got = cotraining.score(odd_docs, model, odd_docs["doc_id"]).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.p_good <= 1 for r in got)
    assert cotraining.filter_documents(odd_docs, model).columns == odd_docs.columns
    assert cotraining.score(no_docs, model, no_docs["doc_id"]).count() == 0
    blank = cotraining.train(odd_docs, odd_labels.limit(0))
    assert all(r.kept for r in cotraining.score(odd_docs, blank, odd_docs["doc_id"]).collect())


def test_co_training_held_out_accuracy(spark, small_dir):
    d = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = C.table(spark, d, "documents"), C.table(spark, d, "labels")
    model = cotraining.train(docs, labels.where("doc_id % 4 <> 1"))
    out = cotraining.score(docs, model, docs["doc_id"]).join(labels.where("doc_id % 4 = 1"), F.col("__carry") == F.col("doc_id")).toPandas()
    good = (out.quality == 1) & (out.toxic == 0)
    assert out.kept[good].mean() > 0.93 and (~out.kept[out.quality == 0]).mean() > 0.8
    assert model.exchanged


def test_pseudo_labels_come_from_all_unlabelled_documents(spark, small_dir, monkeypatch):
    """Ten copies of the unlabelled rows are ten times the examples; how rows are split changes nothing."""
    monkeypatch.setattr(cotraining, "EVALUATIONS", 4)
    monkeypatch.setattr(cotraining, "ROUNDS", 1)
    d = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = C.table(spark, d, "documents"), C.table(spark, d, "labels")
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    free = docs.join(labels.select("doc_id"), "doc_id", "left_anti")
    some = known.unionByName(free).select(docs.columns)
    copies = free.crossJoin(spark.range(10)).select(docs.columns)
    copies = copies.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))     # rows without an id too
    one, split, ten = (cotraining.train(d, labels) for d in (some.coalesce(1), some.repartition(5), known.unionByName(copies)))
    assert 0 < one.exchanged[0] <= 2 * free.count() and ten.exchanged[0] == 10 * one.exchanged[0]
    for a, b in ((one.text, split.text), (one.meta, split.meta)):
        assert (a.weights == b.weights).all() and a.bias == b.bias
    assert (one.mix == split.mix).all()


def test_pools_in_memory_and_in_spark_fit_alike(spark, monkeypatch):
    monkeypatch.setattr(cotraining, "EVALUATIONS", 5)
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 400)
    text = [np.unique(np.append(rng.integers(100, 140, 5), 7 if v else 8)).astype(np.int32) for v in y]
    meta = [np.array([20 + v if rng.random() < 0.97 else 21 - v], np.int32) for v in y]
    free = spark.createDataFrame([(bytearray(t.tobytes()), bytearray(m.tobytes())) for t, m in zip(text[200:], meta[200:], strict=True)],
                                 "t binary, m binary").repartition(3)
    local = cotraining.co_train(text, meta, np.append(y[:200], np.full(200, -1)), ("a",))
    spread = cotraining.co_train(text[:200], meta[:200], y[:200], ("a",), cotraining.SparkPool(free))
    assert local.exchanged == spread.exchanged and local.exchanged
    assert (local.text.weights == spread.text.weights).all() and (local.meta.weights == spread.meta.weights).all()
    # the steps end near the minimum: as good on the labelled rows as a fit of many steps
    best = cotraining.fit(text[:200], y[:200].astype(float), by_z=True)
    z, w = local.text.logits(text), best.logits(text)
    assert ((z > 0) == y).mean() >= ((w > 0) == y).mean() - 0.01


def test_a_very_long_text_does_not_crowd_out_the_sample(spark, small_dir, monkeypatch):
    """The labelled text with the smallest hash is longer than all the sample may hold."""
    monkeypatch.setattr(cotraining, "SAMPLE_BYTES", 1 << 20)
    monkeypatch.setattr(cotraining, "LONG_TEXT", 20_000)
    d = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = C.table(spark, d, "documents"), C.table(spark, d, "labels")
    first = docs.join(labels, "doc_id").orderBy(F.xxhash64("doc_id")).first().doc_id
    longer = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("word "), 300_000)).otherwise(F.col("text")))
    before, after = ({r["__id"]: r["__good"] for r in cotraining.sample_ids(some, labels).collect()} for some in (docs, longer))
    assert 50 < len(before) < 1000 and first in before
    assert first not in after and {i: g for i, g in before.items() if i != first}.items() <= after.items()
    model = cotraining.train(longer, labels)
    assert model.text is not None and cotraining.score(longer, model, docs["doc_id"]).where("not kept").count() > 0


def test_a_sample_without_a_class_stops_the_training(odd_docs, odd_labels):
    with pytest.raises(ValueError, match="lacks a class"):
        cotraining.train(odd_docs, odd_labels, labelled=1)


def test_views_exchange_only_what_they_agree_on():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    text = [np.unique(np.r_[10 + v, rng.integers(100, 5000, 6)]) for v in y]
    meta = [np.array([20 + v]) for v in y]
    seen = np.where(np.arange(600) < 300, y, -1)
    model = cotraining.co_train(text, meta, seen, ("a",))
    p = model.probability(np.array([model.text.logit(t) for t in text]), np.array([model.meta.logit(m) for m in meta]))
    assert ((p > .5) == y)[300:].mean() > 0.97 and model.exchanged[0] > 300


def test_scores_are_those_of_the_views(spark, odd_docs, odd_labels, odd_rows):
    """Scoring and combination by hand, row by row, from the fitted weights."""
    import math
    model = cotraining.train(odd_docs, odd_labels)
    got = {}
    for r in cotraining.score(odd_docs, model, odd_docs["doc_id"]).collect():
        got.setdefault(r["__carry"], []).append((r.p_text, r.p_meta, r.p_good, r.kept))

    def logistic(x):
        return 1 / (1 + math.exp(-min(max(x, -35), 35)))
    for r in odd_rows:
        t = model.text.bias + sum(model.text.weights[s] for s in set(
            cotraining.text_features((r[1] or "").encode(), cotraining.WordSlots(), C.WordNumbers()).tolist()))
        m = model.meta.bias + sum(model.meta.weights[s] for s in cotraining.metadata_features(
            dict(zip(("lang", "source", "n_chars"), r[2:5], strict=True))).tolist())
        clip = [min(max(v, -12), 12) for v in (t, m)]
        p = logistic(clip[0] * model.mix[0] + clip[1] * model.mix[1] + model.mix[2])
        assert any(np.allclose(g[:3], (logistic(t), logistic(m), p), atol=1e-9) and g[3] == (g[2] >= cotraining.THRESHOLD) for g in got[r[0]])


def test_words_are_hashed_once_for_many_texts(odd_rows, monkeypatch):
    """Slots of many texts are those of each text alone; a word's repeats in other texts cost no hashing."""
    texts = [(r[1] or "").encode() for r in odd_rows] + [b"\xff\xc3 A a \x1c\x85", b"x y z " * 900 + b"X y Z\n" * 3]
    want = [cotraining.text_features(t, cotraining.WordSlots(), C.WordNumbers()).tolist() for t in texts]
    hashed = Counter()

    class Hashes:
        @staticmethod
        def xxh3_64_intdigest(word, seed=0):
            hashed[word] += not seed
            return xxhash.xxh3_64_intdigest(word, seed=seed)

    monkeypatch.setattr(cotraining, "xxhash", Hashes)
    batches = [pa.record_batch([pa.array(texts, pa.binary()), pa.array([{"m": 0}] * len(texts))], names=["__text", "__meta"])]
    [(_, rows, _)] = cotraining._features(iter(batches), ())
    assert [p.tolist() for p in np.split(rows.flat, np.cumsum(rows.sizes)[:-1])] == want
    assert max(hashed.values()) <= 2                       # a word and its capitals
    assert len(cotraining.text_rows(pa.array([], pa.binary()))) == 0


# -- token counts


def brute_count(word, scores, byte):
    best = [(0, 0)]
    for e in range(1, len(word) + 1):
        options = [(best[s][0] + scores[word[s:e]], best[s][1] - 1) for s in range(e) if word[s:e] in scores]
        if word[e - 1] not in scores:
            size = len(word[e - 1].encode())
            options.append((best[e - 1][0] + size * byte, best[e - 1][1] - size))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_against_brute_force(odd_docs, odd_rows, no_docs):
    path = queries.vocabulary(queries.PIECES)
    got = token_counts.token_counts(odd_docs, path).collect()
    scores = token_counts.unigram_scores(path)
    byte = min(scores.values()) - token_counts.BYTE_PENALTY
    known = {}

    def count(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for x in w:
            if x not in known:
                known[x] = brute_count(token_counts.MARK + x, scores, byte) if len(x) < 100 else None
        return len(w), (sum(known[x] for x in w) if all(known[x] is not None for x in w) else None)

    want = {}
    for r in odd_rows:
        want.setdefault(r[0], []).append(count(r[1]))
    for r in got:
        n, k = want[r.doc_id][0]
        assert r.n_pretokens == n and (k is None or r.n_tokens == k)
    assert len(got) == len(odd_rows) and token_counts.token_counts(no_docs, path).count() == 0


def test_trie_shares_prefixes_without_changing_counts():
    scores = {"▁": -5, "a": -3, "b": -3, "ab": -4, "aba": -9, "▁a": -4, "ba": -4}
    words = ["▁" + w for w in ("", "a", "ab", "aba", "abab", "b", "bab", "éa", "aéb", "abé")]
    byte = min(scores.values()) - token_counts.BYTE_PENALTY
    assert token_counts.TrieCounter(scores).counts(words) == {w: brute_count(w, scores, byte) for w in words}


# -- packing


def check_pieces(rows, want):
    """Every id in exactly one piece; sequences gapless; few padded."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for doc, pieces in by_doc.items():
        starts = Counter()
        for r in pieces:
            assert any(r.doc_tokens == len(w) and r.ids == w[r.start:r.start + r.length].tobytes() for w in want[doc])
            starts[r.start] += 1
        assert sum(r.length for r in pieces) == sum(map(len, want[doc]))
    return by_sequence


def test_packing_round_trip(odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer
    path = queries.vocabulary(queries.WORDS)
    t = Tokenizer.from_file(path)
    want = {}
    for r in odd_rows:
        want.setdefault(r[0], []).append(np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4"))
    rows = packing.pack(odd_docs, path).collect()
    sequences = check_pieces(rows, want)
    padded = [s for s in sequences.values() if (n := sum(r.length for r in s)) & (n - 1)]
    assert len(padded) <= 3                      # at most one a task
    steps = Counter()
    for s in sequences.values():
        assert len({r.step_group for r in s}) == 1
        steps[s[0].step_group] += s[0].tier
    assert max(steps.values()) <= packing.STEP_TOKENS
    assert packing.pack(no_docs, path).count() == 0


def test_ids_by_words_are_those_of_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 500)
    monkeypatch.setattr(packing, "KNOWN_PARTS", 300)
    encoder = packing.WordIds(queries.vocabulary(queries.WORDS))
    assert encoder.plain
    rng = random.Random(3)
    odd = "aAzZéÉßÿŸÀÖ×÷0123456789'’!!&%$<|>|\t\n\r\x0b.,-_ıİΣσς漢字🙂e\u0301²ªº\x1c\x85\xa0 'sST're'LL''"
    for k in range(60):
        texts = []
        for _ in range(20):
            letters = odd if k % 2 else "abcdeThe!&'s019éÜ \n"
            t = "".join(rng.choice(letters) for _ in range(rng.randrange(80)))
            texts.append(t + rng.choice(["", "<|endoftext|>x", "'s 't 'RE!!'s", "x" * 300]) * (k % 3 == 0))
        want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encoder.encode([t.encode() for t in texts]) == want


def test_words_are_looked_up_once_for_many_texts(monkeypatch):
    """Repeats in a slice of texts cost no lookups; long texts are gathered in parts."""
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    monkeypatch.setattr(packing, "GATHERED", 7)
    encoder = packing.WordIds(queries.vocabulary(queries.WORDS))
    encoder.parts = Counted(packing.LINE_BREAK)
    texts = [b"The cat's 12 cats\n" * n for n in (0, 1, 300, 2)] + [b"", b" \x0b ", b" \xffcat\xe9 The"]
    want = [np.array(encoder.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want and 0 < Counted.asked <= 20
    assert encoder.encode(pa.array(texts, pa.binary()).slice(2)) == want[2:]


def test_packer_cuts_little_and_fills_tiers():
    rng = np.random.default_rng(3)
    p, pieces = packing.Packer(), []
    for i, n in enumerate(rng.integers(1, 5000, 400).tolist()):
        pieces += p.add(i, bytes(4 * n))
    pieces += p.drain(True)
    sizes = [sum(len(x[2]) // 4 for x in s) for s in pieces]
    assert sum(1 for s in sizes if s & (s - 1)) <= 1 and max(sizes) <= 2048
    assert len([x for s in pieces for x in s]) < 400 + len(sizes) + 400


# -- language model


@pytest.mark.parametrize("which", ["odd", "none"])
def test_language_model_against_brute_force(odd_docs, odd_rows, no_docs, which):
    docs = odd_docs if which == "odd" else no_docs
    fold = F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % 7
    got = maxent_lm.score(docs, fold != 2, head=64).collect()      # most words come by the join
    if which == "none":
        assert got == []
        return
    tokens = lambda t: [*WORD.findall(lower((t or "").encode())), b""]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for r in odd_rows if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = {}
    for r in odd_rows:
        w = tokens(r[1])
        want[r[0]] = (held(r[0]), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4]) and r.score < 0
    held_rows = [r for r in got if r.held_out]
    assert held_rows


def test_probabilities_of_a_history_add_up_to_one():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent_lm.BUCKETS, 12)).astype(np.float32)
    bias = rng.normal(size=12).astype(np.float32)
    rows = rng.integers(0, maxent_lm.BUCKETS, (3, 50)).astype(np.int32)
    total = sum(np.exp(maxent_lm.class_log_probability(weights, bias, rows, np.full(50, c))) for c in range(12))
    assert np.allclose(total, 1, atol=1e-5)
    counts, unseen = np.array([5, 3, 1]), 1      # a class of three words and its place for unseen ones
    assert ((counts + 1).sum() + unseen) / (counts.sum() + len(counts) + 1) == 1


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    history = rng.integers(0, 8, 20000)
    cls = (history + (rng.random(20000) < .1)) % 8
    rows = np.stack([history * 3, history * 3 + 1, history * 3 + 2]).astype(np.int32)
    t = maxent_lm.Trainer(np.zeros((maxent_lm.BUCKETS, 8), np.float32), np.zeros(8, np.float32))
    before = maxent_lm.class_log_probability(t.weights, t.bias, rows, cls).mean()
    for at in range(0, 20000, 1000):
        t.step(rows[:, at:at + 1000], cls[at:at + 1000])
    assert maxent_lm.class_log_probability(t.weights, t.bias, rows, cls).mean() > before + 1


def test_choices_of_a_class_add_up_to_one():
    classes, counts, rest = np.array([0, 1, 2, 2, 3, 2, 2, 2]), np.array([9, 8, 7, 6, 5, 4, 3, 3]), np.array([1, 1, 2, 5, 3.])
    trees = maxent_lm.Trees(classes, counts, 2, rest)
    hashes = np.random.default_rng(0).integers(0, 1 << 32, (3, 1), np.uint32)
    for weights in (np.zeros(4096, np.float32), np.random.default_rng(1).normal(size=4096).astype(np.float32)):
        for c, words in {2: [2, 3, 5, 6, 7], 3: [4], 4: []}.items():
            leaves = np.array([*words, 8 + c])
            p = np.exp(maxent_lm.choice_log_probability(weights, trees, np.repeat(hashes, len(leaves), 1), leaves))
            assert p.sum() == pytest.approx(1, abs=1e-5)
            if not weights.any():       # without history: the smoothed relative frequency
                mass = np.r_[counts[words] + 1, rest[c]]
                assert p == pytest.approx(mass / mass.sum(), abs=1e-5)
        assert maxent_lm.choice_log_probability(weights, trees, hashes, np.array([1])) == 0


def test_rows_are_summed_as_one_by_one():
    rng = np.random.default_rng(5)
    data = rng.normal(size=(500, 7)).astype(np.float32)
    times = np.r_[1, 2, 3, 7, 8, 900, rng.integers(1, 40, 60)]
    at = rng.integers(0, 500, times.sum())
    want = np.zeros((len(times), 7))
    np.add.at(want, np.repeat(np.arange(len(times)), times), data[at])
    sums, which = maxent_lm.sums_of_rows(data, at, times)
    assert sorted(which) == list(range(len(times))) and np.allclose(sums, want[which], atol=1e-3)


def test_steps_in_parts_are_those_of_the_whole_batch(monkeypatch):
    rng = np.random.default_rng(6)
    n = 5000
    counts = np.sort(rng.zipf(1.3, 300))[::-1].astype(float)
    trees = maxent_lm.Trees(np.r_[0, 1, rng.integers(2, 6, 298)], counts, 2, np.r_[1, 1, rng.random(4) + 1])
    hashes, leaves = rng.integers(0, 1 << 32, (3, n), np.uint32), rng.integers(0, 300, n)
    rows, cls = rng.integers(0, 3000, (3, n)).astype(np.int32), rng.integers(0, 6, n)
    found = []
    for part in (256, 1 << 13):
        for name in ("CHOICE_PART", "DENSE_PART", "CLASS_PART"):
            monkeypatch.setattr(maxent_lm, name, part)
        chooser = maxent_lm.ChoiceTrainer(np.zeros(4096, np.float32), trees)
        trainer = maxent_lm.Trainer(np.zeros((maxent_lm.BUCKETS, 6), np.float32), np.zeros(6, np.float32))
        for _ in range(3):
            chooser.step(hashes, leaves)
            trainer.step(rows, cls)
        found.append((chooser.weights, chooser.scale, trainer.weights, trainer.used,
                      maxent_lm.choice_log_probability(chooser.weights, trees, hashes, leaves),
                      maxent_lm.class_log_probability(trainer.weights, trainer.bias, rows, cls)))
    for a, b in zip(*found, strict=True):
        assert a.any() and np.allclose(a, b, atol=1e-3, rtol=1e-4)


def test_weights_on_the_way_to_a_leaf_are_near_each_other():
    """The choices of ``LEVELS`` levels share one cache line for each feature, at spots of their own."""
    rng = np.random.default_rng(7)
    counts = np.sort(rng.zipf(1.2, 3000))[::-1].astype(float)
    trees = maxent_lm.Trees(np.r_[0, 1, rng.integers(2, 6, 2998)], counts, 2, np.r_[1, 1, rng.random(4) + 1]).prepare()
    leaves = np.arange(2, 3000)
    hashes = rng.integers(0, 1 << 32, (3, len(leaves)), np.uint32)
    token, place = trees.choices(leaves)
    depth = np.bincount(token)
    assert depth.max() > 2 * maxent_lm.LEVELS
    for slots in maxent_lm.slots_of(hashes, token, place, trees, 1 << 16):
        lines = np.unique(token << 16 | slots >> maxent_lm.LEVELS)
        assert (np.bincount(lines >> 16) <= -(-depth // maxent_lm.LEVELS)).all() and slots.max() < 1 << 16
        assert len(np.unique(slots >> maxent_lm.LEVELS)) > 1000
    nodes = np.unique(trees.codes >> 1)
    assert len(np.unique(trees.groups[nodes].astype(np.int64) * 16 + trees.spots[nodes])) == len(nodes)
    chooser = maxent_lm.ChoiceTrainer(np.arange(4096, dtype=np.float32), trees)
    assert chooser.weights.ctypes.data % 64 == chooser.total.ctypes.data % 64 == 0 and (chooser.weights == np.arange(4096)).all()


def test_steps_use_numpys_own_dtype_objects():
    """np.add.at takes some fifty times as long with the dtype object of an array that was sent."""
    sent = pickle.loads(pickle.dumps((np.zeros(4096, np.float32), maxent_lm.Trees(np.r_[0, 1, 1], np.r_[3., 2, 1], 1, np.ones(2)))))
    chooser = maxent_lm.ChoiceTrainer(*sent)
    native = np.dtype(np.float32)
    assert chooser.weights.dtype is native and chooser.total.dtype is native and chooser.scale.dtype is native
    places = chooser.trees.choices(np.array([1, 2]))[1]
    z, _ = maxent_lm.chosen(chooser.weights, chooser.trees, [np.zeros(len(places), np.intp)] * 3, places)
    assert z.dtype is native
    chooser.step(np.zeros((3, 2), np.uint32), np.array([1, 2]))
    assert chooser.weights.any() and sent[0].any() == 0


def test_probabilities_of_very_large_scores():
    weights = np.zeros((maxent_lm.BUCKETS, 3), np.float32)
    weights[0], weights[1] = (1000, 999, -1000), (-500, -501, -502)
    for row, want in ((0, [1, math.exp(-1), 0]), (1, [1, math.exp(-1), math.exp(-2)])):
        p = [np.exp(maxent_lm.class_log_probability(weights, np.zeros(3, np.float32), np.array([[row], [2], [3]]), np.array([c])))[0]
             for c in range(3)]
        assert p == pytest.approx(np.array(want) / sum(want))


def test_tokens_are_those_of_single_texts(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAbZé漢 \t\n\x0b\x0c\r\x1c\x85\xa0\x00.") for _ in range(rng.randrange(40))).encode() for _ in range(700)]
    texts += [b"", b" ", b"\n\n", b"\xff\xc3 A\xe9", b"word " * 500]
    want = [[*t.lower().split(), b""] for t in texts]
    vocabulary = maxent_lm.Vocabulary([b"", b"a"], np.array([9, 5]), []).prepare()
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    for size in (64, 4 << 20):
        monkeypatch.setattr(C, "SLICE_BYTES", size)
        got = []
        for part, sizes, tokens, distinct, (ids, _, away) in maxent_lm._texts([batch.slice(3)], "text", vocabulary):
            assert part.num_rows == len(sizes) and len(set(distinct)) == len(distinct)
            assert [i < 2 for i in ids] == (~away).tolist() == [w in (b"", b"a") for w in distinct]
            words = iter([distinct[k] for k in tokens])
            got += [[next(words) for _ in range(n)] for n in sizes]
            assert next(words, None) is None
        assert got == want[3:]


def test_words_are_counted_by_hash_and_keep_their_ending(spark, capsys):
    texts = spark.createDataFrame([("a Ab éab a",), ("x" * 60 + "yz b",), ("x" * 60 + "yz",)], "text string")
    counts = maxent_lm.word_counts(texts.select(F.col("text").cast("binary")))
    counts.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    got = {bytes(r.word): (bytes(r.ending), r.c) for r in counts.collect()}
    long = maxent_lm.key_of(b"x" * 60 + b"yz")
    assert len(long) <= maxent_lm.HEAD_BYTES and got == {
        b"a": (b"a", 2), b"ab": (b"ab", 1), "éab".encode(): (b"ab", 1), b"b": (b"b", 1), b"": (b"", 3), long: (b"yz", 2)}


def test_history_tells_words_of_one_class_apart(spark):
    """Each word of a cycle follows from the one before it; all but the commonest share an ending, so a class."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        at = int(rng.integers(60))
        rows.append((i, " ".join(f"w{(at + k) % 60}ly" for k in range(100))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = maxent_lm.score(docs, docs["doc_id"] % 5 != 2).where("held_out").toPandas()
    by_class_and_frequency = -math.log10(42) * 42 / 60
    assert (got.score / got.n_tokens).mean() > by_class_and_frequency / 2
