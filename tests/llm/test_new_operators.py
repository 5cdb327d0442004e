"""SimHash groups, whitening and importance resampling."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickforge.llm import common as C
from tickforge.llm import queries, resampling, simhash, whitening

# -- SimHash


def brute_fingerprint(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(prints, bits):
    """prints: (id, fingerprint) rows; smallest id reached by each row's fingerprint."""
    kinds = sorted({p for _, p in prints})
    up = {p: p for p in kinds}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p
    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(least.get(root(p), i), i)
    return sorted((str(i), p, least.get(root(p))) for i, p in prints)


@pytest.mark.parametrize("width,bits", [(4, 4), (2, 7), (4, 0)])
def test_simhash_against_brute_force(odd_docs, odd_rows, no_docs, monkeypatch, width, bits):
    monkeypatch.setattr(C, "BLOCK_BYTES", 3000)          # long texts go in parts
    got = simhash.near_duplicates(odd_docs, width, bits).collect()
    want = reach([(r[0], brute_fingerprint(r[1], width)) for r in odd_rows], bits)
    assert sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in got) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_blocks_cut_no_word():
    text = b"  ab cd\te" * 50 + b"x" * 300 + b" y"
    old, C.BLOCK_BYTES = C.BLOCK_BYTES, 17
    try:
        parts = list(C.blocks(text))
        assert b"".join(parts) == text and sum((p.split() for p in parts), []) == text.split() and len(parts) > 5
        assert simhash.fingerprint(text) == brute_fingerprint(text.decode(), 4)
        assert list(C.blocks(b"")) == [b""]
    finally:
        C.BLOCK_BYTES = old


def planted(rng, families, members, bits):
    prints = []
    for _ in range(families):
        base = rng.getrandbits(64)
        for _ in range(members):
            p = base
            for b in rng.sample(range(64), rng.randrange(bits + 3)):
                p ^= 1 << b
            prints.append(p)
    return list(dict.fromkeys(prints))


@pytest.mark.parametrize("bits", [1, 3, 4, 8])
def test_links_find_every_group(spark, bits):
    rng = random.Random(bits)
    prints = planted(rng, 60, 8, bits) + [0, 2**64 - 1, 1, 3, 7, 15]
    prints = list(dict.fromkeys(prints))
    assert_groups(spark, prints, bits)


def test_links_of_one_large_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(simhash, "ROWS_TOGETHER", 50)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    prints = list(dict.fromkeys(base ^ (rng.getrandbits(6) << 3) ^ (rng.getrandbits(2) << 50) for _ in range(200)))
    assert_groups(spark, prints + planted(rng, 10, 5, 4), 4)


def assert_groups(spark, prints, bits):
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    classes = spark.createDataFrame(signed, "fp long")
    got = {}
    for r in simhash.components(simhash.links(classes, bits)).collect():
        got.setdefault(r.label, set()).add(r.node % 2**64)
    want = {}
    for i, p, least in reach(list(enumerate(prints)), bits):
        want.setdefault(least, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_every_start_of_a_chain_is_needed_only_once():
    """Any pair within the bound has a start from which all budgets hold."""
    rng = random.Random(1)
    for bits in (1, 2, 4, 9):
        masks = [[int(m) for m in row] for row in simhash.chain_masks(bits)]
        for _ in range(300):
            d = sum(1 << b for b in rng.sample(range(64), rng.randrange(bits + 1)))
            assert any(all((d & m).bit_count() <= k for k, m in enumerate(row)) for row in masks)


# -- whitening


def whole(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


def taking_part(rows, width):
    return [(i, whole(v)) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]


def vectors(width=6, n=80):
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(width, width))
    rows = [(i, [float(np.float32(c)) for c in mix @ rng.normal(size=width)]) for i in range(n)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[0][1]), (None, rows[1][1]), (102, None), (103, [None] * width),
             (104, [float("nan")] + [0.0] * (width - 1)), (105, [float("inf")] * width), (106, [1.0, 2.0]), (107, []), (108, [-0.0] * width)]
    return rows


def test_whitening_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit(1), "id": F.lit("c"), "n": F.lit(0)}).repartition(3)
    got = whitening.whiten(df, 4).collect()
    own = taking_part(rows, 6)
    kinds = np.array(sorted({tuple(x) for _, x in own}))
    n, total = len(kinds), kinds.sum(0)
    centred = kinds - total / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    assert len(got) == 4 * len(own) and sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in own for _ in range(4))
    sign = {}
    by_id = {i: np.array(x) for i, x in own}
    for r in got:
        x, k = by_id[r.vec_id], r.component - 1
        want = (x - total / n) @ vecs[:, k] / math.sqrt(values[k])
        sign.setdefault(k, np.sign(want * r.whitened) if abs(want) > 1e-6 else None)
        if sign[k]:
            assert r.whitened == pytest.approx(sign[k] * want, abs=1e-9)
        assert r.n == n and r.deviation == int(((n * x - total) ** 2).sum())
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-10) and 0 <= r.identity_error < 1e-10


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0])], schema)).collect()      # one component has no variance
    assert sorted(round(r.whitened, 9) for r in line) == [-1.0, 1.0] and {r.component for r in line} == {1}


def test_deviations_of_large_numbers():
    x = np.array([[2**61, -5], [3, 2**40]])
    centre = whitening.Centre(2, tuple(whitening.whole_sum(x)))
    exact = [[2 * int(c) - int(s) for c, s in zip(r, centre.sums, strict=True)] for r in x]
    assert centre.deviations(x).tolist() == exact and centre.squares(x) == [None, None]
    small = whitening.Centre(3, (4, 5))
    assert small.squares(np.array([[1, 2], [3, 0]])) == [(3 - 4) ** 2 + 1, 25 + 25]


@pytest.mark.parametrize("kind", ["random", "clusters", "repeated", "wide", "singular", "diagonal", "identity"])
def test_eigen_against_numpy(kind):
    rng = np.random.default_rng(5)
    n = 24
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {"random": rng.normal(size=n), "clusters": np.repeat([1.0, 2.0, 3.0], 8) + 1e-9 * rng.normal(size=n),
              "repeated": np.repeat([1.0, 1.0, 5.0], 8), "wide": 10.0 ** np.linspace(-9, 6, n), "singular": np.r_[np.zeros(n - 3), 1, 2, 3],
              "diagonal": np.arange(n), "identity": np.ones(n)}[kind]
    v = np.diag(values.astype(float)) if kind in ("diagonal", "identity") else q @ np.diag(values) @ q.T
    e, w = whitening.eigen(v)
    scale = np.abs(values).max()
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 * scale
    assert np.abs(w.T @ w - np.eye(n)).max() < 1e-12 and np.abs(v @ w - w * e).max() < 1e-12 * scale
    top, some = whitening.eigen(v, 4)
    assert np.allclose(top, e[:4], rtol=0, atol=1e-12 * scale) and some.shape == (n, 4)


def test_polar_factor_is_orthogonal():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    u = whitening.polar_factor(a)
    assert np.abs(u @ u.T - np.eye(30)).max() < 1e-13 and np.linalg.eigvalsh(u.T @ a).min() > 0


# -- importance resampling


def brute_resample(docs, target, width, buckets, share, least, seed):
    def feats(text):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
        return len(words), [zlib.crc32(b" ".join(words[i:i + k])) % buckets for k in range(1, width + 1) for i in range(len(words) - k + 1)]

    own = [(i, *feats(t)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, f in own:
        for b in f:
            s[b] += 1
    for text in target:
        for b in feats(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, f in own:
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:len(fit) * share // 100]):
        r[4] = k + 1
    return sorted(map(str, (r[:5] for r in rows)))


def found(df):
    return sorted(str([r.doc_id, r.n_features, r.weight, r.score, r["rank"]]) for r in df.collect())


@pytest.mark.parametrize("width,share", [(1, 10), (2, 60), (3, 100), (1, 0)])
def test_resampling_against_brute_force(spark, odd_docs, odd_rows, no_docs, monkeypatch, width, share):
    monkeypatch.setattr(resampling, "LAST", 3)
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 7)
    monkeypatch.setattr(C, "BLOCK_BYTES", 2000)
    target = [None, "", "alpha1 beta2 gamma3 delta4 of the", "Éa1 xyz2, idiot!"]
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(odd_docs, texts, width, 500, share, 5, 7)
    assert found(got) == brute_resample([(r[0], r[1]) for r in odd_rows], target, width, 500, share, 5, 7)
    assert resampling.resample(no_docs, texts).count() == 0
    bare = resampling.resample(odd_docs, texts.limit(0), 1, 500, 10, 5, 7)
    assert found(bare) == brute_resample([(r[0], r[1]) for r in odd_rows], [], 1, 500, 10, 5, 7)


@pytest.mark.parametrize("kind", ["ties", "spread", "text ids"])
def test_cutoff_is_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(resampling, "LAST", 4)
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 16)
    rng = random.Random(6)
    n = 500
    rows = [(rng.randrange(3) if kind == "ties" else rng.randrange(10**6), rng.choice([None, rng.randrange(20)]), k) for k in range(n)]
    keys = spark.createDataFrame(rows, "score long, id long, row long").repartition(4)
    if kind == "text ids":
        keys = keys.withColumn("id", F.col("id").cast("string"))
    keys = C.written(resampling.with_keys(keys), "keys-test")
    want = sorted(tuple(r) for r in keys.select(*resampling.KEYS).collect())
    for rank in (1, 2, 137, n - 1, n):
        assert resampling.cutoff(keys, n, rank) == want[rank - 1]


def test_winners_lean_to_the_target(spark, small_dir):
    """Documents drawn hold more of the target's words than the rest."""
    got = queries.op13_target_resampling(spark, small_dir).toPandas()
    drawn = got[got["rank"].notna()]
    assert len(drawn) == (got.n_features >= 20).sum() // 10 and sorted(drawn["rank"]) == list(range(1, len(drawn) + 1))
    assert drawn.weight.mean() > got[got["rank"].isna() & (got.n_features >= 20)].weight.mean()
