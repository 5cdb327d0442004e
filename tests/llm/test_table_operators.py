"""Virtual slots, tool calls, mixing, top-k search, near-duplicates and the pipeline."""

import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickforge.llm import common as C
from tickforge.llm import mixing, neardup, quality_rules, queries, sharding, toolcalls, topk

# -- virtual slots


def test_sharding_places_every_row(odd_docs, odd_rows, no_docs):
    rows = sharding.shard(odd_docs, 7).collect()
    assert sorted(map(str, ((r.doc_id, r.size, r.text_crc32) for r in rows))) == sorted(
        map(str, ((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows)))
    for k in range(7):
        places = sorted(r.place for r in rows if r.shard == k)
        assert places == list(range(len(places)))
    same = {}
    for r in rows:
        assert same.setdefault((r.doc_id, r.text_crc32), r.shard) == r.shard
    assert sharding.shard(no_docs, 7).count() == 0


def test_rebalancing_levels_bytes_and_moves_little():
    rng = np.random.default_rng(4)
    load = rng.pareto(1.5, 4096).clip(0, 30) * 1000 + 100
    load = load.astype(np.int64)
    start = sharding.initial_map(4096, 40)
    after = sharding.rebalance(start, load, 40)
    shards = np.bincount(after, load, 40)
    assert shards.max() - shards.min() <= 0.001 * shards.mean()
    assert (after != start).mean() < 0.5
    grown = sharding.rebalance(after, load, 41)          # an added shard is filled from the others
    shards = np.bincount(grown, load, 41)
    assert shards.max() - shards.min() <= 0.01 * shards.mean() and (grown != after).mean() < 0.15


def test_map_versions_are_kept(spark, odd_docs):
    folder = C.scratch_folder(spark, "map-test")
    sharding.shard(odd_docs, 5, n_slots=64, folder=folder).count()
    first, second = (sharding.load_map(spark, folder, v).orderBy("slot").collect() for v in (0, 1))
    assert [r.shard for r in first] == [s % 5 for s in range(64)] and len(second) == 64


def test_growing_reads_the_newest_map(spark, small_dir):
    """40 shards become 41, then 39: few slots move, and every version stays as it was."""
    docs = C.table(spark, small_dir.replace("sf0.001", "sf0.1"), "documents")
    folder = C.scratch_folder(spark, "map-grown")
    maps = []
    for n in (40, 40, 41, 39):
        rows = sharding.shard(docs, n, n_slots=2048, folder=folder).groupBy("shard").agg(F.sum("size").alias("b")).collect()
        assert {r.shard for r in rows} <= set(range(n))
        maps.append(sharding.map_array(spark, folder, sharding.newest_version(spark, folder)))
    assert sharding.newest_version(spark, folder) == 4
    moved = [float((a != b).mean()) for a, b in zip(maps, maps[1:], strict=False)]
    assert moved[0] < 0.01 and moved[1] < 0.15 and moved[2] < 0.3 and maps[2].max() == 40 and maps[3].max() == 38
    assert (sharding.map_array(spark, folder, 1) == maps[0]).all()
    with pytest.raises(ValueError, match="slots are fixed"):
        sharding.shard(docs, 40, n_slots=64, folder=folder)


def test_query_balances_bytes(spark, small_dir):
    """The registered law: the shards' bytes differ by little, whole documents apart."""
    out = queries.op2_virtual_slots(spark, small_dir.replace("sf0.001", "sf0.1")).toPandas()
    total = out.groupby("shard")["size"].sum()
    assert len(total) == 40 and set(out.law) == {"bytes"} and total.max() - total.min() <= 0.01 * total.mean()


# -- tool calls


def test_tool_calls(spark):
    schemas = spark.createDataFrame([("t", "x", "integer", True, 0., 10.), ("t", "s", "string", False, 1., 3.),
                                     ("u", "o", "object", True, None, None)], toolcalls.SCHEMAS)
    calls = spark.createDataFrame([
        (1, "a", 0, "t", '{"s":"ab", "x":3}', []), (1, "b", 2, "t", '{"x":11,"s":"abcd","q":1}', ["a"]),
        (1, "c", 4, "zz", "{}", ["nope"]), (2, "a", 0, "u", '{"o":{"z":1,"a":[1.50,true,null]}}', ["b"]),
        (2, "b", 1, "u", "[1]", []), (3, "a", 0, "t", None, ["b"]), (3, "b", 1, "t", '{"x":"1"}', ["a"]),
        (4, None, 0, "t", '{"x":1.5}', []), (1, "a", 9, "t", '{"x":1}', []), (1, "a", 9, "t", '{"x":1}', [])], toolcalls.CALLS)
    calls = calls.withColumns({"level": F.lit("clash"), "errors": F.lit(1)})
    results = spark.createDataFrame([(1, "a", 1, "r1"), (1, "a", 5, "r0"), (1, "b", 3, None), (9, "q", 1, "o"), (1, None, 2, "n")],
                                    "conv_id long, call_id string, seq long, output string")
    got = {(r.conv_id, r.call_id, r.seq): r for r in toolcalls.link(calls, results, schemas).collect()}
    assert len(got) == 11
    assert {k: (r.level, r.status, r.n_results, r.errors) for k, r in got.items()} == {
        (1, "a", 0): (0, "repeated_result", 2, ""), (1, "a", 9): (None, "repeated_call", 0, ""),
        (1, "b", 2): (1, "ok", 1, "range:s,range:x,undeclared:q"), (1, "c", 4): (0, "no_result", 0, "unknown_dependency,unknown_tool"),
        (2, "a", 0): (1, "no_result", 0, ""), (2, "b", 1): (0, "no_result", 0, "not_an_object"),
        (3, "a", 0): (None, "no_result", 0, "cycle,not_an_object"), (3, "b", 1): (None, "no_result", 0, "cycle,type:x"),
        (4, None, 0): (None, "no_result", 0, "type:x"), (9, "q", 1): (None, "orphan_result", 0, ""), (1, None, 2): (None, "orphan_result", 0, "")}
    assert got[2, "a", 0].json == '{"arguments":{"o":{"a":[1.5,true,null],"z":1}},"id":"a","seq":0,"status":"no_result","tool":"u"}'
    assert got[1, "a", 0].json.startswith('{"arguments":{"s":"ab","x":3},"id":"a","output":"r1","result_seq":1,')
    none = toolcalls.link(calls.limit(0), results.limit(0), schemas)
    assert none.count() == 0


def brute_levels(deps):
    """Longest path by fixed-point rounds; None where a cycle never settles."""
    known = {n: 0 for n in deps if not deps[n]}
    while True:
        more = {n: 1 + max(known[d] for d in deps[n]) for n in deps if n not in known and all(d in known for d in deps[n])}
        if not more:
            return {n: known.get(n) for n in deps}
        known.update(more)


def test_levels_against_brute_force(spark):
    rng, graphs = random.Random(5), {}
    graphs[0] = {i: [i + 1] if i < 99 else [] for i in range(100)}           # a long chain backwards
    graphs[1] = {i: [(i + 1) % 7] for i in range(7)} | {7: [3], 8: [7, 9], 9: [], 10: [9], 11: [8]}   # a cycle and what hangs on it
    graphs[2] = {0: [0], 1: []} | {i: [1] for i in range(2, 60)}             # waits for itself; a call that many wait for
    for g in range(3, 9):                                                     # random, mostly without cycles
        graphs[g] = {i: rng.sample(range(i), min(i, rng.choice([0, 1, 1, 1, 2, 3]))) for i in range(40)}
        if g > 6:
            graphs[g][rng.randrange(10)] = [rng.randrange(10, 40)]
    rows = [(g, str(n), rng.randrange(9), "t", None, [str(d) for d in on]) for g, deps in graphs.items() for n, on in deps.items()]
    got = {(r.conv_id, int(r.call_id)): r.level for r in toolcalls.levels(spark.createDataFrame(rows, toolcalls.CALLS)).collect()}
    assert got == {(g, n): v for g, deps in graphs.items() for n, v in brute_levels(deps).items()}


def test_exchanges_with_nulls(spark):
    chats = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", 'quo"te\n'), (None, 0, "user", "x"), (1, 2, None, "y"),
                                   (1, 4, "user", "z"), (1, 4, "user", "z"), (2, 5, "assistant", "alone")],
                                  "conv_id long, turn long, role string, text string")
    calls, results = toolcalls.exchanges(chats)
    got = toolcalls.link(calls, results, spark.sql(queries.TOOL_SCHEMAS)).collect()
    assert sorted(r.status for r in got) == ["no_result", "no_result", "ok", "orphan_result"]
    assert '"output":"quo\\"te\\n"' in next(r.json for r in got if r.status == "ok")


# -- mixing


def test_raking_meets_targets(spark):
    rng = random.Random(1)
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", f"t{c}", rng.randrange(50, 5000), 10) for a, b, c in
                                   itertools.product(range(5), range(3), range(2))], "source string, lang string, topic string, tokens long, rows long")
    target = {"source": {f"s{i}": i + 1 for i in range(5)}, "lang": {"l0": 5, "l1": 3, "l2": 2}, "topic": {"t0": 1, "t1": 3}}
    frames = {d: spark.createDataFrame([(k, float(v)) for k, v in {**t, "nobody": 9.0}.items()], "value string, share double") for d, t in target.items()}
    out = mixing.rake(cells, frames).toPandas()
    assert len(out) == 30
    for d, t in target.items():
        got = out.groupby(d).weight.sum()
        for k, v in t.items():
            assert got[k] == pytest.approx(v / sum(t.values()), abs=1e-4)
    p = mixing.probabilities(mixing.rake(cells, frames), 0.5).toPandas()
    assert (p.probability * p.tokens).sum() == pytest.approx(0.5 * p.tokens.sum(), rel=1e-6) and p.probability.max() <= 1


def test_sampled_mix_meets_its_targets(spark, small_dir):
    """Many cells are taken whole; the shares of every dimension are met all the same."""
    docs = C.table(spark, small_dir.replace("sf0.001", "sf0.01"), "documents")
    dims = {"source": docs["source"], "lang": docs["lang"], "topic": mixing.topic(docs["text"])}
    cells = C.written(mixing.cells_of(docs, dims, mixing.tokens(docs["text"])), "cells")
    rates = C.written(mixing.calibrated(cells), "rates")
    assert rates.where("probability = 1").count() > 20
    out = mixing.shares(rates).toPandas()
    assert set(out.dim) == set(mixing.DIMS) and (out.target - out.achieved).abs().max() < 1e-3
    p = rates.toPandas()
    assert (p.probability * p.tokens).sum() == pytest.approx(mixing.BUDGET * p.tokens.sum(), rel=1e-4)
    # rarer values gain, none is asked for more than it has
    langs = out[out.dim == "lang"].set_index("value").target
    have = p.groupby("lang").tokens.sum() / p.tokens.sum()
    assert langs[have.idxmax()] < have.max() and (langs * mixing.BUDGET <= have[langs.index] + 1e-9).all()


def test_infeasible_targets_lower_the_budget(spark):
    cells = spark.createDataFrame([("a", "x", 100, 1), ("a", "y", 800, 1), ("b", "x", 60, 1), ("b", "y", 40, 1)],
                                  "source string, lang string, tokens long, rows long")
    target = {"source": spark.createDataFrame([("a", 1.0), ("b", 1.0)], "value string, share double"),
              "lang": spark.createDataFrame([("x", 1.0), ("y", 1.0)], "value string, share double")}
    rates = mixing.calibrated(cells, target, 0.8)
    p = rates.toPandas()
    assert (p.probability * p.tokens).sum() == pytest.approx(200, rel=0.01)       # b has 100 tokens for its half
    out = mixing.shares(rates).toPandas()
    assert (out.achieved - 0.5).abs().max() < 0.01


def test_sampling_keeps_columns(odd_docs, no_docs):
    def run(d):
        return mixing.sample(d, {"source": d["source"], "lang": d["lang"], "topic": mixing.topic(d["text"])}, mixing.tokens(d["text"]))
    out = run(odd_docs)
    assert out.columns == odd_docs.columns and 0 < out.count() <= odd_docs.count()
    assert run(no_docs).count() == 0


# -- top-k search


def brute_top(rows, k=5):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            w = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            fine[i] = max(fine.get(i, w), w)
    width = max(map(len, fine.values()))
    fine = {i: w + [0] * (width - len(w)) for i, w in fine.items()}
    out = []
    for q in fine:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(fine[q], w)), i) for i, w in fine.items() if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["ties", "long", "spread"])
def test_top_k_against_brute_force(spark, monkeypatch, kind):
    for name, n in (("BUCKET_ROWS", 40), ("BLOCK_ROWS", 25), ("QUERY_ROWS", 2), ("SEEDS", 12)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(6)
    if kind == "ties":
        rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)]) for i in range(300)]
    elif kind == "long":
        rows = [(i, (rng.normal(size=6) * 10.0 ** rng.integers(0, 5)).tolist()) for i in range(260)]
    else:   # directions close together: high local cosines
        rows = [(i, (np.array([3, 1, 2, .5]) + rng.normal(size=4) * .05 * (1 + i % 7)).tolist()) for i in range(300)]
    rows += [(50, rows[50][1]), (301, None), (302, [1.0, None, 2.0]), (303, [float("nan"), 1.0]), (304, [float("inf")]), (None, [1.0, 1.0]), (305, [2.0]), (350, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit("x")}).repartition(4)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df["vec_id"] % 50 == 0).collect())
    assert got == brute_top(rows)


def test_top_k_of_little(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, empty["vec_id"] % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0]), (7, [2.0])], empty.schema)
    assert [(r.query_id, r.rank, r.vec_id) for r in topk.top_k(one, one["vec_id"] % 50 == 0).collect()] == [(0, 1, 7)]


def test_exact_products_of_large_numbers():
    big = np.array([[2 ** 40, 3]])
    assert topk.products(big, big)[0, 0] == np.iinfo(np.int64).max
    assert topk.products(np.array([[2 ** 30, 1]]), np.array([[2 ** 31, 1]]))[0, 0] == 2 ** 61 + 1


# -- near-duplicates


def brute_groups(rows, width, percent):
    sets = []
    for i, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w)} if 0 < len(w) < width else set(zip(*(w[k:] for k in range(width)))))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            up[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    out = []
    for g in groups.values():
        ids = [rows[k][0] for k in g if rows[k][0] is not None]
        for k in g:
            name = rows[k][0] if not sets[k] else min(ids, default=None)
            out.append((rows[k][0], len(sets[k]), name, name is None or rows[k][0] == name))
    return sorted(map(str, out))


def found_groups(df):
    return sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())))


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(odd_docs, odd_rows, no_docs, width, percent):
    assert found_groups(neardup.near_duplicates(odd_docs, width, percent)) == brute_groups(odd_rows, width, percent)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_large_group_in_blocks(spark, monkeypatch):
    """A large family whose members differ from each other more than from their source."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neardup, "SMALL", 6)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        t = base[:]
        for _ in range(rng.randrange(1, 9)):
            t[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    passage = " ".join(f"p{k}" for k in range(60))     # shared by texts that are not alike
    rows += [(200 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(80))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_groups(neardup.near_duplicates(df, 3, 85)) == brute_groups(rows, 3, 85)


def test_rows_without_an_id_link_others(spark):
    """A and C are alike only by way of B, whose rows have no id; D and E have none at all."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    b, c = base[:], base[:]
    for k in range(0, 8):
        b[k] = f"b{k}"
    c[:8] = b[:8]
    for k in range(390, 400):
        c[k] = f"c{k}"
    d = [f"d{rng.randrange(10**6)}" for _ in range(200)]
    e = d[:-1] + ["end"]
    rows = [(1, base), (None, b), (None, b), (3, c), (None, d), (None, e), (7, ["alone"])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(3)
    linked = set()
    for percent in (95, 97):      # at 95, A and C reach each other only by way of B
        found = neardup.near_duplicates(docs, 5, percent)
        assert found_groups(found) == brute_groups([(i, " ".join(w)) for i, w in rows], 5, percent)
        linked |= {(r.doc_id, r.component_id) for r in found.collect()}
    assert {(3, 1), (3, 3), (None, None)} <= linked


def test_one_of_each(odd_docs, odd_rows, no_docs):
    out = neardup.one_of_each(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and 10 in ids and not set(range(11, 20)) & set(ids) and None in ids
    assert neardup.one_of_each(no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(b"x", b"y"), (b"y", b"x"), (b"z", b"z")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in neardup.components(edges).collect()}
    assert set(got.values()) == {bytes([0, 0]), b"x"} and len(got) == 63


# -- registered queries against their SQL, and the pipeline


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small_dir, name):
    got = queries.QUERIES[name](spark, small_dir).toPandas()
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(df):
        return sorted(df[sorted(df.columns)].astype(object).where(df.notna(), None).map(
            lambda v: round(v, 6) if isinstance(v, float) and v % 1 else (int(v) if isinstance(v, float) else v)).astype(str).values.tolist())
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_covers_its_table(spark, small_dir, name):
    out = queries.QUERIES[name](spark, small_dir)
    table, key = ("embeddings", "vec_id") if "vec_id" in out.columns else ("documents", "doc_id")
    n = C.table(spark, small_dir, table).count()
    assert out.select(key).distinct().count() == n


def test_pipeline_stages(spark, odd_docs, odd_labels, no_docs, monkeypatch, small_dir):
    real = C.table
    monkeypatch.setattr(C, "table", lambda s, d, name: odd_labels if name == "labels" else real(s, d, name))
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = C.written(stage(spark, docs, small_dir), "stage")
            if name != "packing":
                assert out.columns == columns
                assert out.select("doc_id").distinct().subtract(docs.select("doc_id").distinct()).count() == 0
                docs = out


def test_pipeline_rules_reject_junk(spark, small_dir):
    """The list is learned from the labelled documents of the table, whatever the classifier has left."""
    d = small_dir.replace("sf0.001", "sf0.01")
    docs, labels = C.table(spark, d, "documents"), C.table(spark, d, "labels")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").where("lang = 'en'")
    junk = good.withColumns({"text": F.concat_ws(" ", F.transform(F.split("text", " "), lambda w: F.concat(w, F.lit("###$$$"))) ), "doc_id": -F.col("doc_id") - 1})
    kept = {r.doc_id for r in corpus_pipeline.rules(spark, good.unionByName(junk), d).collect()}
    n = {r.doc_id for r in good.collect()}
    assert quality_rules.learn_from(docs, labels)
    assert len(kept & n) > 0.8 * len(n) and not {k for k in kept if k < 0}


def test_pipeline_runs(spark, small_dir):
    docs = C.table(spark, small_dir, "documents")
    out = corpus_pipeline.run(spark, small_dir)
    assert 0 < out.select("doc_id").distinct().count() < docs.count()
