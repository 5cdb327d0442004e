"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import (
    cotraining,
    maxent_lm,
    mixing,
    neardup,
    packing,
    quality_rules,
    resampling,
    sharding,
    simhash,
    token_counts,
    toolcalls,
    topk,
    whitening,
)

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
N_SHARDS = 40
QUERY_STEP = 50          # rows whose id it divides are the search's queries


def vocabulary(name: str) -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    fold = F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % 7
    return maxent_lm.score(docs, fold != 2)


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(C.table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


TOOL_SCHEMAS = """
SELECT * FROM VALUES
  ('reply', 'text', 'string', true, 1D, 200D), ('reply', 'turn', 'integer', true, 0D, 1000D), ('reply', 'role', 'string', true, NULL, NULL),
  ('answer', 'text', 'string', true, 1D, NULL), ('answer', 'turn', 'integer', true, 0D, NULL), ('answer', 'role', 'string', false, NULL, NULL)
AS schemas(tool, argument, kind, required, least, most)
"""


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.exchanges(C.table(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, spark.sql(TOOL_SCHEMAS))


OP3_SQL = """
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
u AS (SELECT DISTINCT conv_id, turn, text FROM m WHERE role = 'user'),
a AS (SELECT DISTINCT conv_id, turn, text FROM m WHERE role = 'assistant'),
node AS (SELECT DISTINCT conv_id, turn FROM u),
placed AS (
  SELECT conv_id, turn, 0 AS level FROM node ANTI JOIN (SELECT conv_id, turn + 2 AS turn FROM node) b USING (conv_id, turn)
  UNION ALL
  SELECT node.conv_id, node.turn, placed.level + 1 FROM placed JOIN node ON node.conv_id = placed.conv_id AND node.turn = placed.turn + 2),
linked AS (
  SELECT 'call-' || u.conv_id || '-' || u.turn AS call_id, u.conv_id, u.turn AS seq, u.text,
         CASE WHEN contains(u.text, '?') THEN 'answer' ELSE 'reply' END AS tool,
         a.turn AS result_seq, a.text AS output, placed.level,
         CASE WHEN a.turn IS NULL THEN 'no_result' ELSE 'ok' END AS status
  FROM u JOIN placed USING (conv_id, turn) LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1)
SELECT conv_id, call_id, level, seq, status, (result_seq IS NOT NULL)::BIGINT AS n_results,
       CASE WHEN length(text) < 1 OR (tool = 'reply' AND length(text) > 200) THEN 'range:text' ELSE '' END AS errors,
       '{"arguments":{"role":"user","text":' || to_json(text)::VARCHAR || ',"turn":' || seq || '},"id":"' || call_id || '"'
         || CASE WHEN result_seq IS NULL THEN '' ELSE ',"output":' || to_json(output)::VARCHAR || ',"result_seq":' || result_seq END
         || ',"seq":' || seq || ',"status":"' || status || '","tool":"' || tool || '"}' AS json
FROM linked
UNION ALL
SELECT a.conv_id, 'call-' || a.conv_id || '-' || (a.turn - 1), NULL, a.turn, 'orphan_result', 0, '',
       '{"id":"call-' || a.conv_id || '-' || (a.turn - 1) || '","output":' || to_json(a.text)::VARCHAR || ',"seq":' || a.turn
         || ',"status":"orphan_result"}'
FROM a ANTI JOIN u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
"""


def op4_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    rows = C.written(docs.select("doc_id", "source", "lang", mixing.topic(docs["text"]).alias("topic"),
                                 mixing.tokens(docs["text"]).alias("tokens")), "mixing")
    rates = mixing.calibrated(mixing.cells_of(rows, {d: rows[d] for d in mixing.DIMS}, rows["tokens"]))
    same = [rows[d].eqNullSafe(rates[d]) for d in mixing.DIMS]
    p = rates["probability"]
    return rows.join(rates, same).select(rows["doc_id"], rows["source"], rows["lang"], rows["topic"], rows["tokens"],
                                         F.round(p, 6).alias("probability"), (mixing.place(rows["doc_id"]) < p).alias("kept"))


def _op4_sql() -> str:
    """The raking unrolled: one step per sweep and dimension, one per round of a scale."""
    steps = ["""docs AS (
  SELECT doc_id, source, lang,
    CASE WHEN contains(coalesce(text, ''), '|') THEN 'table' WHEN contains(coalesce(text, ''), '@') THEN 'contact'
         WHEN contains(coalesce(text, ''), chr(10)) THEN 'article' ELSE 'note' END AS topic,
    CASE WHEN coalesce(text, '') = '' THEN 0
         ELSE length(text) - length(replace(replace(text, ' ', ''), chr(10), '')) + 1 END AS tokens
  FROM documents)""", "cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)"]
    for d in mixing.DIMS:
        steps.append(f"t_{d} AS (SELECT {d} AS v, sum(tokens) AS t FROM cells GROUP BY {d})")
        steps.append(f"p_{d} AS MATERIALIZED (SELECT v, pow(t, {mixing.TEMPER}) / (SELECT sum(pow(t, {mixing.TEMPER})) FROM t_{d}) AS raw, "
                     f"{mixing.MOST / mixing.BUDGET!r}::DOUBLE * t / (SELECT sum(t) FROM t_{d}) AS most FROM t_{d})")
        k = "1.0::DOUBLE"
        for i in range(mixing.FILL_ROUNDS):
            steps.append(f"f_{d}{i} AS MATERIALIZED (SELECT coalesce((1 - coalesce(sum(CASE WHEN raw * {k} >= most THEN most END), 0)) "
                         f"/ sum(CASE WHEN raw * {k} < most THEN raw END), {k}) AS k FROM p_{d})")
            k = f"(SELECT k FROM f_{d}{i})"
        steps.append(f"l_{d} AS MATERIALIZED (SELECT v, least(raw * {k}, most) AS share FROM p_{d})")
        steps.append(f"s_{d} AS MATERIALIZED (SELECT v, share / (SELECT sum(share) FROM l_{d}) AS share FROM l_{d})")
    last, n = "(SELECT *, tokens AS weight FROM cells)", 0
    for _ in range(mixing.SWEEPS):
        for d in mixing.DIMS:
            n += 1
            steps.append(f"r{n} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, CASE WHEN sum(weight) OVER (PARTITION BY c.{d}) > 0 "
                         f"THEN weight * s.share / sum(weight) OVER (PARTITION BY c.{d}) ELSE 0 END AS weight "
                         f"FROM {last} c JOIN s_{d} s ON s.v IS NOT DISTINCT FROM c.{d})")
            last = f"r{n}"
    limits = ", ".join(f"(SELECT min(t / w) FROM (SELECT sum(tokens) AS t, sum(weight) AS w FROM {last} GROUP BY {d}) WHERE w > 0) / sum(tokens)"
                       for d in mixing.DIMS)
    steps.append(f"total AS MATERIALIZED (SELECT least({mixing.BUDGET}, {limits}) AS share, sum(tokens) AS tokens FROM {last})")
    aims = ", ".join(f"sum(weight * share * t.tokens) OVER (PARTITION BY {d}) AS aim_{d}" for d in mixing.DIMS)
    steps.append(f"w AS MATERIALIZED (SELECT source, lang, topic, c.tokens, weight * share * t.tokens AS want, {aims} FROM {last} c, total t)")
    last, n = "w", 0
    columns = ", ".join(["source", "lang", "topic", "tokens", *(f"aim_{d}" for d in mixing.DIMS)])
    for _ in range(mixing.CAP_SWEEPS):
        for d in mixing.DIMS:
            n += 1
            kept = f"sum(least(want, tokens)) OVER (PARTITION BY {d})"
            steps.append(f"w{n} AS MATERIALIZED (SELECT {columns}, CASE WHEN {kept} > 0 THEN want * aim_{d} / {kept} ELSE 0 END AS want FROM {last})")
            last = f"w{n}"
    scale = "1.0::DOUBLE"
    for k in range(mixing.CAP_ROUNDS):
        steps.append(f"k{k} AS MATERIALIZED (SELECT coalesce(((SELECT share * tokens FROM total) "
                     f"- coalesce(sum(CASE WHEN want * {scale} >= tokens THEN tokens END), 0))"
                     f" / sum(CASE WHEN want * {scale} < tokens THEN want END), {scale}) AS scale FROM {last} WHERE tokens > 0)")
        scale = f"(SELECT scale FROM k{k})"
    steps.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0, want * {scale} / tokens) "
                 f"ELSE (SELECT share FROM total) END AS probability FROM {last})")
    place = "('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0"
    return "WITH " + ",\n".join(steps) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(p.probability, 6) AS probability, {place} < p.probability AS kept
FROM docs d JOIN p ON p.source IS NOT DISTINCT FROM d.source AND p.lang IS NOT DISTINCT FROM d.lang AND p.topic = d.topic"""


OP4_SQL = _op4_sql()


def op5_multi_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(C.table(spark, sf_dir, "documents"), vocabulary(WORDS))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "tier", "step_group")


def op6_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = C.table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors["vec_id"] % QUERY_STEP == 0)


OP6_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op7_minhash_inverted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(C.table(spark, sf_dir, "documents"), width=3, percent=85)


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    rules = quality_rules.learn_from(docs, C.table(spark, sf_dir, "labels"))
    return quality_rules.judge(quality_rules.statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op9_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = cotraining.train(docs, C.table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model, docs["doc_id"]).withColumnRenamed("__carry", "doc_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(C.table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op11_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(C.table(spark, sf_dir, "documents"), width=4, bits=4)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(C.table(spark, sf_dir, "embeddings"), components=4)


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# The table of CRC-32 is built by its rule: eight steps of the reversed polynomial.
OP13_SQL = rf"""
WITH crc AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dw AS (SELECT row, unnest(w) AS word FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
bytes AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT) AS b
  FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bucket AS (
  SELECT word, xor(list_reduce([4294967295] || b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % {resampling.BUCKETS} AS k
  FROM bytes, crc),
s AS (SELECT k, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bw JOIN bucket USING (word) GROUP BY k),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t_all),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {resampling.BUCKETS})
                            / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + {resampling.BUCKETS}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (k), totals),
weights AS (SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (k) GROUP BY row),
scored AS (
  SELECT row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (row)),
ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE n_features >= {resampling.LEAST_WORDS}),
drawn AS (SELECT {resampling.SHARE} * count(*) // 100 AS n FROM ranked)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn.n THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row), drawn
"""


QUERIES = {f.__name__: f for f in (
    op1_maxent_lm, op2_virtual_slots, op3_tool_call_linking, op4_raked_mixing, op5_multi_length_packing, op6_norm_buckets, op7_minhash_inverted_join,
    op8_quality_rules, op9_co_training, op10_token_counts, op11_simhash_pigeonring, op12_qdwh_whitening, op13_target_resampling)}
ORACLES: dict[str, str] = {"op3_tool_call_linking": OP3_SQL, "op4_raked_mixing": OP4_SQL, "op6_norm_buckets": OP6_SQL,
                           "op7_minhash_inverted_join": OP7_SQL, "op13_target_resampling": OP13_SQL}
