"""Exact top-k inner product search by norm buckets (operator 6).

Vectors are grouped into buckets by length; a bucket is cut into blocks of
bounded size.  A query first meets a bounded set of the longest vectors,
which gives a score that its k-th best reaches at least.  From it follows,
for each bucket, the cosine a member needs at least: the local threshold.
Buckets where it is above 1 are skipped before any row moves.  In the others
it decides the pruning: with a high threshold, coordinate ranges around the
query's largest coordinates; with a low one, the members' lengths.  What is
left is verified by exact products.

A component x becomes floor(256 * x).  Vectors that are null or hold a null
or non-finite component take no part, nor do rows with a null id; a shorter
vector counts as padded with zeros.  Rows that repeat an id count once, with
the greatest vector.  Ties in the score go to the smaller id.  Other columns
are not read, so clashing names do not matter; an empty table (or one vector)
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

K, SCALE = 5, 256
BUCKET_ROWS, MAX_BUCKETS = 8192, 256
BLOCK_ROWS, QUERY_ROWS = 8192, 2048
SEEDS = 1024             # the longest vectors, for a first threshold
HIGH_COSINE, FOCUS = 0.8, 4
SLACK = 1e-9             # of rounding in lengths
EXACT = 2.0 ** 52


def whole_numbers(embedding: Column) -> Column:
    """floor(256 * x) of each component; null where the vector takes no part."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & fine,
                  F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(float) ** 2).sum(1))


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point only where it is exact."""
    if not len(q) or not len(p):
        return np.zeros((len(q), len(p)), np.int64)
    most = _lengths(q).max() * _lengths(p).max()
    if most < EXACT and max(np.abs(q).max(initial=0), np.abs(p).max(initial=0)) < EXACT:
        return (q.astype(float) @ p.astype(float).T).astype(np.int64)
    exact = q.astype(object) @ p.astype(object).T
    edge = np.iinfo(np.int64)
    return np.clip(exact, edge.min, edge.max).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= edge)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search_block(q_ids, q, theta, p_ids, p, k):
    """The k best members of one block for each query, of those that may count.

    Members come in any order; ``theta`` is a score that the k-th best of all
    members reaches at least.
    """
    order = np.lexsort((p_ids, -_lengths(p)))
    p_ids, p, = p_ids[order], p[order]
    lp, lq = _lengths(p), _lengths(q)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(lq * lp[0] > 0, theta / (lq * lp[0]), -np.inf)
        unit_p = p / np.where(lp > 0, lp, 1)[:, None]
    found = []

    def keep(i, places, scores):
        own = p_ids[places] != q_ids[i]
        places, scores = places[own], scores[own]
        enough = scores >= theta[i]
        places, scores = places[enough], scores[enough]
        for j in best_of(scores, p_ids[places], k):
            found.append((int(q_ids[i]), int(p_ids[places[j]]), int(scores[j])))

    by_length = np.flatnonzero(local < HIGH_COSINE)
    for at in range(0, len(by_length), 256):
        part = by_length[at:at + 256]
        # lengths fall: only a first part of the block can reach the smallest threshold
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where((theta[part] > 0) & (lq[part] > 0), theta[part] / lq[part], 0).min()
        n = int(np.searchsorted(-lp, -need * (1 - SLACK), side="right")) if need > 0 else len(lp)
        scores = products(q[part], p[:n])
        for i, row in zip(part, scores, strict=True):
            keep(i, np.arange(n), row)
    for i in np.flatnonzero((local >= HIGH_COSINE) & (local <= 1 + SLACK)):
        unit, cosine = q[i] / lq[i], min(1.0, local[i] * (1 - SLACK))
        alive = np.ones(len(p), bool)
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            # two unit vectors with cosine >= c differ in a coordinate within this range
            mid, half = unit[f] * cosine, np.sqrt(max(0.0, (1 - cosine ** 2) * (1 - unit[f] ** 2)))
            low = mid - half if unit[f] > -cosine else -1.0
            high = mid + half if unit[f] < cosine else 1.0
            alive &= (unit_p[:, f] >= low - 1e-7) & (unit_p[:, f] <= high + 1e-7)
        places = np.flatnonzero(alive)
        if len(places):
            keep(i, places, products(q[i:i + 1], p[places])[0])
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id and score of the k best other rows of every query."""
    spark = vectors.sparkSession
    rows = (vectors.select(vectors[id_col].cast("long").alias("id"), whole_numbers(vectors[vector_col]).alias("v"),
                           is_query.alias("is_query"))
            .where("id is not null and v is not null")
            .groupBy("id").agg(F.max("v").alias("v"), F.max("is_query").alias("is_query")))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = C.written(rows.select("id", "v", "is_query", F.sqrt(squares).alias("length")), "vectors")
    n, n_queries, width, longest = rows.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1)), F.max(F.size("v")),
                                            F.max("length")).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not n or not n_queries:
        return spark.createDataFrame([], result)
    buckets = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    edges = sorted(set(rows.approxQuantile("length", [i / buckets for i in range(1, buckets)], 0.001))) if buckets > 1 else []
    bucket = F.lit(0)
    for e in edges:      # at most MAX_BUCKETS
        bucket = bucket + (F.col("length") > F.lit(e)).cast("int")
    sizes = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.max("length").alias("most")).collect()
    blocks = {r.bucket: -(-r.rows // BLOCK_ROWS) for r in sizes}
    n_parts = -(-n_queries // QUERY_ROWS)

    # a bounded set of seeds gives every query its first threshold
    seeds = rows.orderBy(F.desc("length"), "id").limit(SEEDS).select("id", "v").toArrow()
    shared = spark.sparkContext.broadcast((seeds["id"].to_numpy(), _matrix(seeds["v"], width)))
    none = -(2 ** 62)

    def first_threshold(batches):
        seed_ids, seed = shared.value
        for batch in batches:
            ids, q = batch.column("id").to_numpy(), _matrix(batch.column("v"), width)
            theta = np.full(len(ids), none, np.int64)
            scores = products(q, seed)
            for i, row in enumerate(scores):
                others = row[seed_ids != ids[i]]
                if len(others) >= k:
                    theta[i] = np.partition(others, len(others) - k)[len(others) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(theta)], names=[*batch.schema.names, "theta"])

    queries = rows.where("is_query").select("id", "v", "length").mapInArrow(
        first_threshold, "id long, v array<long>, length double, theta long")
    # the buckets that a query can still find something in: their local threshold is at most 1
    open_buckets = F.filter(F.array(*(F.struct(F.lit(r.bucket).alias("bucket"), F.lit(float(r.most)).alias("most"),
                                               F.lit(blocks[r.bucket]).alias("blocks")) for r in sizes)),
                            lambda b: F.col("theta") <= F.col("length") * b["most"] * (1 + SLACK) + SLACK)
    queries = (queries.withColumn("b", F.explode(open_buckets))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("b.blocks") - 1)))
               .select(F.col("b.bucket").alias("bucket"), "block", F.pmod(F.xxhash64("id"), F.lit(n_parts)).cast("int").alias("part"),
                       "id", "v", "theta"))
    block_count = F.create_map(*(F.lit(x) for b, c in blocks.items() for x in (b, c)))
    members = (rows.withColumn("bucket", bucket)
               .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), block_count[F.col("bucket")]).cast("int"))
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
               .select("bucket", "block", "part", "id", "v"))

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = search_block(left["id"].to_numpy(), _matrix(left["v"], width), left["theta"].to_numpy(),
                                 right["id"].to_numpy(), _matrix(right["v"], width), k)
        cols = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    keys = ["bucket", "block", "part"]
    found = queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(verify, "query_id long, vec_id long, score long")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
