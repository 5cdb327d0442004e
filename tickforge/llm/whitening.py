"""Embedding whitening by QDWH spectral divide-and-conquer (operator 12).

1. A component c becomes x = floor(256 * c).  The fit list is each distinct x
   vector once; it is written, so its passes read one table.
2. Exact per-dimension sums, then the covariance of the centred vectors (a
   second pass), are summed per task and added up by matrix row: a task sends
   d rows of d numbers, the driver gets d rows in all.
3. The d x d covariance is taken apart on the driver: the polar factor U of
   ``V - s`` (dynamically weighted Halley iterations, QDWH) gives the spectral
   projector ``(U + 1) / 2`` on the eigenvalues above the shift s; bases of its
   range and of the rest split V into two smaller matrices, and so on down to
   single components.  Parts that hold none of the wanted ones are left whole.
4. The basis (d x components) goes to every task, which whitens its rows.  A
   last pass over the fit list measures the whitened vectors' covariance.

Rows whose vector is null or holds a null or non-finite entry are left out;
so are vectors of another length than the most frequent one (of two equally
frequent ones the longer counts).  Entries beyond a long saturate.  Repeated
vectors count once in the fit, repeated rows all come out, also those with a
null id.  Only the id and the vector are read, so clashing names do not
matter.  Components without variance (eigenvalue at most d * 1e-15 of the
largest) cannot be whitened and are not returned: a table of one distinct
vector, or an empty one, gives an empty result.  A deviation beyond a long is
null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .topk import whole_numbers

EPS = np.finfo(float).eps
LONGS = 2.0 ** 62        # whole numbers whose bound is below this are added as longs
SHIFTS = 60              # tried before a part is taken for one repeated eigenvalue


# -- the symmetric eigenproblem


def polar_factor(a: np.ndarray) -> np.ndarray:
    """U of a = U H, U orthogonal, by QDWH (at most some seven steps whatever the condition)."""
    n = len(a)
    one = np.eye(n)
    x = a / np.linalg.norm(a)
    low = 1e-17                              # below the smallest singular value worth telling apart
    while True:
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, one]))
            new = q / r * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        else:
            new = q / r * x + (p - q / r) * np.linalg.solve(one + r * x.T @ x, x.T).T
        new = (new + new.T) / 2
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved <= (5 * EPS) ** (1 / 3):
            return x


def _shifts(a: np.ndarray, rng: np.random.Generator) -> Iterator[float]:
    diagonal = np.diag(a)
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    reach = np.linalg.norm(a - diagonal.mean() * np.eye(len(a)))
    for k in range(SHIFTS):
        yield float(diagonal.mean() + rng.normal() * reach / 2 ** (k % 20))


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the eigenvectors above some shift."""
    n = len(a)
    for shift in _shifts(a, rng):
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved) > EPS * scale:
            continue
        projector = (polar_factor(moved) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-8 * n:
            continue
        basis = projector @ rng.normal(size=(n, k))
        for _ in range(2):                   # the second time only tidies up
            basis, _ = np.linalg.qr(basis, mode="complete")
            whole = basis
            basis = projector @ basis[:, :k]
        if np.linalg.norm(whole[:, k:].T @ a @ whole[:, :k]) <= 50 * n * EPS * scale:
            return whole, k
    return None


def eigen(v: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    n = len(v)
    wanted = n if wanted is None else min(wanted, n)
    v = (v + v.T) / 2
    scale = float(np.linalg.norm(v))
    rng = np.random.Generator(np.random.PCG64(12))
    found, todo = [], [(np.eye(n), 0)]       # basis of a part, number of eigenvalues above it
    while todo:
        basis, above = todo.pop()
        if above >= wanted:
            continue
        part = basis.T @ v @ basis
        part = (part + part.T) / 2
        size = len(part)
        cut = None
        if size > 1 and np.linalg.norm(part - np.trace(part) / size * np.eye(size)) > size * EPS * scale:
            cut = _split(part, scale, rng)
        if cut is None:                      # one component, or one eigenvalue repeated
            found += [(float(part[i, i]), basis[:, i]) for i in range(size)]
            continue
        whole, k = cut
        todo += [(basis @ whole[:, :k], above), (basis @ whole[:, k:], above + k)]
    found.sort(key=lambda f: -f[0])
    found = found[:wanted]
    if not found:
        return np.zeros(0), np.zeros((n, 0))
    vectors = np.stack([f[1] / np.linalg.norm(f[1]) for f in found], 1)
    return np.array([f[0] for f in found]), vectors


# -- sums over the fit list


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def whole_sum(x: np.ndarray) -> list[int]:
    """Exact column sums."""
    if not x.size or float(np.abs(x.astype(float)).max()) * len(x) < LONGS:
        return [int(s) for s in x.sum(0)]
    return [int(s) for s in x.astype(object).sum(0)]


@dataclass(frozen=True)
class Centre:
    """Size and exact per-dimension sums of the fit list."""
    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs, or Python's whole numbers where longs are too short."""
        most = self.n * float(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most < LONGS:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Each row's sum of squared deviations; None beyond a long."""
        off = self.deviations(x)
        if off.dtype != object and float(np.abs(off).max(initial=0)) ** 2 * max(x.shape[1], 1) < LONGS:
            return (off * off).sum(1).tolist()
        exact = (off.astype(object) ** 2).sum(1)
        return [int(s) if s < 2 ** 63 else None for s in exact]


def centre_of(fit: DataFrame, width: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            n += batch.num_rows
            sums = [a + b for a, b in zip(sums, whole_sum(rows_of(batch.column(0), width)), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([s >> 32 for s in sums], pa.int64()),
             pa.array([s & 0xFFFFFFFF for s in sums], pa.int64()), pa.array([n] * width, pa.int64())], names=["i", "high", "low", "n"])

    parts = fit.select("x").mapInArrow(C.tidy(run), "i int, high long, low long, n long")
    total = parts.groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).collect()
    sums = {r.i: (r.high << 32) + r.low for r in total}
    return Centre(max((r.n for r in total), default=0), tuple(sums[i] for i in range(width)))


def products(fit: DataFrame, width: int, of, size: int) -> np.ndarray:
    """Sum over the fit list of the outer products of ``of(x)``, a row of ``size`` numbers each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            w = of(rows_of(batch.column(0), width))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                         names=["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows[i] = rows.get(i, 0.0) + np.frombuffer(row)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())],
                                         names=["i", "row"])

    parts = fit.select("x").mapInArrow(C.tidy(run), "i int, row binary")
    n = min(size, int(fit.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros((size, size))
    for r in parts.repartition(max(n, 1), "i").mapInArrow(C.tidy(add), "i int, row binary").collect():
        out[r.i] = np.frombuffer(r.row)
    return out


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    basis: np.ndarray            # d x components, eigenvectors over the root of their eigenvalue
    eigenvalues: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and x of the rows that take part, before lengths are looked at."""
    return embeddings.select(embeddings[id_col].alias("id"), whole_numbers(embeddings[vector_col]).alias("x")).where("x is not null")


def fit(vectors: DataFrame, components: int) -> tuple[Whitening | None, int]:
    """The whitening of an ``x`` column's distinct vectors, and their length."""
    distinct = C.written(vectors.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    lengths = distinct.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    width = common[0].width if common else 0
    if not width:
        return None, 0
    distinct = distinct.where(F.size("x") == width)
    centre = centre_of(distinct, width)
    v = products(distinct, width, centre.centred, width) / centre.n
    values, vectors_ = eigen(v, components)
    fine = values > max(width * 1e-15 * (values[0] if len(values) else 0), 0)
    values, vectors_ = values[fine], vectors_[:, fine]
    if not len(values):
        return None, width
    basis = vectors_ / np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        return np.hstack([centre.centred(x) @ basis, np.ones((len(x), 1))])

    both = products(distinct, width, whitened, len(values) + 1) / centre.n
    mean = both[-1, :-1]
    error = np.abs(both[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max()
    return Whitening(centre, basis, values, vectors_, values / np.trace(v), float(error)), width


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector and component: id and the columns of ``OUT``."""
    rows = whole_vectors(embeddings, id_col, vector_col)
    model, width = fit(rows, components)
    schema = C.fields(id_col, embeddings.schema[id_col].dataType, OUT)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch.column(1), width)
            which = pa.array(np.repeat(np.arange(len(x)), k))
            white = model.centre.centred(x) @ model.basis
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, model.centre.n)), pa.array(model.centre.squares(x), pa.int64()).take(which),
                 pa.array(white.ravel()), pa.array(np.tile(model.explained, len(x))),
                 pa.array(np.full(len(x) * k, model.identity_error))], names=schema.names)

    return rows.where(F.size("x") == width).mapInArrow(C.tidy(run), schema)
