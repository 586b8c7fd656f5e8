"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers ``x = floor(scale * c) + offset``; the fit list holds each distinct one
once. With A the fit list's rows, centred, the bidiagonalisation builds orthonormal columns U and V
and an upper bidiagonal B with ``A V = U B``, by alternating products ``A v`` and ``Aᵀ u``. The
singular value decomposition of the small B then gives the components (right singular vectors of A)
and their deviations (singular values over the square root of n).

Distributed. Right vectors are short and live in the driver. Left vectors have an entry per row of
the fit list and are never gathered: each is ``u = A p`` with a short p that is carried along, so a
task makes the entries of its rows anew from P. One scan of the fit list gives ``A p``, its norm,
its products with all earlier left vectors and ``Aᵀ A p``; what leaves a task is one number per
dimension and per left vector, added up by Spark. Both sides are reorthogonalised against all
earlier vectors, twice: a step is two scans.

Rows are centred before anything is multiplied, from exact integers: ``(n x - S) / n`` with S the
exact sums, so a large offset costs no digits.

The steps end when the vectors span the whole space, or when it is certain that the leading
components are found: their residuals are rounding errors, and the variance outside the space built
so far, which bounds any component still unseen, is below the last of them. A space that closes
early (equal variances, fewer independent directions) is left by a new start orthogonal to it.

Defined cases: vectors that are null or hold a null, NaN or infinite entry take no part, nor do
empty ones; of vectors with different lengths the commonest length counts (of equally common ones
the longer) and others take no part; repeated vectors count once in the fit and each row has its
result; rows without an id keep their null; entries beyond 2 ** 62 count as that, and deviations
beyond a long as the greatest long; directions without variance (a deviation below 1e-11 of the
largest) are no components, so a table of equal vectors, like an empty one, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.topk import integers, usable

SEED = 20240101
BLOCK = 2048
LONG = 2**63 - 1
#: Relative size below which a residual or a deviation is a rounding error.
ROUNDING = 1e-14
NO_VARIANCE = 1e-11
LOW = np.int64((1 << 31) - 1)


class Whitening(NamedTuple):
    """``components`` has one unit column per component; ``deviations`` are those of the fit list."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    trace: float


def rows_of(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def scaled_deltas(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they surely fit, Python integers elsewhere."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), max(map(abs, sums), default=0) // n + 1)
    if 2 * n * most <= LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (scaled_deltas(x, n, sums) / n).astype(np.float64)


def squared_lengths(deltas: np.ndarray) -> np.ndarray:
    """Exact sums of squares by row, at most the greatest long."""
    most = max(abs(int(deltas.max(initial=0))), abs(int(deltas.min(initial=0))))
    if deltas.dtype != object and most * most * max(1, deltas.shape[1]) <= LONG:
        return (deltas * deltas).sum(axis=1)
    return np.array([min(LONG, sum(int(v) ** 2 for v in row)) for row in deltas], np.int64)


def fit_blocks(vectors: DataFrame) -> DataFrame:
    """The distinct rows of ``x`` as stored matrices of up to ``BLOCK`` rows each."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = rows_of(batch.column(0).slice(begin, BLOCK))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int64()), pa.array([part.astype("<i8").tobytes()], pa.binary())],
                    ["rows", "matrix"],
                )

    return stored(vectors.select("x").distinct().mapInArrow(matrices, "rows long, matrix binary"), "whitening-fit")


def added_up(blocks: DataFrame, parts: Callable[[np.ndarray], np.ndarray], length: int, kind: str = "double") -> np.ndarray:
    """The sum over all blocks of ``parts(x)``, a vector; a task adds up its own first."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows, matrix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = parts(np.frombuffer(matrix, "<i8").reshape(rows, -1))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], ["at", "amount"])

    found = blocks.mapInArrow(sums, f"at long, amount {kind}").groupBy("at").agg(F.sum("amount").alias("amount"))
    result = np.zeros(length, object if kind == "long" else np.float64)
    for at, amount in found.collect():
        result[at] = amount
    return result


def exact_sums(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and the sums by dimension; values are added in two halves, which cannot overflow."""

    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 31).sum(axis=0), (x & LOW).sum(axis=0)])

    found = [int(v) for v in added_up(blocks, halves, 1 + 2 * dims, "long")]
    return found[0], [(high << 31) + low for high, low in zip(found[1 : 1 + dims], found[1 + dims :])]


def against(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``vector`` without its parts along the orthonormal ``basis``, twice."""
    if basis:
        columns = np.stack(basis, axis=1)
        for _ in range(2):
            vector = vector - columns @ (columns.T @ vector)
    return vector


def bidiagonalised(
    product: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]],
    dims: int,
    variance: float,
    most: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors of A as columns, and its singular values.

    ``product(p, P)`` gives the squared norm of ``u = A p``, its products with the columns of
    ``A P``, and ``Aᵀ u``. ``variance`` is the sum of all squared entries of A.
    """
    size = np.sqrt(variance)
    rng = np.random.default_rng(SEED)
    right: list[np.ndarray] = []
    left, back = np.zeros((dims, 0)), np.zeros((dims, 0))  # u = A left[:, i]; back[:, i] = Aᵀ u
    entries: list[tuple[int, int, float]] = []
    links: list[int] = []  # for each left vector its step
    following, beta = None, 0.0

    while True:
        step = len(right)
        if following is None:  # a start, orthogonal to what there is
            fresh = against(rng.normal(size=dims), right)
            following, beta = fresh / np.linalg.norm(fresh), 0.0
        v = following
        right.append(v)
        p = v.copy()
        if beta:
            entries.append((links[-1], step, beta))
            p = v - beta * left[:, -1]
        for _ in range(2):
            squared, along, backwards = product(p, left)
            p = p - left @ along
        # the second scan's remainders are rounding errors; its sums are corrected by them
        alpha = float(np.sqrt(max(0.0, squared - along @ along)))
        backwards = backwards - back @ along
        if alpha > ROUNDING * size * np.sqrt(dims):
            entries.append((step, step, alpha))
            links.append(step)
            left = np.column_stack([left, p / alpha])
            back = np.column_stack([back, backwards / alpha])
            rest = against(backwards / alpha - alpha * v, right)
            beta = float(np.linalg.norm(rest))
        else:
            beta = 0.0
        steps = len(right)
        b = np.zeros((steps, steps))
        for row, column, value in entries:
            b[row, column] = value
        outer, values, inner = np.linalg.svd(b)
        if steps < dims and beta > ROUNDING * size:
            following = rest / beta
            residual = beta * np.abs(outer[step, :most])
        else:
            following, residual = None, np.zeros(min(most, steps))
        unseen = variance - float((values**2).sum())
        found = len(values) >= most and residual.max() <= ROUNDING * values[0]
        if steps == dims or found and unseen < 0.5 * values[most - 1] ** 2:
            return np.stack(right, axis=1) @ inner.T[:, :most], values[:most]


def fit(blocks: DataFrame, dims: int, most: int = 16) -> Whitening | None:
    """The whitening of a fit list; None without rows."""
    n, sums = exact_sums(blocks, dims)
    if not n:
        return None
    variance = float(added_up(blocks, lambda x: np.array([(centred(x, n, sums) ** 2).sum()]), 1)[0])
    if not variance:
        return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0)

    def product(p: np.ndarray, left: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        k = left.shape[1]

        def parts(x: np.ndarray) -> np.ndarray:
            a = centred(x, n, sums)
            u = a @ p
            return np.concatenate([[u @ u], (a @ left).T @ u, a.T @ u])

        found = added_up(blocks, parts, 1 + k + dims)
        return float(found[0]), found[1 : 1 + k], found[1 + k :]

    components, values = bidiagonalised(product, dims, variance, min(most, dims))
    real = values > NO_VARIANCE * values[0]
    return Whitening(n, sums, components[:, real], values[real] / np.sqrt(n), variance / n)


def whitened_values(x: np.ndarray, by: Whitening) -> np.ndarray:
    return centred(x, by.n, by.sums) @ by.components / by.deviations


def identity_error(blocks: DataFrame, by: Whitening) -> float:
    """The largest entry by which the whitened fit list's covariance differs from the identity."""
    k = len(by.deviations)
    means = added_up(blocks, lambda x: whitened_values(x, by).sum(axis=0), k) / by.n

    def products(x: np.ndarray) -> np.ndarray:
        w = whitened_values(x, by) - means
        return (w.T @ w).ravel()

    covariance = added_up(blocks, products, k * k).reshape(k, k) / by.n
    return float(np.abs(covariance - np.eye(k)).max())


def prepared(
    embeddings: DataFrame, vec_id: str, embedding: str, scale: int, offset: int
) -> tuple[DataFrame, int]:
    """vec_id, x of the rows that take part, and the vectors' length (0 without rows)."""
    rows = embeddings.filter(usable(F.col(embedding)) & (F.size(embedding) > 0))
    rows = rows.select(
        F.col(vec_id).alias("vec_id"),
        F.transform(integers(F.col(embedding), scale), lambda x: x + F.lit(offset)).alias("x"),
    )
    sizes = rows.groupBy(F.size("x").alias("dims")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common.dims if common else 0
    return rows.filter(F.size("x") == dims), dims


def whiten(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    most: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    rows, dims = prepared(embeddings, vec_id, embedding, scale, offset)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    blocks = fit_blocks(rows) if dims else None
    by = fit(blocks, dims, most) if dims else None
    if by is None or not len(by.deviations):
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(blocks, by)
    k = len(by.deviations)
    explained = by.deviations**2 / by.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                x = rows_of(part.column(1))
                m = len(x)
                lengths = squared_lengths(scaled_deltas(x, by.n, by.sums))
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, by.n, np.int64)),
                    pa.array(np.repeat(lengths, k)),
                    pa.array(whitened_values(x, by).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                )

    return rows.mapInArrow(project, schema)


def digest(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
