"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred matrix A of distinct vectors stays distributed by rows. A step multiplies it by a
right vector (Av, a number a row) and at once by the result (A'u, a number a dimension), so each
step is one pass in which a task returns dimension + steps numbers. Left vectors are not stored:
each is A times a known direction, so that reorthogonalising against all of them needs only the
products of the same pass. The singular value decomposition of the small bidiagonal matrix gives
components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Tasks of a pass at most: each returns dimension + steps numbers to the driver.
TASKS = 2048
#: Numbers of a matrix that a task works on at once.
CELLS = 1 << 20
_OUT = [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]


def scaled(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows whose vector is whole and finite, and the dimension.

    ``x`` is floor(256 c) as long, saturating beyond 64 bits. A vector shorter than the longest
    one goes on with zeros. The rows are written once and read by every later pass.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    whole = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = cut_lineage(rows.where(F.col("c").isNotNull() & whole).select("vec_id", F.transform("c", lambda c: F.floor(c * 256.0).cast("long")).alias("x")))
    dim = rows.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    padded = F.when(F.size("x") == dim, F.col("x")).otherwise(F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))))
    return rows.withColumn("x", padded), dim


def _matrices(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    """A list column as integer matrices of bounded size."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    step = max(1, CELLS // dim)
    for lo in range(0, len(flat), step):
        yield flat[lo : lo + step]


def _pass(fit: DataFrame, dim: int, kernel: Callable, state: object, kind: str = "double") -> np.ndarray:
    """The sum over all rows of ``kernel(x, state)``, a flat array for a matrix of rows.

    Tasks sum their rows; their sums are added in the order of the partitions, so reruns agree.
    """
    sent = fit.sparkSession.sparkContext.broadcast(state)
    dtype = np.int64 if kind == "long" else np.float64
    schema = pa.schema([("part", pa.int32()), ("sums", pa.list_(pa.from_numpy_dtype(dtype)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in _matrices(b.column(0), dim):
                part = np.asarray(kernel(x, sent.value), dtype)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], schema.field(1).type)], schema=schema)

    rows = fit.select("x").mapInArrow(run, f"part int, sums array<{kind}>").collect()
    sent.unpersist()
    return sum((np.array(r["sums"], dtype) for r in sorted(rows, key=lambda r: r["part"])), 0)


def _halves(x: np.ndarray, _) -> np.ndarray:
    """Column sums as high and low 32 bits, which cannot overflow."""
    high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
    return np.concatenate((high + (low >> 32), low & 0xFFFFFFFF))


def _products(x: np.ndarray, state: tuple) -> np.ndarray:
    """A times the directions, then A' times the last of the results: (last . all, A' last, sum of squares)."""
    mean, directions = state
    a = x - mean
    y = a @ directions
    u = y[:, -1]
    return np.concatenate((y.T @ u, a.T @ u, [np.sum(a * a)]))


def _moments(x: np.ndarray, state: tuple) -> np.ndarray:
    mean, weights = state
    w = (x - mean) @ weights
    return np.concatenate((w.sum(0), (w.T @ w).ravel()))


def _orthogonal(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``r`` without its parts along the basis, taken out twice."""
    for _ in range(2):
        r = r - basis @ (basis.T @ r)
    return r


def bidiagonalise(fit: DataFrame, dim: int, mean: np.ndarray, steps: int | None = None, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """(singular values falling, right singular vectors as columns, sum of all squares) of the centred rows.

    ``steps`` is the number of Lanczos steps; without it as many as dimensions, which is exact up
    to rounding. Where a step ends in a zero (an exhausted or repeated part of the spectrum), it
    starts again from a random vector orthogonal to all before.
    """
    steps = min(steps or dim, dim)
    rng = np.random.default_rng(seed)
    right, left, images = np.zeros((dim, 0)), np.zeros((dim, 0)), np.zeros((dim, 0))  # v, directions of u, A'u
    small = np.zeros((steps, steps))
    v, beta, squares = rng.standard_normal(dim), 0.0, 0.0
    v /= np.linalg.norm(v)
    has_left = []  # steps that have a left vector, in the order of the columns of ``left``
    for k in range(steps):
        right = np.column_stack((right, v))
        q = v - beta * left[:, -1] if beta else v
        sums = _pass(fit, dim, _products, (mean, np.column_stack((left, q))))
        dots, norm2, image, squares = sums[: len(has_left)], sums[len(has_left)], sums[len(has_left) + 1 : -1], float(sums[-1])
        q, image = q - left @ dots, image - images @ dots
        norm2 = max(0.0, norm2 - dots @ dots)
        if beta:
            small[has_left[-1], k] = beta
        for j, d in zip(has_left, dots):  # what rounding or a fresh start has left along earlier vectors
            small[j, k] += d
        tiny = 1e-13 * np.sqrt(squares)
        alpha = float(np.sqrt(norm2))
        if alpha > tiny:
            small[k, k] = alpha
            left, images = np.column_stack((left, q / alpha)), np.column_stack((images, image / alpha))
            has_left.append(k)
            r = _orthogonal(images[:, -1] - alpha * v, right)
            beta = float(np.linalg.norm(r))
        else:
            beta = 0.0
        if beta <= tiny:
            beta = 0.0
            r = _orthogonal(rng.standard_normal(dim), right)
        v = r / (np.linalg.norm(r) or 1.0)
    _, values, turned = np.linalg.svd(small)
    return values, right @ turned.T, squares


def whiten(vectors: DataFrame, components: int = 4, steps: int | None = None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every remaining row.

    Rows whose vector is null or holds null or non-finite entries are dropped. Components, n and
    moments come from the distinct vectors. ``deviation`` is the exact sum over dimensions of
    (n x - S)^2, null where it does not fit in 64 bits. Components without variance (fewer distinct
    vectors than components, constant or repeated dimensions) do not exist and give no rows; so an
    empty table, or one distinct vector, gives none. Null and repeated ids keep all their rows;
    components of equal variance are one of the possible bases. Further columns play no part.
    """
    spark = vectors.sparkSession
    rows, dim = scaled(vectors)
    ddl = ", ".join(f"{c} {t}" for c, t in _OUT)
    fit = cut_lineage(rows.select("x").distinct())
    n = fit.count()
    if n == 0 or dim == 0:
        return spark.createDataFrame([], ddl)
    if fit.rdd.getNumPartitions() > TASKS:
        fit = fit.coalesce(TASKS)
    halves = _pass(fit, dim, _halves, None, "long")
    sums = [int(h) * (1 << 32) + int(low) for h, low in zip(halves[:dim], halves[dim:])]
    mean = np.array([s / n for s in sums])
    values, vectors_, squares = bidiagonalise(fit, dim, mean, steps)
    found = int(min(components, np.sum(values[:components] > 1e-12 * max(values[0], 1e-300)))) if squares > 0 else 0
    if found == 0:
        return spark.createDataFrame([], ddl)
    deviations = values[:found] / np.sqrt(n)
    weights = vectors_[:, :found] / deviations
    moments = _pass(fit, dim, _moments, (mean, weights))
    centre, gram = moments[:found] / n, moments[found:].reshape(found, found) / n
    error = float(np.max(np.abs(gram - np.outer(centre, centre) - np.eye(found))))
    explained = [float(e) for e in deviations**2 * n / squares]
    sent = spark.sparkContext.broadcast((mean, weights, sums))
    schema = pa.schema([(c, {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[t]) for c, t in _OUT])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, weights, sums = sent.value
        for b in batches:
            at = 0
            for x in _matrices(b.column(1), dim):
                ids = b.column(0).slice(at, len(x))
                at += len(x)
                w = (x - mean) @ weights
                each = np.repeat(np.arange(len(x)), found)
                dev = pa.array(_deviation(x, n, sums), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)),
                     dev.take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))], schema=schema)

    return rows.mapInArrow(project, ddl)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum of (n x - S)^2 of every row, exactly; null where it does not fit in 64 bits."""
    most = n * float(np.max(np.abs(x.astype(np.float64)), initial=0)) + max(abs(s) for s in sums)
    if x.shape[1] * most * most < 9e18:
        t = n * x - np.array(sums, np.int64)
        return (t * t).sum(1).tolist()
    whole = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in whole]
