"""Whitening by QDWH spectral divide-and-conquer.

The polar factor of a shifted covariance, V - s I, has the eigenvalues +1 and -1 for those of V above
and below s. (U + I) / 2 therefore projects on the upper eigenvectors; a basis of its range and one of the
rest cut V into two smaller covariances, each of which is cut again until single components are left.
Parts below the last wanted component are not looked into.

Spark sums up the covariance over all rows: exact sums first, then products of centred vectors, added
up within each task and by pair of dimensions. What reaches the driver has the size of one covariance matrix,
at most WIDEST squared. The whitening matrix goes to every task; rows are not moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import map_columns, small_batches, stored

#: Most dimensions of a vector.
WIDEST = 2_048
#: A component with less than this part of the greatest variance times the dimensions counts as none.
PRECISION = np.finfo(float).eps


# --- polar decomposition and spectral cuts -------------------------------------------------------


def polar(matrix: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor by the dynamically weighted Halley iteration, by QR alone.

    ``low`` is a lower bound of the smallest singular value; the weights lift it to 1 in six steps from
    any start that double precision can tell from zero.
    """
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix)
    low, eye = PRECISION, np.eye(size)
    for _ in range(30):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        after = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        after = (after + after.T) / 2  # the factor of a symmetric matrix is symmetric
        step = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (a + b * low**2) / (1 + c * low**2))
        if low > 1 - 1e-8 and step <= 1e-12 * size:
            break
    return x


def _shifts(matrix: np.ndarray) -> Iterator[float]:
    """Where to cut: the median of the diagonal, then the mean, which always has eigenvalues on both
    sides, then places around it in case an eigenvalue lies on one of these."""
    diagonal = np.diag(matrix)
    yield float(np.median(diagonal))
    mean, spread = float(diagonal.mean()), float(np.linalg.norm(matrix - diagonal.mean() * np.eye(len(matrix))))
    yield mean
    for part in (0.013, -0.017, 0.11, -0.13, 0.29, -0.31):
        yield mean + part * spread / np.sqrt(len(matrix))


def _range(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal basis of a projector's range, from fixed random vectors projected twice."""
    start = np.random.default_rng(rank).standard_normal((len(projector), rank))
    basis = np.linalg.qr(projector @ start)[0]
    return np.linalg.qr(projector @ basis)[0]


def cut(matrix: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the upper and the lower invariant subspace; None if no shift parts the eigenvalues."""
    size = len(matrix)
    for shift in _shifts(matrix):
        shifted = matrix - shift * np.eye(size)
        if np.linalg.norm(shifted) <= tolerance:
            continue
        projector = (polar(shifted) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size or np.linalg.norm(projector @ projector - projector) > 1e-10 * size:
            continue
        upper, lower = _range(projector, rank), _range(np.eye(size) - projector, size - rank)
        both = np.linalg.qr(np.hstack([upper, lower]))[0]
        upper, lower = both[:, :rank], both[:, rank:]
        if np.linalg.norm(lower.T @ matrix @ upper) <= tolerance:
            return upper, lower
    return None


def components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    matrix = np.asarray(matrix, float)
    tolerance = 10 * len(matrix) * PRECISION * np.linalg.norm(matrix)
    values, vectors = [], []

    def split(part: np.ndarray, basis: np.ndarray) -> None:
        if len(values) >= wanted:
            return
        level = np.trace(part) / len(part)
        if len(part) == 1 or np.linalg.norm(part - level * np.eye(len(part))) <= tolerance:
            for column in basis.T:  # one eigenvalue: any basis consists of components
                values.append(float(column @ matrix @ column))
                vectors.append(column)
            return
        halves = cut(part, tolerance)
        if halves is None:
            raise ArithmeticError(f"no shift parts a block of {len(part)} components")
        for half in halves:  # the upper one first, so components come by falling eigenvalue
            inner = half.T @ part @ half
            split((inner + inner.T) / 2, basis @ half)

    if len(matrix):
        split((matrix + matrix.T) / 2, np.eye(len(matrix)))
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    columns = np.array(vectors).reshape(len(vectors), len(matrix))[order].T
    return np.array(values)[order], columns


# --- distributed moments -------------------------------------------------------------------------


@dataclass
class Moments:
    """Rows, exact sums (whole numbers stay whole) and covariance, divisor n."""

    n: int
    sums: list
    covariance: np.ndarray


def _rows(array: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column as a matrix; no entry is null."""
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1)


def _centred(rows: np.ndarray, n: int, sums: list) -> np.ndarray:
    """Rows less the mean. Whole numbers lose their whole part exactly before the rest is taken off."""
    if rows.dtype.kind == "i":
        whole = np.array([s // n for s in sums], np.int64)
        return (rows - whole).astype(float) - np.array([s % n / n for s in sums])
    return rows - np.array(sums, float) / n


def _products(n: int, sums: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of centred vectors, added up over a task: one row per pair of dimensions."""
    total = None
    for batch in small_batches(batches):
        if batch.num_rows:
            centred = _centred(_rows(batch.column(0)), n, sums)
            total = centred.T @ centred + (0 if total is None else total)
    if total is not None:
        left, right = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(total[left, right])],
            names=["i", "j", "product"],
        )


def moments(frame: DataFrame, vector: str) -> Moments:
    """Of all rows; their vectors are whole, have no null entries and one length."""
    vectors = frame.select(F.col(f"`{vector}`").alias("x"))
    shape = vectors.agg(
        F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")
    ).first()
    if not shape.n:
        return Moments(0, [], np.zeros((0, 0)))
    if shape.least != shape.most:
        raise ValueError(f"vectors of {shape.least} to {shape.most} entries have no covariance")
    if shape.most > WIDEST:
        raise ValueError(f"vectors of {shape.most} entries, at most {WIDEST}")
    by_place = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"))
    sums = [r.s for r in sorted(by_place.collect())]  # one row per dimension
    covariance = np.zeros((shape.most, shape.most))
    products = vectors.mapInArrow(partial(_products, shape.n, sums), "i int, j int, product double")
    for r in products.groupBy("i", "j").agg(F.sum("product").alias("product")).collect():  # one per pair
        covariance[r.i, r.j] = covariance[r.j, r.i] = r.product / shape.n
    return Moments(shape.n, sums, covariance)


# --- whitening -----------------------------------------------------------------------------------


@dataclass
class Whitening:
    """What was learnt: rows, sums, eigenvalues by fall, unit components as columns, and total variance."""

    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    variance: float


def finite(frame: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty, and holds neither null nor a non-finite entry."""
    entry = "c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity')"
    return frame.where(f"size(`{vector}`) > 0 AND forall(`{vector}`, {entry})")


def fit(frame: DataFrame, vector: str, wanted: int = 8) -> Whitening:
    """Up to ``wanted`` components of all rows. Components without variance are left out."""
    found = moments(frame, vector)
    values, vectors = components(found.covariance, wanted)
    kept = values > max([0.0, *values]) * len(found.sums) * PRECISION
    variance = float(np.trace(found.covariance))
    return Whitening(found.n, found.sums, values[kept], vectors[:, kept], variance)


def whiten(frame: DataFrame, vector: str, model: Whitening) -> DataFrame:
    """Add whitened array<double>: the centred vector on each component, over the root of its variance."""
    return map_columns(frame, [vector], partial(_whitened, model), "whitened array<double>")


def _whitened(model: Whitening, vectors: pa.Array) -> dict[str, pa.Array]:
    if not len(vectors):
        return {"whitened": pa.array([], pa.list_(pa.float64()))}
    scaled = _centred(_rows(vectors), model.n, model.sums) @ (model.vectors / np.sqrt(model.values))
    offsets = pa.array(np.arange(len(vectors) + 1) * len(model.values), pa.int32())
    return {"whitened": pa.ListArray.from_arrays(offsets, pa.array(scaled.ravel(), pa.float64()))}


def whitened_components(frame: DataFrame, vector: str, wanted: int = 8) -> DataFrame:
    """A row per row of ``frame`` and component: the frame's columns, component (int, from 1), n, deviation,
    whitened, explained and identity_error.

    The vector has whole entries (array<long>), the same number in each row; moments() refuses others.
    deviation is the exact sum over dimensions of (n x - sum)^2; a sum beyond a long is an error. explained is
    the component's part of all variance. identity_error is the largest absolute entry of the covariance
    of what was written, less the identity. Rows with a null vector, an empty one, or one that holds null or
    non-finite entries are dropped; all others are fitted and returned, repeated ones and those with
    null in other columns too. Components without variance have no rows, so equal vectors and a single
    one give none. An empty table gives an empty result. Columns with the names of results are replaced.
    """
    names = {"component", "n", "deviation", "whitened", "explained", "identity_error"}
    if vector.lower() in names:
        raise ValueError(f"the vector column cannot be called {vector}")
    sound = finite(frame.drop(*[c for c in frame.columns if c.lower() in names]), vector)
    model = fit(sound, vector, wanted)
    sums = ", ".join(f"{s}L" for s in model.sums)
    gaps = f"zip_with(`{vector}`, array({sums}), (x, s) -> {model.n}L * x - s)"
    deviation = F.expr(f"aggregate({gaps}, 0L, (total, gap) -> total + gap * gap)") if model.sums else F.lit(0)
    written = stored(
        whiten(sound.withColumn("deviation", deviation.cast("long")), vector, model), "whitened"
    )
    left = moments(written, "whitened").covariance if len(model.values) else np.zeros((0, 0))
    error = float(np.abs(left - np.eye(len(left))).max()) if len(left) else 0.0
    parts = F.array(*[F.lit(float(v / model.variance)) for v in model.values]).cast("array<double>")
    kept = [F.col(f"`{c}`") for c in sound.columns]
    by_component = written.select(*kept, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return by_component.select(
        *kept, (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(parts, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
