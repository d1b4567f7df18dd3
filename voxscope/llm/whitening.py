"""Operator 11: whitening of embeddings by their leading principal components.

Entries become integers, ``x = floor(64 * c) + 1000000``, and stay integers until the last division: a vector is shifted by a
whole number next to the mean before anything is multiplied, tasks add up whole numbers, and the remainder of the mean is
taken off exactly.  So an offset that dwarfs the spread costs no digits, and the order of tasks does not matter.

1. *Sums*: a row per task and dimension gives the mean.
2. *Covariance*: each task adds up the products of its shifted vectors; the driver gets one dimensions-by-dimensions table.
3. *Eigenvectors* of that table, on the driver: Householder reflections to tridiagonal form, bisection on Sturm counts for
   the leading eigenvalues, inverse iteration for the components, orthogonal again within clusters of close eigenvalues.
4. *Projection* with the broadcast components, and a pass that measures the covariance of what came out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import fresh

SCALE, OFFSET, COMPONENTS, MAX_DIMS = 64.0, 1_000_000, 32, 4096
_LARGEST = float(1 << 50)  # entries beyond it count as it
_EXACT = 1 << 53
_EPS = float(np.finfo(float).eps)
_BLOCK = 4096


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal ``q`` with ``matrix = q @ t @ q.T``, by Householder reflections."""
    a, n = matrix.copy(), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        mirror = a[k + 1:, k].copy()
        mirror[0] += np.copysign(np.linalg.norm(mirror), mirror[0])
        size = np.linalg.norm(mirror)
        if size == 0:
            continue
        mirror /= size
        a[k + 1:] -= 2 * np.outer(mirror, mirror @ a[k + 1:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ mirror, mirror)
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ mirror, mirror)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_counts(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: the negative pivots of the shifted matrix."""
    least = np.finfo(float).tiny / _EPS
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], beside):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - at - e * e / pivot
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, by bisection down to neighbouring numbers."""
    around = np.abs(np.concatenate([[0.0], beside])) + np.abs(np.concatenate([beside, [0.0]]))
    slack = 4 * _EPS * (np.abs(diagonal) + around).max() + np.finfo(float).tiny
    low = np.full(k, (diagonal - around).min() - slack)
    high = np.full(k, (diagonal + around).max() + slack)
    wanted = len(diagonal) - np.arange(k)  # so many lie below anything above the eigenvalue
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any() or ((high - low) < slack * _EPS).all():
            return middle
        above = sturm_counts(diagonal, beside, middle) >= wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def _solve_shifted(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """``(t - shift) x = right`` by elimination with row exchanges; vanishing pivots become ``least``."""
    n = len(diagonal)
    d, e, x = (diagonal - shift).tolist(), beside.tolist(), right.tolist()
    upper = []  # the finished rows: pivot and the two entries after it
    here = [d[0], e[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        after = [e[i], d[i + 1], e[i + 1] if i + 2 < n else 0.0]
        if abs(after[0]) > abs(here[0]):
            here, after = after, here
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(here[0]) < least:
            here[0] = least
        factor = after[0] / here[0]
        upper.append(here)
        x[i + 1] -= factor * x[i]
        here = [after[1] - factor * here[1], after[2] - factor * here[2], 0.0]
    if abs(here[0]) < least:
        here[0] = least
    upper.append(here)
    for i in reversed(range(n)):
        p, a, b = upper[i]
        x[i] = (x[i] - (a * x[i + 1] if i + 1 < n else 0.0) - (b * x[i + 2] if i + 2 < n else 0.0)) / p
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one per column, for falling ``values``."""
    norm = max(np.abs(diagonal).max(initial=0.0), np.abs(beside).max(initial=0.0), np.finfo(float).tiny)
    rng = np.random.default_rng(11)
    found = np.zeros((len(diagonal), len(values)))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        close = found[:, first:k]
        x = rng.standard_normal(len(diagonal))
        for _ in range(5):
            x = _solve_shifted(diagonal, beside, value, x / np.linalg.norm(x), _EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= close @ (close.T @ x)
        found[:, k] = x / np.linalg.norm(x)
    return found


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above rounding, falling, and their unit eigenvectors (one per column).

    The largest entry of each is positive.
    """
    size = np.abs(covariance).max(initial=0.0)
    if size == 0 or k < 1:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, beside, q = tridiagonal(covariance / size)
    values = leading_eigenvalues(diagonal, beside, min(k, len(covariance)))
    values = values[values > len(covariance) * _EPS * values.max()]
    vectors = q @ inverse_iteration(diagonal, beside, values)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values * size, vectors * sign


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)


def _scaled(entries: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * np.clip(entries, -_LARGEST, _LARGEST)), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _exact_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` in whole numbers, however large."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    peak = max(int(np.abs(y).max(initial=0)), 1) ** 2
    if peak >= _EXACT:
        return y.T.astype(object) @ y.astype(object)
    step = min(_BLOCK, _EXACT // peak)
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(float)
        total += np.rint(part.T @ part).astype(np.int64)  # exact: no sum reaches 2^53
    return total


@dataclass
class Fit:
    """What the projection needs: the vectors' number, a whole shift next to the mean, what is left of the sums, components."""

    n: int
    shift: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exactly."""
        y = x - self.shift
        if self.n * (int(np.abs(y).max(initial=0)) + 1) >= 1 << 62:
            y = y.astype(object)
        return y * self.n - self.rest

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(float) @ (self.vectors / np.sqrt(self.values))

    def squares(self, deviations: np.ndarray) -> list[Decimal]:
        peak = int(np.abs(deviations).max(initial=0))
        if peak * peak * max(deviations.shape[1], 1) >= 1 << 63:
            deviations = deviations.astype(object)
        return [Decimal(int(s)) for s in (deviations * deviations).sum(axis=1)]


def _triangle(total: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The upper triangle, a batch per row."""
    names = ["i", "j", "total"]
    for i, row in enumerate(total):
        yield pa.RecordBatch.from_arrays([pa.array([i] * (len(row) - i), pa.int32()), pa.array(range(i, len(row)), pa.int32()), pa.array(
            [Decimal(int(v)) if kind.scale == 0 else Decimal(f"{v:.15f}") for v in row[i:]], kind)], names=names)


def _sums(vectors: DataFrame) -> DataFrame:
    """(dims, i, n, total) per task: the sums of the vectors of each length; a row ``i = -1`` only counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths).tolist():
                x = _scaled(_matrix(column.filter(pa.array(lengths == dims)), dims))
                have = seen.setdefault(dims, [0, np.zeros(dims, dtype=object)])
                have[0] += len(x)
                have[1] = have[1] + x.sum(axis=0, dtype=object)
        for dims, (n, sums) in seen.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([dims] * (dims + 1), pa.int32()), pa.array(range(-1, dims), pa.int32()), pa.array([n] * (dims + 1), pa.int64()),
                pa.array([Decimal(0), *[Decimal(int(s)) for s in sums]], pa.decimal128(38, 0))], names=["dims", "i", "n", "total"])

    return vectors.mapInArrow(run, "dims int, i int, n long, total decimal(38,0)")


def _whole_vectors(rows: DataFrame, vector: str) -> Column:
    """No null, and only finite entries."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))


def _measured(spark, found: DataFrame, k: int, n: int) -> float:
    """The largest absolute entry of the covariance of the whitened vectors, minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = _matrix(batch.column(0), k)
            for at in range(0, len(w), _BLOCK):
                part = np.column_stack([w[at:at + _BLOCK], np.ones(len(w[at:at + _BLOCK]))])
                total += part.T @ part
        yield from _triangle(total, pa.decimal128(38, 15))

    sums = np.zeros((k + 1, k + 1))
    for r in found.mapInArrow(run, "i int, j int, total decimal(38,15)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r.i, r.j] = sums[r.j, r.i] = float(r.total) / n
    return float(np.abs(sums[:k, :k] - np.outer(sums[k, :k], sums[k, :k]) - np.eye(k)).max(initial=0.0))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[int, Fit] | None:
    """The length that most rows of the array column have (of equals the largest) and the fit to these rows; None without any."""
    sums = stage(_sums(vectors), "whitening-sums")
    best = sums.where("i = -1").groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if best is None or best.dims == 0:
        return None
    dims, n = best.dims, int(best.n)
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; the driver solves for {MAX_DIMS} at most")
    total = np.zeros(dims, dtype=object)
    for r in sums.where((F.col("dims") == dims) & (F.col("i") >= 0)).groupBy("i").agg(F.sum("total").alias("total")).collect():
        total[r.i] = int(r.total)
    shift = np.array([(2 * int(s) + n) // (2 * n) for s in total], dtype=np.int64)
    rest = np.array([int(s) - n * int(c) for s, c in zip(total, shift)], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dims, dims), dtype=object)
        for batch in batches:
            products = products + _exact_products(_scaled(_matrix(batch.column(0), dims)) - shift)
        yield from _triangle(products, pa.decimal128(38, 0))

    name = vectors.columns[0]
    covariance = np.zeros((dims, dims))
    tasks = vectors.where(F.size(name) == dims).mapInArrow(run, "i int, j int, total decimal(38,0)")
    for r in tasks.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        covariance[r.i, r.j] = covariance[r.j, r.i] = (n * int(r.total) - int(rest[r.i]) * int(rest[r.j])) / (n * n)
    values, basis = leading_components(covariance, components)
    return dims, Fit(n, shift, rest, values, basis, float(np.trace(covariance)))


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(row, n, deviation, whitened, explained, identity_error): a row per vector of the fit list.

    ``row`` holds the input's columns; ``whitened`` and ``explained`` are arrays with an entry per component, at most
    ``components``; ``deviation`` is the exact sum over dimensions of ``(n * x - S) ** 2``; ``identity_error`` is measured
    over the returned values.

    Rows whose vector is null or holds a null or a non-finite entry are left out, and so are rows of another length than most
    rows have (of equally frequent lengths the largest counts).  Entries beyond 2^50 count as 2^50.  Directions without
    spread (eigenvalue zero but for rounding) cannot be whitened and are no components: one single vector, or vectors all
    equal, give rows with empty arrays.  Repeated rows are members of the fit list each.  No vectors give an empty table.
    """
    spark = table.sparkSession
    v = fresh("v", table.columns)
    rows = table.select(F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("row"), F.col(f"`{vector}`").cast("array<double>").alias(v))
    rows = rows.where(_whole_vectors(rows, v))
    fitted = fit(rows.select(v), components)
    if fitted is None:
        return rows.where("false").select("row", F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast(
            "array<double>").alias("whitened"), F.array().cast("array<double>").alias("explained"), F.lit(0.0).alias("identity_error"))
    dims, model = fitted
    shared = spark.sparkContext.broadcast(model)

    def project(column: pa.Array) -> pa.Array:
        off = shared.value.deviations(_scaled(_matrix(column, dims)))
        w = shared.value.whiten(off)
        ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
        return pa.StructArray.from_arrays([pa.array(shared.value.squares(off), pa.decimal128(38, 0)), pa.ListArray.from_arrays(
            pa.array(ends), pa.array(w.ravel()))], names=["deviation", "whitened"])

    rows = rows.where(F.size(v) == dims)
    found = rows.select("row", F.arrow_udf(project, "deviation decimal(38,0), whitened array<double>")(v).alias("p"))
    error = _measured(spark, found.select("p.whitened"), len(model.values), model.n)
    shares = F.array(*[F.lit(float(e) / model.trace) for e in model.values]).cast("array<double>")
    return found.select("row", F.lit(model.n).cast("long").alias("n"), "p.deviation", "p.whitened", shares.alias("explained"),
                        F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame, key: str) -> DataFrame:
    """A row per vector and component: ``key`` of the row, component (from 1), n, deviation (null beyond a long), whitened,
    explained, identity_error."""
    return whitened.select(F.col(f"row.`{key}`").alias(key), "n", F.col("deviation").try_cast("long").alias("deviation"),
                           F.posexplode("whitened").alias("at", "whitened"), "explained", "identity_error").select(
        key, (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"),
        "identity_error")
