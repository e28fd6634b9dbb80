"""Whitening of embeddings: leading components of their covariance, found without a library's eigensolver.

Sums and centred cross products are taken where the vectors lie and added up as rows. The covariance matrix, whose size is
that of one vector squared, is reduced to tridiagonal form by Householder reflections; Sturm counts bisect for the leading
eigenvalues, inverse iteration gives their vectors, and those of eigenvalues that lie close together are made orthogonal to each
other. The components, which fit a few kilobytes, travel to the vectors for the projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import in_batches, staged

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
# Entries of this size or more would lose digits as whole numbers; they count as not finite.
LARGEST = float(1 << 40)
# Vectors multiplied at once.
BLOCK = 4_096
# Eigenvalues below this share of the largest are those of directions without spread, which cannot be scaled to one.
LEAST_SHARE = 1e-12
_EPS = float(np.finfo(np.float64).eps)


@dataclass
class Fit:
    """Exact counts and sums of the fit list, and the leading components of its covariance."""

    n: int
    sums: list[int]
    widest: int  # largest |n * x - sum| of an entry of the fit list
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one per column
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def split_mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The whole part of the mean, and what is left of the sums beside it."""
        return np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows of x less the mean; the whole part of the mean is taken off as whole numbers."""
        whole, rest = self.split_mean()
        return (x - whole) - rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of (n * x - sum)^2 by row, NULL beyond a long."""
        whole, rest = self.split_mean()
        if self.dimension * self.widest**2 < 1 << 63 and self.n < 1 << 62:
            return pa.array(((self.n * (x - whole) - rest) ** 2).sum(axis=1), pa.int64())
        wide = ((self.n * (x - whole).astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([d if d < 1 << 63 else None for d in wide], pa.int64())

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def whole_vectors(rows: DataFrame, vector_col: str = "embedding", name: str = "x") -> DataFrame:
    """Rows whose vector is complete, with `name` = floor(64 * entry) + 1000000 as long for each entry.

    A vector that is NULL or empty, or holds a NULL, NaN, infinite or huge (2**40 and more) entry, is left out with its row.
    """
    entries = F.col(vector_col).cast("array<double>")
    complete = F.forall(entries, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))) & (F.size(entries) > 0)
    return rows.filter(F.coalesce(complete, F.lit(False))).withColumn(name, F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


_ENTRY = "i int, j int, v double"


def _entries(matrix: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a symmetric matrix as rows."""
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix[i, j])], ["i", "j", "v"])


def _collected(entries: DataFrame, size: int) -> np.ndarray:
    """A matrix of `size` squared entries on the driver, whatever number of vectors it sums up."""
    table = entries.toArrow()
    i, j, v = (table[name].to_numpy() for name in ("i", "j", "v"))
    out = np.zeros((size, size))
    out[i, j] = v
    out[j, i] = v
    return out


def _cross_products(distinct: DataFrame, width: int, values) -> np.ndarray:
    """Sum over all vectors of the outer product of `values(x)`, added up per task first."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, total = values(), np.zeros((width, width))
        some = False
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                y = function(batch.column(0).slice(first, BLOCK))
                total += y.T @ y
                some = True
        if some:
            yield _entries(total)

    return _collected(_added(in_batches(distinct.select("x"), products, _ENTRY)), width)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components of the distinct vectors `x` (array of long, all of one length); None without any vector.

    Divisor is their number. Components of eigenvalue 0 (to rounding) are left out.
    """

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, None, None, None
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.column(0).slice(first, BLOCK)
                x = _matrix(part, len(part[0]))
                total = x.sum(axis=0).astype(object)  # whole numbers of any size from here on
                n, sums = n + len(x), total if sums is None else sums + total
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            columns = [pa.array(np.arange(len(sums)), pa.int32()), pa.array(np.full(len(sums), n)), pa.array([str(s) for s in sums]), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n", "s", "low", "high"])

    parts = in_batches(distinct.select("x"), sums_of, "i int, n bigint, s string, low bigint, high bigint")
    by_dimension = parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    seen = by_dimension.orderBy("i").collect()  # a row per dimension
    if not seen:
        return None
    n, sums = seen[0].n, [int(r.s) for r in seen]
    widest = max(max(abs(n * r.low - int(r.s)), abs(n * r.high - int(r.s))) for r in seen)
    out = Fit(n, sums, widest, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    shared = distinct.sparkSession.sparkContext.broadcast(out)

    def centred():
        plain = shared.value
        return lambda column: plain.centred(_matrix(column, plain.dimension))

    covariance = _cross_products(distinct, out.dimension, centred) / n
    out.trace = float(np.trace(covariance))
    out.values, out.vectors = leading(covariance, components)
    return out


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened distinct vectors less the identity."""
    size = len(model.values)
    if not size:
        return 0.0
    shared = distinct.sparkSession.sparkContext.broadcast(model)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, np.zeros(size)
        for batch in batches:
            total += model.whitened(_matrix(batch.column(0), model.dimension)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "j", "v"])

    sums = _added(in_batches(distinct.select("x"), totals, _ENTRY)).collect()
    mean = np.zeros(size)
    mean[[r.j for r in sums]] = [r.v / model.n for r in sums]

    def centred():
        model = shared.value
        return lambda column: model.whitened(_matrix(column, model.dimension)) - mean

    covariance = _cross_products(distinct, size, centred) / model.n
    return float(np.abs(covariance - np.eye(size)).max())


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, Q) with Q.T @ matrix @ Q tridiagonal, by Householder reflections."""
    a = np.array(matrix, np.float64)
    q = np.eye(len(a))
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        if not v[1:].any():
            continue
        to = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= to
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = to
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def above(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie above each point."""
    squares = off * off
    least = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-200) * _EPS * _EPS
    pivot = diagonal[0] - points
    count = (pivot > 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = diagonal[k] - points - squares[k - 1] / pivot
        count += pivot > 0
    return count


def bisected(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The `count` largest eigenvalues, falling: all intervals are halved together down to the rounding of the matrix."""
    reach = np.zeros(len(diagonal))
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = np.full(count, (diagonal - reach).min()), np.full(count, (diagonal + reach).max())
    size = max(abs(low[0]), abs(high[0]), 1e-300)
    low, high = low - 4 * _EPS * size, high + 4 * _EPS * size
    rank = np.arange(1, count + 1)
    while (high - low).max() > _EPS / 4 * size:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            break
        beyond = above(diagonal, off, middle) >= rank
        low, high = np.where(beyond, middle, low), np.where(beyond, high, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (tridiagonal - shift) x = right by elimination with row exchanges; pivots of zero become `least`."""
    size = len(diagonal)
    main, over, over2 = diagonal - shift, np.append(off, 0.0), np.zeros(size)
    right = right.copy()
    for k in range(size - 1):
        under = off[k]
        if abs(main[k]) >= abs(under):
            pivot = main[k] if main[k] != 0 else least
            main[k] = pivot
            factor = under / pivot
            main[k + 1] -= factor * over[k]
            right[k + 1] -= factor * right[k]
        else:
            factor = main[k] / under
            main[k], over[k], main[k + 1] = under, main[k + 1], over[k] - factor * main[k + 1]
            if k + 2 < size:
                over2[k], over[k + 1] = over[k + 1], -factor * over[k + 1]
            right[k], right[k + 1] = right[k + 1], right[k] - factor * right[k + 1]
    out = np.zeros(size)
    for k in range(size - 1, -1, -1):
        rest = right[k]
        if k + 1 < size:
            rest -= over[k] * out[k + 1]
        if k + 2 < size:
            rest -= over2[k] * out[k + 2]
        out[k] = rest / (main[k] if abs(main[k]) > least else np.copysign(least, main[k]))
        if abs(out[k]) > 1e200:  # only the direction counts
            out *= 1e-200
            right *= 1e-200
    return out


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix as columns, in the order of its falling eigenvalues.

    Each value is solved for in turn from a start that is none of the earlier ones; vectors of a cluster, eigenvalues
    closer than a thousandth of the largest, are kept orthogonal to each other in every step.
    """
    size = len(diagonal)
    scale = max(float(np.abs(values).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-300)
    least = _EPS * scale
    source = np.random.default_rng(0)
    out = np.zeros((size, len(values)))
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * scale:
            cluster = k
        earlier = out[:, cluster:k]
        v = source.standard_normal(size)
        for _ in range(6):
            for _ in range(2):
                v = v - earlier @ (earlier.T @ v)
            v /= np.linalg.norm(v)
            v = _solve(diagonal, off, float(value), v, least)
            v /= np.abs(v).max()
        for _ in range(2):
            v = v - earlier @ (earlier.T @ v)
        out[:, k] = v / np.linalg.norm(v)
    return out


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the largest eigenvalues of a covariance matrix, falling."""
    count = min(count, len(matrix))
    diagonal, off, q = tridiagonal(matrix)
    values = bisected(diagonal, off, count)
    # A value right at the bound stays: the largest value's rounding can put it on either side, by machine.
    least = (LEAST_SHARE - len(matrix) * _EPS) * max(float(values[0]), 0.0)
    values = values[: int((values > least).sum())] if values[0] > 0 else values[:0]
    if not len(values):
        return values, np.zeros((len(matrix), 0))
    return values, q @ inverse_iteration(diagonal, off, values)


def _length_kept(vectors: DataFrame) -> int | None:
    """The commonest length of the vectors, the larger of those that tie."""
    first = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return None if first is None else first.d


_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row of a complete vector and component: (`id_col`, `component` from 1, `n`, `deviation`, `whitened`, `explained`,
    `identity_error`).

    The fit list is each distinct whole-number vector once, so copies do not weigh. `deviation` is the exact sum of squares of
    n * x - sum, NULL where it exceeds a long. Vectors of another length than the commonest one are left out. Components without
    spread do not exist, so a list of one vector gives no rows; neither does an empty table.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    vectors = whole_vectors(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector").select("id", "x")
    dimension = _length_kept(vectors)
    schema = f"id {kind}, {_OUT}"
    if dimension is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    vectors = vectors.filter(F.size("x") == dimension)
    distinct = staged(vectors.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, components)
    error = identity_error(distinct, model)
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        count = len(model.values)
        if not count:
            return
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = _matrix(part.column("x"), model.dimension)
                size = len(x)
                each = pa.array(np.repeat(np.arange(size), count))
                columns = [
                    part.column("id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, model.n, np.int64)),
                    model.deviations(x).take(each),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, size)),
                    pa.array(np.full(size * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return in_batches(vectors, project, schema).withColumnRenamed("id", id_col)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings. Repeated rows and ids get rows each, a NULL id is kept; other columns are not read."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
