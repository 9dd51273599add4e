"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Components become whole numbers x. One pass adds up x per dimension, a second the products
of x less the whole part of the mean; both are sums of whole numbers, so the scatter matrix
is exact whatever the partitions. The driver sees that one matrix (dimension x dimension,
never rows): it is factored by Cholesky with diagonal pivots, which also tells the rank, and
the columns of the triangular factor are rotated in pairs (one-sided Jacobi) until all are
orthogonal. Their squared norms are the eigenvalues and the normalised columns the
components, to high relative accuracy, without ever forming a product of the factor. Two
more passes project the rows and measure how far their covariance is from the identity.

Defined cases: a vector that is null or holds null, NaN or infinite entries takes no part.
Vectors of another length than the most frequent one (ties: the longest) cannot be projected
and take no part either. Scaled entries are kept within 2^40. Directions without variance
cannot be scaled to 1: there are as many components as the rank, none for a single vector,
for equal vectors or for an empty table, and the result is then empty. Repeated rows and
null ids are rows as any other. ``deviation`` is null where it does not fit 64 bits. Of a
component's two signs the one is taken whose largest entry is positive. Other columns of the
table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, IntegerType, LongType, DoubleType

from claimward.llm.common import table
from claimward.llm.vectors import by_length, exact_dot, usable, whole

SHIFT = 1_000_000
COMPONENTS = 32
SWEEPS = 60
#: Rows projected at once inside a task.
ROWS = 2048

EXACT = pa.decimal128(38, 0)
#: Decimal places to which tasks hand over sums of products of whitened values.
PLACES = 12


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor (dimension x rank) and row order with matrix[order][:, order] = L L^T.

    A dimension counts as explained by those before it when what is left of its variance is
    rounding, measured against its own variance, so the rank does not depend on units.
    """
    left = matrix.astype(np.float64).copy()
    size = len(left)
    order = np.arange(size)
    lower = np.zeros((size, size))
    rounding = size * np.finfo(np.float64).eps * matrix.diagonal()
    for k in range(size):
        open_ = np.where(left.diagonal()[k:] > rounding[order[k:]], left.diagonal()[k:], 0.0)
        pivot = k + int(np.argmax(open_))
        if not open_.any():
            return lower[:, :k], order
        swap, into = [k, pivot], [pivot, k]
        order[swap] = order[into]
        lower[swap] = lower[into]
        left[swap] = left[into]
        left[:, swap] = left[:, into]
        lower[k, k] = np.sqrt(left[k, k])
        lower[k + 1 :, k] = left[k + 1 :, k] / lower[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
    return lower, order


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns, in rounds of disjoint pairs (a round-robin tournament)."""
    even = size + size % 2
    ring = np.arange(even)
    for _ in range(even - 1):
        one, two = ring[: even // 2], ring[: even // 2 - 1 : -1]
        real = (one < size) & (two < size)
        yield np.minimum(one, two)[real], np.maximum(one, two)[real]
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """Columns of ``factor`` rotated until each pair is orthogonal to working precision."""
    columns = factor.astype(np.float64).copy()
    close = np.finfo(np.float64).eps * np.sqrt(max(1, len(columns)))
    for _ in range(SWEEPS):
        rotated = False
        for one, two in _rounds(columns.shape[1]):
            a, b = columns[:, one], columns[:, two]
            norm_a, norm_b, both = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            open_ = np.abs(both) > close * np.sqrt(norm_a * norm_b)
            if not open_.any():
                continue
            rotated = True
            one, two, a, b = one[open_], two[open_], a[:, open_], b[:, open_]
            zeta = (norm_b[open_] - norm_a[open_]) / (2 * both[open_])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            columns[:, one] = cosine * (a - tangent * b)
            columns[:, two] = cosine * (b + tangent * a)
        if not rotated:
            break
    return columns


def principal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a covariance matrix."""
    lower, order = pivoted_cholesky(matrix)
    columns = one_sided_jacobi(lower)
    norms = np.sqrt((columns * columns).sum(0))
    rank = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(columns)
    vectors[order] = columns[:, rank] / norms[rank]
    largest = np.abs(vectors).argmax(0)
    signs = np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return norms[rank] ** 2, vectors * signs


def _tasks(df: DataFrame, change, schema: str) -> DataFrame:
    """One result per task: ``change`` takes the matrices of all batches of the column x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = change(m for batch in batches for _, m in by_length(batch.column(0)))
        if found is not None:
            yield found

    return df.select("x").mapInArrow(run, schema)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], EXACT)


def dimension_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the most frequent length and their sums per dimension."""

    def add(matrices):
        count, total = {}, {}
        for m in matrices:
            size = m.shape[1]
            count[size] = count.get(size, 0) + len(m)
            total[size] = total.get(size, np.zeros(size, object)) + m.sum(0).astype(object)
        sizes = [s for s in total for _ in range(s)]
        return pa.RecordBatch.from_pydict(
            {
                "size": pa.array(sizes, pa.int32()),
                "place": pa.array([i for s in total for i in range(s)], pa.int32()),
                "n": pa.array([count[s] for s in sizes], pa.int64()),
                "total": _decimals(v for s in total for v in total[s]),
            }
        )

    sums = (
        _tasks(rows, add, "size int, place int, n bigint, total decimal(38,0)")
        .groupBy("size", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
        .groupBy("size")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "total"))).alias("sums"))
        .orderBy(F.desc("n"), F.desc("size"))
        .first()
    )
    return (0, []) if sums is None else (sums.n, [int(s.total) for s in sums.sums])


def scatter(rows: DataFrame, base: list[int]) -> np.ndarray:
    """Sum of (x - base)(x - base)^T over all vectors, in Python integers."""
    size = len(base)
    upper = np.triu_indices(size)

    def add(matrices):
        total = np.zeros((size, size), object)
        for m in matrices:
            if m.shape[1] == size:
                d = m - np.array(base, np.int64)
                total = total + exact_dot(d.T, d).astype(object)
        return pa.RecordBatch.from_pydict(
            {
                "i": pa.array(upper[0], pa.int32()),
                "j": pa.array(upper[1], pa.int32()),
                "total": _decimals(total[upper]),
            }
        )

    summed = (
        _tasks(rows, add, "i int, j int, total decimal(38,0)")
        .groupBy("i", "j")
        .agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    )
    found = np.zeros((size, size), object)
    for r in summed.collect():  # dimension x dimension numbers
        found[r.i, r.j] = found[r.j, r.i] = int(r.total)
    return found


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: x less ``base`` less ``rest / n``, times ``weights``."""

    n: int
    base: list[int]
    rest: list[int]
    eigenvalues: np.ndarray
    weights: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.base)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of whole-number vectors."""
        centre = np.array([r / self.n for r in self.rest])
        return ((x - np.array(self.base, np.int64)) - centre) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exactly; None beyond 64 bits."""
        d = x - np.array(self.base, np.int64)
        most = self.n * int(np.abs(d).max(initial=0)) + max(map(abs, self.rest), default=0)
        kind = np.int64 if most * most * max(1, self.size) < 1 << 63 else object
        far = d.astype(kind) * self.n - np.array(self.rest, kind)
        return [int(v) if v < 1 << 63 else None for v in (far * far).sum(1)]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from all rows of the column x; None where nothing varies."""
    n, sums = dimension_sums(rows)
    if not n:
        return None
    base = [s // n for s in sums]
    rest = [s - n * b for s, b in zip(sums, base)]
    products = scatter(rows, base)
    far = np.array(rest, object)
    exact = n * products - np.outer(far, far)
    covariance = np.array([[v / (n * n) for v in row] for row in exact.tolist()], np.float64)
    values, vectors = principal(covariance)
    values, vectors = values[:components], vectors[:, :components]
    if not len(values):
        return None
    trace = sum(exact.diagonal().tolist()) / (n * n)
    return Whitening(n, base, rest, values, vectors / np.sqrt(values), trace)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    width = len(fitted.eigenvalues)
    upper = np.triu_indices(width)

    def add(matrices):
        total = np.zeros((width, width))
        for m in matrices:
            if m.shape[1] == fitted.size:
                w = fitted.project(m)
                total += w.T @ w
        return pa.RecordBatch.from_pydict(
            {
                "i": pa.array(upper[0], pa.int32()),
                "j": pa.array(upper[1], pa.int32()),
                "total": pa.array([Decimal(f"{v:.{PLACES}f}") for v in total[upper]], pa.decimal128(38, PLACES)),
            }
        )

    # decimal sums do not depend on the order in which tasks end, so reruns agree
    summed = (
        _tasks(rows, add, f"i int, j int, total decimal(38,{PLACES})")
        .groupBy("i", "j")
        .agg(F.sum("total").alias("total"))
        .collect()  # at most components x components numbers
    )
    return max(abs(float(r.total) / fitted.n - (r.i == r.j)) for r in summed)


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component, with the whitened value."""
    kind = embeddings.schema[id_column]
    x = whole(F.col(vector), SHIFT)
    rows = embeddings.filter(usable(F.col(vector))).select(id_column, x.alias("x"))
    schema = StructType(
        [
            StructField(id_column, kind.dataType),
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    fitted = fit(rows, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, fitted)
    width = len(fitted.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                for at, m in by_length(part.column(1)):
                    if m.shape[1] == fitted.size:
                        yield expanded(part.column(0).take(pa.array(at)), m)

    def expanded(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        each = np.repeat(np.arange(len(x)), width)
        columns = [
            ids.take(pa.array(each)),
            pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
            pa.array(np.full(len(each), fitted.n, np.int64)),
            pa.array(fitted.deviations(x), pa.int64()).take(pa.array(each)),
            pa.array(fitted.project(x).ravel()),
            pa.array(np.tile(fitted.eigenvalues / fitted.trace, len(x))),
            pa.array(np.full(len(each), error)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select(id_column, "x").mapInArrow(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
