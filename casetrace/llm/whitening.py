"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries are quantised to integers, so equal vectors are equal exactly and sums
are exact.  Then, over the list of distinct vectors:

1. sums per dimension;
2. the scatter of the centred vectors, summed per partition and added up as a
   tree: what leaves a task is one matrix;
3. pivoted Cholesky of the covariance, V = A A', which stops at V's rank;
4. one-sided Jacobi directly on the factor: its columns are rotated until they
   are orthogonal.  Then their squared norms are V's eigenvalues and the
   normalised columns its eigenvectors, small ones to high relative accuracy;
5. the first ``components`` of them whiten every vector, and the covariance of
   the whitened list is measured against the identity in a further pass.

Only matrices of the vectors' dimension reach the driver.

Result for odd input: a vector that is null, empty, or holds null, non-finite
or unquantisable entries (beyond ``LARGEST``) is dropped, as is one whose
length is not the most common (the longer of two); a null ``vec_id`` is kept;
repeated rows are each whitened and count once in the fit; components beyond
the rank do not exist, so fewer than two different vectors give no rows;
``deviation`` is null where it exceeds a long; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import require, struct
from casetrace.llm.sums import sum_arrays
from casetrace.session import scratch_path

STEPS, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40
_LONG = (1 << 63) - 1

WHITENED = struct(("vec_id", T.LongType()), ("component", T.IntegerType()), ("n", T.LongType()),
                  ("deviation", T.LongType()), ("whitened", T.DoubleType()),
                  ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))


# --- the eigenvectors --------------------------------------------------------

def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A with A A' = V, one column per rank, for a positive semi-definite V."""
    v, d = v.astype(float), len(v)
    left = np.diag(v).copy()
    factor = np.zeros((d, 0))
    least = d * np.finfo(float).eps * (left.max() if d else 0.0)
    for _ in range(d):
        p = int(np.argmax(left))
        if left[p] <= least:
            break
        column = (v[:, p] - factor @ factor[p]) / np.sqrt(left[p])
        factor = np.column_stack([factor, column])
        left -= column ** 2
        left[p] = 0.0
    return factor


def one_sided_jacobi(a: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``a`` with its columns rotated until they are orthogonal.  A round takes
    disjoint pairs, dealt as in a round-robin tournament."""
    a = a.copy()
    m = a.shape[1]
    table = list(range(m)) + [-1] * (m % 2)
    for _ in range(sweeps):
        rotated = False
        for _ in range(max(len(table) - 1, 0)):
            half = len(table) // 2
            pairs = [(i, j) for i, j in zip(table[:half], table[:half - 1:-1]) if i >= 0 and j >= 0]
            table = [table[0], table[-1], *table[1:-1]]
            i, j = np.array(pairs, int).T if pairs else np.zeros((2, 0), int)
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > np.finfo(float).eps * np.sqrt(xx * yy)
            if not turn.any():
                continue
            rotated = True
            i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
            with np.errstate(over="ignore"):
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, i], a[:, j] = c * x - s * y, s * x + c * y
        if not rotated:
            break
    return a


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of V above its rank's limit, falling, and unit vectors."""
    columns = one_sided_jacobi(pivoted_cholesky(v))
    values = (columns ** 2).sum(0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 0]
    return values[order], columns[:, order] / np.sqrt(values[order])


# --- the fit -----------------------------------------------------------------

def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and the integer vector ``x`` of usable rows."""
    def usable(c: Column) -> Column:
        return F.coalesce(F.abs(c) <= LARGEST, F.lit(False))  # NaN is greater than all

    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col(column).cast("array<double>").alias("x"))
    good = held.where(F.coalesce(F.forall("x", usable) & (F.size("x") > 0), F.lit(False)))
    return good.select("vec_id", F.transform(
        "x", lambda c: F.floor(c * STEPS).cast("long") + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    return np.asarray(batch.column(column).flatten()).reshape(-1, d)


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray       # per dimension, exact
    values: np.ndarray     # eigenvalues, falling
    vectors: np.ndarray    # dimension x components
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = self.sums // self.n  # small numbers first, then the fraction
        return (x - whole) - (self.sums - whole * self.n) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 per row: in 64 bits where that is safe, else in
        whole numbers of any size."""
        reach = np.abs(self.centred(x)).max(initial=0.0) * self.n + 1
        if reach ** 2 * max(x.shape[1], 1) < 2.0 ** 62 and self.n * np.abs(x).max(initial=0) < 2 ** 62:
            return ((self.n * x - self.sums) ** 2).sum(1).tolist()
        big = [sum((self.n * int(v) - int(s)) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return [b if b <= _LONG else None for b in big]


def fit(x: DataFrame, components: int = 16) -> Whitening | None:
    """Whitening of the rows of ``x`` (one array of longs of equal length
    each, distinct and stored); None for an empty table."""
    first = x.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    rows = x.select("x")

    def sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(d + 1, np.int64)
        for batch in batches:
            total[:d] += _matrix(batch, 0, d).sum(0)
            total[d] += batch.num_rows
        return total

    total = sum_arrays(rows, sums, (d + 1,), "<i8")
    none = np.zeros(0)
    start = Whitening(int(total[d]), total[:d], none, none, 0.0, 0.0)

    def scatter(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        held = np.zeros((d, d))
        for batch in batches:
            c = start.centred(_matrix(batch, 0, d))
            held += c.T @ c
        return held

    v = sum_arrays(rows, scatter, (d, d)) / start.n
    values, vectors = eigenvectors(v)
    values, vectors = values[:components], vectors[:, :components]
    model = Whitening(start.n, start.sums, values, vectors, float(np.trace(v)), 0.0)
    k = len(values)

    def check(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        held = np.zeros((k + 1, k))  # products, and the sums in the last row
        for batch in batches:
            w = model.whiten(_matrix(batch, 0, d))
            held[:k] += w.T @ w
            held[k] += w.sum(0)
        return held

    held = sum_arrays(rows, check, (k + 1, k))
    mean = held[k] / model.n
    off = held[:k] / model.n - np.outer(mean, mean) - np.eye(k)
    return Whitening(model.n, model.sums, values, vectors, model.trace, float(np.abs(off).max(initial=0.0)))


def whiten(vectors: DataFrame, components: int = 16, column: str = "embedding") -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``."""
    require(vectors, ["vec_id", column])
    usable = quantised(vectors, column)
    common = (usable.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("d")).first())
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], WHITENED)
    rows = usable.where(F.size("x") == common["d"])
    path = scratch_path(spark, "distinct-vectors")
    rows.select("x").distinct().write.parquet(path)  # integers of few values: it packs small
    model = fit(spark.read.parquet(path), components)
    k, d = len(model.values), common["d"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch, 1, d), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n, np.int64)),
                 pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(model.whiten(x).ravel()),
                 pa.array(np.tile(model.values / model.trace, m) if k else np.zeros(0)),
                 pa.array(np.full(m * k, model.identity_error))], names=WHITENED.names)

    return rows.mapInArrow(project, WHITENED)
