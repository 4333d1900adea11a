"""Whitening of embeddings from exact bit-sliced cross-products.

Every entry c becomes the integer ``floor(scale * c) + offset``.  The fit list
holds each distinct integer vector once.  Within a block of its rows the
entries of a dimension, less the least entry of that dimension, are cut into
bit planes: one bit a row, packed into 64-bit words.  The product sum of two
dimensions is the sum over their planes a and b of
``2**(a + b) * popcount(plane a AND plane b)``, so it is exact whatever the
number of rows.  Spark adds the blocks up; what reaches the driver is one
integer a pair of dimensions.  Sums are centred as integers there, and only
the centred products become doubles for the eigenvectors.

Defined results: a row whose vector is null, empty or holds a null or
non-finite entry takes no part, nor does one of another length than most
distinct vectors have (ties: the longest).  Entries beyond 2**62 saturate
there.  Repeated rows, and rows with a null id, each get their own result.
Directions without variance have no whitened value and are left out, so
equal vectors, a single row and an empty table give no rows.  ``deviation``
is null where the exact value is beyond a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, staged

#: Rows whose bits are packed and compared at a time.
BLOCK_ROWS = 4096
#: A sum of products is kept in parts of so many bits of weight.
LIMB_BITS = 24
#: Beyond this, |floor(scale * c)| saturates.
LARGEST = 2**62
#: Rounds after which the rotations of an ill-scaled matrix have long settled.
SWEEPS = 60

OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _finite(v: Column) -> Column:
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vec_id`` and ``x``, the integer vector, of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(_finite(F.col("v")))

    def entry(c: Column) -> Column:
        return F.least(F.greatest(F.floor(c * F.lit(float(scale))), F.lit(-LARGEST)), F.lit(LARGEST)) + F.lit(offset)

    return rows.select("vec_id", F.transform("v", entry).alias("x"))


def _matrix(b: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch, all of length ``dims``, as rows."""
    column = b["x"]
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dims)


def _ranges(fit: DataFrame, dims: int) -> tuple[list[int], list[int]]:
    """Least and greatest entry of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo = hi = None
        for b in batches:
            if b.num_rows:
                x = _matrix(b, dims)
                lo = x.min(0) if lo is None else np.minimum(lo, x.min(0))
                hi = x.max(0) if hi is None else np.maximum(hi, x.max(0))
        if lo is not None:
            yield batch(dim=np.arange(dims, dtype=np.int32), lo=lo, hi=hi)

    got = arrow_iter(fit.select("x"), run, "dim int, lo long, hi long").groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = sorted(got.collect())  # one row a dimension
    return [r["lo"] for r in rows], [r["hi"] for r in rows]


class BitPlanes:
    """Product sums of the dimensions of shifted vectors from their bit planes."""

    def __init__(self, lo: list[int], hi: list[int]):
        self.lo = np.array(lo, np.int64)
        widths = [int(h - l).bit_length() for l, h in zip(lo, hi, strict=True)]
        self.dims = len(lo)
        self.dim = np.repeat(np.arange(self.dims), widths)
        self.bit = np.concatenate([np.arange(w) for w in widths]).astype(np.uint64) if self.dim.size else np.zeros(0, np.uint64)
        self.limbs = max(1, (2 * max(widths) - 2) // LIMB_BITS + 1)
        self.products = np.zeros((self.limbs, self.dims, self.dims), np.int64)
        self.sums = np.zeros((self.limbs, self.dims), np.int64)
        self.rows = 0

    def add(self, x: np.ndarray) -> None:
        """Count a block of vectors in."""
        self.rows += len(x)
        if not self.dim.size:
            return
        shifted = (x - self.lo).astype(np.uint64)
        bits = ((shifted[:, self.dim] >> self.bit) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.T, axis=1)
        words = np.zeros((len(self.dim), -(-packed.shape[1] // 8) * 8), np.uint8)
        words[:, : packed.shape[1]] = packed
        words = words.view(np.uint64)
        place = self.bit.astype(np.int64)
        for p in range(len(self.dim)):
            i = self.dim[p]
            first = int(np.searchsorted(self.dim, i))  # every pair of planes of one dimension, each other dimension once
            counts = np.bitwise_count(words[p] & words[first:]).sum(axis=1, dtype=np.int64)
            weight = place[first:] + place[p]
            parts = counts << (weight % LIMB_BITS)
            starts = np.flatnonzero(np.diff(self.dim[first:], prepend=-1))
            for limb in range(self.limbs):
                mine = parts if self.limbs == 1 else np.where(weight // LIMB_BITS == limb, parts, 0)
                self.products[limb, i, self.dim[first:][starts]] += np.add.reduceat(mine, starts)
            own = int(counts[p - first])
            self.sums[place[p] // LIMB_BITS, i] += own << int(place[p] % LIMB_BITS)

    def rows_out(self) -> pa.RecordBatch:
        """(i, j, limb, value) of every pair i <= j; j = -1: the plain sum of
        dimension i; i = j = -1: the number of rows."""
        i, j = np.triu_indices(self.dims)
        parts = [(np.array([-1]), np.array([-1]), 0, np.array([self.rows]))]
        for limb in range(self.limbs):
            parts.append((i, j, limb, self.products[limb, i, j]))
            parts.append((np.arange(self.dims), np.full(self.dims, -1), limb, self.sums[limb]))
        return batch(
            i=np.concatenate([p[0] for p in parts]).astype(np.int32), j=np.concatenate([p[1] for p in parts]).astype(np.int32),
            limb=np.concatenate([np.full(len(p[0]), p[2]) for p in parts]).astype(np.int32), value=np.concatenate([p[3] for p in parts]).astype(np.int64),
        )


def scatter(fit: DataFrame, lo: list[int], hi: list[int]) -> tuple[int, list[int], dict[tuple[int, int], int]]:
    """(rows, sum of every dimension, product sum of every pair i <= j) of the
    shifted vectors, exact."""
    dims = len(lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = BitPlanes(lo, hi)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                planes.add(_matrix(b.slice(at, BLOCK_ROWS), dims))
        if planes.rows:
            yield planes.rows_out()

    parts = arrow_iter(fit.select("x"), run, "i int, j int, limb int, value long")
    total = parts.groupBy("i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    n, sums, products = 0, [0] * dims, {}
    for i, j, limb, value in total.collect():  # bounded by the pairs of dimensions
        value = int(value) << (LIMB_BITS * limb)
        if i < 0:
            n = value
        elif j < 0:
            sums[i] += value
        else:
            products[i, j] = products.get((i, j), 0) + value
    return n, sums, products


def _rotated(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors by Jacobi rotations down to entries that are
    small against their own two diagonal entries: small eigenvalues keep their
    digits beside very large ones, which ``eigh`` does not promise."""
    order = np.argsort(-np.diag(a), kind="stable")
    a = a[np.ix_(order, order)].astype(np.longdouble)
    q = np.eye(len(a), dtype=np.longdouble)[:, np.argsort(order)].T
    tiny = np.finfo(np.float64).eps
    for _ in range(SWEEPS):
        turned = False
        for i in range(len(a) - 1):
            for j in range(i + 1, len(a)):
                if a[i, j] == 0 or a[i, j] ** 2 <= tiny**2 * abs(a[i, i] * a[j, j]):
                    continue
                turned = True
                theta = (a[j, j] - a[i, i]) / (2 * a[i, j])
                t = (1 if theta >= 0 else -1) / (abs(theta) + np.sqrt(theta * theta + 1))
                c = 1 / np.sqrt(t * t + 1)
                s = t * c
                for m in (a, a.T, q):  # columns, rows, vectors
                    left, right = m[:, i].copy(), m[:, j].copy()
                    m[:, i], m[:, j] = c * left - s * right, s * left + c * right
        if not turned:
            break
    return np.diag(a).astype(np.float64), q.astype(np.float64)


@dataclass
class Whitening:
    """What a fit leaves: bounded by the square of the dimension, whatever the rows.

    ``shifted_sums`` are sums of the entries less ``lo``; ``vectors`` has a
    unit eigenvector a column."""

    n: int
    lo: list[int]
    hi: list[int]
    shifted_sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.lo)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where every value fits, else Python integers."""
        reach = max(self.n * (h - l) for l, h in zip(self.lo, self.hi, strict=True))
        kind = np.int64 if reach < 2**62 else object
        lo, sums = np.array(self.lo, np.int64), np.array(self.shifted_sums, kind)
        return (x - lo).astype(np.uint64).astype(kind) * (self.n if kind is object else np.int64(self.n)) - sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """One column a component."""
        return (centred / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        reach = max(self.n * (h - l) for l, h in zip(self.lo, self.hi, strict=True))
        if self.dims * reach * reach < 2**63:
            return (centred * centred).sum(1).tolist()
        exact = (centred.astype(object) ** 2).sum(1)
        return [int(d) if d < 2**63 else None for d in exact]


def fit_whitening(x: DataFrame, components: int = 16) -> tuple[Whitening, DataFrame] | None:
    """Fit to the distinct vectors ``x``; also the fit list.  None: no rows."""
    distinct = staged(x.select("x").dropDuplicates(["x"]), "whitening-fit")
    sizes = distinct.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not sizes:
        return None
    dims = sizes[0]["dims"]
    fit = distinct.where(F.size("x") == dims)
    lo, hi = _ranges(fit, dims)
    n, sums, products = scatter(fit, lo, hi)
    cov = np.zeros((dims, dims))
    trace = 0
    for (i, j), p in products.items():
        m = n * p - sums[i] * sums[j]  # the shift cancels; exact until this division
        cov[i, j] = cov[j, i] = m / (n * n)
        trace += m if i == j else 0
    values, vectors = np.linalg.eigh(cov)
    least = np.sort(values)[::-1][: min(components, dims)][-1]
    if least < 1e-8 * values.max():
        values, vectors = _rotated(cov)
    order = np.argsort(-values, kind="stable")[:components]
    floor = dims * np.finfo(np.float64).eps * np.diag(cov).max(initial=0) * np.finfo(np.float64).eps
    order = [k for k in order if values[k] > floor and _varies(cov, vectors[:, k], values[k])]
    fitted = Whitening(n, lo, hi, sums, values[order], vectors[:, order], trace / (n * n))
    fitted.identity_error = _identity_error(fit, fitted) if order else 0.0
    return fitted, fit


def _varies(cov: np.ndarray, vector: np.ndarray, value: float) -> bool:
    """Whether an eigenvalue is more than the rounding of the entries that its
    own direction weighs."""
    scale = np.abs(vector) @ np.abs(cov) @ np.abs(vector)
    return value > 8 * len(vector) * np.finfo(np.float64).eps * scale


def _identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus
    the identity."""
    k, dims = len(fitted.values), fitted.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                w = fitted.whitened(fitted.centred(_matrix(b.slice(at, BLOCK_ROWS), dims)))
                products += w.T @ w
                sums += w.sum(0)
        i, j = np.triu_indices(k)
        yield batch(
            i=np.concatenate([i, np.arange(k)]).astype(np.int32), j=np.concatenate([j, np.full(k, -1)]).astype(np.int32), value=np.concatenate([products[i, j], sums]),
        )

    parts = arrow_iter(fit.select("x"), run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    got = {(i, j): v / fitted.n for i, j, v in parts.collect()}  # one row a pair of components
    # the whitened mean is zero but for rounding, so taking it off the products loses nothing
    return max(abs(got[i, j] - got[i, -1] * got[j, -1] - (i == j)) for i, j in got if j >= 0)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000, components: int = 16) -> DataFrame:
    """One row a vector and component: ``vec_id``, ``component`` (from 1, by
    falling eigenvalue), ``n`` (length of the fit list), ``deviation`` (sum
    over dimensions of (n * x - S)**2), ``whitened``, ``explained`` and
    ``identity_error``."""
    x = integer_vectors(vectors, id_col, vector_col, scale, offset)
    fit = fit_whitening(x, components)
    if fit is None or not len(fit[0].values):
        return vectors.sparkSession.createDataFrame([], OUTPUT)
    fitted = fit[0]
    k, dims = len(fitted.values), fitted.dims
    explained = fitted.values / fitted.trace

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        centred = fitted.centred(_matrix(b, dims))
        rows = np.repeat(np.arange(b.num_rows), k)
        return batch(
            vec_id=b["vec_id"].take(pa.array(rows)), component=np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows),
            n=np.full(len(rows), fitted.n), deviation=pa.array(fitted.deviations(centred), pa.int64()).take(pa.array(rows)),
            whitened=fitted.whitened(centred).ravel(), explained=np.tile(explained, b.num_rows),
            identity_error=np.full(len(rows), fitted.identity_error),
        )

    return arrow(x.where(F.size("x") == dims), apply, OUTPUT)
