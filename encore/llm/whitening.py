"""Whitening of vectors from an exact integer covariance.

Vectors are quantised to integers. Each task shifts its rows' dimensions to begin at 0 and packs every bit of every
dimension across rows into 64-bit words, a bit plane. A cross-product of two dimensions is then the sum over their pairs of planes
of 2^(a + b) times the number of ones that both planes share; no rounding takes place. The sums of all tasks are
centred as integers (n * cross-products less the product of sums) and only then become floating-point
numbers for the eigenvectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: One unit of a vector's entries makes so many steps of the integers.
STEPS = 256
COMPONENTS = 4
#: Rows packed at a time, and words of planes compared at a time.
ROWS, WORDS = 8192, 1 << 22
#: Eigenvalues below this share of the trace, times the dimensions, are taken as 0.
NIL = 1e-15

_SAFE = 1 << 62


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes (planes x words, 64 rows a word) of non-negative integers (rows x dimensions), with each plane's
    dimension and bit."""
    bits = [int(v).bit_length() for v in y.max(axis=0)]
    dims = np.repeat(np.arange(y.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]).astype(np.int64)
    words = np.zeros((len(dims), -(-len(y) // 64) * 8), dtype=np.uint8)
    at = 0
    for i, b in enumerate(bits):
        ones = (y[:, i] >> np.arange(b, dtype=np.uint64)[:, None]) & np.uint64(1)
        words[at:at + b, :-(-len(y) // 8)] = np.packbits(ones.astype(bool), axis=1, bitorder="little")
        at += b
    return words.view("<u8"), dims, bit


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y_i * y_j for non-negative integers (uint64, rows x dimensions)."""
    words, dims, bit = planes(y)
    d, p = y.shape[1], len(dims)
    shared = np.zeros((p, p), dtype=np.int64)
    step = max(1, WORDS // max(1, words.size))
    for lo in range(0, p, step):
        both = words[lo:lo + step, None, :] & words[None, lo:, :]
        shared[lo:lo + step, lo:] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
    shared = np.triu(shared) + np.triu(shared, 1).T
    exact = np.int64 if p == 0 or len(y) << (2 * int(bit.max()) + 2) < _SAFE else object
    weight = (np.array([1 << int(b) for b in bit], dtype=object)).astype(exact)
    out = np.zeros((d, d), dtype=exact)
    part = np.zeros((d, p), dtype=exact)
    np.add.at(part, dims, shared.astype(exact) * weight[:, None])
    np.add.at(out.T, dims, (part * weight[None, :]).T)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over rows of x_i and of x_i * x_j for integers (rows x dimensions), as Python integers."""
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # exact whatever the signs: modulo 2^64
    m, n = low.astype(object), len(x)
    s = np.array([int(v) for v in (y >> np.uint64(32)).sum(axis=0)], dtype=object) * (1 << 32) + np.array(
        [int(v) for v in (y & np.uint64(0xFFFFFFFF)).sum(axis=0)], dtype=object)
    c = cross_products(y).astype(object)
    return s + n * m, c + np.outer(m, s) + np.outer(s, m) + n * np.outer(m, m)


@dataclass
class Whitening:
    """A fit for vectors of one length: ``n`` distinct integer vectors, their sums (exact), eigenvalues of the first components with
    the share of the trace each explains, and components (dimensions x components)."""

    n: int
    sums: list[int]
    values: np.ndarray
    explained: np.ndarray
    components: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Exact n * x - sums."""
        s = np.array(self.sums, dtype=object)
        largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if self.n * largest + max((abs(v) for v in self.sums), default=0) < _SAFE:
            return self.n * x - s.astype(np.int64)
        return self.n * x.astype(object) - s

    def apply(self, centred: np.ndarray) -> np.ndarray:
        """Whitened coordinates (rows x components) of centred vectors; 0 along components of no variance."""
        z = (centred / self.n).astype(np.float64) @ self.components
        return np.divide(z, np.sqrt(self.values), out=np.zeros_like(z), where=self.values > 0)


def solve(n: int, sums: list[int], cross: np.ndarray, k: int) -> Whitening:
    """The fit from exact sums and cross-products: integers are centred before they become floating-point."""
    s = np.array(sums, dtype=object)
    centred = n * cross - np.outer(s, s)
    v = (centred / (n * n)).astype(np.float64)  # true division of integers: each entry rounded once
    size = np.abs(v).max()
    unit = v / size if size > 0 else v
    e, u = np.linalg.eigh(unit)
    e, u, total = e[::-1][:k].copy(), u[:, ::-1][:, :k], float(np.trace(unit))
    e[e <= NIL * len(s) * total] = 0.0
    return Whitening(n, list(sums), e * size, e / total if total > 0 else np.zeros(len(e)), u)


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", steps: int = STEPS) -> DataFrame:
    """(vec_id, x): each usable vector as integers floor(steps * entry). Rows whose vector is null, empty or holds null or
    non-finite entries are left out; entries beyond the range of long become its limits."""
    v = F.col(f"`{vector}`")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return (vectors.where(good).select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v"))
            .select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * float(steps))).alias("x")))


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, rows x dimensions) for each length of the batch's vectors, in slices."""
    col = b.column("x")
    flat, ends = col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
    size = np.diff(ends)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        for lo in range(0, len(at), ROWS):
            some = at[lo:lo + ROWS]
            yield some, flat[ends[some][:, None] + np.arange(d)]


def fit(points: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Fits by vector length from ``points`` (x), each row counted once.

    A task holds the cross-products of its rows, d x d numbers for each length d; they are summed by (d, i, j), and the sums reach the
    driver, whose size follows from the lengths alone. Few lengths are expected (one for each model that made the vectors).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for _, x in _matrices(b):
                s, c = scatter(x)
                old = held.get(x.shape[1])
                held[x.shape[1]] = [len(x), s, c] if old is None else [old[0] + len(x), old[1] + s, old[2] + c]
        for d, (n, s, c) in held.items():
            i, j = np.triu_indices(d)
            value = [str(n), *map(str, s), *map(str, c[i, j])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(value), d), pa.int32()), pa.array(np.concatenate([[-1], np.full(d, -1), i]), pa.int32()),
                 pa.array(np.concatenate([[-1], np.arange(d), j]), pa.int32()), pa.array(value)], ["d", "i", "j", "value"])

    got = (points.mapInArrow(run, "d int, i int, j int, value string")
           .groupBy("d", "i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    by: dict[int, dict] = {}
    for r in got:
        by.setdefault(r.d, {})[r.i, r.j] = int(r.value)
    out = {}
    for d, v in by.items():
        cross = np.array([[v[min(i, j), max(i, j)] for j in range(d)] for i in range(d)], dtype=object)
        out[d] = solve(v[-1, -1], [v[-1, j] for j in range(d)], cross, components)
    return out


def identity_errors(points: DataFrame, fits: dict[int, Whitening]) -> dict[int, float]:
    """By vector length: the largest absolute entry of the covariance of all whitened ``points`` less the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in _matrices(b):
                f = fits[x.shape[1]]
                w = f.apply(f.centred(x))
                one = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                held[x.shape[1]] = held.get(x.shape[1], 0) + one.T @ one
        for d, m in held.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, d), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                              pa.array(m.ravel())], ["d", "i", "j", "value"])

    got = points.mapInArrow(run, "d int, i int, j int, value double").groupBy("d", "i", "j").agg(F.sum("value").alias("value")).collect()
    sums = {d: np.zeros((len(f.values) + 1,) * 2) for d, f in fits.items()}
    for r in got:
        sums[r.d][r.i, r.j] = r.value
    out = {}
    for d, m in sums.items():
        mean = m[-1, :-1] / fits[d].n
        out[d] = float(np.abs(m[:-1, :-1] / fits[d].n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return out


def whitened(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, steps: int = STEPS) -> DataFrame:
    """One row per usable row and component (from 1, at most as many as dimensions): vec_id, component, n, deviation (decimal),
    whitened, explained, identity_error.

    The fit counts each distinct integer vector once. ``n`` is their number, ``deviation`` the exact sum of (n * x - S)^2 over dimensions (S:
    their sums; null beyond 38 digits), ``whitened`` the centred vector's coordinate along the component over the
    eigenvalue's root (0 where the eigenvalue is 0), ``explained`` the eigenvalue's share of the trace (0 if that is 0), ``identity_error``
    how far the covariance of the whitened distinct vectors is from the identity, at most. Equal eigenvalues leave their
    components' choice open. Vectors of different lengths are whitened apart, each length from a fit of its own. For
    vectors left out see :func:`quantised`; rows without key and rows that repeat one each give rows; an empty table gives none. Other columns are not read.
    """
    rows = quantised(vectors, key, vector, steps)
    points = stored(rows.select("x").distinct(), "op11-points")
    fits = fit(points, components)
    errors = identity_errors(points, fits)
    # by length: n, d sums and d x components numbers, whatever the rows; plain values, as a task need not have this package installed
    send = vectors.sparkSession.sparkContext.broadcast(({d: vars(f) for d, f in fits.items()}, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, err = {d: Whitening(**f) for d, f in send.value[0].items()}, send.value[1]
        for b in batches:
            for at, x in _matrices(b):
                f = known[x.shape[1]]
                c, k, n = f.centred(x), len(f.values), len(at)
                largest = max(abs(int(c.max())), abs(int(c.min())))
                wide = c if c.dtype == object or largest ** 2 * c.shape[1] < _SAFE else c.astype(object)
                dev = (wide * wide).sum(axis=1)
                ids = b.column("vec_id").take(pa.array(np.repeat(at, k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()), pa.array(np.full(n * k, f.n), pa.int64()),
                     pa.array(np.repeat([str(v) for v in dev], k)), pa.array(f.apply(c).ravel()),
                     pa.array(np.tile(f.explained, n)), pa.array(np.full(n * k, err[x.shape[1]]))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = rows.mapInArrow(run, "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))
