"""Linear models of all folds from one pass: moments summed by fold.

One job sums, for each fold, the rows, the columns and the products of columns (design columns and label). The moments of a
fold's training rows are the total less its own, so ten folds, their scalers and any ridge cost the same single pass; each
fit is the normal equations of centred moments. Moments are centred on a column's overall mean before they are summed.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .design import NON_FEATURES, split_columns
from .levels import dictionary, level_table, with_level_numbers


@dataclass
class Design:
    """Columns of ``label ~ .``: numbers as they are, a factor as one column for each level but its first (null numbers count as 0, levels
    unseen in the fit as the first). If ``whole``, the first level has a column, too."""

    numeric: list[str]
    factors: list[str]
    levels: DataFrame | None
    widths: list[int]
    whole: bool = False

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *[f"{c}[{i}]" for c, n in zip(self.factors, self.widths) for i in range(0 if self.whole else 1, n)]]

    def rows(self, df: DataFrame, keep: dict[str, Column]) -> DataFrame:
        """(keep..., num, lev): the numbers, and the factors' level numbers."""
        if self.factors:
            df = with_level_numbers(df, self.levels, self.factors)
        lev = F.concat(*[F.col(c + "__no") for c in self.factors]) if self.factors else F.array().cast("array<double>")
        return df.select(*[c.alias(n) for n, c in keep.items()],
                         F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in self.numeric]).cast("array<double>").alias("num"), lev.alias("lev"))

    def matrix(self, b: pa.RecordBatch) -> np.ndarray:
        n = b.num_rows
        x = np.zeros((n, len(self.names)))
        x[:, :len(self.numeric)] = b.column("num").flatten().to_numpy().reshape(n, -1)
        lev = b.column("lev").flatten().to_numpy().reshape(n, -1).astype(np.int64)
        at, first = len(self.numeric), 0 if self.whole else 1
        for j, w in enumerate(self.widths):
            rows = np.flatnonzero(lev[:, j] >= first)
            x[rows, at + lev[rows, j] - first] = 1.0
            at += w - first
        return x

    def plain(self) -> "Design":
        """Without the table, for tasks."""
        return Design(self.numeric, self.factors, None, self.widths, self.whole)


def design(train: DataFrame, label: str = "total", exclude: Sequence[str] = NON_FEATURES, columns: Sequence[str] | None = None,
           most: int = 4096, whole: bool = False) -> Design:
    """The design of ``train``; levels are numbered as a table (see ``levels``). More than ``most`` columns are refused, as a Gram matrix of that
    size goes to the driver: leave wide factors out by a filter."""
    numeric, factors = split_columns(train, [*exclude, label])
    if columns is not None:
        numeric, factors = [c for c in columns if c in numeric], [c for c in columns if c in factors]
    levels, widths = None, []
    if factors:
        levels = dictionary(level_table(train, factors, label))
        n = {r.factor: int(r.n) + 1 for r in levels.groupBy("factor").agg(F.max(F.col("numbers")[0]).alias("n")).collect()}
        widths = [n.get(c, 1) for c in factors]
    out = Design(numeric, factors, levels, widths, whole)
    if len(out.names) > most:
        raise ValueError(f"{len(out.names)} design columns, more than {most}")
    return out


@dataclass
class Moments:
    """Rows, mean and centred products (label last)."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def minus(self, other: "Moments") -> "Moments":
        n = self.n - other.n
        if n <= 0:
            return Moments(0.0, np.zeros_like(self.mean), np.zeros_like(self.products))
        mean = (self.n * self.mean - other.n * other.mean) / n
        d = other.mean - mean
        return Moments(n, mean, self.products - other.products - np.outer(d, d) * n * other.n / self.n)

    def plus(self, other: "Moments") -> "Moments":
        if not self.n or not other.n:
            return other if not self.n else self
        n, d = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + d * other.n / n, self.products + other.products + np.outer(d, d) * self.n * other.n / n)

    @property
    def deviation(self) -> np.ndarray:
        """Sample standard deviations."""
        return np.sqrt(np.maximum(np.diag(self.products), 0.0) / max(self.n - 1, 1.0))

    def solve(self, ridge: float = 1e-9) -> tuple[float, np.ndarray]:
        """(constant, coefficients) of least squares; ``ridge`` is relative to each column's own sum of squares, and columns without
        variance get 0."""
        size = np.sqrt(np.maximum(np.diag(self.products)[:-1], 0.0))
        use = size > 1e-9 * np.maximum(1.0, np.abs(self.mean[:-1])) * np.sqrt(max(self.n, 1.0))
        out = np.zeros(len(size))
        if use.any():
            s = size[use]
            a = self.products[:-1, :-1][np.ix_(use, use)] / np.outer(s, s)
            out[use] = np.linalg.solve(a + ridge * np.eye(len(s)), self.products[:-1, -1][use] / s) / s
        return float(self.mean[-1] - self.mean[:-1] @ out), out


def moments(train: DataFrame, by: Design, label: str = "total", fold: str | Column = "fold") -> dict[int, Moments]:
    """Moments of each fold (of all rows under -1 if there is no fold column); rows without label are left out. ``fold`` may also be an
    array column of the groups that a row counts in, which may overlap."""
    if isinstance(fold, str):
        fold = F.col(fold).cast("int") if fold in train.columns else F.lit(-1)
        train = train.withColumn("__group", fold)
    else:
        train = train.withColumn("__group", F.explode(fold.cast("array<int>")))
    rows = by.rows(train.where(F.col(label).isNotNull()), {"y": F.col(label).cast("double"), "fold": F.col("__group")})
    plain = by.plain()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = np.concatenate([plain.matrix(b), b.column("y").to_numpy()[:, None]], axis=1)
            folds = b.column("fold").to_numpy()
            for f in np.unique(folds):
                mine = x[folds == f]
                mean = mine.mean(axis=0)
                new = Moments(float(len(mine)), mean, (mine - mean).T @ (mine - mean))
                held[int(f)] = held[int(f)].plus(new) if int(f) in held else new
        for f, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([np.concatenate([[m.n], m.mean, m.products.ravel()]).tobytes()], pa.binary())], ["fold", "v"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            for f, v in zip(b.column("fold").to_pylist(), b.column("v").to_pylist()):
                new = _moments(v)
                held[f] = held[f].plus(new) if f in held else new
        for f, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([np.concatenate([[m.n], m.mean, m.products.ravel()]).tobytes()], pa.binary())], ["fold", "v"])

    parts = max(1, min(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16))
    got = rows.mapInArrow(sums, "fold int, v binary").repartition(parts, "fold").mapInArrow(added, "fold int, v binary").collect()
    return {r.fold: _moments(r.v) for r in got}


def _moments(v: bytes) -> Moments:
    a = np.frombuffer(v)
    d = int((np.sqrt(4 * len(a) - 3) - 1) / 2)
    return Moments(float(a[0]), a[1:1 + d], a[1 + d:].reshape(d, d))


def total(parts: dict[int, Moments]) -> Moments:
    out = None
    for f in sorted(parts):
        out = parts[f] if out is None else out.plus(parts[f])
    return out


@dataclass
class LinearFolds:
    """Least squares of every fold's training rows (fold -1: of all rows)."""

    by: Design
    moments: dict[int, Moments]
    solutions: dict[int, tuple[float, np.ndarray]]

    def predict(self, df: DataFrame, fold: Column, keep: Sequence[str] = ("account_id",)) -> DataFrame:
        """(keep..., prediction): each row by the solution that ``fold`` names."""
        rows, plain = self.by.rows(df, {c: F.col(c) for c in keep} | {"__f": fold.cast("int")}), self.by.plain()
        solutions, names = self.solutions, list(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x, f, out = plain.matrix(b), b.column("__f").to_numpy(), np.full(b.num_rows, np.nan)
                for k in np.unique(f):
                    if int(k) in solutions:
                        c, w = solutions[int(k)]
                        out[f == k] = c + x[f == k] @ w
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(out, mask=np.isnan(out))], [*names, "prediction"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", prediction double")


def fit_linear_folds(train: DataFrame, label: str = "total", fold: str = "fold", columns: Sequence[str] | None = None,
                     ridge: float = 1e-9) -> LinearFolds:
    """Fit each fold's model from the total moments less its own, and one of all rows, in one pass."""
    by = design(train, label, columns=columns)
    parts = moments(train, by, label, fold)
    if not parts:
        return LinearFolds(by, {}, {})
    whole = total(parts)
    each = {f: whole.minus(m) for f, m in parts.items() if f != -1} | {-1: whole}
    return LinearFolds(by, each, {f: m.solve(ridge) for f, m in each.items()})


def fit_linear_holdouts(train: DataFrame, held_out: Sequence[Column], learn: Column | None = None, label: str = "total",
                        ridge: float = 1e-9) -> LinearFolds:
    """One model for each of ``held_out`` (conditions that may overlap), numbered from 0, from one pass: all rows' moments less
    those of the rows held out. Only rows that meet ``learn`` are learned from."""
    data = train if learn is None else train.where(learn)
    by = design(train, label)
    groups = F.filter(F.array(F.lit(-1), *[F.when(c, i) for i, c in enumerate(held_out)]), lambda g: g.isNotNull())
    parts = moments(data, by, label, groups)
    none = Moments(0.0, np.zeros(len(by.names) + 1), np.zeros((len(by.names) + 1,) * 2))
    whole = parts.get(-1, none)
    each = {i: whole.minus(parts.get(i, none)) for i in range(len(held_out))}
    return LinearFolds(by, each, {i: m.solve(ridge) for i, m in each.items() if m.n})


def scaled(train: DataFrame, label: str = "total", columns: Sequence[str] | None = None, keep: Sequence[str] = ("account_id", "total", "fold"),
           fit_on: Column | None = None) -> tuple[DataFrame, list[str]]:
    """(keep..., scaled) and the names of the scaled columns: design columns less their mean over their standard deviation, from the
    moments of the rows that meet ``fit_on``; columns that do not vary there are left out."""
    by = design(train, label, columns=columns)
    m = total(moments(train if fit_on is None else train.where(fit_on), by, label, "__none"))
    sd, mean = m.deviation[:-1], m.mean[:-1]
    use = np.flatnonzero(sd > 1e-9 * np.maximum(1.0, np.abs(mean)))
    rows, plain, names = by.rows(train, {c: F.col(c) for c in keep}), by.plain(), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = (plain.matrix(b)[:, use] - mean[use]) / sd[use]
            ends = pa.array(np.arange(b.num_rows + 1) * len(use), pa.int32())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.ListArray.from_arrays(ends, pa.array(z.ravel()))], [*names, "scaled"])

    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
    return rows.mapInArrow(run, kept + ", scaled array<double>"), [by.names[i] for i in use]
