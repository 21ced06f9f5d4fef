"""Linear discriminant analysis with class means, a pooled covariance and class priors, for all folds from one pass.

Rows, means and centred products are summed once for each class of each fold (``gram.moments``); what a fold's training rows hold is
each class's total less its own, and the products of the classes added up are the pooled scatter. Only (folds x classes) moments of
the columns' size reach the driver, where the small linear solves happen; all rows are scored in one pass, each by its fold's classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gram import Design, Moments, design, moments, total
from .regressors import Fitted

#: The fold number under which the classes of all rows stand.
ALL = -1


@dataclass
class Discriminant:
    """The classes of one fit, rising, with their weights (classes x columns) and constants."""

    classes: np.ndarray
    weights: np.ndarray
    constants: np.ndarray

    def best(self, x: np.ndarray) -> np.ndarray:
        """The class of largest score; of equal ones the larger class."""
        s = x @ self.weights.T + self.constants
        return self.classes[len(self.classes) - 1 - np.argmax(s[:, ::-1], axis=1)]


def _discriminant(parts: dict[float, Moments], ridge: float) -> Discriminant:
    """From each class's moments; columns without variance count for nothing."""
    classes = sorted(parts)
    every = total(dict(enumerate(parts[k] for k in classes)))
    n, c = every.n, len(classes)
    size = np.sqrt(np.maximum(np.diag(every.products)[:-1], 0.0))
    use = np.flatnonzero(size > 1e-9 * np.maximum(1.0, np.abs(every.mean[:-1])) * np.sqrt(max(n, 1.0)))
    scatter = sum(parts[k].products[:-1, :-1] for k in classes)[np.ix_(use, use)]
    means = np.stack([parts[k].mean[:-1] for k in classes])
    w = np.zeros_like(means)
    w[:, use] = np.linalg.solve(scatter / max(1.0, n - c) + ridge * np.eye(len(use)), means[:, use].T).T
    b = -0.5 * (means * w).sum(axis=1) + np.log([parts[k].n / n for k in classes])
    return Discriminant(np.array(classes, dtype=np.float64), w, b)


@dataclass
class LdaFolds:
    """The fit of every fold's training rows (``ALL``: of all rows)."""

    by: Design
    fits: dict[int, Discriminant]

    def predict(self, df: DataFrame, fold: Column, keep: Sequence[str] = ("account_id",)) -> DataFrame:
        """(keep..., prediction): each row's class by the fit that ``fold`` names."""
        rows, plain = self.by.rows(df, {c: F.col(c) for c in keep} | {"__f": fold.cast("int")}), self.by.plain()
        fits, names = self.fits, list(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x, f, out = plain.matrix(b), b.column("__f").to_numpy(), np.full(b.num_rows, np.nan)
                for k in np.unique(f):
                    if int(k) in fits:
                        out[f == k] = fits[int(k)].best(x[f == k])
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(out, mask=np.isnan(out))], [*names, "prediction"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", prediction double")


def fit_lda_folds(train: DataFrame, label: str = "total", fold: str = "fold", ridge: float = 1e-6) -> LdaFolds:
    """Fit each fold's classes from the rows outside it, and those of all rows, in one pass."""
    by = design(train, label)
    rows = train.where(F.col(label).isNotNull())
    classes = [float(r[0]) for r in rows.select(F.col(label).cast("double")).distinct().collect()]
    if not classes:
        return LdaFolds(by, {})
    f = F.col(fold).cast("int") if fold in train.columns else F.lit(ALL)
    # one group for each class of each fold; fold numbers from -1 on
    at = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("double")).cast("int") - 1
    parts = moments(rows.withColumn("__cell", (f + 1) * len(classes) + at), by, label, "__cell")
    cells: dict[float, dict[int, Moments]] = {}
    for g, m in parts.items():
        cells.setdefault(classes[g % len(classes)], {})[g // len(classes) - 1] = m
    whole = {c: total(m) for c, m in cells.items()}
    fits = {ALL: _discriminant(whole, ridge)}
    for k in sorted({f for m in cells.values() for f in m} - {ALL}):
        rest = {c: whole[c].minus(m[k]) if k in m else whole[c] for c, m in cells.items()}
        rest = {c: m for c, m in rest.items() if m.n > 0}
        if rest:
            fits[k] = _discriminant(rest, ridge)
    return LdaFolds(by, fits)


def fit_lda(train: DataFrame, label: str = "total", ridge: float = 1e-6) -> Fitted:
    m = fit_lda_folds(train.drop("fold"), label, ridge=ridge)
    one = m.fits[ALL]
    w, b = ({k: v for k, v in zip(one.classes.tolist(), of)} for of in (one.weights, one.constants))
    return Fitted((w, b), lambda df: m.predict(df, F.lit(ALL)), {"classes": one.classes.tolist()})
