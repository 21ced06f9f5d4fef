"""Kernel machines on a Nystroem map: epsilon-insensitive regression and hinge classification, many at a time.

Landmarks are rows drawn by the hash of their key. The landmarks' kernel matrix is decomposed once on the driver; a row's map is its kernels
to the landmarks times that root, so that products of maps approximate the kernel. Machines are then linear in the map and are
solved as the losses say, by majorisation: |t| lies below a parabola that touches it where the current solution is,
so each step is a weighted least-squares problem whose weights follow from the residuals. Machines that differ by the fold they leave out
share a row's curvature: the largest of their weights, whose parabola lies above the loss of each, so that a row counts in one
weighted Gram matrix for its setting and fold instead of one for every machine; a machine's matrix is the sum of the other folds'. One pass
over the rows sums these matrices and the machines' own gradients (ten folds by nine grid points, or the classes of ten folds), the driver solves systems
of landmark size, and the true loss falls with every pass until it stays.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import lgamma
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Landmarks, passes at most, relative fall of the loss that ends them, and the residual below which weights grow no more.
LANDMARKS, PASSES, TOLERANCE, SMOOTH = 128, 40, 1e-3, 1e-3
#: Rows of a block at most.
BLOCK = 4096


def bessel_ratio(z: np.ndarray, order: int) -> np.ndarray:
    """J_order(z) / z^order over its limit at 0: 1 at 0, falling. A power series where ``z`` is small, else the Bessel
    integral by the trapezoid rule, which is exact to double precision for enough points."""
    z = np.asarray(z, dtype=np.float64)
    out = np.ones_like(z)
    small = z < 8.0 + order
    q, term = -(z[small] / 2.0) ** 2, np.ones(int(small.sum()))
    total = term.copy()
    for k in range(1, 80):
        term = term * q / (k * (order + k))
        total += term
        if not len(term) or np.abs(term).max() < 1e-20:  # the result is far above where it has not cancelled
            break
    out[small] = total
    big = z[~small]
    if len(big):
        points = int(2 * np.ceil(big.max()) + 4 * order + 64)
        theta = 2 * np.pi * np.arange(points) / points
        j = np.empty(len(big))
        step = max(1, (1 << 22) // points)
        for lo in range(0, len(big), step):
            j[lo:lo + step] = np.cos(order * theta - big[lo:lo + step, None] * np.sin(theta)).mean(axis=1)
        out[~small] = j * np.exp(lgamma(order + 1) + order * np.log(2.0 / big))
    return out


@dataclass(frozen=True)
class Kernel:
    """``radial``: exp(-width * distance^2). ``bessel``: the Bessel function of ``order`` of width * distance, over its limit, to the ``degree``."""

    kind: str = "radial"
    width: float = 0.025
    order: int = 10
    degree: int = 1

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d2 = np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * x @ y.T)
        if self.kind == "radial":
            return np.exp(-self.width * d2)
        if self.kind == "bessel":
            return bessel_ratio(self.width * np.sqrt(d2), self.order) ** self.degree
        raise ValueError(self.kind)


@dataclass
class Nystroem:
    """A kernel's map from its landmarks: ``kernel(x, landmarks) @ root``."""

    kernel: Kernel
    landmarks: np.ndarray
    root: np.ndarray

    @staticmethod
    def fit(kernel: Kernel, landmarks: np.ndarray) -> "Nystroem":
        e, u = np.linalg.eigh(kernel(landmarks, landmarks))
        use = e > 1e-10 * e.max()
        return Nystroem(kernel, landmarks, u[:, use] / np.sqrt(e[use]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Map of rows, with a last column of ones."""
        return np.concatenate([self.kernel(x, self.landmarks) @ self.root, np.ones((len(x), 1))], axis=1)


@dataclass(frozen=True)
class Machine:
    """One machine: its kernel's number, loss (``regression`` or ``class``), ``cost`` of a unit of loss, ``epsilon``, the fold it does
    not learn from (-1: none) and, for classes, the label that counts as 1 (all others as -1)."""

    kernel: int = 0
    loss: str = "regression"
    cost: float = 1.0
    epsilon: float = 0.1
    out: int = -1
    positive: float = 0.0

    def step(self, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(weights, targets) of the parabolas above the loss at scores ``f``, and the loss."""
        if self.loss == "regression":
            e = y - f
            a, b = (self.cost / (2 * np.sqrt((e + s) ** 2 + SMOOTH ** 2)) for s in (-self.epsilon, self.epsilon))
            return a + b, y + self.epsilon * (b - a) / (a + b), float(self.cost * np.maximum(0.0, np.abs(e) - self.epsilon).sum())
        t = np.where(y == self.positive, 1.0, -1.0)
        u = np.sqrt((1 - t * f) ** 2 + SMOOTH ** 2)
        return self.cost / (2 * u), t * (1 + u), float(self.cost * np.maximum(0.0, 1 - t * f).sum())


def _array(df: DataFrame, c: str) -> Column:
    return F.col(c) if df.schema[c].dataType.typeName() == "array" else vector_to_array(c)


def landmarks(rows: DataFrame, key: str, vector: str, n: int, seed: int = 7) -> np.ndarray:
    """``n`` rows' vectors at most: those of smallest hash of the key."""
    got = rows.select(_array(rows, vector).alias("v"), F.xxhash64(F.lit(seed), F.col(key)).alias("h"), key).orderBy("h", key).limit(n).collect()
    return np.unique(np.array([r.v for r in got], dtype=np.float64), axis=0)


@dataclass
class Machines:
    """Fitted machines: maps, each machine's weights, and the losses by pass (with half the squared norm)."""

    machines: list[Machine]
    maps: list[Nystroem]
    weights: list[np.ndarray]
    losses: list[list[float]]

    def scores(self, df: DataFrame, vector: str, keep: Sequence[str], of: Column | None = None) -> DataFrame:
        """(keep..., scores): the scores of all machines for each row, null for machines outside the array of numbers ``of``."""
        k = len(self.machines)
        which = of if of is not None else F.sequence(F.lit(0), F.lit(k - 1))
        rows = df.select(*keep, _array(df, vector).alias("__v"), which.cast("array<int>").alias("__of"))
        names, me = list(keep), self  # landmarks by features, and machines by landmarks, whatever the rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                x = b.column("__v").flatten().to_numpy().reshape(n, -1)
                of = b.column("__of")
                wanted = np.zeros((n, k), dtype=bool)
                wanted[np.repeat(np.arange(n), of.value_lengths().to_numpy()), of.flatten().to_numpy()] = True
                out = np.zeros((n, k))
                for i, m in enumerate(me.maps):
                    mine = [j for j in range(k) if me.machines[j].kernel == i]
                    use = np.flatnonzero(wanted[:, mine].any(axis=1))
                    for lo in range(0, len(use), 4096):
                        some = use[lo:lo + 4096]
                        out[np.ix_(some, mine)] = m(x[some]) @ np.stack([me.weights[j] for j in mine], axis=1)
                flat = pa.array(out.ravel(), mask=~wanted.ravel())
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), flat)],
                                                 [*names, "scores"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", scores array<double>")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, y, fold) of many rows as one row of bytes."""
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            some = b.slice(lo, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (some.column("v").flatten().to_numpy(), some.column("y").to_numpy(),
                                                                                               some.column("fold").to_numpy())], ["v", "y", "fold"])


def fit_machines(rows: DataFrame, kernels: Sequence[Kernel], machines: Sequence[Machine], vector: str = "scaled", label: str = "total",
                 key: str = "account_id", fold: str = "fold", n_landmarks: int = LANDMARKS, passes: int = PASSES,
                 tolerance: float = TOLERANCE) -> Machines:
    """Fit all ``machines`` on ``rows`` (key, label, vector, and fold where a machine leaves one out) together.

    Each pass is one job over packed blocks of rows; a task sums one weighted Gram matrix of (landmarks + 1)^2 numbers for each setting and fold and
    a gradient for each machine, and Spark adds them up. A machine is done when its loss falls by less than ``tolerance`` of itself.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    machines = list(machines)
    at = landmarks(rows, key, vector, n_landmarks)
    maps = [Nystroem.fit(k, at) for k in kernels]
    has_fold = fold in rows.columns
    flat = rows.select(_array(rows, vector).alias("v"), F.col(label).cast("double").alias("y"),
                       (F.col(fold).cast("int") if has_fold else F.lit(-2)).alias("fold")).where("y is not null")
    cur = flat.mapInArrow(_packed, "v binary, y binary, fold binary").checkpoint().persist()
    out = Machines(machines, maps, [np.zeros(maps[m.kernel].root.shape[1] + 1) for m in machines], [[] for _ in machines])
    settings = list(dict.fromkeys(replace(m, out=-1) for m in machines))
    of = [settings.index(replace(m, out=-1)) for m in machines]
    outs = sorted({m.out for m in machines})  # the parts that a setting's matrix is summed in: folds that some machine leaves out, and the rest (0)
    width = at.shape[1]
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), len(machines)))
    todo = list(range(len(machines)))
    for _ in range(passes):
        weights, now = out.weights, list(todo)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int, int], np.ndarray] = {}

            def add(kind: int, j: int, part: int, v: np.ndarray) -> None:
                held[kind, j, part] = held[kind, j, part] + v if (kind, j, part) in held else v

            for b in batches:
                for v_, y_, f_ in zip(*(b.column(c).to_pylist() for c in ("v", "y", "fold"))):
                    x, y, fold_ = np.frombuffer(v_).reshape(-1, width), np.frombuffer(y_), np.frombuffer(f_, np.int32)
                    part = np.searchsorted(outs, fold_)
                    part = np.where(np.isin(fold_, outs), part + 1, 0)
                    ends = np.r_[0, np.cumsum(np.bincount(part, minlength=len(outs) + 1))]
                    order = np.argsort(part, kind="stable")
                    x, y, fold_ = x[order], y[order], fold_[order]
                    for i, m in enumerate(maps):
                        mine = [j for j in now if machines[j].kernel == i]
                        if not mine:
                            continue
                        phi = m(x)
                        f = phi @ np.stack([weights[j] for j in mine], axis=1)
                        pull, top = np.zeros((len(y), len(mine))), {}
                        for k, j in enumerate(mine):
                            use = fold_ != machines[j].out
                            c, t, loss = machines[j].step(y[use], f[use, k])
                            pull[use, k] = c * (t - f[use, k])
                            most = top.setdefault(of[j], np.zeros(len(y)))
                            most[use] = np.maximum(most[use], c)
                            add(1, j, 0, np.array([loss]))
                        for j, g in zip(mine, (phi.T @ pull).T):
                            add(2, j, 0, g)
                        for s, c in top.items():
                            q = phi * np.sqrt(c)[:, None]
                            for k in range(len(ends) - 1):
                                if ends[k + 1] > ends[k]:
                                    add(0, s, k, (q[ends[k]:ends[k + 1]].T @ q[ends[k]:ends[k + 1]]).ravel())
            for (kind, j, k), v in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([j], pa.int32()), pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["kind", "j", "part", "v"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int, int], np.ndarray] = {}
            for b in batches:
                for kind, j, k, v in zip(*(b.column(c).to_pylist() for c in ("kind", "j", "part", "v"))):
                    a = np.frombuffer(v)
                    held[kind, j, k] = held[kind, j, k] + a if (kind, j, k) in held else a
            for (kind, j, k), v in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([j], pa.int32()), pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["kind", "j", "part", "v"])

        shape = "kind int, j int, part int, v binary"
        got = {(r.kind, r.j, r.part): np.frombuffer(r.v) for r in cur.mapInArrow(sums, shape).repartition(parts, "kind", "j", "part").mapInArrow(added, shape).collect()}
        for j in now:
            if (1, j, 0) not in got:
                continue
            w = out.weights[j]
            d = len(w)
            out.losses[j].append(0.5 * float(w[:-1] @ w[:-1]) + float(got[1, j, 0][0]))
            ridge = np.ones(d)
            ridge[-1] = 1e-9  # the constant is not penalised
            skip = outs.index(machines[j].out) + 1
            gram = sum(got[0, of[j], k] for k in range(len(outs) + 1) if k != skip and (0, of[j], k) in got).reshape(d, d)
            out.weights[j] = w + np.linalg.solve(gram + np.diag(ridge), got[2, j, 0] - ridge * w)
        todo = [j for j in now if (1, j, 0) in got and not (len(out.losses[j]) > 2 and out.losses[j][-2] - out.losses[j][-1] < tolerance * out.losses[j][-2])]
        if not todo:
            break
    cur.unpersist()
    return out
