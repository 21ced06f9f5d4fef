"""Random Fourier maps of all folds, and the linear models on them, from passes that all folds share.

Each fold's map has the scaler and the draws that a separate fit on its training rows has: columns that do not vary there are left out, the
others are scaled by their own mean and deviation there. Scaling is part of the map (``cos(x @ turn + shift)`` of the plain design columns), so the
rows are read as they are and no mapped row is ever stored. Huber regression solves the loss of ``LinearRegression(loss="huber")``, scale
included, by Newton steps: a pass sums each fold's loss, gradient and curvature, and the driver solves systems of the map's size. Where rows are many, the steps begin at the
solution of a part of the blocks, so that few passes over all rows are left; they end as before, when a step over all rows promises nothing more. Support-vector classes solve
the hinge loss of ``LinearSVC`` in the same way. A step that does not lower the loss is shortened.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial, pi
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .gram import Design, design, moments, total
from .kernels import draws
from .machines import Machine, Machines, _packed

#: Newton passes at most, fall of the loss that a step must promise (relative), and the smallest scale.
PASSES, PROMISE, LEAST = 60, 1e-10, 1e-9
#: Widths of the hinge's parabola, each with the fall of the loss that a step must promise there (relative), and parts of a step whose losses a pass
#: looks at.
BANDS, TRIES = ((2.0, 1e-2), (0.5, 1e-3), (0.15, 1e-3), (0.05, 2e-4), (0.02, 2e-5)), (1.0, 0.6, 0.3, 0.1, 0.03, 0.01, 0.001)


#: Rows from which on the steps begin at the solution of one block in ``PART``, and numbers whose cosine is taken at a time.
WARM, PART, RUN = 200_000, 16, 32_768
#: cos(v) by powers of v^2, from the highest on, up to a quarter of pi; and 2 pi in two parts, the first of few digits.
POWERS, TURN = [(-1) ** k / factorial(2 * k) for k in range(8, -1, -1)], (6.28125, 2 * pi - 6.28125)


def cosine(p: np.ndarray) -> np.ndarray:
    """``p`` replaced by its cosines, to some 1e-14: the angle within half a turn, a power series of its quarter, and the angle doubled twice."""
    flat = p.reshape(-1)
    for lo in range(0, len(flat), RUN):
        v = flat[lo:lo + RUN]
        turns = np.rint(v * (1 / (2 * pi)))
        v -= turns * TURN[0]
        v -= turns * TURN[1]
        v *= 0.25
        v *= v
        s = v * POWERS[0]
        for c in POWERS[1:-1]:
            s += c
            s *= v
        s += POWERS[-1]
        for _ in range(2):
            s *= s
            s *= 2.0
            s -= 1.0
        v[:] = s
    return p


@dataclass
class Fourier:
    """A map of plain design columns, each column of the map over its deviation ``size`` (0 there: left out), with a last column of ones."""

    turn: np.ndarray
    shift: np.ndarray
    size: np.ndarray

    @property
    def width(self) -> int:
        """Columns of the rows."""
        return self.turn.shape[0]

    @property
    def dimension(self) -> int:
        """Columns of the map."""
        return len(self.shift) + 1

    def angles(self, x: np.ndarray) -> np.ndarray:
        p = np.ascontiguousarray(x @ self.turn)
        p += self.shift
        return p

    def plain(self, x: np.ndarray) -> np.ndarray:
        p = cosine(self.angles(x))
        p *= np.sqrt(2.0 / len(self.shift))
        return p

    def __call__(self, x: np.ndarray) -> np.ndarray:
        by = np.divide(1.0, self.size, out=np.zeros(len(self.size)), where=self.size > 0)
        out = np.ones((len(x), self.dimension))
        np.multiply(cosine(self.angles(x)), np.sqrt(2.0 / len(self.shift)) * by, out=out[:, :-1])
        return out


def summed(rows: DataFrame, sums: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """The (key, vector) pairs that ``sums`` gives for each task, added up by key."""
    def batch(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["k", "v"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for k, v in sums(batches):
            held[k] = held[k] + v if k in held else v
        yield from batch(held)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("k").to_pylist(), b.column("v").to_pylist()):
                v = np.frombuffer(v)
                held[k] = held[k] + v if k in held else v
        yield from batch(held)

    parts = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16))
    got = rows.mapInArrow(each, "k int, v binary").repartition(parts, "k").mapInArrow(added, "k int, v binary").collect()
    return {r.k: np.frombuffer(r.v) for r in got}


def _slots(by: Design) -> list[list[tuple[int, bool]]]:
    """For each factor, its levels' columns by level name, and whether the level is null (last: null takes the place of invalid levels)."""
    names: dict[str, list[tuple]] = {c: [] for c in by.factors}
    if by.factors:  # no more than the design's columns
        for r in by.levels.select("factor", "level", F.col("numbers")[0].alias("n")).collect():
            if r.factor in names:
                names[r.factor].append((r.level is None, r.level or "__blank__", int(r.n)))
    out, at = [], len(by.numeric)
    for c, w in zip(by.factors, by.widths):
        out.append([(at + n, null) for null, _, n in sorted(names[c])])
        at += w
    return out


@dataclass
class FourierFolds:
    """Packed rows to learn from, each fold's map, and the number of rows that it learns from."""

    by: Design
    folds: list[int]
    maps: list[Fourier]
    counts: list[float]
    packed: DataFrame

    def vectors(self, df: DataFrame, keep: Sequence[str], out: str = "design") -> DataFrame:
        """(keep..., out): the plain design columns."""
        return vectors(df, self.by, keep, out)


def vectors(df: DataFrame, by: Design, keep: Sequence[str], out: str = "design") -> DataFrame:
    rows, plain, names = by.rows(df, {c: F.col(c) for c in keep}), by.plain(), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = plain.matrix(b)
            ends = pa.array(np.arange(b.num_rows + 1) * x.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], [*names, out])

    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
    return rows.mapInArrow(run, kept + f", `{out}` array<double>")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for v, y, f in zip(*(b.column(c).to_pylist() for c in ("v", "y", "fold"))):
            yield np.frombuffer(v).reshape(-1, width), np.frombuffer(y), np.frombuffer(f, np.int32)


def fourier_folds(train: DataFrame, folds: Sequence[int], gamma: float, n_components: int, seed: int = 7, label: str = "total", fold: str = "fold",
                  columns: Sequence[str] | None = None, learn: Column | None = None) -> FourierFolds:
    """Each fold's map, fitted on the rows of the other folds that meet ``learn``."""
    ensure_checkpoint_dir(train.sparkSession)
    folds = list(folds)
    data = (train if learn is None else train.where(learn)).where(F.col(label).isNotNull())
    by = design(train, label, columns=columns, whole=True)
    parts, slots, d = moments(data, by, label, fold), _slots(by), len(by.names)
    maps, counts = [], []
    for f in folds:
        others = {g: m for g, m in parts.items() if g != f}
        if not others:
            raise ValueError(f"no rows to learn from without fold {f}")
        m = total(others)
        sd, mean = m.deviation[:-1], m.mean[:-1]
        sd = np.where(sd > 1e-12 * np.maximum(1.0, np.abs(mean)), sd, 0.0)
        place, k = np.full(d, -1), 0  # a column's row of the draws
        for j in range(len(by.numeric)):
            if sd[j] > 0:
                place[j], k = k, k + 1
        for levels in slots:
            for j, null in levels:
                if not null and mean[j] > 0:
                    place[j], k = k, k + 1
                elif null:
                    place[j] = k
            k += 1
        w, b = draws(k, gamma, n_components, seed)
        turn, use = np.zeros((d, n_components)), (place >= 0) & (sd > 0)
        turn[use] = w[place[use]] / sd[use, None]
        maps.append(Fourier(turn, b - mean @ turn, np.ones(n_components)))
        counts.append(m.n)
    flat = vectors(data.withColumn("__y", F.col(label).cast("double")).withColumn("__f", F.col(fold).cast("int")), by, ("__y", "__f"))
    packed = (flat.select(F.col("design").alias("v"), F.col("__y").alias("y"), F.col("__f").alias("fold"))
              .mapInArrow(_packed, "v binary, y binary, fold binary").checkpoint().persist())

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for x, _, f in _blocks(batches, d):
            for i, m in enumerate(maps):
                z = m.plain(x[f != folds[i]])
                yield i, np.concatenate([z.sum(axis=0), (z * z).sum(axis=0)])

    for i, v in summed(packed, sizes).items():
        s, q = v.reshape(2, -1)
        var = np.maximum(q - s * s / counts[i], 0.0) / max(counts[i] - 1, 1.0)
        maps[i].size = np.sqrt(np.where(var > 1e-14 * q / counts[i], var, 0.0))
    return FourierFolds(by, folds, maps, counts, packed)


@dataclass
class _Huber:
    """A fold's state: the best solution and its loss, the step tried from it, and the solution to look at next."""

    w: np.ndarray
    scale: float
    loss: float = np.inf
    step: np.ndarray | None = None
    share: float = 1.0

    @property
    def next(self) -> tuple[np.ndarray, float]:
        return (self.w, self.scale) if self.step is None else (self.w + self.share * self.step[:-1], self.scale + self.share * float(self.step[-1]))


def fit_huber_folds(data: FourierFolds, reg: float, epsilon: float = 1.35, passes: int = PASSES) -> tuple[Machines, list[float], list[float]]:
    """Each fold's least loss ``mean((scale + H(r / scale) * scale) / 2) + reg / 2 * |w|^2`` (the weights of the maps' scaled columns, the constant
    is free), H(z) being z^2 up to ``epsilon`` and linear above. Returns the models, their scales and losses."""
    maps, folds, counts = data.maps, data.folds, data.counts
    width, d = maps[0].width, maps[0].dimension
    ridge = np.ones(d)
    ridge[-1] = 0.0

    def sums(at: dict[int, tuple[np.ndarray, float]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
            for x, y, f in _blocks(batches, width):
                for i, (w, scale) in at.items():
                    use = f != folds[i]
                    z = maps[i](x[use])
                    r = y[use] - z @ w
                    far = np.abs(r) > epsilon * scale
                    near = np.where(far, 0.0, r)
                    q = z[~far].astype(np.float32)  # the curvature alone: it gives the step, the slope and the loss say when it is the last
                    yield i, np.concatenate([[far.sum(), near @ near, np.abs(r[far]).sum()], z.T @ near, z.T @ np.where(far, np.sign(r), 0.0), (q.T @ q).astype(np.float64).ravel()])

        return run

    def begun(rows: DataFrame) -> tuple[dict[int, _Huber], dict[int, float]]:
        """Least squares to begin with, and the rows of each fold's fit."""
        state, many = {}, {}
        for i, v in summed(rows, sums({i: (np.zeros(d), np.inf) for i in range(len(maps))})).items():
            u, gram = v[3:3 + d], v[3 + 2 * d:].reshape(d, d)
            n = many[i] = float(gram[-1, -1])  # the column of ones
            spread = max(np.sqrt(max(v[1] / n - (u[-1] / n) ** 2, 0.0)), LEAST) if n else LEAST
            w = np.linalg.solve(gram + np.diag(n * reg * spread * ridge + 1e-9), u)
            state[i] = _Huber(w, max(float(np.sqrt(max(v[1] - 2 * w @ u + w @ gram @ w, 0.0) / max(n, 1.0))), LEAST))
        return state, many

    def settled(rows: DataFrame, state: dict[int, _Huber], many: dict[int, float]) -> None:
        todo = list(state)
        for _ in range(passes):
            found = summed(rows, sums({i: state[i].next for i in todo}))
            for i in list(todo):
                s, n, v = state[i], many[i], found[i]
                (w, scale), (far, near, away) = s.next, v[:3]
                u, g, gram = v[3:3 + d], v[3 + d:3 + 2 * d], v[3 + 2 * d:].reshape(d, d)
                loss = 0.5 * (n * scale + near / scale + 2 * epsilon * away - epsilon ** 2 * scale * far) + 0.5 * n * reg * float((ridge * w) @ w)
                if loss > s.loss:  # the step was too long
                    s.share /= 4
                    if s.share < 1e-6:
                        todo.remove(i)
                    continue
                s.w, s.scale, s.loss, s.share = w, scale, loss, 1.0
                slope = np.append(-u / scale - epsilon * g + n * reg * ridge * w, 0.5 * (n - near / scale ** 2 - epsilon ** 2 * far))
                curve = np.zeros((d + 1, d + 1))
                curve[:d, :d] = gram / scale + np.diag(n * reg * ridge + 1e-9 * n)
                curve[:d, d] = curve[d, :d] = u / scale ** 2
                curve[d, d] = near / scale ** 3 + 1e-9 * n / scale
                s.step = -np.linalg.solve(curve, slope)
                if s.scale + s.step[-1] < s.scale / 4:  # the scale stays positive
                    s.share = float(-0.75 * s.scale / s.step[-1])
                if -float(slope @ s.step) <= PROMISE * abs(loss) or (s.scale <= LEAST and s.step[-1] < 0):
                    todo.remove(i)
            if not todo:
                break

    state: dict[int, _Huber] = {}
    if min(counts) >= WARM:
        some = data.packed.where(F.pmod(F.xxhash64("y", "fold"), F.lit(PART)) == 0)
        state, many = begun(some)
        if len(state) == len(maps) and min(many.values()) >= 10 * d:
            settled(some, state, many)
            state = {i: _Huber(s.w, s.scale) for i, s in state.items()}
        else:
            state = {}
    if not state:
        state, _ = begun(data.packed)
    settled(data.packed, state, dict(enumerate(counts)))
    each = [state[i] for i in range(len(maps))]
    models = Machines([Machine(i, out=f) for i, f in enumerate(folds)], maps, [s.w for s in each], [[] for _ in each])
    return models, [s.scale for s in each], [s.loss / n for s, n in zip(each, counts)]


@dataclass
class _Hinge:
    """A machine's state: the best solution and its loss, the step tried from it, and the place among ``BANDS``."""

    w: np.ndarray
    loss: float = np.inf
    step: np.ndarray | None = None
    share: float = 1.0
    band: int = 0


def fit_class_folds(data: FourierFolds, classes: dict[int, list[float]], reg: float, passes: int = PASSES) -> tuple[Machines, list[float]]:
    """One machine for each fold and each of its ``classes`` (that class against all others), with the loss of ``LinearSVC(regParam=reg)``,
    ``mean(max(0, 1 - t f)) + reg / 2 * |w|^2`` on the maps' scaled columns (the constant is free). Newton steps on the hinge with its kink as a
    parabola, whose width (``BANDS``) narrows as the steps settle: only rows in the band count in a matrix. Returns the models and their losses."""
    maps, folds, counts = data.maps, data.folds, data.counts
    width, d = maps[0].width, maps[0].dimension
    every = [Machine(i, "class", 1.0 / (reg * counts[i]), 0.0, f, float(c)) for i, f in enumerate(folds) for c in classes[f]]
    ridge = np.ones(d)
    ridge[-1] = 0.0

    def loss(z: np.ndarray, band: float) -> np.ndarray:
        return np.where(z >= band, z, np.where(z > -band, (z + band) ** 2 / (4 * band), 0.0))

    def sums(at: dict[int, tuple[np.ndarray, np.ndarray | None, float, float]]):
        """For each machine's base, step, share and band: its losses at ``TRIES`` of the share, the true loss, slope and curvature at the share."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
            for x, y, f in _blocks(batches, width):
                for i in range(len(maps)):
                    mine = [j for j in at if every[j].kernel == i]
                    if not mine:
                        continue
                    use = f != folds[i]
                    phi, label = maps[i](x[use]), y[use]
                    base = phi @ np.stack([at[j][0] for j in mine], axis=1)
                    move = phi @ np.stack([np.zeros(d) if at[j][1] is None else at[j][1] for j in mine], axis=1)
                    for k, j in enumerate(mine):
                        _, _, share, band = at[j]
                        t = np.where(label == every[j].positive, 1.0, -1.0)
                        tries = [loss(1 - t * (base[:, k] + share * s * move[:, k]), band).sum() for s in TRIES]
                        z = 1 - t * (base[:, k] + share * move[:, k])
                        inside = np.abs(z) < band
                        pull = t * np.where(inside, (z + band) / (2 * band), z >= band)
                        q = phi[inside]
                        yield j, np.concatenate([tries, [np.maximum(z, 0.0).sum()], phi.T @ pull, (q.T @ q).ravel() / (2 * band)])

        return run

    state = [_Hinge(np.zeros(d)) for _ in every]
    exact = [np.inf] * len(every)
    todo = list(range(len(every)))
    for _ in range(passes):
        found = summed(data.packed, sums({j: (state[j].w, state[j].step, state[j].share, BANDS[state[j].band][0]) for j in todo}))
        for j in list(todo):
            s, n, v = state[j], counts[every[j].kernel], found[j]
            at = [s.w if s.step is None else s.w + s.share * t * s.step for t in TRIES]
            tries = [x + 0.5 * n * reg * float((ridge * w) @ w) for x, w in zip(v, at)]
            if tries[0] > s.loss:  # the step was too long
                if min(tries) < s.loss:
                    s.share *= TRIES[int(np.argmin(tries))]
                    continue
                settled = True  # no gain in reach: the next band, or done
            else:
                s.w, s.loss = at[0], tries[0]
                exact[j] = float(v[len(TRIES)]) + 0.5 * n * reg * float((ridge * s.w) @ s.w)
                pull, curve = v[len(TRIES) + 1:][:d], v[len(TRIES) + 1 + d:].reshape(d, d)
                slope = n * reg * ridge * s.w - pull
                s.step, s.share = -np.linalg.solve(curve + np.diag(n * reg * ridge + 1e-4 * n), slope), 1.0
                settled = -float(slope @ s.step) <= BANDS[s.band][1] * abs(s.loss)
            if settled and s.band + 1 < len(BANDS):
                s.band, s.loss, s.step, s.share = s.band + 1, np.inf, None, 1.0
            elif settled:
                todo.remove(j)
        if not todo:
            break
    return Machines(every, maps, [s.w for s in state], [[e] for e in exact]), [e / counts[m.kernel] for e, m in zip(exact, every)]
