"""Boosted regression trees of several models in one pass over the rows.

The models of a cross-validation (one for each fold left out), or trials of a search, grow together: a job
reads the binned rows once and serves every model, so ten folds cost about as many jobs as one. Rows are packed in blocks, feature by
feature: bins (one byte each), factors' level numbers as bins for each model, and each model's score, so that a pass compares and counts whole columns.

A tree grows best split first until it has ``splits`` splits. One job sums gradient histograms of the open nodes of all models (partial
sums in each task, added by node and block of features, where the best split of each is found); only those splits
reach the driver. The nodes that the next splits may need are opened together, so a tree takes about as many jobs as it has levels. Then
one job re-estimates the leaves by the loss: the mean for squared loss, the median for absolute loss, the location of the t-distribution
for its loss, each from sums over narrow bins of the leaf's residuals.

The trees of one model follow one from the other, so a job for each level of each tree costs thousands of jobs, whatever the rows. Where the packed rows
of a single model are no more than a partition (``ALONE`` bytes), one task therefore grows all its trees: the same bags, bins, splits and leaves. More rows than that, or
more models, share jobs as above.

Scores are those of the last checkpoint plus the trees since; every ``RENEW`` trees they are written anew into
``spark.checkpoint.dir``, so a lost executor costs a task and never the boosting so far. Trees are kept as
flat arrays of nodes, and scoring goes through all of them in one pass over the rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .design import NON_FEATURES, split_columns
from .levels import dictionary, level_table, with_level_numbers

#: Bins of a feature, features of a block of histograms, trees between checkpoints of the scores.
BINS, BLOCK, RENEW = 64, 32, 5
#: Residual bins: relative width, and size up to which a residual counts as 0.
WIDTH, NIL = 0.001, 1e-9
#: Rows of a packed block at most, and pieces of a leaf's sums that are held before they are added up.
PACK, PIECES = 8192, 16
#: Bytes of a model's binned rows up to which one task grows its trees, and rows counted at a time there.
ALONE, STEP = 128 << 20, 4096
#: Rows of a partition at least, and sums (node by block) of a reducing task at least: less is not worth a task.
ROWS, SUMS = 4000, 24

LOSSES = ("gaussian", "laplace", "tdist")


@dataclass(frozen=True)
class Spec:
    """Settings of one model; ``out`` is the fold whose rows it does not learn from (-1: none)."""

    trees: int = 100
    shrinkage: float = 0.1
    bagfrac: float = 0.5
    splits: int = 3
    minobsinnode: int = 5
    loss: str = "gaussian"
    df: float = 8.0
    out: int = -1
    seed: int = 551724


@dataclass
class Trees:
    """Nodes of all trees one after the other; a node goes left where its feature's bin is at most ``cut``. ``feature`` is -1 at leaves."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def plus(self, nodes: list[dict]) -> "Trees":
        n = len(self.feature)
        at = lambda k: np.array([x.get(k, -1) for x in nodes])
        move = lambda v: np.where(v >= 0, v + n, -1).astype(np.int32)
        return Trees(np.concatenate([self.feature, at("feature").astype(np.int32)]), np.concatenate([self.cut, np.maximum(at("cut"), 0).astype(np.uint8)]),
                     np.concatenate([self.left, move(at("left"))]), np.concatenate([self.right, move(at("right"))]),
                     np.concatenate([self.value, np.array([x.get("value", 0.0) for x in nodes])]), np.append(self.roots, np.int32(n)))

    def nodes(self, columns: Sequence[np.ndarray], n: int, tree: int = 0) -> np.ndarray:
        """The node of ``tree``, counted from its root, that each of ``n`` rows ends in; ``columns`` gives each feature's bins."""
        lo = int(self.roots[tree])
        hi = int(self.roots[tree + 1]) if tree + 1 < len(self.roots) else len(self.feature)
        at = np.zeros(n, np.int16)
        for i in range(lo, hi):  # a node stands after its parent
            f = self.feature[i]
            if f >= 0:
                here, go = at == i - lo, columns[f] <= self.cut[i]
                np.copyto(at, np.int16(self.left[i] - lo), where=here & go)
                np.copyto(at, np.int16(self.right[i] - lo), where=here & ~go)
        return at

    def score(self, columns: Sequence[np.ndarray], n: int) -> np.ndarray:
        out = np.zeros(n)
        for t, lo in enumerate(self.roots):
            hi = self.roots[t + 1] if t + 1 < len(self.roots) else len(self.feature)
            out += self.value[lo:hi][self.nodes(columns, n, t)]
        return out


def gradient(loss: str, u: np.ndarray, df: float) -> np.ndarray:
    """Negative gradient of the loss at residuals ``u``."""
    if loss == "gaussian":
        return u
    if loss == "laplace":
        return np.where(np.abs(u) <= NIL, 0.0, np.sign(u))
    return (df + 1.0) * u / (df + u * u)


def location(loss: str, x: np.ndarray, weight: np.ndarray, df: float) -> float:
    """What a leaf adds: weighted mean, lower weighted median, or location of the t-distribution (weights renewed
    from the median on until the location stays)."""
    total = weight.sum()
    if total <= 0:
        return 0.0
    if loss == "gaussian":
        return float((x * weight).sum() / total)
    order = np.argsort(x, kind="stable")
    middle = float(x[order][np.searchsorted(np.cumsum(weight[order]), total / 2)])
    if loss == "laplace":
        return middle
    for _ in range(100):
        w = weight / (df + (x - middle) ** 2)
        new = float((w * x).sum() / w.sum())
        if abs(new - middle) <= 1e-10 * max(1.0, abs(middle)):
            return new
        middle = new
    return middle


def uniform(h: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number from 0 to 1 for each row: follows from its key's hash, the seed and the tree alone."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1B54A32D192ED03) & (2 ** 64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def drawn(h: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Whether each row is in a tree's bag."""
    return uniform(h, seed, tree) < share


class Rows:
    """A packed block of binned rows: features stand one after the other, each with the bins of all rows."""

    def __init__(self, models: int, n: int, h: bytes, y: bytes, fold: bytes, x: bytes, z: bytes, f: bytes) -> None:
        self.n, self.h, self.y, self.fold = n, np.frombuffer(h, np.int64), np.frombuffer(y), np.frombuffer(fold, np.int32)
        self.x, self.z = np.frombuffer(x, np.uint8).reshape(-1, n), np.frombuffer(z, np.uint8).reshape(models, -1, n)
        self.f = np.frombuffer(f).reshape(models, n)
        self.bags: dict[tuple, np.ndarray] = {}

    def of(self, m: int) -> list[np.ndarray]:
        return [*self.x, *self.z[m]]

    def active(self, spec: Spec, tree: int) -> np.ndarray:
        """Whether each row is learned from."""
        use = self.fold != spec.out
        if tree >= 0 and spec.bagfrac < 1.0:
            which = (spec.seed, spec.bagfrac)  # a job is about one tree
            if which not in self.bags:
                self.bags[which] = drawn(self.h, spec.seed, tree, spec.bagfrac)
            use = use & self.bags[which]
        return use


PACKED = "n int, h binary, y binary, fold binary, x binary, z binary, f binary"


def _blocks(b: pa.RecordBatch, models: int) -> Iterator[Rows]:
    for v in zip(*(b.column(c).to_pylist() for c in ("n", "h", "y", "fold", "x", "z", "f"))):
        yield Rows(models, *v)


def _row(*v) -> pa.RecordBatch:
    types = [pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(v, types)], ["n", "h", "y", "fold", "x", "z", "f"])


def _pack(models: int):
    """Binned rows as packed blocks, with scores of 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in batches:
            for lo in range(0, every.num_rows, PACK):
                b = every.slice(lo, PACK)
                n = b.num_rows
                h, y, fold = (b.column(c).to_numpy().astype(t).tobytes() for c, t in (("h", np.int64), ("y", np.float64), ("fold", np.int32)))
                x, z = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8) for c in ("x", "z"))
                x, z = x.reshape(n, -1).T, z.reshape(n, models, -1).transpose(1, 2, 0)
                yield _row(n, h, y, fold, np.ascontiguousarray(x).tobytes(), np.ascontiguousarray(z).tobytes(), np.zeros((models, n)).tobytes())

    return run


@dataclass
class Boosted:
    """Fitted models: where features are cut into bins, the factors' levels, each model's first value and trees, and the
    share of each feature in the splits' improvement."""

    specs: list[Spec]
    numeric: list[str]
    factors: list[str]
    edges: list[np.ndarray]
    levels: DataFrame | None
    widths: np.ndarray
    first: list[float]
    trees: list[Trees]
    gains: list[dict[str, float]]

    def binned(self, df: DataFrame, keep: dict[str, Column]) -> DataFrame:
        """(keep..., x, z): ``df``'s features as bins."""
        m = len(self.specs)
        if self.factors:
            df = with_level_numbers(df, self.levels, self.factors, m)
        numbers = F.concat(*[F.col(c + "__no") for c in self.factors]) if self.factors else F.array().cast("array<double>")
        rows = df.select(*[c.alias(n) for n, c in keep.items()],
                         F.array(*[F.col(f"`{c}`").cast("double") for c in self.numeric]).cast("array<double>").alias("num"), numbers.alias("lev"))
        edges, widths, names = self.edges, self.widths, list(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                num = b.column("num").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, len(edges))
                x = np.zeros(num.shape, np.uint8)
                for j, e in enumerate(edges):
                    x[:, j] = np.searchsorted(e, num[:, j], side="left")
                lev = b.column("lev").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1, m)
                z = np.floor(lev * np.minimum(1.0, (BINS - 1) / np.maximum(widths, 1.0))).astype(np.int64) + 1
                z = z.clip(0, BINS - 1).astype(np.uint8).transpose(0, 2, 1)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array([r.tobytes() for r in x], pa.binary()),
                                                  pa.array([np.ascontiguousarray(r).tobytes() for r in z], pa.binary())], [*names, "x", "z"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", x binary, z binary")

    def predict(self, df: DataFrame, model: Column | int = 0, keep: Sequence[str] = ("account_id",)) -> DataFrame:
        """(keep..., prediction): the score of each row by the model whose number ``model`` gives (null prediction where it gives none)."""
        which = F.lit(model) if isinstance(model, int) else model
        rows = self.binned(df, {c: F.col(c) for c in keep} | {"__m": which.cast("int")})
        m, names = len(self.specs), list(keep)
        # nodes by trees and splits, whatever the rows; plain values, as a task need not have this package installed
        send = df.sparkSession.sparkContext.broadcast((self.first, [vars(t) for t in self.trees]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, trees = send.value[0], [Trees(**t) for t in send.value[1]]
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(n, -1)
                z = np.frombuffer(b"".join(b.column("z").to_pylist()), np.uint8).reshape(n, m, -1)
                at = b.column("__m").fill_null(-1).to_numpy()
                out = np.full(n, np.nan)
                for i in np.unique(at[(at >= 0) & (at < m)]):
                    use = np.flatnonzero(at == i)
                    for lo in range(0, len(use), 4096):
                        some = use[lo:lo + 4096]
                        out[some] = first[i] + trees[i].score([*np.ascontiguousarray(x[some].T), *np.ascontiguousarray(z[some, i].T)], len(some))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(out, mask=np.isnan(out))], [*names, "prediction"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", prediction double")

    def influence(self, model: int = 0) -> list[tuple[str, float]]:
        """(feature, share in %) by falling share of the improvement that the splits on it made."""
        total = sum(self.gains[model].values()) or 1.0
        return sorted(((n, 100.0 * g / total) for n, g in self.gains[model].items()), key=lambda v: (-v[1], v[0]))


@dataclass
class _Growing:
    """A tree while it grows: nodes as dicts (feature, cut, left, right; n, s; known, gain, best)."""

    nodes: list[dict]

    def chosen(self, splits: int) -> tuple[list[int], bool]:
        """Nodes to split, best first, and whether all that this needs is known."""
        done, heap = [], [(-self.nodes[0]["gain"], 0)] if self.nodes[0].get("known") else []
        if not heap:
            return [], False
        while heap and len(done) < splits:
            gain, at = heapq.heappop(heap)
            if -gain <= 0:
                break
            done.append(at)
            if len(done) == splits:
                break
            kids = [self.nodes[at].get("left", -1), self.nodes[at].get("right", -1)]
            if any(k < 0 or not self.nodes[k].get("known") for k in kids):
                return done, False
            for k in kids:
                heapq.heappush(heap, (-self.nodes[k]["gain"], k))
        return done, True

    def open(self, splits: int, minobs: int) -> list[int]:
        """Children of the nodes that may be split next, opened: their numbers."""
        done, _ = self.chosen(splits)
        tops = sorted((i for i, x in enumerate(self.nodes) if x.get("known") and "left" not in x and x["gain"] > 0),
                      key=lambda i: (-self.nodes[i]["gain"], i))[:max(1, splits - len(done) + 1)]
        new = []
        for i in tops:
            self.split(i)
            for k in (self.nodes[i]["left"], self.nodes[i]["right"]):
                if self.nodes[k]["n"] < 2 * minobs:  # cannot be split
                    self.nodes[k] |= {"known": True, "gain": 0.0}
                else:
                    new.append(k)
        return new

    def split(self, i: int) -> None:
        x = self.nodes[i]
        f, c, nl, sl = x["best"]
        x |= {"feature": f, "cut": c, "left": len(self.nodes), "right": len(self.nodes) + 1}
        self.nodes += [{"n": nl, "s": sl}, {"n": x["n"] - nl, "s": x["s"] - sl}]

    def final(self, splits: int) -> list[dict]:
        """The tree with the chosen splits alone."""
        done = set(self.chosen(splits)[0])
        for i in done:
            if "left" not in self.nodes[i]:
                self.split(i)
        out: list[dict] = []

        def copy(i: int) -> int:
            at = len(out)
            out.append({"n": self.nodes[i].get("n", 0), "s": self.nodes[i].get("s", 0.0)})
            if i in done:
                out[at] |= {k: self.nodes[i][k] for k in ("feature", "cut", "gain")}
                out[at]["left"] = copy(self.nodes[i]["left"])
                out[at]["right"] = copy(self.nodes[i]["right"])
            return at

        copy(0)
        return out


def _flat(nodes: list[dict]) -> Trees:
    return Trees().plus(nodes)


def _flat_all(trees: list[list[dict]]) -> Trees:
    each = [_flat(nodes) for nodes in trees]
    starts = np.cumsum([0, *[len(t.feature) for t in each]])[:-1]
    move = lambda v, n: np.where(v >= 0, v + n, -1).astype(np.int32)
    if not each:
        return Trees()
    join = lambda k: np.concatenate([getattr(t, k) for t in each])
    return Trees(join("feature"), join("cut"), *(np.concatenate([move(getattr(t, k), n) for t, n in zip(each, starts)]) for k in ("left", "right")),
                 join("value"), starts.astype(np.int32))


def _best_splits(cur: DataFrame, specs: list[Spec], since: list[Trees], open_: dict[int, tuple[Trees, list[int]]], tree: int,
                 parts: int) -> list:
    """Best split of each open node: (model, node, n, s, gain, feature, cut, left n, left s)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for rows in _blocks(b, len(specs)):
                for m, (partial, nodes) in open_.items():
                    columns = rows.of(m)
                    width = len(columns)
                    place = np.full(len(partial.feature), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[partial.nodes(columns, rows.n)]
                    use = np.flatnonzero(rows.active(specs[m], tree) & (at >= 0))
                    if not len(use):
                        continue
                    g = gradient(specs[m].loss, (rows.y - rows.f[m] - since[m].score(columns, rows.n))[use], specs[m].df)
                    if m not in held:
                        held[m] = [np.zeros((width, len(nodes) * BINS)), np.zeros((width, len(nodes) * BINS)), width]
                    base, (n, s, _) = at[use] * BINS, held[m]
                    for j, c in enumerate(columns):
                        cell = base + c[use]
                        n[j] += np.bincount(cell, minlength=n.shape[1])
                        s[j] += np.bincount(cell, weights=g, minlength=n.shape[1])
        for m, (n, s, width) in held.items():
            nodes = open_[m][1]
            n, s = n.reshape(width, len(nodes), BINS), s.reshape(width, len(nodes), BINS)
            out = [(m, node, lo, n[lo:lo + BLOCK, i].tobytes() + s[lo:lo + BLOCK, i].tobytes())
                   for i, node in enumerate(nodes) for lo in range(0, width, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.binary())], ["m", "node", "lo", "v"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            for m, node, lo, v in zip(*(b.column(c).to_pylist() for c in ("m", "node", "lo", "v"))):
                a = np.frombuffer(v, dtype=np.float64)
                held[m, node, lo] = held[m, node, lo] + a if (m, node, lo) in held else a
        out = []
        for (m, node, lo), a in held.items():
            n, s = a.reshape(2, -1, BINS)
            total, sum_ = n[0].sum(), s[0].sum()
            nl, sl = np.cumsum(n, axis=1), np.cumsum(s, axis=1)
            nr, sr = total - nl, sum_ - sl
            least = specs[m].minobsinnode
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((nl >= least) & (nr >= least) & (nl > 0) & (nr > 0), sl * sl / nl + sr * sr / nr - sum_ * sum_ / total, 0.0)
            f, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
            out.append((m, node, int(total), float(sum_), float(gain[f, c]), int(lo + f), int(c), int(nl[f, c]), float(sl[f, c])))
        if out:
            types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], list("abcdefghi"))

    got = cur.mapInArrow(sums, "m int, node int, lo int, v binary").repartition(max(1, min(parts, sum(len(w) for _, w in open_.values()) // SUMS)), "m", "node", "lo")
    return got.mapInArrow(best, "a int, b int, c long, d double, e double, f int, g int, h long, i double").collect()


def _leaf_values(cur: DataFrame, specs: list[Spec], since: list[Trees], trees: dict[int, Trees], tree: int, parts: int) -> dict[tuple[int, int], float]:
    """By (model, node): what each leaf of the new trees adds, before shrinkage."""
    def added(pieces: list[tuple]) -> tuple:
        c, inv = np.unique(np.concatenate([x[0] for x in pieces]), return_inverse=True)
        return c, *(np.bincount(inv, weights=np.concatenate([x[k] for x in pieces])) for k in (1, 2))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for b in batches:
            for rows in _blocks(b, len(specs)):
                for m, t in trees.items():
                    use = np.flatnonzero(rows.active(specs[m], tree))
                    if not len(use):
                        continue
                    columns = rows.of(m)
                    u = (rows.y - rows.f[m] - since[m].score(columns, rows.n))[use]
                    cell = (np.sign(u) * np.ceil(np.log(np.maximum(np.abs(u) / NIL, 1.0)) / WIDTH)).astype(np.int64)
                    at = t.nodes(columns, rows.n)[use]
                    for node in np.unique(at):
                        mine = at == node
                        c, inv = np.unique(cell[mine], return_inverse=True)
                        pieces = held.setdefault((m, int(node)), [])
                        pieces.append((c, np.bincount(inv), np.bincount(inv, weights=u[mine])))
                        if len(pieces) > PIECES:
                            pieces[:] = [added(pieces)]
        out = [(m, node, np.concatenate([x.astype(np.float64) for x in added(v)]).tobytes()) for (m, node), v in held.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.binary())], ["m", "node", "v"])

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for b in batches:
            for m, node, v in zip(*(b.column(c).to_pylist() for c in ("m", "node", "v"))):
                new = np.frombuffer(v, dtype=np.float64).reshape(3, -1)
                if (m, node) in held:
                    both = np.concatenate([held[m, node], new], axis=1)
                    c, inv = np.unique(both[0], return_inverse=True)
                    new = np.stack([c, np.bincount(inv, weights=both[1]), np.bincount(inv, weights=both[2])])
                held[m, node] = new
        out = [(m, node, location(specs[m].loss, v[2] / v[1], v[1], specs[m].df)) for (m, node), v in held.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), [pa.int32(), pa.int32(), pa.float64()])], ["m", "node", "value"])

    got = cur.mapInArrow(sums, "m int, node int, v binary").repartition(max(1, min(parts, len(trees) // SUMS)), "m", "node").mapInArrow(values, "m int, node int, value double")
    return {(r.m, r.node): r.value for r in got.collect()}


def _grow(rows: list[Rows], spec: Spec, first: float) -> Iterator[list[dict]]:
    """The nodes of each tree of the first model, grown from all its ``rows``."""
    width = rows[0].x.shape[0] + rows[0].z.shape[1]
    size, n = width * BINS, sum(r.n for r in rows)
    cells, at = np.empty((n, width), np.uint16 if size <= 1 << 16 else np.uint32), 0  # a row's places in a histogram
    for r in rows:
        cells[at:at + r.n] = np.concatenate([r.x, r.z[0]]).T
        at += r.n
    cells += (np.arange(width) * BINS).astype(cells.dtype)
    h, y, fold = (np.concatenate([getattr(r, k) for r in rows]) for k in ("h", "y", "fold"))
    order = np.argsort(h, kind="stable")  # sums do not hang on how rows arrive
    cells, h, y, use, f = cells[order], h[order], y[order], fold[order] != spec.out, np.full(n, first)

    def sums(idx: np.ndarray, g: np.ndarray) -> np.ndarray:
        out = np.zeros((2, size))
        for lo in range(0, len(idx), STEP):
            c = cells[idx[lo:lo + STEP]].ravel().astype(np.intp)
            out[0] += np.bincount(c, minlength=size)
            out[1] += np.bincount(c, np.repeat(g[idx[lo:lo + STEP]], width), size)
        return out

    def known(node: dict, idx: np.ndarray, held: np.ndarray) -> dict:
        """The node with its best split, as ``_best_splits`` finds it."""
        n, s = held.reshape(2, width, BINS)
        total, sum_ = n[0].sum(), s[0].sum()
        nl, sl = np.cumsum(n, axis=1), np.cumsum(s, axis=1)
        nr, sr = total - nl, sum_ - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((nl >= spec.minobsinnode) & (nr >= spec.minobsinnode) & (nl > 0) & (nr > 0), sl * sl / nl + sr * sr / nr - sum_ * sum_ / total, 0.0)
        j, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
        top = float(gain[j, c])
        return node | {"n": int(total), "s": float(sum_), "known": True, "gain": top if top > 1e-12 * max(1.0, abs(sum_)) else 0.0,
                       "best": (int(j), int(c), int(nl[j, c]), float(sl[j, c])), "idx": idx, "held": held}

    def goes_left(idx: np.ndarray, node: dict) -> np.ndarray:
        return cells[idx, node["feature"]] <= node["feature"] * BINS + node["cut"]

    def leaf(u: np.ndarray) -> float:
        if not len(u):
            return 0.0
        cell = (np.sign(u) * np.ceil(np.log(np.maximum(np.abs(u) / NIL, 1.0)) / WIDTH)).astype(np.int64)
        cell -= cell.min()
        many = np.bincount(cell)
        some = np.flatnonzero(many)
        return location(spec.loss, np.bincount(cell, u)[some] / many[some], many[some].astype(np.float64), spec.df)

    for t in range(spec.trees):
        idx = np.flatnonzero(use & drawn(h, spec.seed, t, spec.bagfrac) if spec.bagfrac < 1.0 else use)
        u = y - f
        g = gradient(spec.loss, u, spec.df)
        tree = _Growing([known({}, idx, sums(idx, g))])
        for left in reversed(range(spec.splits)):
            done, settled = tree.chosen(spec.splits)
            if settled or not done:
                break
            at = done[-1]
            tree.split(at)
            node = tree.nodes[at]
            go, kids = goes_left(node["idx"], node), (node["left"], node["right"])
            parts = [node["idx"][go], node["idx"][~go]]
            need = [len(p) >= 2 * spec.minobsinnode for p in parts] if left else [False, False]  # children of the last split stay leaves
            held: list = [None, None]
            if any(need):
                less = int(len(parts[1]) < len(parts[0]))
                held[less] = sums(parts[less], g)
                held[1 - less] = node["held"] - held[less]
            for k, part, sum_, wanted in zip(kids, parts, held, need):
                tree.nodes[k] = known(tree.nodes[k], part, sum_) if wanted else tree.nodes[k] | {"known": True, "gain": 0.0, "idx": part}
            node["held"] = None
        nodes = tree.final(spec.splits)
        where, bag = {0: np.arange(n)}, {0: idx}
        for i, x in enumerate(nodes):  # a node stands after its parent
            every, mine = where.pop(i), bag.pop(i)
            if "left" in x:
                for held_, part in ((where, every), (bag, mine)):
                    go = goes_left(part, x)
                    held_[x["left"]], held_[x["right"]] = part[go], part[~go]
            else:
                x["value"] = spec.shrinkage * ((x["s"] / x["n"] if x["n"] else 0.0) if spec.loss == "gaussian" else leaf(u[mine]))
                f[every] += x["value"]
        yield nodes


def _grown(cur: DataFrame, spec: Spec, first: float) -> list[list[dict]]:
    """The nodes of all trees of a single model, grown in one task (see ``ALONE``); only they reach the driver."""
    names = ["feature", "cut", "left", "right", "value", "gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in _blocks(b, 1)]
        for t, nodes in enumerate(_grow(rows, spec, first) if rows else []):
            lists = [pa.array([[x.get(k, -1) for x in nodes]], pa.list_(pa.int32())) for k in names[:4]]
            lists += [pa.array([[float(x.get(k, 0.0)) for x in nodes]], pa.list_(pa.float64())) for k in names[4:]]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *lists], ["t", *names])

    shape = "t int, " + ", ".join(f"`{k}` array<{'int' if i < 4 else 'double'}>" for i, k in enumerate(names))
    got = sorted(cur.coalesce(1).mapInArrow(run, shape).collect(), key=lambda r: r.t)
    # inner nodes have children, leaves a value
    return [[{k: v for k, v in zip(names, x) if v != -1 or k in names[4:]} for x in zip(*r[1:])] for r in got]


def prepared(train: DataFrame, specs: list[Spec], label: str, key: str, fold: str, exclude: Sequence[str], bins: int = BINS) -> tuple[Boosted, DataFrame]:
    """Models without trees (edges and levels alone), and the rows to learn from, binned and packed in the checkpoint folder."""
    out = binning(train, specs, label, key, fold, exclude, bins)
    return out, packed(train, out, label, key, fold)


def binning(train: DataFrame, specs: list[Spec], label: str, key: str, fold: str, exclude: Sequence[str], bins: int = BINS) -> Boosted:
    """Models without trees: edges and levels alone."""
    ensure_checkpoint_dir(train.sparkSession)
    numeric, factors = split_columns(train, [*exclude, key, label, fold])
    rows = train.where(F.col(label).isNotNull())
    probs = [i / (bins - 1) for i in range(bins)]
    quantiles = rows.approxQuantile(numeric, probs, 0.001) if numeric else []
    edges = [np.unique(np.array(q, dtype=np.float64))[:bins - 1] for q in quantiles]
    levels, widths = None, np.zeros((len(factors), len(specs)))
    if factors:
        apart = any(s.out >= 0 for s in specs)
        table = level_table(rows, factors, label, [s.out for s in specs] if apart else (), fold)
        if not apart:
            table = table.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(specs) - 1))))
        levels = dictionary(table, len(specs))
        most = levels.groupBy("factor").agg(F.array(*[F.max(F.col("numbers")[i]) for i in range(len(specs))]).alias("n"))
        for r in most.collect():
            widths[factors.index(r.factor)] = np.array(r.n) + 1
    return Boosted(specs, numeric, factors, edges, levels, widths, [0.0] * len(specs), [Trees() for _ in specs], [{} for _ in specs])


def packed(train: DataFrame, by: Boosted, label: str, key: str, fold: str) -> DataFrame:
    """The rows to learn from, binned by ``by`` and packed in the checkpoint folder."""
    rows = train.where(F.col(label).isNotNull())
    keep = {"h": F.xxhash64(F.col(key)), "y": F.col(label).cast("double"), "fold": F.col(fold).cast("int") if fold in train.columns else F.lit(-2)}
    return by.binned(rows, keep).mapInArrow(_pack(len(by.specs)), PACKED).checkpoint()


def fit_boosted(train: DataFrame, specs: Sequence[Spec], label: str = "total", key: str = "account_id", fold: str = "fold",
                exclude: Sequence[str] = NON_FEATURES) -> Boosted:
    """Fit all ``specs`` on ``train`` together: numeric columns as bins at quantiles, text columns as factors of any number of levels.

    A model whose ``out`` is a fold learns from the other folds' rows, levels' order included. Rows with a null label
    are left out; a null number is cut as the largest. ``train`` needs ``fold`` only if a spec names one.
    """
    spark = train.sparkSession
    specs = list(specs)
    for s in specs:
        if s.loss not in LOSSES:
            raise ValueError(s.loss)
    out, cur = prepared(train, specs, label, key, fold, exclude)
    many = cur.agg(F.sum("n")).first()[0] or 0
    cur = cur.coalesce(max(1, many // ROWS)).persist()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [*out.numeric, *out.factors]

    none = [Trees() for _ in specs]
    start = _leaf_values(cur, specs, none, {m: _flat([{}]) for m in range(len(specs))}, -1, parts)
    out.first = [start.get((m, 0), 0.0) for m in range(len(specs))]
    if len(specs) == 1 and many and names and many * len(names) <= ALONE:
        trees = _grown(cur, specs[0], out.first[0])
        for x in (x for nodes in trees for x in nodes if "left" in x):
            out.gains[0][names[x["feature"]]] = out.gains[0].get(names[x["feature"]], 0.0) + x["gain"]
        out.trees[0] = _flat_all(trees)
        cur.unpersist()
        return out
    base, since = list(out.first), [Trees() for _ in specs]
    for t in range(max((s.trees for s in specs), default=0)):
        growing = {m: _Growing([{}]) for m, s in enumerate(specs) if t < s.trees}
        wanted = {m: [0] for m in growing}
        shifted = [Trees(value=np.array([b]), feature=np.array([-1], np.int32), cut=np.zeros(1, np.uint8), left=np.full(1, -1, np.int32),
                         right=np.full(1, -1, np.int32), roots=np.zeros(1, np.int32)) for b in base]
        now = [_joined(a, b) for a, b in zip(shifted, since)]
        while wanted:
            found = _best_splits(cur, specs, now, {m: (_flat(growing[m].nodes), w) for m, w in wanted.items()}, t, parts)
            seen: dict[tuple, tuple] = {}
            for m, node, n, s, gain, f, c, nl, sl in sorted(map(tuple, found)):
                if (m, node) not in seen or gain > seen[m, node][2]:
                    seen[m, node] = (n, s, gain, (f, c, nl, sl))
            for m, w in wanted.items():
                for node in w:
                    n, s, gain, best = seen.get((m, node), (0, 0.0, 0.0, None))
                    growing[m].nodes[node] |= {"known": True, "n": n, "s": s, "gain": gain if gain > 1e-12 * max(1.0, abs(s)) else 0.0, "best": best}
            wanted = {m: w for m in wanted if not growing[m].chosen(specs[m].splits)[1]
                      for w in [_opened(growing[m], specs[m])] if w}
        final = {m: g.final(specs[m].splits) for m, g in growing.items()}
        other = {m: _flat(n) for m, n in final.items() if specs[m].loss != "gaussian"}
        values = _leaf_values(cur, specs, now, other, t, parts) if other else {}
        for m, nodes in final.items():
            for i, x in enumerate(nodes):
                if "left" in x:
                    name = names[x["feature"]]
                    out.gains[m][name] = out.gains[m].get(name, 0.0) + x["gain"]
                else:
                    leaf = values.get((m, i), 0.0) if m in other else (x["s"] / x["n"] if x["n"] else 0.0)
                    x["value"] = specs[m].shrinkage * leaf
            out.trees[m] = out.trees[m].plus(nodes)
            since[m] = since[m].plus(nodes)
        if (t + 1) % RENEW == 0:
            new = _renewed(cur, len(specs), [_joined(a, b) for a, b in zip(shifted, since)])
            cur.unpersist()
            cur, since, base = new, [Trees() for _ in specs], [0.0] * len(specs)
    cur.unpersist()
    return out


def _opened(g: _Growing, spec: Spec) -> list[int]:
    """Open nodes until some need a job or the tree is settled."""
    while not g.chosen(spec.splits)[1]:
        new = g.open(spec.splits, spec.minobsinnode)
        if new:
            return new
    return []


def _joined(a: Trees, b: Trees) -> Trees:
    n = len(a.feature)
    move = lambda v: np.where(v >= 0, v + n, -1).astype(np.int32)
    return Trees(np.concatenate([a.feature, b.feature]), np.concatenate([a.cut, b.cut]), np.concatenate([a.left, move(b.left)]),
                 np.concatenate([a.right, move(b.right)]), np.concatenate([a.value, b.value]), np.concatenate([a.roots, (b.roots + n).astype(np.int32)]))


def _renewed(cur: DataFrame, models: int, since: list[Trees]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for v, rows in zip(zip(*(b.column(c).to_pylist() for c in ("n", "h", "y", "fold", "x", "z"))), _blocks(b, models)):
                yield _row(*v, np.stack([rows.f[m] + since[m].score(rows.of(m), rows.n) for m in range(models)]).tobytes())

    return cur.mapInArrow(run, PACKED).checkpoint().persist()
