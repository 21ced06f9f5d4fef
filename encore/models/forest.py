"""Random forests of several models (one for each fold left out) grown together, a level of many trees in each pass over the rows.

Rows are binned and packed once (see ``boosting``): numbers at quantiles, factors by level. A tree's bag is a Poisson draw for each row that follows
from the key's hash, the seed and the tree's number, and each node looks at its own draw of a third of the features. Trees of a number that belong to different models have
the same bag and look at the same features, so that rows go down their common ways once: a node that several models reach by equal splits is summed by fold, and
each model takes the folds that it learns from. (Levels have one number for all models meanwhile, unless a factor has more levels than bins.) A job sums the histograms of the
open nodes of as many trees as fit ``HELD``; Spark adds them by tree, finds each node's best split, and only those splits reach the
driver. A split sends a set of bins to the left: those up to a cut of a number, or the levels of smallest mean label in the node of a factor.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boosting import BINS, ROWS, Boosted, Rows, Spec, _blocks, binning, packed, prepared, uniform  # noqa: F401
from .design import NON_FEATURES

#: Bins of a number (more only if a factor needs them), bytes of histograms that a task holds, rows of a partition at most.
LEAST, HELD, MOST = 32, 48 << 20, 200_000
#: Rows counted at a time, and what a draw adds to a number that holds draws and labels.
TOGETHER, UNIT = 65536, 2.0 ** 31
#: Chances of at most 0, 1, 2... draws of a row in a bag.
POISSON = np.cumsum([math.exp(-1.0) / math.factorial(i) for i in range(12)])


def bag(h: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree's bag holds each row."""
    return np.searchsorted(POISSON, uniform(h, seed, tree), side="right").astype(np.uint8)


def one_numbering(base: Boosted) -> tuple[Boosted, list[np.ndarray]] | None:
    """``base`` with a single number for each level of a factor, whatever the model, and for each factor the models' bins of these bins (models by
    bins); None if a factor has more levels than bins."""
    if not base.factors:
        return Boosted([Spec()], base.numeric, [], base.edges, None, np.zeros((0, 1)), [0.0], base.trees[:1], [{}]), []
    many = {r.factor: int(r["count"]) for r in base.levels.groupBy("factor").count().collect()}
    if max(many.values(), default=0) >= BINS:
        return None
    place = F.row_number().over(Window.partitionBy("factor").orderBy("level")) - 1  # fewer levels than bins
    levels = base.levels.withColumn("at", place.cast("double")).checkpoint()
    to = [np.zeros((len(base.specs), BINS), np.int64) for _ in base.factors]
    for r in levels.collect():
        to[base.factors.index(r.factor)][:, int(r["at"]) + 1] = np.array(r.numbers, dtype=np.int64) + 1
    widths = np.array([[many.get(c, 0)] for c in base.factors], dtype=np.float64)
    return Boosted([Spec()], base.numeric, base.factors, base.edges, levels.select("factor", "level", F.array("at").alias("numbers")), widths, [0.0], base.trees[:1], [{}]), to


@dataclass
class Node:
    """A place in the trees of several models that all took the same ways there: the models whose node is open (each with its place among the model's
    open nodes), and the splits that go on: (feature, bins that go left) -> nodes on the left and on the right."""

    draw: int = -1
    open: list[tuple[int, int]] = field(default_factory=list)
    splits: dict[tuple[int, int], list["Node | None"]] = field(default_factory=dict)

    def leaves(self) -> Iterator["Node"]:
        if self.open:
            yield self
        for kids in self.splits.values():
            for k in kids:
                if k is not None:
                    yield from k.leaves()


def ways(open_: dict[int, np.ndarray], feature: np.ndarray, mask: np.ndarray, level: int) -> Node:
    """The open nodes of one tree number (by model) as common ways from the root; ``feature`` and ``mask`` are the models' nodes."""
    root = Node()
    for m, nodes in open_.items():
        for at, place in enumerate(nodes.tolist()):
            cur, i = root, 0
            for step in range(level - 1, -1, -1):
                side = place >> step & 1
                kids = cur.splits.setdefault((int(feature[m, i]), int(mask[m, i])), [None, None])
                if kids[side] is None:
                    kids[side] = Node()
                cur, i = kids[side], 2 * i + 1 + side
            cur.draw = place
            cur.open.append((m, at))
    return root


@dataclass
class Columns:
    """Rows of some packed blocks: bins of one numbering, feature by feature."""

    flat: np.ndarray
    n: int
    h: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    @staticmethod
    def of(blocks: list[Rows], z: int) -> "Columns":
        x = np.concatenate([np.concatenate([r.x, r.z[z]]) for r in blocks], axis=1)
        return Columns(x.ravel(), x.shape[1], *(np.concatenate([getattr(r, k) for r in blocks]) for k in ("h", "y", "fold")))


def some_blocks(batches: Iterator[pa.RecordBatch], models: int) -> Iterator[list[Rows]]:
    """Blocks of ``TOGETHER`` rows or a little more."""
    held, n = [], 0
    for b in batches:
        for r in _blocks(b, models):
            held, n = [*held, r], n + r.n
            if n >= TOGETHER:
                yield held
                held, n = [], 0
    if held:
        yield held


@dataclass
class Forest:
    """Fitted models: bins and levels (``base``), and of each model's trees each node's feature (-1: leaf), bins that go left, and mean label."""

    base: Boosted
    feature: np.ndarray
    mask: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, df: DataFrame, model: Column | int = 0, keep: Sequence[str] = ("account_id",)) -> DataFrame:
        """(keep..., prediction): the trees' mean for each row by the model whose number ``model`` gives (null where it gives none)."""
        which = F.lit(model) if isinstance(model, int) else model
        rows = self.base.binned(df, {c: F.col(c) for c in keep} | {"__m": which.cast("int")})
        models, names, depth = len(self.base.specs), list(keep), self.depth
        send = df.sparkSession.sparkContext.broadcast((self.feature, self.mask, self.value))  # nodes by trees, whatever the rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feature, mask, value = send.value
            tree = np.arange(feature.shape[1])[None, :]
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(n, -1)
                z = np.frombuffer(b"".join(b.column("z").to_pylist()), np.uint8).reshape(n, models, -1)
                of, out = b.column("__m").fill_null(-1).to_numpy(), np.full(n, np.nan)
                for i in np.unique(of[(of >= 0) & (of < models)]):
                    use = np.flatnonzero(of == i)
                    for lo in range(0, len(use), 512):
                        some = use[lo:lo + 512]
                        bins, row = np.concatenate([x[some], z[some, i]], axis=1).astype(np.uint64), np.arange(len(some))[:, None]
                        at = np.zeros((len(some), feature.shape[1]), np.int64)
                        for _ in range(depth):
                            f = feature[i][tree, at]
                            go = ((mask[i][tree, at] >> bins[row, f]) & np.uint64(1)).astype(np.int64)
                            at = np.where(f < 0, at, 2 * at + 2 - go)
                        out[some] = value[i][tree, at].mean(axis=1)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(out, mask=np.isnan(out))], [*names, "prediction"])

        kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in keep)
        return rows.mapInArrow(run, kept + ", prediction double")


def _splits(cur: DataFrame, outs: Sequence[int], seed: int, open_: dict[tuple[int, int], np.ndarray], roots: dict[int, list[Node]],
            looks: dict[int, np.ndarray], numbers: int, bins: int, parts: int) -> list:
    """Best split of each open node: (model, tree, node, n, s, gain, feature, mask, left n, left s). ``open_`` gives each tree's open nodes as places in
    the level, ``roots`` the ways there (one root, or one for each model where bins differ by model), ``looks`` the features that each node of the level looks at."""
    views = len(next(iter(roots.values())))
    folds = sorted(set(outs))
    # a node that several models share is summed by fold: part 0 for folds that no model leaves out
    learns = np.array([[True, *(f != out for f in folds)] for out in outs])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # (n, s) by feature, part and bin
        both: dict[int, np.ndarray] = {}  # n and s in one number, see UNIT
        every = [(t, v, root, list(root.leaves())) for t, each in roots.items() for v, root in enumerate(each)]
        load = 0.0

        def parted() -> None:
            for key, a in both.items():
                n = np.rint(a / UNIT)
                new = np.stack([n, (a - n * UNIT) / 2])
                held[key] = held[key] + new if key in held else new
            both.clear()

        for blocks in some_blocks(batches, views):
            cols = [Columns.of(blocks, v) for v in range(views)]
            c = cols[0]
            part = np.where(np.isin(c.fold, folds), np.searchsorted(folds, c.fold) + 1, 0)
            base = part * bins
            # whole or half labels: sums of draws (below 2^22) and of labels (below 2^29) are exact in one double
            high = max(2 * float(np.abs(c.y).max()), 128.0)
            exact = bool((2 * c.y == np.rint(2 * c.y)).all()) and high * 16 * c.n < UNIT / 4
            if exact and (load + high * 16 * c.n) >= UNIT / 4:
                parted()
                load = 0.0
            load += high * 16 * c.n
            bags: dict[int, tuple] = {}
            for t, v, root, _ in every:
                if t not in bags:
                    w = bag(c.h, seed, t)
                    rows = np.flatnonzero(w)
                    w = w.astype(np.float64)
                    bags = {t: (rows, w * (UNIT + 2 * c.y)) if exact else (rows, w, w * c.y)}
                rows, *weights = bags[t]
                flat, size = cols[v].flat, c.n

                def add(node: Node, idx: np.ndarray) -> None:
                    look = looks[t][node.draw]
                    if len(node.open) > 1:
                        pieces, more = len(folds) + 1, base[idx]
                    else:
                        pieces, more = 1, None
                        idx = idx[learns[node.open[0][0]][part[idx]]]
                    if not len(idx):
                        return
                    u, new = [v[idx] for v in weights], np.empty((len(weights), len(look), pieces * bins))
                    for j, f in enumerate(look):
                        cell = flat[f * size:(f + 1) * size][idx]
                        cell = cell if more is None else cell + more
                        for i, v in enumerate(u):
                            new[i, j] = np.bincount(cell, v, pieces * bins)
                    new = new.reshape(len(weights), -1)
                    where, new = (both, new[0]) if exact else (held, new)
                    key = id(node)
                    if key in where:
                        where[key] += new
                    else:
                        where[key] = new

                def down(node: Node, idx: np.ndarray) -> None:
                    if node.open:
                        add(node, idx)
                    for (f, m), (left, right) in node.splits.items():
                        go = (np.uint64(m) >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool)[flat[f * size:(f + 1) * size][idx]]
                        if left is not None:
                            down(left, idx[go])
                        if right is not None:
                            down(right, idx[~go])

                down(root, rows)
        parted()
        for t in roots:
            out: dict[int, np.ndarray] = {}
            for _, _, _, leaves in (e for e in every if e[0] == t):
                for node in leaves:
                    k = looks[t].shape[1]
                    a = held.pop(id(node), None)
                    if a is None:
                        continue
                    a = a.reshape(2, k, -1, bins)
                    for m, at in node.open:
                        if m not in out:
                            out[m] = np.zeros((2, len(open_[m, t]), k, bins))
                        out[m][:, at] = a[:, :, learns[m]].sum(axis=2) if len(node.open) > 1 else a[:, :, 0]
            for m, a in out.items():
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([t], pa.int32()), pa.array([a.tobytes()], pa.binary())], ["m", "t", "v"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            for m, t, v in zip(*(b.column(c).to_pylist() for c in ("m", "t", "v"))):
                a = np.frombuffer(v)
                held[m, t] = held[m, t] + a if (m, t) in held else a
        out = []
        for (m, t), a in held.items():
            nodes = open_[m, t]
            look = looks[t][nodes]
            n, s = a.reshape(2, len(nodes), -1, bins)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = np.where(n > 0, s / n, np.inf)
            order = np.argsort(np.where((look >= numbers)[:, :, None], mean, np.arange(bins)), axis=2, kind="stable")
            nl, sl = (np.cumsum(np.take_along_axis(v, order, axis=2), axis=2) for v in (n, s))
            total, sum_ = n[:, :1].sum(axis=2, keepdims=True), s[:, :1].sum(axis=2, keepdims=True)
            nr, sr = total - nl, sum_ - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((nl > 0.5) & (nr > 0.5), sl * sl / nl + sr * sr / nr - sum_ * sum_ / total, 0.0)  # n counts draws
            for i, node in enumerate(nodes):
                f, c = np.unravel_index(int(np.argmax(gain[i])), gain[i].shape)
                left = int(np.bitwise_or.reduce(np.uint64(1) << order[i, f, :c + 1].astype(np.uint64)))
                out.append((m, t, int(node), float(total[i, 0, 0]), float(sum_[i, 0, 0]), float(gain[i, f, c]), int(look[i, f]), left - (1 << 64 if left >> 63 else 0),
                            float(nl[i, f, c]), float(sl[i, f, c])))
        if out:
            types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], list("abcdefghij"))

    got = cur.mapInArrow(sums, "m int, t int, v binary").repartition(max(1, min(parts, len(open_))), "m", "t")
    return got.mapInArrow(best, "a int, b int, c int, d double, e double, f double, g int, h long, i double, j double").collect()


def fit_forests(train: DataFrame, outs: Sequence[int], trees: int = 300, depth: int = 5, seed: int = 551724, label: str = "total", key: str = "account_id",
                fold: str = "fold", exclude: Sequence[str] = NON_FEATURES) -> Forest:
    """One forest for each of ``outs``, the fold whose rows it does not learn from (-1: none): ``trees`` trees of ``depth`` levels, bags of
    as many draws as rows (on average), a third of the features for each node, least squares."""
    spark = train.sparkSession
    specs = [replace(Spec(), out=f) for f in outs]
    base = binning(train, specs, label, key, fold, exclude, LEAST)
    one = one_numbering(base)
    by, to = one or (base, [])
    cur = packed(train, by, label, key, fold)
    bins = LEAST if by.widths.size == 0 or by.widths.max() < LEAST else BINS
    rows = cur.agg(F.sum("n")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    cur = cur.coalesce(max(1, min(rows // ROWS, cores), rows // MOST)).persist()
    parts, models = int(spark.conf.get("spark.sql.shuffle.partitions")), len(specs)
    numbers, width = len(base.numeric), len(base.numeric) + len(base.factors)
    size = 2 ** (depth + 1) - 1
    feature, mask, value = np.full((models, trees, size), -1, np.int32), np.zeros((models, trees, size), np.uint64), np.zeros((models, trees, size))
    k = math.ceil(width / 3)
    open_ = {(m, t): np.zeros(1, np.int64) for t in range(trees) for m in range(models)} if width else {}
    for level in range(depth):
        first = 2 ** level - 1
        looks = {t: np.sort(np.argsort(np.random.default_rng([seed, t, level]).random((2 ** level, width)), axis=1)[:, :k], axis=1) for t in {t for _, t in open_}}
        found, some, ready, load = [], {}, {}, 0
        for t in [*sorted({t for _, t in open_}), None]:  # as many trees as a task may hold; all models' trees of a number share their bags and common ways
            now = {m: open_[m, t] for m in range(models) if (m, t) in open_}
            views = [now] if one else [{m: v} for m, v in now.items()]
            each = [ways(v, feature[:, t], mask[:, t], level) for v in views] if now else []
            size = sum(len(n.open) + (len(outs) + 1 if len(n.open) > 1 else 1) for root in each for n in root.leaves()) * k * bins * 16
            if some and (t is None or load + size > HELD):
                found += _splits(cur, outs, seed, some, ready, {i: looks[i] for i in ready}, numbers, bins, parts)
                some, ready, load = {}, {}, 0
            if now:
                if not one:  # a root for each model, in their order
                    each = [next((r for v, r in zip(views, each) if m in v), Node()) for m in range(models)]
                some, ready[t], load = some | {(m, t): v for m, v in now.items()}, each, load + size
        after: dict[tuple[int, int], list[int]] = {}
        for m, t, node, n, s, gain, f, left, nl, sl in sorted(map(tuple, found), key=lambda r: (r[1], r[0], r[2])):
            i = first + node
            value[m, t, i] = s / n if n else 0.0
            if gain <= 1e-12 * max(1.0, abs(s)):
                continue
            feature[m, t, i], mask[m, t, i] = f, np.uint64(left % (1 << 64))
            value[m, t, 2 * i + 1], value[m, t, 2 * i + 2] = sl / nl, (s - sl) / (n - nl)
            after.setdefault((m, t), []).extend(2 * node + j for j, many in ((0, nl), (1, n - nl)) if many > 1.5)
        open_ = {at: np.array(v) for at, v in after.items() if v}
    cur.unpersist()
    for i, of in enumerate(to):  # bins of the common numbering as each model's
        for m, t, node in zip(*np.nonzero(feature == numbers + i)):
            left = np.flatnonzero((mask[m, t, node] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
            mask[m, t, node] = np.bitwise_or.reduce(np.uint64(1) << of[m, left].astype(np.uint64))
    return Forest(base, feature, mask, value, depth)
