"""Exact k-nearest-neighbour vote.

Rows of equal vector, group and label are one entry with their number (more than k of them are k), and equal queries are asked once, so
the pairs compared are those of different vectors. A tree of cuts along the widest directions deals entries into blocks of near vectors and bounded size
(a block that is too large is dealt on by hash). A query first passes by its own block; the distance of its k-th neighbour there bounds
what can matter, and it goes on only to blocks whose box lies within that bound. A task holds one block and lets queries pass by it in batches: no side goes
through the driver, none is broadcast, and no pair set is made. In a block, tiles of near rows whose box is beyond the bound are left out in the same way; of
the others products of single-precision matrices give distances up to a known rounding, and pairs within that rounding of a query's k nearest
are computed again as sums of squares, so the order is exact. Where vectors differ in so many directions that no box can be left out, the work is that of all
pairs. A grouped top-k keeps the nearest of all blocks, and a vote picks the class (ties: the lower label).
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries and rows compared at a time, directions of boxes, and candidates computed again at a time.
STEP, TILE, DIRECTIONS, AGAIN = 256, 1024, 12, 32768
#: Cells (block by chunk) for each core, where blocks alone would leave cores idle; vectors that the cuts between blocks are taken from, and their bytes at most.
CELLS, SAMPLE, BYTES = 3, 20_000, 32 << 20
#: Squared lengths up to which products are of single precision.
SINGLE = 1e30


def _nearest_of(i: np.ndarray, d2: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each ``i`` in the order of (d2, y)."""
    order = np.lexsort((y, d2, i))
    s = i[order]
    begin = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    rank = np.arange(len(s)) - np.repeat(begin, np.diff(np.r_[begin, len(s)]))
    return order[rank < k]


def _directions(x: np.ndarray) -> np.ndarray:
    """The widest directions of centred rows, as orthonormal columns."""
    top = max(float(np.abs(x).max()), 1e-300)
    return np.linalg.eigh((x / top).T @ (x / top))[1][:, -DIRECTIONS:]


def _cut(p: np.ndarray, share: float) -> tuple[int, float] | None:
    """(direction, value) that parts rows ``p`` about at ``share``, along the widest direction that can be parted."""
    for j in np.argsort(-np.ptp(p, axis=0)):
        v = np.sort(p[:, j])
        at = v[min(len(v) - 1, max(0, int(share * len(v)) - 1))]
        at = at if at < v[-1] else v[np.searchsorted(v, at) - 1]  # some rows lie above
        if v[0] <= at < v[-1]:
            return int(j), float(at)
    return None


class Cuts:
    """A tree of cuts that gives each vector the number of its leaf, of ``n`` at most; any vectors may be given."""

    def __init__(self, sample: np.ndarray, n: int) -> None:
        self.centre = sample.mean(axis=0)
        self.turn = _directions(sample - self.centre)
        self.nodes: list[tuple] = []
        self.leaves = 0
        self._grow(self.along(sample), n)

    def along(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.turn

    def _grow(self, p: np.ndarray, n: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        cut = _cut(p, (n // 2) / n) if n > 1 and len(p) > 1 else None
        if cut is None:
            self.nodes[at] = (-1, 0.0, self.leaves, -1)
            self.leaves += 1
        else:
            left = p[:, cut[0]] <= cut[1]
            self.nodes[at] = (*cut, self._grow(p[left], n // 2), self._grow(p[~left], n - n // 2))
        return at

    def leaf(self, p: np.ndarray) -> np.ndarray:
        out, here = np.zeros(len(p), np.int32), {0: np.arange(len(p))}
        for i, (j, value, left, right) in enumerate(self.nodes):  # a node stands after its parent
            rows = here.pop(i)
            if j < 0:
                out[rows] = left
            else:
                go = p[rows, j] <= value
                here[left], here[right] = rows[go], rows[~go]
        return out


def _order(p: np.ndarray, size: int) -> np.ndarray:
    """Rows in an order that has near rows together, halved along the widest direction down to ``size``."""
    out, todo = [], [np.arange(len(p))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        half = -(-len(rows) // (2 * size)) * size
        cut = np.argpartition(p[rows, np.argmax(np.ptp(p[rows], axis=0))], half - 1)
        todo += [rows[cut[half:]], rows[cut[:half]]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _beyond(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances (rows by boxes) of ``p`` from boxes."""
    out = np.zeros((len(p), len(lo)))
    for j in range(p.shape[1]):
        gap = np.maximum(lo[None, :, j] - p[:, None, j], p[:, None, j] - hi[None, :, j])
        out += np.maximum(gap, 0.0) ** 2
    return out


def _rounding(eps: float, d: int, squares: np.ndarray | float) -> np.ndarray | float:
    """What rounding can make of distances between vectors of these squared lengths, either way of computing them."""
    return 8 * (d + 8) * eps * (squares + 1e-300)


class Tiles:
    """The rows of a block as tiles of near rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, group: np.ndarray | None = None, times: np.ndarray | None = None) -> None:
        self.centre = x.mean(axis=0)
        self.turn = _directions(x - self.centre) if len(x) > TILE else np.zeros((x.shape[1], 0))
        order = _order((x - self.centre) @ self.turn, TILE) if len(x) > TILE else np.arange(len(x))
        self.x, self.y = x[order], y[order]
        self.group, self.times = (v if v is None else v[order] for v in (group, times))
        self.parts, self.right, self.middles = [slice(lo, lo + TILE) for lo in range(0, len(x), TILE)], [], []
        p = self.along(self.x)
        self.lo, self.hi = (np.stack([of(p[t], axis=0) for t in self.parts]) for of in (np.min, np.max))
        for t in self.parts:
            middle = self.x[t].mean(axis=0)
            b = self.x[t] - middle
            bb = (b * b).sum(axis=1)
            self.middles.append((middle, float(bb.max())))
            kind = np.float32 if bb.max() < SINGLE else np.float64
            self.right.append(np.concatenate([-2.0 * b, bb[:, None]], axis=1).T.astype(kind, order="C"))
        self.longest = float(((self.x - self.centre) ** 2).sum(axis=1).max())

    def along(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.turn

    def nearest(self, q: np.ndarray, k: int, own: np.ndarray | None = None, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(squared distances, labels), by k, of each query's k nearest rows in the order of (distance, label): infinite where there are fewer. Rows whose
        group is the query's ``own`` are no neighbours; rows beyond ``within`` (squared) may be left out."""
        n, d = q.shape
        eps = np.finfo(np.float64).eps
        slack = _rounding(eps, d, ((q - self.centre) ** 2).sum(axis=1) + self.longest + (self.centre ** 2).sum())
        best_d, best_y = np.full((n, k), np.inf), np.zeros((n, k))
        bound = np.full(n, np.inf) if within is None else within
        away = _beyond(self.along(q), self.lo, self.hi)
        for t in np.argsort(away.min(axis=0), kind="stable"):
            limit = np.minimum(best_d[:, -1], bound) + 2 * slack
            act = np.flatnonzero(away[:, t] <= limit)
            if not len(act):
                continue
            part, right, (middle, bb) = self.parts[t], self.right[t], self.middles[t]
            a = q[act] - middle
            aa = (a * a).sum(axis=1)
            kind = right.dtype if aa.max() < SINGLE else np.float64
            near = np.concatenate([a, np.ones((len(act), 1))], axis=1).astype(kind) @ right.astype(kind, copy=False)  # squared distance less the query's square
            rough = _rounding(float(np.finfo(kind).eps), d, aa + bb)
            most = limit[act] - aa + rough
            new = np.flatnonzero(~np.isfinite(most))
            if len(new) and near.shape[1] > k:  # the tile's own k-th bounds what has to be computed again (each row counts once at least)
                some = near[new]
                if self.group is not None:
                    some[own[act[new]][:, None] == self.group[None, part]] = np.inf
                most[new] = np.minimum(most[new], np.partition(some, k - 1, axis=1)[:, k - 1] + 2 * rough[new] + 2 * slack[act[new]])
            at = np.flatnonzero(near <= most[:, None])
            i, c = act[at // near.shape[1]], part.start + at % near.shape[1]
            if self.group is not None:
                use = own[i] != self.group[c]
                i, c = i[use], c[use]
            if not len(i):
                continue
            d2 = np.concatenate([np.cumsum((q[i[lo:lo + AGAIN]] - self.x[c[lo:lo + AGAIN]]) ** 2, axis=1)[:, -1] for lo in range(0, len(i), AGAIN)])  # one after the other
            if self.times is not None:
                i, c, d2 = (np.repeat(v, np.minimum(self.times[c], k)) for v in (i, c, d2))
            mine = np.unique(i)
            old = np.isfinite(best_d[mine])
            i = np.concatenate([np.repeat(mine, old.sum(axis=1)), i])
            d2, yy = np.concatenate([best_d[mine][old], d2]), np.concatenate([best_y[mine][old], self.y[c]])
            keep = _nearest_of(i, d2, yy, k)
            i, d2, yy = i[keep], d2[keep], yy[keep]
            begin = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            rank = np.arange(len(i)) - np.repeat(begin, np.diff(np.r_[begin, len(i)]))
            best_d[i, rank], best_y[i, rank] = d2, yy
        return best_d, best_y


def nearest_rows(q: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, own: np.ndarray | None = None, group: np.ndarray | None = None,
                 times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, label, squared distance) of each query's k nearest rows (see :class:`Tiles`)."""
    best_d, best_y = Tiles(x, y, group, times).nearest(q, k, own)
    use = np.isfinite(best_d)
    return np.repeat(np.arange(len(q)), use.sum(axis=1)), best_y[use], best_d[use]


def matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)


def knn_vote(train: DataFrame, queries: DataFrame, k: int = 3, vec: str = "scaled", label: str = "total", block_rows: int = 65536,
             apart: str | None = None, keep: Sequence[str] = (), key: str = "account_id") -> DataFrame:
    """(query_id, keep..., prediction) for every row of ``queries`` (query_id, ``vec``) that has a neighbour.

    With ``apart``, a column of both sides, rows of equal value are no neighbours (the folds of a
    cross-validation, all of which are then scored in one pass). Vectors are ``pyspark.ml`` vectors or arrays. Blocks and chunks follow from
    hashes of the vectors, so that a repeated task deals its rows alike.
    """
    spark = train.sparkSession

    def array(df: DataFrame) -> Column:
        c = F.col(vec) if df.schema[vec].dataType.typeName() == "array" else vector_to_array(F.col(vec))
        return F.transform(c, lambda v: v.cast("double") + F.lit(0.0))  # one zero

    group = F.xxhash64(F.col(apart)) if apart else F.lit(0).cast("long")
    entries = (train.select(array(train).alias("v"), group.alias("grp"), F.col(label).cast("double").alias("label")).where("label is not null")
               .groupBy("v", "grp", "label").agg(F.count(F.lit(1)).alias("n")))
    # of a vector's entries in a group, those among the k lowest labels suffice
    before = Window.partitionBy("v", "grp").orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    entries = (entries.withColumn("_b", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("_b") < k)
               .select("v", "grp", "label", F.least("n", F.lit(k)).cast("int").alias("times"))).checkpoint()
    asked = queries.select("query_id", *keep, array(queries).alias("_v"), group.alias("_g"))
    different = asked.select(F.col("_v").alias("v"), F.col("_g").alias("grp")).distinct().withColumn("id", F.monotonically_increasing_id()).checkpoint()
    rows, asks, cores = entries.count(), different.count(), spark.sparkContext.defaultParallelism
    if not rows:
        return asked.select("query_id", *keep, F.lit(None).cast("double").alias("prediction")).limit(0)
    blocks = -(-rows // block_rows)
    cuts = None
    if blocks > 1:  # where to cut follows from some vectors; the blocks hold all
        width = max(1, len(entries.first().v))
        some = entries.select("v").orderBy(F.xxhash64("v", "grp", "label")).limit(max(blocks, min(SAMPLE, BYTES // (8 * width)))).collect()
        cuts = Cuts(np.array([r.v for r in some]), blocks)

    def dealt(df: DataFrame) -> DataFrame:
        """``df`` with the number of each vector's leaf, and the vector along the cuts' directions."""
        if cuts is None:
            return df.withColumn("leaf", F.lit(0)).withColumn("p", F.array().cast("array<double>"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    p = cuts.along(matrix(b))
                    ends = pa.array(np.arange(b.num_rows + 1) * p.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cuts.leaf(p)), pa.ListArray.from_arrays(ends, pa.array(p.ravel()))], [*b.schema.names, "leaf", "p"])

        return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", leaf int, p array<double>")

    placed = dealt(entries)
    wide = 0 if cuts is None else cuts.turn.shape[1]
    leaves = [r for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[f(F.col("p")[j]).alias(f"{a}{j}") for a, f in (("lo", F.min), ("hi", F.max)) for j in range(wide)])
              .orderBy("leaf").collect()]
    number = np.array([r.leaf for r in leaves])
    lo, hi = (np.array([[r[f"{a}{j}"] for j in range(wide)] for r in leaves]).reshape(len(leaves), wide) for a in ("lo", "hi"))
    # a leaf that holds far more than its share is several blocks
    pieces = {r.leaf: max(1, -(-r.n // (2 * block_rows))) for r in leaves}
    first, cells = {}, 0
    for f, n in pieces.items():
        first[f], cells = cells, cells + n
    chunks = max(1, min(-(-asks // STEP), -(-CELLS * cores // cells)))
    all_cells = cells * chunks
    begin = F.create_map(*[x for f in first for x in (F.lit(int(f)), F.lit(first[f]))])[F.col("leaf")]
    many = F.create_map(*[x for f in pieces for x in (F.lit(int(f)), F.lit(pieces[f]))])[F.col("leaf")]
    none = F.lit(None)
    held = placed.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), (begin + F.pmod(F.xxhash64("v", "grp", "label"), many).cast("int")).alias("block"),
                         F.lit(False).alias("asks"), none.cast("long").alias("id"), "leaf", "grp", "label", "times", none.cast("double").alias("within"), "v")
    near_type = "array<struct<d2: double, label: double>>"

    def passed(asking: DataFrame, vectors: bool) -> DataFrame:
        """(id, near) of queries (id, leaf to look at, grp, within, v) for each block of the leaf; with ``vectors`` the query's columns, too, and whether it is its leaf's first block."""
        q = asking.where(F.col("leaf").isin([int(f) for f in first])).select(
            F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), F.explode(F.sequence(begin, begin + many - 1)).alias("block"),
            F.lit(True).alias("asks"), "id", "leaf", "grp", none.cast("double").alias("label"), none.cast("int").alias("times"), "within", "v")
        both = held.unionByName(q).withColumn("cell", F.col("block") * chunks + F.col("chunk")).drop("block", "chunk")
        starts = set(first.values())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, parts, tiles = None, [], None
            for b in batches:
                at, asks = b.column("cell").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
                ends = np.flatnonzero((at[1:] != at[:-1]) | (asks[1:] != asks[:-1])) + 1
                for start, stop in zip([0, *ends.tolist()], [*ends.tolist(), b.num_rows]):
                    if stop == start:
                        continue
                    if at[start] != cell:
                        cell, parts, tiles = at[start], [], None
                    part = b.slice(start, stop - start)
                    if not asks[start]:
                        parts.append(part)
                        continue
                    if tiles is None and parts:
                        y, group, times = (np.concatenate([h.column(c).to_numpy() for h in parts]) for c in ("label", "grp", "times"))
                        tiles = Tiles(np.concatenate([matrix(h) for h in parts]), y, group if apart else None, times)
                        parts = []
                    mine, own, within = matrix(part), part.column("grp").to_numpy(), part.column("within").to_numpy()
                    order = _order(tiles.along(mine), STEP) if tiles is not None and len(mine) > STEP and tiles.turn.shape[1] else np.arange(len(mine))
                    for lo_ in range(0, len(order), STEP):
                        some = order[lo_:lo_ + STEP]
                        best_d, best_y = tiles.nearest(mine[some], k, own[some], within[some]) if tiles is not None else (np.full((len(some), k), np.inf), np.zeros((len(some), k)))
                        use = np.isfinite(best_d)
                        near = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(use.sum(axis=1))], pa.int32()),
                                                        pa.StructArray.from_arrays([pa.array(best_d[use]), pa.array(best_y[use])], ["d2", "label"]))
                        out = [part.column("id").take(pa.array(some)), near]
                        if vectors:
                            out += [*(part.column(c).take(pa.array(some)) for c in ("leaf", "grp", "v")), pa.array(np.minimum(best_d[:, -1], within[some])),
                                    pa.array(np.full(len(some), int(cell) // chunks in starts))]
                        yield pa.RecordBatch.from_arrays(out, ["id", "near", *(["leaf", "grp", "v", "within", "first"] if vectors else [])])

        shape = f"id long, near {near_type}" + (", leaf int, grp long, v array<double>, within double, first boolean" if vectors else "")
        return both.repartitionById(all_cells, "cell").sortWithinPartitions("cell", "asks").mapInArrow(run, shape)

    inf = F.lit(float("inf"))
    asking = dealt(different).drop("p").withColumn("within", inf)
    if cuts is None:
        near = passed(asking, False)
    else:
        home = passed(asking, True).checkpoint()
        # vectors whose leaf holds no row have been nowhere yet
        lost = asking.where(~F.col("leaf").isin([int(f) for f in first])).select("id", "leaf", "grp", "v", "within")

        def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size = (cuts.centre ** 2).sum()
            longest = np.maximum(lo ** 2, hi ** 2).sum(axis=1).max()
            for b in batches:
                if not b.num_rows:
                    continue
                x = matrix(b)
                slack = _rounding(np.finfo(np.float64).eps, x.shape[1], ((x - cuts.centre) ** 2).sum(axis=1) + longest + size)
                go = _beyond(cuts.along(x), lo, hi) <= (b.column("within").to_numpy() + 2 * slack)[:, None]
                go &= b.column("leaf").to_numpy()[:, None] != number[None, :]
                i, j = np.nonzero(go)
                if len(i):
                    yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(i)) for c in ("id", "grp", "v", "within")), pa.array(number[j].astype(np.int32))],
                                                     ["id", "grp", "v", "within", "leaf"])

        further = home.where("first").select("id", "leaf", "grp", "v", "within").unionByName(lost).mapInArrow(onward, "id long, grp long, v array<double>, within double, leaf int")
        near = home.select("id", "near").unionByName(passed(further, False))
    best = (near.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near")))  # k of each block that a query goes to
    votes = F.transform(F.array_distinct(F.col("near.label")), lambda y: F.struct(F.size(F.filter("near", lambda e: e["label"] == y)).alias("v"), (-y).alias("l")))
    found = best.where(F.size("near") > 0).select("id", (-F.array_max(votes)["l"]).alias("prediction")).join(different, "id")
    return asked.join(found, (asked["_v"] == found["v"]) & (asked["_g"] == found["grp"])).select("query_id", *keep, "prediction")
