"""Nearest neighbours by multi-index hashing.

A bounded sample teaches the codes: principal axes, then a rotation that brings the projections nearest to their signs. A vector's code is
the signs, cut into substrings, each indexed by itself. Two codes at most ``radius`` bits apart differ by at most
``radius // substrings`` bits in some substring (pigeonhole), so probing every substring's buckets up to that distance meets
every code within the radius. Those are then compared as the vectors they are.

Each query has a radius of its own. The sample shows how far apart the codes of neighbours at a given distance lie, and how far
a query's neighbours are at most; a first probing with a small radius brings that bound down
where neighbours are many.

The index of a substring is dealt out by the first bits of its key, so that a group of buckets fits one task; a query goes to the groups whose
first bits are near enough to its own, and there to the buckets whose whole keys are. A group of very many rows is
cut into blocks. A task holds one block and the queries that probe it, and gives each query's nearest alone.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Most vectors of each length that teach codes and radii (those with the smallest hashes), and most of them used as queries.
SAMPLE, SAMPLE_QUERIES, NEAREST = 8192, 512, 32
#: Most bits of a code, substrings, and steps of the learned rotation.
BITS, SUBSTRINGS, TURNS = 64, 4, 40
#: Share of neighbours at a given distance that a radius must reach.
REACH = 0.98
#: Rows of a block of the index, and candidates that the first probing looks for.
BLOCK, FIRST = 32768, 512
#: Most bytes of a block's vectors; longer vectors make smaller blocks.
BLOCK_BYTES = 1 << 26
#: Numbers compared at a time.
CELLS = 1 << 22
SEED = 13


@dataclass
class Codes:
    """Codes of vectors of one length: ``scale`` brings them to size 1, ``mean`` and ``axes`` give the projections. ``edges`` and ``radii``
    say which radius reaches neighbours up to which distance; ``sample`` holds the vectors that this was learned from."""

    scale: float
    mean: np.ndarray
    axes: np.ndarray
    edges: np.ndarray
    radii: np.ndarray
    sample: np.ndarray
    bounds: list[int]

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Codes (uint64) of vectors (rows x dimensions)."""
        with np.errstate(over="ignore"):
            y = (np.clip(x * self.scale, -1e6, 1e6) - self.mean) @ self.axes > 0
        return (y.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Keys of the substrings (rows x substrings)."""
        cuts = list(zip(self.bounds, self.bounds[1:]))
        return np.stack([(codes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in cuts], axis=1)

    def radius(self, distance: np.ndarray) -> np.ndarray:
        """Radius for neighbours up to a distance."""
        if not len(self.radii):
            return np.full(len(distance), self.bits)
        at = np.searchsorted(self.edges, distance)
        return np.where(at < len(self.radii), self.radii[np.minimum(at, len(self.radii) - 1)], self.bits)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances (queries x rows) from the differences themselves, so that equal vectors tie exactly."""
    out = np.empty((len(q), len(x)))
    step = max(1, CELLS // max(1, x.size))
    with np.errstate(over="ignore", invalid="ignore"):
        for lo in range(0, len(q), step):
            d = x[None, :, :] - q[lo:lo + step, None, :]
            out[lo:lo + step] = np.sqrt((d * d).sum(axis=2))
    i, j = np.nonzero(~np.isfinite(out))
    if len(i):  # squares beyond the range of double
        big = np.maximum(np.abs(q).max(axis=1)[i], np.abs(x).max(axis=1)[j])
        d = x[j] / big[:, None] - q[i] / big[:, None]
        with np.errstate(over="ignore"):
            out[i, j] = np.sqrt((d * d).sum(axis=1)) * big
    return out


def learned(x: np.ndarray, k: int, bits: int = BITS, substrings: int = SUBSTRINGS, reach: float = REACH, seed: int = SEED) -> Codes:
    """Codes from sample vectors (rows x dimensions)."""
    norm = np.abs(x).max(axis=1)
    with np.errstate(over="ignore", divide="ignore"):
        scale = min(1.0 / float(np.median(norm)), 1e300)
        y = np.clip(x * scale, -1e6, 1e6)
    mean = y.mean(axis=0)
    y = y - mean
    u = np.linalg.eigh(y.T @ y)[1][:, ::-1][:, :min(bits, x.shape[1])]
    p = y @ u
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(p.shape[1],) * 2))[0]
    for _ in range(TURNS):
        a, _, b = np.linalg.svd(np.where(p @ turn > 0, 1.0, -1.0).T @ p)
        turn = (a @ b).T
    n = p.shape[1]
    m = min(substrings, n)
    out = Codes(scale, mean, u @ turn, np.zeros(0), np.zeros(0, int), x, [n * i // m for i in range(m + 1)])
    codes = out(x)
    some = np.linspace(0, len(x) - 1, min(len(x), SAMPLE_QUERIES)).astype(int)
    near, apart = [], []
    for lo in range(0, len(some), 16):
        at = some[lo:lo + 16]
        d = distances(x[at], x)
        d[np.arange(len(at)), at] = np.inf
        best = np.argpartition(d, min(NEAREST, len(x)) - 1, axis=1)[:, :NEAREST]
        near.append(np.take_along_axis(d, best, axis=1).ravel())
        apart.append(np.bitwise_count(codes[at][:, None] ^ codes[best]).astype(int).ravel())
    d, h = np.concatenate(near), np.concatenate(apart)
    d, h = d[np.isfinite(d)], h[np.isfinite(d)]
    if len(d):
        order = np.argsort(d, kind="stable")
        groups = np.array_split(order, max(1, min(32, len(order) // 100)))
        out.edges = np.array([d[g].max() for g in groups])
        out.radii = np.maximum.accumulate([int(np.quantile(h[g], reach, method="higher")) for g in groups])
    return out


def prefix_bits(rows: int, bits: int, block: int) -> int:
    """First bits of a key by which an index of so many rows is dealt out."""
    return int(min(bits, max(0, np.ceil(np.log2(max(1, rows) / block)))))


def near_prefixes(own: np.ndarray, slack: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, prefix) for all prefixes of ``bits`` bits that differ from a row's own by at most its slack."""
    rows, found = [], []
    for t in range(bits + 1):
        at = np.flatnonzero(slack >= t)
        if not len(at):
            break
        flips = np.array([sum(1 << b for b in c) for c in itertools.combinations(range(bits), t)], dtype=np.int64)
        for lo in range(0, len(at), max(1, CELLS // len(flips))):
            some = at[lo:lo + max(1, CELLS // len(flips))]
            rows.append(np.repeat(some, len(flips)))
            found.append((own[some][:, None] ^ flips).ravel())
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(rows or [none]), np.concatenate(found or [none])


def probe(q: dict, x: dict, sub: int, codes: Codes, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, distance) of each query's ``k`` nearest rows of one block, among rows whose key of substring ``sub`` lies within the query's
    slack and whose code within its radius. A row that an earlier substring meets is left to that one."""
    m = len(codes.bounds) - 1
    rk, qk = codes.keys(x["code"]), codes.keys(q["code"])
    keys, place = np.unique(rk[:, sub], return_inverse=True)
    order = np.argsort(place, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(keys)))])
    slack = q["radius"] // m
    step = max(1, CELLS // max(1, len(keys)))
    for lo in range(0, len(slack), step):
        hit = np.bitwise_count(qk[lo:lo + step, sub, None] ^ keys) <= slack[lo:lo + step, None]
        for i in range(len(hit)):
            a = lo + i
            buckets = np.flatnonzero(hit[i])
            if not len(buckets):
                continue
            size = start[buckets + 1] - start[buckets]
            met = order[np.arange(size.sum()) + np.repeat(start[buckets] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
            met = met[np.bitwise_count(x["code"][met] ^ q["code"][a]) <= q["radius"][a]]
            for j in range(sub):
                met = met[np.bitwise_count(rk[met, j] ^ qk[a, j]) > slack[a]]
            if len(met):
                d = distances(q["v"][a:a + 1], x["v"][met])[0]
                best = np.lexsort((x["id"][met], d))[:k] if len(met) <= 4 * k else None
                if best is None:
                    few = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                    best = few[np.lexsort((x["id"][met[few]], d[few]))[:k]]
                yield np.full(len(best), a), met[best], d[best]


def _packed(x: np.ndarray) -> pa.Array:
    """Rows as bytes, of single precision where that holds them exactly."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return pa.array([r.tobytes() for r in (short if (short == x).all() else x)], pa.binary())


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=np.float32 if len(v) == 4 * dim else np.float64).astype(np.float64) for v in col.to_pylist()])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            sample: int = SAMPLE, block: int = BLOCK, first: int = FIRST, reach: float = REACH) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` found for each row of ``queries`` (both with ``key`` and ``vector``):
    query_id, rank, vec_id, score.

    ``score`` is the Euclidean distance in double precision, nearest first, ties to the smaller vec_id; rows of the query's own id are not its
    neighbours. A query gets min(k, candidates) rows always: where a radius gives fewer, it is widened to all. Vectors that are null, empty, zero or hold
    null or non-finite components take no part on either side, nor do rows without id; vectors of different lengths are not compared. Of equal
    vectors the k + 1 smallest ids are indexed, as others cannot be among the nearest; rows that repeat an id and its vector are taken once, a query id with
    several vectors asks for its nearest over all of them, a candidate once, at its least distance. Empty tables give no rows. Other columns are not read.

    Every row is indexed; codes and radii are learned from the ``sample`` vectors of smallest hash, per length. Few lengths are expected.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vector}`")
        good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
                                                           ) & F.exists(v, lambda c: c != 0)
        return df.where(good & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("id"),
                                                                   F.transform(v, lambda c: c.cast("double") + 0.0).alias("x"))

    # row_number() <= n is applied in each task before the shuffle, so copies without number do not gather
    w = Window.partitionBy("x").orderBy("id")
    few = usable(vectors).distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    points = few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    # a vector's name is its smallest id and its hash, as an id may come with several vectors
    points = stored(points.select("x", "ids", F.col("ids")[0].alias("id"), F.xxhash64("x").alias("h"), F.size("x").alias("d")), "op13-points")
    counts = {r.d: r.n for r in points.groupBy("d").agg(F.count("*").alias("n")).collect()}
    codes: dict[int, Codes] = {}
    for d in sorted(counts):
        # a bounded sample: at most ``sample`` vectors reach the driver
        rows = points.where(F.col("d") == d).orderBy("h", "id").limit(sample).select("x").toPandas()["x"]
        codes[d] = learned(np.stack([np.asarray(v, dtype=np.float64) for v in rows]), k, reach=reach)
    # a sample and projections for each length, as plain values: a task need not have this package installed
    send = spark.sparkContext.broadcast(({d: vars(c) for d, c in codes.items()}, counts))

    def received() -> tuple[dict[int, Codes], dict[int, int]]:
        return {d: Codes(**c) for d, c in send.value[0].items()}, send.value[1]

    block = max(1, min(block, BLOCK_BYTES // (8 * max(counts, default=1))))

    def matrices(b: pa.RecordBatch, rows: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        col = b.column("x")
        flat, ends = col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
        size = np.diff(ends)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            for lo in range(0, len(at), rows):
                yield at[lo:lo + rows], flat[ends[at[lo:lo + rows]][:, None] + np.arange(d)]

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = received()
        for b in batches:
            for at, x in matrices(b):
                c = known[x.shape[1]]
                code = c(x)
                keys, ids, h = c.keys(code), b.column("id").take(pa.array(at)), b.column("h").take(pa.array(at))
                for s, (lo, hi) in enumerate(zip(c.bounds, c.bounds[1:])):
                    group = keys[:, s] >> np.uint64(hi - lo - prefix_bits(n[x.shape[1]], hi - lo, block))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(np.full(len(at), s), pa.int32()), pa.array(group.astype(np.int64)),
                         ids, h, pa.array(code.view(np.int64)), _packed(x)], ["d", "sub", "grp", "id", "h", "code", "v"])

    index = stored(points.select("id", "h", "x").mapInArrow(indexed, "d int, sub int, grp long, id long, h long, code long, v binary"), "op13-index")
    sizes = stored(index.groupBy("d", "sub", "grp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "op13-groups")
    index = index.join(sizes, ["d", "sub", "grp"]).withColumn("part", F.pmod(F.xxhash64("id", "h"), F.col("blocks")).cast("int"))
    index = index.select("d", "sub", "grp", "part", F.lit(False).alias("asks"), "id", "h", "code", F.lit(0).alias("radius"), "v")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = received()
        for b in batches:
            for at, x in matrices(b, 64):
                if x.shape[1] not in known:
                    continue
                c = known[x.shape[1]]
                code, d, near = c(x), distances(x, c.sample), len(c.sample)
                # the query's own vector may be one of the sample
                reached = np.partition(d, k, axis=1)[:, k] if near > k else np.full(len(x), np.inf)
                radius = c.radius(reached)
                apart = np.bitwise_count(code[:, None] ^ c(c.sample)).astype(int)
                want = int(np.ceil(first * near / n[x.shape[1]]))
                small = np.partition(apart, min(want, near) - 1, axis=1)[:, min(want, near) - 1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(at)), pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(code.view(np.int64)),
                     pa.array(np.minimum(small, radius).astype(np.int32)), pa.array(radius.astype(np.int32)), _packed(x)],
                    ["id", "d", "code", "small", "radius", "v"])

    asking = stored(usable(queries).distinct().mapInArrow(asked, "id long, d int, code long, small int, radius int, v binary")
                    .withColumn("h", F.xxhash64("v")), "op13-queries")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = received()
        for b in batches:
            size, code, radius = b.column("d").to_numpy(), b.column("code").to_numpy().view(np.uint64), b.column("radius").to_numpy()
            for d in np.unique(size):
                at, c = np.flatnonzero(size == d), known[d]
                keys, m = c.keys(code[at]), len(c.bounds) - 1
                for s, (lo, hi) in enumerate(zip(c.bounds, c.bounds[1:])):
                    bits = prefix_bits(n[d], hi - lo, block)
                    row, group = near_prefixes((keys[:, s] >> np.uint64(hi - lo - bits)).astype(np.int64), radius[at] // m, bits)
                    for cut in range(0, len(row), 4096):
                        r = pa.array(at[row[cut:cut + 4096]])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), d), pa.int32()), pa.array(np.full(len(r), s), pa.int32()),
                                                          pa.array(group[cut:cut + 4096]), *[b.column(x).take(r) for x in ("id", "h", "code", "radius", "v")]],
                                                         ["d", "sub", "grp", "id", "h", "code", "radius", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = received()
        held: list[pa.RecordBatch] = []

        def take(held: list[pa.RecordBatch], dim: int) -> dict:
            t = pa.Table.from_batches(held)
            return {"id": t.column("id").to_numpy(), "h": t.column("h").to_numpy(), "code": t.column("code").to_numpy().view(np.uint64),
                    "radius": t.column("radius").to_numpy(), "v": _vectors(t.column("v"), dim)}

        def flush(now: tuple, rows: dict | None) -> Iterator[pa.RecordBatch]:
            if rows is None or not held:
                return
            q = take(held, now[0])
            got = list(probe(q, rows, now[1], known[now[0]], k + 1))
            if got:
                a, b, d = (np.concatenate(c) for c in zip(*got))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (q["id"][a], q["h"][a], rows["id"][b], rows["h"][b], d)],
                                                 ["query_id", "q", "id", "h", "score"])

        last, rows, index_rows = None, None, []
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.stack([b.column(c).to_numpy() for c in ("d", "sub", "grp", "part")])
            asks = b.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                this = tuple(int(v) for v in ids[:, lo])
                if this != last:
                    yield from flush(last, rows)
                    held.clear()
                    last, rows, index_rows = this, None, []
                if not asks[lo]:
                    index_rows.append(b.slice(lo, hi - lo))
                    continue
                if rows is None and index_rows:
                    rows, index_rows = take(index_rows, this[0]), []
                held.append(b.slice(lo, hi - lo))
                if sum(h.num_rows for h in held) >= 4096:
                    yield from flush(last, rows)
                    held.clear()
        yield from flush(last, rows)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def round_of(some: DataFrame, name: str) -> DataFrame:
        """(query_id, q, id, h, score, r): the nearest found with each query's ``radius``, k + 1 at most."""
        at = some.select("id", "h", "d", "code", "radius", "v").mapInArrow(
            dealt, "d int, sub int, grp long, id long, h long, code long, radius int, v binary")
        at = at.join(sizes, ["d", "sub", "grp"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        both = index.unionByName(at.withColumn("asks", F.lit(True)).drop("blocks"))
        both = both.repartition(parts, "d", "sub", "grp", "part").sortWithinPartitions("d", "sub", "grp", "part", "asks")
        found = both.mapInArrow(compare, "query_id long, q long, id long, h long, score double")
        best = Window.partitionBy("query_id", "q").orderBy("score", "id")
        return stored(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1), name)

    def tightened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = received()
        for b in batches:
            new = b.column("radius").to_numpy().copy()
            size, score = b.column("d").to_numpy(), b.column("score").to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                at = np.flatnonzero((size == d) & ~np.isnan(score))
                new[at] = np.minimum(new[at], known[d].radius(score[at]))
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int32()) if c == "radius" else b.column(c) for c in b.schema.names], b.schema.names)

    def listed(found: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): the ids of the vectors found, the query's own left out."""
        each = found.join(points.select("id", "h", "ids"), ["id", "h"]).select("query_id", "score", F.explode("ids").alias("vec_id"))
        return each.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))

    found = round_of(asking.withColumn("radius", F.col("small")), "op13-first")
    # the query's own vector may be among those found, so the last of k + 1 bounds the k-th neighbour
    bound = found.where(F.col("r") == k + 1).select(F.col("query_id").alias("id"), F.col("q").alias("h"), "score")
    wider = stored(asking.join(bound, ["id", "h"], "left").select("id", "h", "d", "code", "small", "radius", "v", "score")
                   .mapInArrow(tightened, "id long, h long, d int, code long, small int, radius int, v binary, score double")
                   .where("radius > small"), "op13-wider")
    again = wider.select(F.col("id").alias("query_id"), F.col("h").alias("q"))
    found = found.join(again, ["query_id", "q"], "left_anti").unionByName(round_of(wider, "op13-more"))
    whole = stored(listed(found), "op13-found")
    # queries with fewer than k neighbours: every code lies within a radius of all bits
    full = whole.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id"))
    short = stored(asking.join(full, "id", "left_anti").withColumn("radius", F.lit(BITS)), "op13-short")
    if not short.isEmpty():
        rest = listed(round_of(short, "op13-rest"))
        whole = whole.unionByName(rest).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return whole.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
