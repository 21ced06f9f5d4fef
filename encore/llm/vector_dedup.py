"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random to eight dimensions, once for each table, and decoded to the
nearest point of the E8 lattice. Each vector enters its own cell and the cells across the nearest
walls. Vectors that share a cell in some table are compared by cosine in double precision.

Expected share of pairs met at cosine 0.9 with three tables, scale 2 and eight neighbouring cells: 0.9997
(one table meets 0.936 of them, and 0.02 of unrelated pairs); more scale and more tables trade rows for fewer
unrelated pairs.
"""

from __future__ import annotations

import itertools
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .links import by_bucket, components, counted_here, in_blocks, local_roots

COSINE, TABLES, NEIGHBOURS, SCALE, SEED, BLOCK = 0.9, 3, 8, 2.0, 0, 1024


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or eight halves with an even number of minuses."""
    out = []
    for a, b in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            r = np.zeros(8)
            r[a], r[b] = s, t
            out.append(r)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array(out)


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: the nearer of those of D8 and of D8 moved by one half."""
    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        off = y - near
        odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        return near

    a, b = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def cells(unit: np.ndarray, tables: int, neighbours: int, scale: float, seed: int) -> np.ndarray:
    """Keys (rows x tables * (1 + neighbours)) of each vector's cell and its nearest neighbours' cells."""
    shortest, out = roots(), []
    dim = unit.shape[1]
    for t in range(tables):
        plane = np.random.default_rng([seed, t, dim]).normal(size=(dim, 8)) * scale / np.sqrt(8)
        x = unit @ plane
        p = nearest(x)
        near = np.argsort(-(x - p) @ shortest.T, axis=1, kind="stable")[:, :neighbours]
        points = np.concatenate([p[:, None, :], p[:, None, :] + shortest[near]], axis=1)
        odd = np.random.default_rng([seed, t, dim, 1]).integers(0, 1 << 63, 8, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        h = ((2 * points).astype(np.int64).astype(np.uint64) * odd).sum(axis=2)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(t)
        out.append(h ^ (h >> np.uint64(32)))
    return np.concatenate(out, axis=1).astype(np.int64)


def linked(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
           tables: int = TABLES, neighbours: int = NEIGHBOURS, scale: float = SCALE, seed: int = SEED,
           block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows linked directly (cosine of at least ``cosine``), ``component_id`` is the
    smallest vec_id reachable by links, itself included. Vectors that are null, empty, zero or hold null or non-finite
    components, and vectors of different lengths, link with nothing. Equal vectors are compared once and counted as
    often as they occur. Rows without key are left out; rows that repeat a key count one by one, with the same vector or another;
    an empty table gives no rows. Other columns (labels too) are not read.
    """
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null")
    good = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    # a vector's own number, unique once written; ids may come with several vectors
    same = stored(good.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
                  .withColumn("id", F.monotonically_increasing_id()), "op3-vectors")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                ids, w = part.column("id").to_numpy(), part.column("weight").to_numpy()
                vecs = [np.asarray(x, dtype=np.float64) for x in part.column("v").to_pylist()]
                size = np.array([len(x) for x in vecs])
                for dim in np.unique(size):
                    at = np.flatnonzero(size == dim)
                    x = np.stack([vecs[i] for i in at])
                    unit = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    k = cells(unit, tables, neighbours, scale, seed)
                    k = (k ^ np.int64(dim * 0x9E3779B1)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(w[at]), pa.array([u.tobytes() for u in unit], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k.shape[1], pa.int32()), pa.array(k.ravel()))],
                        ["id", "weight", "unit", "keys"])

    items = stored(same.select("id", "weight", "v").mapInArrow(hashed, "id long, weight long, unit binary, keys array<long>"), "op3-cells")
    members = in_blocks(items, block, "op3").join(items, "id")

    def compare(cell: int, i: int, j: int, c: dict) -> dict | None:
        ids, part = c["id"].to_numpy(), c["part"].to_numpy()
        raw = c["unit"].to_pylist()
        size = np.array([len(x) for x in raw])
        s = np.zeros((len(ids), len(ids)), dtype=bool)
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            x = np.stack([np.frombuffer(raw[k], dtype=np.float64) for k in at])
            s[np.ix_(at, at)] = x @ x.T >= cosine
        np.fill_diagonal(s, False)
        if not s.any():
            return None
        k = c["keys"].flatten().to_numpy().reshape(len(ids), -1)
        links = counted_here(s, k, cell, i, j, part) @ c["weight"].to_numpy()
        use = s.any(axis=1)
        return {"id": ids[use], "links": links[use], "root": local_roots(s, ids)[use]}

    found = stored(by_bucket(members, compare, "id long, links long, root long"), "op3-links")
    n = found.groupBy("id").agg(F.sum("links").alias("links"))
    part_of = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "op3")
    ids = same.select("id", "vec_id").join(part_of, "id").groupBy("component").agg(F.min("vec_id").alias("least"))
    part_of = part_of.join(ids, "component").select("id", "least")
    classes = stored(same.join(n, "id", "left").join(part_of, "id", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")),
        "op3-classes")
    return (rows.join(classes, "v", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
