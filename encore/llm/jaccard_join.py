"""Word-shingle near duplicates by a chosen-path join.

Each set is a row of minhashes (its tokens). From the root of a run's tree a set goes on to two
children at each level, each chosen by a token the path samples, so similar sets mostly go the
same way and others part. After a few levels the leaves hold few sets and are
compared by brute force. A pair at the threshold survives a run with a known chance, and runs are
repeated until the target recall. What meets is checked by exact Jaccard similarity.
"""

from __future__ import annotations

import math
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts, versions, with_version
from .links import by_bucket, components, counted_here, in_blocks, local_roots

SHINGLE, SIMILARITY, RECALL, DEPTH, TOKENS, BLOCK = 5, 0.8, 0.999, 3, 128, 512
#: Words whose hashes a task remembers before it starts anew.
CACHE_WORDS = 400_000
_M = np.uint64(0xBF58476D1CE4E5B9)


def miss(similarity: float, depth: int) -> float:
    """Chance that a pair of this similarity shares no leaf of one run: at each node both children are lost."""
    q = 0.0
    for _ in range(depth):
        q = (1 - similarity + similarity * q) ** 2
    return q


def runs(similarity: float, depth: int, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss(similarity, depth))))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct hashes of a whole text's shingles of ``size`` lower-case words; a text of fewer words is one shingle."""

    def __init__(self, size: int) -> None:
        import xxhash

        self.size = size
        self.split = re.compile(r"\S+").findall

        class Table(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
                return h

        self.table = Table()

    def __call__(self, text: str) -> np.ndarray:
        words = self.split(text.lower())
        if not words:
            return np.zeros(0, dtype=np.uint64)
        w = np.fromiter(map(self.table.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.size, len(w))
        h = np.full(len(w) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i])
        return np.unique(h)


def minhashes(shingles: np.ndarray, tokens: int) -> np.ndarray:
    """``tokens`` minima of the hashes under different multipliers."""
    odd = mixed(np.arange(1, tokens + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.full(tokens, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(shingles), 2048):  # bounded memory for very long texts
        h = shingles[lo:lo + 2048, None] * odd
        out = np.minimum(out, (h ^ (h >> np.uint64(32))).min(axis=0))
    return mixed(out * odd)


def leaves(sig: np.ndarray, depth: int, n_runs: int) -> np.ndarray:
    """Keys (rows x n_runs * 2**depth) of the leaves that each row of minhashes reaches."""
    n, tokens = sig.shape
    path = np.broadcast_to(mixed(np.arange(1, n_runs + 1, dtype=np.uint64)), (n, n_runs))
    for _ in range(depth):
        child = np.stack([mixed(path + np.uint64(c)) for c in (1, 2)], axis=2).reshape(n, -1)
        token = np.take_along_axis(sig, (child % np.uint64(tokens)).astype(np.int64), axis=1)
        path = mixed(child ^ token)
    return path.astype(np.int64)


def similar_sets(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of exact Jaccard similarity at or above the threshold, without its diagonal. Only shingles of
    two or more of the sets are multiplied, a bounded number at once."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    vocab, inv, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(n > 1)
    col = np.full(len(vocab), -1)
    col[shared] = np.arange(len(shared))
    c = col[inv]
    order = np.argsort(c, kind="stable")
    c, owner = c[order], owner[order]
    inter = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for lo in range(0, len(shared), 4096):
        a, b = np.searchsorted(c, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, len(shared) - lo)), dtype=np.float32)
        m[owner[a:b], c[a:b] - lo] = 1
        inter += m @ m.T
    union = size[:, None] + size[None, :] - inter
    out = inter >= similarity * union - 1e-9
    np.fill_diagonal(out, False)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    similarity: float = SIMILARITY, recall: float = RECALL, depth: int = DEPTH, block: int = BLOCK,
                    numbers: DataFrame | None = None) -> DataFrame:
    """One row per input row: doc_id, version, n_links, component_id, kept.

    Texts are linked when the sets of their shingles (``shingle`` lower-case words between white space)
    have a Jaccard similarity of ``similarity`` or more; ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest doc_id reachable by links, itself included, which stays. Texts of equal
    sets are compared once and counted as often as they occur. A pair at the threshold is met
    with a chance of ``recall`` or more, a pair above it with a larger one; no pair below is linked.

    A text of fewer words is one shingle of them all; null, empty and blank texts have none and link with
    nothing. Rows without doc_id are left out; rows that repeat a doc_id count one by one, and where their texts differ
    ``version`` numbers these (see :func:`common.versions`; 0 otherwise): of a component, the rows of the smallest
    doc_id and then version are kept (``numbers``: these versions, where known already). An empty table gives no rows. Other columns are not read.
    """
    n_runs = runs(similarity, depth, recall)
    plain = texts(docs, key, text)
    base = with_version(plain, versions(plain, "op2") if numbers is None else numbers)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cut = Shingles(shingle)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids, sig, n, digest = [], [], [], []
                for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    s = cut(t)
                    ids.append(d)
                    n.append(len(s))
                    digest.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                    sig.append(minhashes(s, TOKENS))
                m = np.array(sig).reshape(-1, TOKENS)
                k = leaves(m, depth, n_runs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), part.column("version"), pa.array(digest, pa.binary()), pa.array(n, pa.int64()),
                     pa.array([x.tobytes() for x in (m & np.uint64(255)).astype(np.uint8)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * k.shape[1], pa.int32()), pa.array(k.ravel()))],
                    ["doc_id", "version", "digest", "n", "sketch", "keys"])

    rows = stored(base.mapInArrow(sketch, "doc_id long, version long, digest binary, n long, sketch binary, keys array<long>"), "op2-sketches")
    classes = stored(rows.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "version")).alias("first"), F.count("*").alias("weight"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("keys").alias("keys")).withColumn("id", F.monotonically_increasing_id()), "op2-classes")  # unique once written

    # which members of which buckets have a candidate that counts there: sizes and sketches tell
    members = in_blocks(classes.select("id", "keys"), block, "op2").join(classes.select("id", "n", "sketch", "keys"), "id")
    # five standard deviations below the expected number of equal tokens
    least = similarity * TOKENS - 5 * math.sqrt(TOKENS * similarity * (1 - similarity))

    def candidates(leaf: int, i: int, j: int, c: dict) -> dict | None:
        ids, part, n = c["id"].to_numpy(), c["part"].to_numpy(), c["n"].to_numpy().astype(float)
        s = np.minimum(n[:, None], n[None, :]) >= similarity * np.maximum(n[:, None], n[None, :]) - 1e-9
        np.fill_diagonal(s, False)
        a, b = np.nonzero(np.triu(s))
        m = np.array([np.frombuffer(x, dtype=np.uint8) for x in c["sketch"].to_pylist()])
        for lo in range(0, len(a), 65536):
            x, y = a[lo:lo + 65536], b[lo:lo + 65536]
            s[x, y] = s[y, x] = (m[x] == m[y]).sum(axis=1) >= least
        if not s.any():
            return None
        use = counted_here(s, c["keys"].flatten().to_numpy().reshape(len(ids), -1), leaf, i, j, part).any(axis=1)
        k = int(use.sum())
        return {"key": np.full(k, leaf), "i": np.full(k, i), "j": np.full(k, j), "part": part[use], "id": ids[use]} if k else None

    needed = stored(by_bucket(members, candidates, "key long, i long, j long, part long, id long"), "op2-needed")

    # the sets themselves, for those members only
    wanted = needed.select("id").distinct().join(classes.select("id", "digest", "first.doc_id", "first.version"), "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingles(shingle)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([cut(t).tobytes() for t in part.column("text").to_pylist()], pa.binary())],
                    ["id", "shingles"])

    chosen = base.join(wanted, ["doc_id", "version"]).select("id", "text").mapInArrow(sets, "id long, shingles binary")
    chosen = chosen.groupBy("id").agg(F.first("shingles").alias("shingles")).join(classes.select("id", "weight", "keys"), "id")

    def verify(leaf: int, i: int, j: int, c: dict) -> dict | None:
        ids, part = c["id"].to_numpy(), c["part"].to_numpy()
        s = similar_sets([np.frombuffer(x, dtype=np.uint64) for x in c["shingles"].to_pylist()], similarity)
        if not s.any():
            return None
        k = c["keys"].flatten().to_numpy().reshape(len(ids), -1)
        links = counted_here(s, k, leaf, i, j, part) @ c["weight"].to_numpy()
        use = s.any(axis=1)
        return {"id": ids[use], "links": links[use], "root": local_roots(s, ids)[use]}

    found = stored(by_bucket(needed.join(chosen, "id"), verify, "id long, links long, root long"), "op2-links")
    n = found.groupBy("id").agg(F.sum("links").alias("links"))
    part_of = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "op2")
    least = part_of.join(classes.select("id", "first"), "id").groupBy("component").agg(F.min("first").alias("least"))
    part_of = part_of.join(least, "component").select("id", "least")
    result = stored(classes.select("digest", "id", "first", "weight").join(n, "id", "left").join(part_of, "id", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "first").alias("least")), "op2-result")
    own = F.struct("doc_id", "version")
    return (rows.select("doc_id", "version", "digest").join(result, "digest", "left")
            .select("doc_id", "version", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("least.doc_id", "doc_id").alias("component_id"), (F.coalesce("least", own) == own).alias("kept")))
