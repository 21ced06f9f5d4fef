"""Links found in buckets, counted once, and the components they make.

Members of a bucket are compared in blocks of bounded size: a bucket of any size becomes pairs of
blocks, each a group of its own, so no task holds more than two blocks. A pair that meets in
several buckets counts only in the one with the smallest key it shares, which either member's
list of keys tells; so links are counted without listing pairs.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def in_blocks(items: DataFrame, block: int, name: str) -> DataFrame:
    """(key, i, j, part, id): memberships of buckets with two or more members, each bucket cut by hash
    of id into parts of about ``block`` members, for each pair of parts i <= j. ``items``: (id, keys)."""
    at = items.select("id", F.explode("keys").alias("key")).distinct()
    n = stored(at.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), f"{name}-buckets")
    m = at.join(n, "key").withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    m = m.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return m.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id")


Compare = Callable[[list[bytes], list[bytes] | None], np.ndarray]


def by_bucket(members: DataFrame, work: Callable, out: str) -> DataFrame:
    """``work(key, i, j, columns)`` for each (key, i, j) of ``members``, where columns are Arrow arrays by
    name; it returns a dict of columns of the schema ``out`` or None."""
    names = [f.split()[0] for f in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        done: list[dict] = []

        def finish() -> None:
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                got = work(t.column("key")[0].as_py(), t.column("i")[0].as_py(), t.column("j")[0].as_py(),
                           {c: t.column(c).chunk(0) for c in t.column_names})
                held.clear()
                if got is not None:
                    done.append(got)

        def flush() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(np.concatenate([d[n] for d in done]).astype(np.int64)) for n in names], names)
            done.clear()
            return b

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.stack([b.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                this = tuple(ids[:, lo])
                if this != last:
                    finish()
                    last = this
                held.append(b.slice(lo, hi - lo))
            if sum(len(d[names[0]]) for d in done) > 20_000:
                yield flush()
        finish()
        if done:
            yield flush()

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, out))


def counted_here(similar: np.ndarray, keys: np.ndarray, key: int, i: int, j: int, part: np.ndarray) -> np.ndarray:
    """Which of the similar pairs count in this bucket and block pair: those that share no smaller key,
    and lie in parts i and j. ``similar`` is symmetric without its diagonal."""
    here = similar.copy()
    if i != j:
        here &= part[:, None] != part[None, :]
    rows = np.flatnonzero(here.any(axis=1))
    if not len(rows):
        return here
    k = keys[rows]
    smaller = k < key
    flat = k[smaller]
    if len(flat):
        vocab, inv, n = np.unique(flat, return_inverse=True, return_counts=True)
        col = np.full(len(vocab), -1)
        both = np.flatnonzero(n > 1)
        col[both] = np.arange(len(both))
        owner = np.broadcast_to(np.arange(len(rows))[:, None], k.shape)[smaller]
        met = np.zeros((len(rows), len(rows)), dtype=bool)
        for lo in range(0, len(both), 4096):
            c = col[inv]
            use = (c >= lo) & (c < lo + 4096)
            m = np.zeros((len(rows), min(4096, len(both) - lo)), dtype=np.float32)
            m[owner[use], c[use] - lo] = 1
            met |= (m @ m.T) > 0
        sub = here[np.ix_(rows, rows)] & ~met
        here = np.zeros_like(here)
        here[np.ix_(rows, rows)] = sub
    return here


def local_roots(similar: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each member reaches by the similar pairs."""
    label = ids.copy()
    rows = np.flatnonzero(similar.any(axis=1))
    if not len(rows):
        return label
    s, now = similar[np.ix_(rows, rows)], label[rows]
    big = np.iinfo(np.int64).max
    while True:
        new = np.minimum(now, np.where(s, now[None, :], big).min(axis=1))
        if (new == now).all():
            label[rows] = now
            return label
        now = new


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component): smallest id that each id of ``edges`` (a, b) reaches.

    Large-star and small-star steps in turn until nothing changes: each node's larger neighbours
    are tied to its smallest one, then its smaller ones. Each step is two grouped minima and a join, stored; a
    node with very many neighbours is counted in each task before it moves.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = stored(e, f"{name}-edges")
    seen = None
    while True:
        mark = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum("b")).first())
        if mark == seen or not mark[0]:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        seen = mark
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), f"{name}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        e = stored(small.where("a <> b").distinct(), f"{name}-small")
