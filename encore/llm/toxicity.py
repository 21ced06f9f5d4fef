"""Toxicity scores from a factorization machine over hashed terms.

Terms are a text's distinct words and the beginnings of its words, hashed into a fixed number of
slots. The machine adds to the terms' own weights one product for each pair of terms, so
that two harmless terms can weigh together (an insult beside a group's name).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts

#: Most labelled rows that the fit reads (those with the smallest hashes of their ids).
MAX_LABELLED = 16_000
#: Slots, factors of each term, and labelled documents that a term must occur in to be known.
SLOTS, FACTORS, MIN_DOCUMENTS = 1 << 20, 4, 5
PREFIXES = (4, 5)
EPOCHS, BATCH = 20, 256
#: Steps and penalties of weights and factors, and the factors' spread at the start.
RATE, PENALTY = 0.2, 1e-3
PAIR_RATE, PAIR_PENALTY, START = 0.1, 0.03, 0.03
#: Standard deviations from chance at which a term counts as leaning, over which it comes to lean in full, and the further penalty
#: of a weight (not of factors) whose term does not lean.
LEAN, NEUTRAL = (1.5, 3.0), 0.02
#: One row in so many sets the bias alone.
ASIDE = 5
#: Words whose slots a task remembers before it starts anew.
CACHE_WORDS = 300_000

_WORDS = re.compile(r"\w+").findall


def slots(word: str) -> list[int]:
    """Slots of a word and of its beginnings."""
    terms = [word, *[f"{word[:n]}\0{n}" for n in PREFIXES if len(word) > n]]
    return [zlib.crc32(t.encode("utf-8", "replace")) % SLOTS for t in terms]


class Terms:
    """Sorted distinct slots of whole texts; with ``places``, only slots that have a place, as places."""

    def __init__(self, places: np.ndarray | None = None) -> None:
        class Table(dict):
            def __missing__(self, word: str) -> tuple[int, ...]:
                s = slots(word)
                if places is not None:
                    s = [int(p) for p in places[s] if p >= 0]
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = t = tuple(s)
                return t

        self.table = Table()

    def __call__(self, text: str) -> np.ndarray:
        found: set[int] = set()
        for t in map(self.table.__getitem__, set(_WORDS(text.lower()))):
            found.update(t)
        return np.fromiter(sorted(found), dtype=np.int32, count=len(found))


@dataclass
class Machine:
    """``places`` gives each slot's row in ``w`` and ``v``, -1 for slots without weights."""

    places: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Margins of rows given as places one row after the other, and the rows' ends."""
        return self.bias + _sums(self.w[flat], ends) + _pairs(self.v[flat], ends)[0]


def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)])
    return c[ends] - c[np.concatenate([[0], ends[:-1]])]


def _pairs(v: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over a row's pairs of terms of their factors' product, whole in texts of any length; and the rows' sums of factors."""
    s = _sums(v, ends)
    return (0.5 * (s * s - _sums(v * v, ends))).sum(axis=1), s


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Machine:
    """A machine from rows of slots: every ``ASIDE``-th row is kept aside, and when the others have
    given the weights, the bias is set so that fewest of those kept aside lie on the wrong side."""
    aside = np.arange(len(y)) % ASIDE == ASIDE - 1
    m = _weights([r for r, a in zip(rows, aside) if not a], y[~aside], seed)
    kept = [p[p >= 0] for p in (m.places[r] for r, a in zip(rows, aside) if a)]
    if not kept or not 0 < y[aside].sum() < aside.sum() or not len(m.w):
        return m
    z, t = m.margin(np.concatenate(kept), np.cumsum([len(k) for k in kept])), y[aside]
    order = np.argsort(z, kind="stable")
    z, t = z[order], t[order]
    # errors if the k smallest margins count as clean
    wrong = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
    wrong[1:-1][z[1:] == z[:-1]] = len(z) + 1
    best = np.flatnonzero(wrong == wrong.min())
    k = int(best[len(best) // 2])
    if 0 < k < len(z):
        m.bias -= float(z[k - 1] + z[k]) / 2
    return m


def _weights(rows: list[np.ndarray], y: np.ndarray, seed: int) -> Machine:
    """Adagrad on logistic loss with penalties applied after each step. Terms of fewer than ``MIN_DOCUMENTS`` rows get no weights. The weight of a
    term that occurs among rows of label 1 as chance has it is held down by a larger penalty; factors of all known terms
    learn alike, so that terms neutral alone can weigh as a pair."""
    seen = np.bincount(np.concatenate(rows), minlength=SLOTS) if rows else np.zeros(SLOTS, int)
    known = np.flatnonzero(seen >= MIN_DOCUMENTS)
    places = np.full(SLOTS, -1, dtype=np.int32)
    places[known] = np.arange(len(known))
    rows = [p[p >= 0] for p in (places[r] for r in rows)]
    rng = np.random.default_rng(seed)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    m = Machine(places, float(np.log(rate / (1 - rate))), np.zeros(len(known)), rng.normal(0, START, (len(known), FACTORS)))
    if not len(known) or not 0 < y.sum() < len(y):
        m.v[:] = 0.0
        return m
    among = np.bincount(np.concatenate([r for r, t in zip(rows, y) if t]), minlength=len(known))
    chance = seen[known] * rate
    lean = np.clip((np.abs(among - chance) / np.sqrt(chance + 0.5) - LEAN[0]) / LEAN[1], 0.0, 1.0)
    held, size_of = PENALTY + NEUTRAL * (1 - lean), 0.1 + 0.9 * lean
    gw, gv = np.full(len(known), 1e-6), np.full((len(known), FACTORS), 1e-4)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            flat = np.concatenate([rows[i] for i in pick])
            size = np.array([len(rows[i]) for i in pick])
            ends = np.cumsum(size)
            vx = m.v[flat]
            pair, s = _pairs(vx, ends)
            z = np.clip(m.bias + _sums(m.w[flat], ends) + pair, -30, 30)
            g = 1 / (1 + np.exp(-z)) - y[pick]
            m.bias -= RATE * float(g.mean())
            if not len(flat):
                continue
            at, inv = np.unique(flat, return_inverse=True)
            dw = np.bincount(inv, np.repeat(g, size), len(at))
            gw[at] += dw * dw
            step = RATE / np.sqrt(gw[at])
            m.w[at] = (m.w[at] - step * size_of[at] * dw) / (1 + step * held[at] * len(pick))
            # a long text's many factors do not make its step larger
            each = g * np.minimum(1.0, 1.0 / np.maximum(np.linalg.norm(s, axis=1), 1e-9))
            dv = np.repeat(each, size)[:, None] * (np.repeat(s, size, axis=0) - vx)
            for f in range(FACTORS):
                d = np.bincount(inv, dv[:, f], len(at))
                gv[at, f] += d * d
                step = PAIR_RATE / np.sqrt(gv[at, f])
                m.v[at, f] = (m.v[at, f] - step * d) / (1 + step * PAIR_PENALTY * len(pick))
    return m


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
            max_labelled: int = MAX_LABELLED) -> Machine:
    """A machine from labelled rows (label 0 or 1; others are left out), at most ``max_labelled`` of them.
    Terms are hashed on the executors. A doc_id given both labels counts as labelled 1. Without labels
    of both kinds all scores are alike."""
    lab = (labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
           .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for pdf in rows:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo:lo + 256]
                yield pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "x": [terms(t).tobytes() for t in part["text"]]})

    got = (texts(docs, key, text).join(lab, "doc_id").mapInPandas(run, "doc_id long, y int, x binary")
           .toPandas().sort_values("doc_id"))
    return fit([np.frombuffer(x, dtype=np.int32) for x in got["x"]], got["y"].to_numpy())


def scored(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for each row, from its whole text alone: see :func:`judged`.

    ``score`` lies between 0 and 1 (higher: more likely toxic), ``predicted`` is 1 from one half on.
    Null and empty texts have no terms and get the bias alone; rows that repeat a doc_id each
    give a row; rows without doc_id are left out; an empty table gives no rows. Other columns
    are not read.
    """
    return judged(texts(docs, key, text), machine, "text", ("doc_id",))


def judged(docs: DataFrame, machine: Machine, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., score, predicted): each row of ``docs`` with the columns ``keep``, whatever its key; no shuffle."""
    # at most SLOTS places and as many weights, whatever the input
    send = docs.sparkSession.sparkContext.broadcast((machine.places, machine.bias, machine.w, machine.v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*send.value)
        terms = Terms(m.places)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                found = [terms(t) for t in part.column("__text").to_pylist()]
                z = m.margin(np.concatenate(found), np.cumsum([len(x) for x in found]))
                s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(s), pa.array(s >= 0.5).cast(pa.int32())],
                                                 [*names, "score", "predicted"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    names = list(keep)
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema)
