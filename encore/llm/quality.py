"""Quality scores by Bradley-Terry pairwise ranking.

A text is described by a few measures of its form. Labelled rows of a bounded sample make
preference pairs (a good text before a bad one); weights of binned measures are learned by
logistic loss on the pairs' feature differences. The threshold is a quantile of the
sample's scores, and scores are shifted so that it lies at one half.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

#: Most labelled rows that the fit reads (those with the smallest hashes of their ids), preference
#: pairs for each of them, bins of a measure, steps and penalty of the fit.
MAX_LABELLED = 20_000
PAIRS_EACH, BINS, STEPS, PENALTY = 8, 12, 300, 1e-3

MEASURES = ("log_words", "distinct_words", "distinct_pairs", "distinct_lines", "log_lines", "top_line", "top_word",
            "letters", "digits", "spaces", "stops", "commas", "bars", "symbols", "capitals", "beyond_ascii",
            "word_length", "long_words", "line_ends", "byte_kinds", "repeated_chars")

_REPEATED = re.compile(r"(\S)\1\1").findall


def measures(text: str) -> list[float]:
    """The measures of one whole text, in the order of ``MEASURES``; all zero for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * len(MEASURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    h = np.bincount(raw, minlength=256)
    n, k = float(len(raw)), float(len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    count = Counter(words)
    upper, lower = h[65:91].sum(), h[97:123].sum()
    symbols = h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum() - h[44] - h[46] - h[39] - h[45]
    return [
        np.log1p(k), len(count) / k, len(set(zip(words, words[1:]))) / k, len(set(lines)) / len(lines), np.log1p(len(lines)),
        max(Counter(lines).values()) / len(lines), max(count.values()) / k,
        (upper + lower + h[128:].sum()) / n, h[48:58].sum() / n, (h[32] + h[9] + h[10]) / n, h[46] / k, h[44] / k, h[124] / k,
        symbols / n, upper / max(1.0, upper + lower), h[128:].sum() / n, n / k,
        sum(len(w) > 15 for w in count) / len(count), sum(x.rstrip()[-1] in ".!?:;\"'»)" for x in lines) / len(lines),
        np.count_nonzero(h) / 64, len(_REPEATED(text)) / k]


@dataclass
class Model:
    """Cut points of the measures, a weight for each bin, and what turns a sum into a score."""

    cuts: np.ndarray
    weights: np.ndarray
    shift: float
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((bins(x, self.cuts) @ self.weights - self.shift) * self.scale, -40, 40)
        return 1 / (1 + np.exp(-z))


def bins(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One-hot bins of each measure."""
    out = np.zeros((len(x), x.shape[1], cuts.shape[1] + 1))
    for j in range(x.shape[1]):
        out[np.arange(len(x)), j, np.searchsorted(cuts[j], x[:, j], side="right")] = 1
    return out.reshape(len(x), -1)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Model:
    """Bradley-Terry: P(i before j) = sigmoid(w . (x_i - x_j)), by gradient steps on all pairs."""
    cuts = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if len(x) else np.zeros((len(MEASURES), BINS - 1))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):  # nothing to prefer
        w, share = np.zeros(len(MEASURES) * BINS), float(len(good) > 0)
        return Model(cuts, w, -1.0 if share else 1.0, 1.0)
    rng = np.random.default_rng(seed)
    m = PAIRS_EACH * max(len(good), len(bad))
    # every row of either kind takes part equally often
    a = np.concatenate([rng.permutation(good) for _ in range(-(-m // len(good)))])[:m]
    b = np.concatenate([rng.permutation(bad) for _ in range(-(-m // len(bad)))])[:m]
    z = bins(x, cuts)
    w, speed = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for _ in range(STEPS):
        s = z @ w
        p = 1 / (1 + np.exp(np.clip(s[a] - s[b], -40, 40)))
        pull = np.bincount(a, p, len(z)) - np.bincount(b, p, len(z))
        speed = 0.9 * speed + (pull @ z) / m - PENALTY * w
        w += 2.0 * speed
    s = z @ w
    shift = float(np.quantile(s, 1 - len(good) / len(y)))
    between = np.abs(s - shift)
    return Model(cuts, w, shift, 2.0 / max(1e-6, float(np.median(between))))


def _measured(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in rows:
        for lo in range(0, len(pdf), 512):
            part = pdf.iloc[lo:lo + 512]
            yield part.drop(columns="text").assign(x=[[float(v) for v in measures(t)] for t in part["text"]])


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
            max_labelled: int = MAX_LABELLED) -> Model:
    """A model from labelled rows (label 0 or 1; others are left out), at most ``max_labelled`` of them.
    The sample is read whole, its texts measured on the executors; a doc_id given both labels counts
    with the larger one. Without labels of both kinds all scores are alike."""
    lab = (labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
           .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = (texts(docs, key, text).join(lab, "doc_id").mapInPandas(_measured, "doc_id long, y int, x array<double>")
            .toPandas().sort_values("doc_id"))
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(MEASURES))
    return fit(x, rows["y"].to_numpy())


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for each row, from its whole text alone.

    ``score`` lies between 0 and 1 (higher: better), ``predicted`` is 1 from one half on. Null text is
    empty, an empty text has measures of zero; rows that repeat a doc_id each give a row; rows
    without doc_id are left out; an empty table gives no rows. Other columns are not read.
    """
    # a few thousand numbers, whatever the input
    send = docs.sparkSession.sparkContext.broadcast((model.cuts, model.weights, model.shift, model.scale))

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*send.value)
        for pdf in rows:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo:lo + 512]
                s = m.score(np.array([measures(t) for t in part["text"]], dtype=float).reshape(-1, len(MEASURES)))
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    return texts(docs, key, text).mapInPandas(run, "doc_id long, score double, predicted int")
