"""How quality filters interact: what each one removes in every order of application.

A document's failed filters are a row of a mask matrix: 0 where it fails, a number beyond all
steps where it passes. The positions of the filters in all orders (each order's inverse permutation) are the
columns of a second matrix. Their product with (min, +) for (+, x) is the step at which each order removes
the document: the smallest position of a filter that it fails. That matrix of steps scatters the
documents' weights to removals, redundant failures and losses.

Documents are counted by (part, failed filters, labels) before the product, so it runs over classes and
not over documents.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Texts of more bytes are gone through word by word instead of being split at once.
LONG_TEXT = 1 << 20

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_NOT_CAPITAL = bytes(c for c in range(256) if not 65 <= c <= 90)


@dataclass(frozen=True)
class Rules:
    """Limits of the filters A to D; E (an identical text of smaller doc_id) has none."""

    min_words: int = 200
    min_distinct_percent: int = 50
    max_capital_percent: int = 3
    symbols: str = "#$%&*|"

    names = "ABCDE"

    def mask(self, text: bytes, chars: int) -> int:
        """Failed filters A to D of one text as bits 0 to 3."""
        if len(text) <= LONG_TEXT:
            words = text.split()  # of bytes: splits at just these six characters
            n, distinct = len(words), len(set(words))
        else:
            seen, n = set(), 0
            for m in _WORDS.finditer(text):
                seen.add(m.group())
                n += 1
            distinct = len(seen)
        capitals = len(text.translate(None, _NOT_CAPITAL))
        symbols = self.symbols.encode()
        return ((n < self.min_words) | (100 * distinct < self.min_distinct_percent * n) << 1
                | (100 * capitals > self.max_capital_percent * chars) << 2
                | (len(text.translate(None, symbols)) < len(text)) << 3)


def document_classes(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text",
                     part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, weight): documents counted by what they fail and how they are labelled.

    Every row counts, also those without key: such a row has no labels and no smaller doc_id, and does not
    make others fail E. Null texts and parts are empty ones. A doc_id labelled in several rows is good (toxic) if one of them
    says 1. Texts are identical if their SHA-256 is. Equal rows are counted before any join, and a text's smallest
    doc_id is joined on text and doc_id, so neither copies nor a repeated doc_id gather in one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, digests = [], []
            for t in b.column("text"):
                s = t.as_py()
                data = s.encode()
                masks.append(rules.mask(data, len(s)))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                                             ["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    seen = stored(rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary"), "op12-masks")
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality"), F.col("toxic"))
           .groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    counted = seen.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    full = counted.join(first, ["digest", "doc_id"], "left").join(lab, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    no = F.lit(False)
    return (full.select("part", F.when(copy, F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")).alias("mask"),
                        F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("weight")))


def positions(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders (orders x steps, filter numbers) and the step of each filter in each order (filters x orders, from 1)."""
    orders = np.array(list(itertools.permutations(range(filters))), dtype=np.int64).reshape(-1, filters)
    return orders, np.argsort(orders, axis=1).T + 1


def removal_steps(fails: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Min-plus product of masks (rows x filters, True: fails) and places (filters x orders): the step at which
    each order removes each row, one more than the number of filters where none does."""
    never = len(place) + 1
    mask = np.where(fails, 0, never)
    steps = np.full((len(fails), place.shape[1]), never)
    for f in range(len(place)):
        np.minimum(steps, mask[:, f, None] + place[f], out=steps)
    return steps


def interactions(classes: DataFrame, names: Sequence[str], losses: dict[str, str], part: str = "part", mask: str = "mask",
                 weight: str = "weight") -> DataFrame:
    """One row per part, order of the filters ``names`` (``filter_order``) and ``step``: kept, removed, redundant,
    unique_fails, one column for each of ``losses`` (name: boolean column of ``classes``) and shapley.

    ``classes`` holds rows of any grain: bit f of ``mask`` says that filter f fails, ``weight`` counts
    documents. ``kept`` are those after the step, ``removed`` those it removes, ``redundant`` those that fail its filter but went
    earlier, ``unique_fails`` those that fail its filter only, a loss counts the removed whose column is true,
    ``shapley`` is the filter's removed summed over all orders. Parts of any number; an empty table gives no rows.
    All orders are taken, so the filters should be few (5: 120 orders, 7: 5,040).
    """
    n = len(names)
    orders, place = positions(n)
    labels = ["".join(names[f] for f in o) for o in orders]
    counts = ["kept", "removed", "redundant", "unique_fails", *losses]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            parts, at = np.unique(np.array(b.column("part").to_pylist(), dtype=object), return_inverse=True)
            w = b.column("weight").to_numpy()
            fails = (b.column("mask").to_numpy()[:, None] >> np.arange(n)) & 1 == 1
            steps = removal_steps(fails, place)
            out = {c: np.zeros((len(parts), len(orders), n), dtype=np.int64) for c in counts}
            lost = {c: w * b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in losses}
            alone = fails & (fails.sum(axis=1) == 1)[:, None]
            for s in range(n):
                here = orders[:, s]
                failing, removed = fails[:, here], steps == s + 1
                for c, v in {"kept": w[:, None] * (steps > s + 1), "removed": w[:, None] * removed,
                             "redundant": w[:, None] * (failing & (steps < s + 1)), "unique_fails": w[:, None] * alone[:, here],
                             **{c: x[:, None] * removed for c, x in lost.items()}}.items():
                    np.add.at(out[c][:, :, s], at, v)
            size = len(orders) * n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(parts, size), pa.string()), pa.array(np.tile(np.repeat(np.arange(len(orders)), n), len(parts)), pa.int32()),
                 pa.array(np.tile(np.arange(1, n + 1), len(parts) * len(orders)), pa.int32()), *[pa.array(out[c].ravel()) for c in counts]],
                ["part", "o", "step", *counts])

    rows = classes.select(F.col(part).alias("part"), F.col(mask).cast("int").alias("mask"), F.col(weight).cast("long").alias("weight"),
                          *[F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(name) for name, c in losses.items()])
    schema = "part string, o int, step int, " + ", ".join(f"{c} long" for c in counts)
    sums = rows.mapInArrow(run, schema).groupBy("part", "o", "step").agg(*[F.sum(c).alias(c) for c in counts])
    names_of = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("o") + 1)
    named = sums.select("part", names_of.alias("filter_order"), "step", *counts)
    named = stored(named.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))), "op12-steps")
    share = named.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return named.join(share, ["part", "filter"]).select("part", "filter_order", "step", *counts, "shapley")
