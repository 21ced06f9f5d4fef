"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of token segments in document order. In each round a source earns
its share of one window in tokens and is served whole segments while its credit lasts;
what is left of the credit (the deficit) goes to later rounds. As credit is never lost, a
segment that ends at token c of its queue is served in round ceil(c / earnings per
round): the order of service is known for all segments at once, on any partition. Two
prefix sums give each segment its place in its queue and in the served stream, and windows are cut
from that stream, so every window but the last is full.
"""

from __future__ import annotations

from typing import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prefix_sum, stored

WINDOW = 2048
#: Longest stretch of one document served at once, in tokens.
SEGMENT = 512


class ByteBpe:
    """Ids of texts as little-endian unsigned 32-bit bytes, exactly as the tokenizers library
    encodes with the given byte-level file.

    Where the file's merges stand in the order of their ids, merging by rank gives the same ids, so
    tiktoken does the work, several times faster. Texts with a special token's string, or with
    characters beyond those on which all Unicode versions agree, go to the tokenizers library."""

    def __init__(self, path: str) -> None:
        import json
        import re

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        special = [t["content"] for t in file["added_tokens"]]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in merges]
        pre = file["pre_tokenizer"]
        plain = (made == sorted(made) and file["normalizer"] is None and pre["type"] == "ByteLevel"
                 and not pre["add_prefix_space"] and pre["use_regex"])
        # a byte that is no visible character stands in the file as the next free one from U+0100
        seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(c): c for c in seen} | {chr(0x100 + k): c for k, c in enumerate(c for c in range(256) if c not in seen)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special} if plain else {}
        self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe if plain else None
        self.odd = re.compile("|".join([*map(re.escape, special), "[^\x00-\u024f\u2010-\u2027]"])).search

    def __call__(self, text: str) -> bytes:
        if self.core is None or self.odd(text):
            return pack(self.tok.encode(text, add_special_tokens=False).ids)
        return bytes(memoryview(self.core.encode_to_tiktoken_buffer(text, set())))


def pack(ids: list[int]) -> bytes:
    import numpy as np

    return np.asarray(ids, dtype="<u4").tobytes()


def tokenized(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text",
              source: str = "source") -> DataFrame:
    """(row_id, doc_id, source, ids, n_tokens): each row's ids and ``end_id`` as bytes, see :class:`ByteBpe`."""
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                    F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
                    F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = ByteBpe(path), pack([end_id])
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [bpe(t) + end for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), part.column("doc_id"), part.column("source"), pa.array(ids, pa.large_binary()).cast(pa.binary()),
                     pa.array([len(x) // 4 for x in ids], pa.int64())],
                    ["row_id", "doc_id", "source", "ids", "n_tokens"])

    return (d.withColumn("row_id", F.monotonically_increasing_id())
            .mapInArrow(encode, "row_id long, doc_id long, source string, ids binary, n_tokens long"))


def packed(docs: DataFrame, path: str, end_id: int = 1, mixture: Mapping[str, float] | None = None,
           window: int = WINDOW, segment: int = SEGMENT, key: str = "doc_id", text: str = "text",
           source: str = "source") -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens, mixed by source.

    Returns one row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset,
    ids (binary, little-endian unsigned 32-bit). Each id of a document (``end_id`` included) lies in
    one piece; pieces leave no gap in a window; all windows but the last are full.

    ``mixture`` gives the sources' target proportions of tokens; sources it leaves out get the
    smallest proportion given. Without it each source's target is its share of all tokens, so
    all queues end together. When a queue is empty the others share the windows
    in their proportions. A window departs from the targets by less than a segment for each source,
    and what it owes is made up later.

    Null text is empty (one token), a null source is a source of its own (''), rows that repeat a
    doc_id are documents of their own, rows without doc_id are left out, an empty table gives no
    rows. Other columns are not read. Order within a source is by doc_id.
    """
    if not 0 < segment <= window:
        raise ValueError("segment must be between 1 and window")
    tokens = stored(tokenized(docs, path, end_id, key, text, source), "op1-tokens")
    sizes = tokens.select("row_id", "source", "doc_id", "n_tokens")
    queue = prefix_sum(sizes, ["source"], ["doc_id", "row_id"], "n_tokens", "before", "op1-queues")
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("w"))
    if mixture:
        least = min(mixture.values())
        if least <= 0:
            raise ValueError("proportions must be positive")
        given = tokens.sparkSession.createDataFrame([(k, float(v)) for k, v in mixture.items()], "source string, p double")
        totals = totals.join(given, "source", "left").select("source", F.coalesce("p", F.lit(least)).alias("w"))
    # one row for each source: a window over so few rows is no burden for one task
    earns = totals.select("source", (F.col("w") / F.sum("w").over(Window.partitionBy(F.lit(0))) * window).alias("earns"))

    parts = queue.join(earns, "source").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / segment))).alias("k"))
    parts = parts.select(
        "row_id", "source", "earns", (F.col("k") * segment).alias("start"),
        F.least(F.lit(segment).cast("long"), F.col("n_tokens") - F.col("k") * segment).alias("length"), "before")
    parts = parts.select(
        "row_id", "source", "start", "length", (F.col("before") + F.col("start")).alias("at"),
        F.ceil((F.col("before") + F.col("start") + F.col("length")) / F.col("earns")).alias("round"))
    served = prefix_sum(parts, [], ["round", "source", "at"], "length", "place", "op1-served")

    fits = F.least("length", window - F.col("place") % window)
    cut = served.select("row_id", F.explode(F.when(
        fits < F.col("length"), F.array(F.struct("start", fits.alias("length"), "place"),
                                        F.struct((F.col("start") + fits).alias("start"), (F.col("length") - fits).alias("length"),
                                                 (F.col("place") + fits).alias("place"))))
        .otherwise(F.array(F.struct("start", "length", "place")))).alias("p")).select("row_id", "p.*")
    return tokens.join(cut, "row_id").select(
        "doc_id", "source", "start", "length", F.col("n_tokens").alias("doc_tokens"),
        F.floor(F.col("place") / window).alias("sequence_id"), (F.col("place") % window).alias("offset"),
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"))
