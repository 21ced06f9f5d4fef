"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of a model has a white-space marker behind another character, nothing is merged
across the start of a marked word, so a text's ids are its words' ids in order. Each task
cuts texts into marked words, segments each distinct word once with the library, and
joins the ids back by position. The table of words stays with the task and is bounded.
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .common import texts

MARK = "▁"
#: Words whose ids a task remembers before it starts anew.
CACHE_WORDS = 400_000
#: Texts turned into one Arrow batch.
BATCH = 256


class WordTable:
    """Encodes whole texts by a table of marked words; checks that the model allows it."""

    def __init__(self, path: str) -> None:
        import re

        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        pieces = [p.piece for p in proto.pieces if p.type not in (2, 3, 6)]
        self.whole = spm.SentencePieceProcessor(model_file=path)
        #: The model's words can be told apart only if texts are taken as they are.
        self.by_word = (not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces
                        and not proto.trainer_spec.treat_whitespace_as_suffix and all(p.type != 4 for p in proto.pieces)
                        and not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces))
        self.first = " " if norm.add_dummy_prefix else ""
        # spaces and what follows up to the next space; line ends stand alone
        self.words = re.compile(f"\n|[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+").findall
        norm.add_dummy_prefix = False
        bare = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())

        class Table(dict):
            def __missing__(self, word: str) -> list[int]:
                ids = bare.encode(word)
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = ids
                return ids

        self.table = Table()

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.by_word:
            return self.whole.encode(text)
        ids: list[int] = []
        for w in map(self.table.__getitem__, self.words(self.first + text)):
            ids += w
        return ids


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the library's ids of each whole text, without begin and end ids.

    Null and empty texts have no ids; rows that repeat a doc_id each give a row; rows without
    doc_id are left out; an empty table gives no rows. Other columns are not read. A model
    whose pieces cross white space is used through the library, text by text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTable(path)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([words.encode(t) for t in part.column("text").to_pylist()], pa.list_(pa.int32()))],
                    ["doc_id", "ids"])

    return texts(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` (any columns) with ``decoded``: the library's text of each row's ids. Null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece as spm

        sp = spm.SentencePieceProcessor(model_file=path)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                out = [None if x is None else sp.decode(x) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, "decoded"])

    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema)
