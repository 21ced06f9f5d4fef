"""Corpus pipeline over ``documents``: from raw texts to packed windows.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. Each stage works on all that
the one before kept, and all but the last return the columns of documents.

1. toxicity: documents that the factorization machine (learned from ``labels``) predicts toxic go.
2. line_dedup: later copies of runs of three lines or fifty words go; a document left without any text goes.
3. jaccard: of each group of near duplicates the one with the smallest doc_id stays (one row of it, where a doc_id repeats).
4. substring_dedup: bytes of repeated 100-byte strings go, characters cut in two with them; a document
   left without any text goes.
5. packing: what is left, packed into windows of 2048 tokens mixed by source.

Rows without doc_id go in the second stage (no operator can name them); rows that repeat a doc_id with
different texts are judged each by its own text. ``n_chars`` follows the text. No SQL
expresses the learned first stage, so there is no ORACLE_SQL; tests hold the stages against a brute-force version.
"""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import jaccard_join, line_dedup, packing, substring_dedup, toxicity
from encore.llm.common import carried, discard, drop_scratch, owned, stored, table, texts, versions, with_version

#: Vocabulary of the packing stage; None takes the installed public one.
VOCABULARY: str | None = None
#: Owner of the scratch tables that stages write.
OWNER = "pipeline"


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def _with_text(docs: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` (text, and the row's other columns as ``rest``) in the columns of documents; empty ones go."""
    out = new.select("text", "rest.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.trim("text") != "").select(*[f"`{c}`" for c in docs.columns])


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage begins by deleting what earlier stages wrote besides their results; other queries' tables stay."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, OWNER)
        with owned(OWNER):
            return work(spark, docs, sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return toxicity.judged(rows, machine, keep=("row",)).where("predicted = 0").select("row.*")


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, line_dedup.without_repeated_lines(docs, rest=_others(docs)))


@_stage
def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbers = versions(texts(docs), "near")
    gone = jaccard_join.near_duplicates(docs, numbers=numbers).where("not kept").select("doc_id", "version").distinct()
    rows = with_version(texts(carried(docs, docs.columns), "doc_id", "text", "rest"), numbers)
    if numbers is not None:  # of equal rows of one doc_id one stays
        ids = numbers.select("doc_id").distinct()
        again = rows.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "version"])
        rows = rows.join(ids, "doc_id", "left_anti").unionByName(again)
    return rows.join(gone, ["doc_id", "version"], "left_anti").select("rest.*")


@_stage
def drop_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(docs, rest=_others(docs), characters=True)
    return _with_text(docs, kept.select(F.col("kept").alias("text"), "rest"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = VOCABULARY
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(docs, path, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard", drop_near),
    ("substring_dedup", drop_substrings),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; the last one's rows."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
