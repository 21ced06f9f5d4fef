"""Exact dedup through content-defined chunk recipes (DataFrame functions only).

A text, freed of white space, is cut where its own characters say so. Equal texts are cut
alike, so a document is its recipe: the ordered list of its chunks' identifiers. Chunk
text moves once, to a table of distinct chunks which verifies that an identifier stands
for one chunk only; from then on only recipes move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import once, stored, texts

#: White space that does not count.
SPACE = " \t\n\x0b\x0c\r"
#: One sentence in so many ends a chunk; a chunk of more characters is cut at each so many.
SENTENCES, MAX_CHUNK = 8, 2048


def normalised(text: Column) -> Column:
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def with_chunks(norm: DataFrame) -> DataFrame:
    """Adds ``chunks``, whose concatenation is ``norm``. A chunk ends behind a full stop when the
    hash of the sentence before it says so, so equal stretches are cut alike wherever they stand;
    long stretches without such an end are cut by length."""
    d = norm.withColumn("s", F.split("norm", r"\."))
    d = d.withColumn("cuts", F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: (
        (F.xxhash64(F.element_at("s", i)).bitwiseAND(F.lit(SENTENCES - 1)) == 0) | (i == F.size("s")))))

    def chunk(end: Column, k: Column) -> Column:
        before = F.when(k == 0, 0).otherwise(F.element_at("cuts", k))
        body = F.concat(F.array_join(F.slice("s", before + 1, end - before), "."),
                        F.when(end < F.size("s"), ".").otherwise(""))
        return body

    d = once(d, whole=F.transform("cuts", chunk))
    return once(d, chunks=F.flatten(F.transform("whole", lambda c: F.when(
        F.octet_length(c) > MAX_CHUNK, F.regexp_extract_all(c, F.lit(f"(?s).{{1,{MAX_CHUNK}}}"), F.lit(0)))
        .otherwise(F.array(c))))).drop("s", "cuts", "whole")


def identifier(chunk: Column, id_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - id_bits) if id_bits < 64 else F.xxhash64(chunk)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", id_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space (``SPACE``). The row whose original
    text has the most code points, then the smallest doc_id, stays. Null text counts as
    empty, and all empty texts are equal. Rows that repeat a doc_id count one by one and
    are kept together. Rows without doc_id are left out; an empty table gives no rows.
    Other columns are not read.

    ``id_bits`` shortens identifiers (tests force collisions with it). Chunks that share an
    identifier are told apart by their rank, so the result never rests on a hash alone.
    """
    base = texts(docs, key, text)
    norm = base.select("doc_id", F.length("text").alias("n_cp"), normalised(F.col("text")).alias("norm"))
    pieces = with_chunks(norm).select(F.explode("chunks").alias("chunk"))
    distinct = pieces.select(identifier(F.col("chunk"), id_bits).alias("id"), "chunk").distinct()
    shared = stored(distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"),
                    "op6-shared-ids")

    recipe = F.transform("chunks", lambda c: identifier(c, id_bits))
    recipes = with_chunks(norm).select("doc_id", "n_cp", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe"))
    if shared.isEmpty():
        recipes = recipes.withColumn("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))
    else:
        recipes = _ranked(norm, pieces, recipes, shared, id_bits)
    recipes = stored(recipes, "op6-recipes")

    groups = stored(recipes.groupBy("recipe", "ranks")
                    .agg(F.max(F.struct("n_cp", (-F.col("doc_id")).alias("minus"))).alias("best"),
                         F.count("*").alias("group_size")), "op6-groups")
    g = groups.select("recipe", "ranks", (-F.col("best.minus")).alias("keep_id"), "group_size")
    return (recipes.join(g, ["recipe", "ranks"])
            .select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def _ranked(norm: DataFrame, pieces: DataFrame, recipes: DataFrame, shared: DataFrame, id_bits: int) -> DataFrame:
    """Recipes with the ranks of those chunks whose identifier is not theirs alone."""
    same = (pieces.select(identifier(F.col("chunk"), id_bits).alias("id"), "chunk")
            .join(shared, "id", "left_semi").distinct())
    ranked = same.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("chunk")))
    found = (with_chunks(norm)
             .select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.posexplode("chunks").alias("pos", "chunk"))
             .withColumn("id", identifier(F.col("chunk"), id_bits)).join(ranked, ["id", "chunk"])
             .groupBy("doc_id", "text_sha256")
             .agg(F.array_sort(F.collect_set(F.struct("pos", "rank"))).alias("ranks")))
    return (recipes.join(found, ["doc_id", "text_sha256"], "left")
            .withColumn("ranks", F.coalesce("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))))
