"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, filter_audit, hamming_search, html_text, jaccard_join, line_dedup, packing, quality, sentencepieces,
               substring_dedup, toxicity, vector_dedup, whitening)
from .common import table


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as n from documents),
g as (select doc_id, n, first_value(doc_id) over (partition by n order by length(t) desc, doc_id) as keep_id,
             count(*) over (partition by n) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(n) as text_sha256 from g
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of runs of three lines or fifty words removed from all documents; one row per document."""
    out = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents),
e as (select doc_id, generate_subscripts(a, 1) - 1 as i, unnest(a) as x from l),
c as (select doc_id, i, x, row_number() over (partition by doc_id order by i) - 1 as j,
             len(regexp_split_to_array(trim(translate(x, chr(9) || chr(13) || chr(11) || chr(12), '    ')), ' +')) as words
      from e where trim(translate(x, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''),
o as (select doc_id, j, x as x0, lead(x, 1) over o as x1, lead(x, 2) over o as x2, words as w0, lead(words, 1) over o as w1 from c
      window o as (partition by doc_id order by j)),
w as (select doc_id, j, 3 as k, x0, x1, x2 from o where x2 is not null
      union all select doc_id, j, 2, x0, x1, '' from o where x1 is not null and w0 + w1 >= 50
      union all select doc_id, j, 1, x0, '', '' from o where w0 >= 50),
f as (select doc_id, j, k, row_number() over (partition by k, x0, x1, x2 order by doc_id, j) as rn from w),
r as (select distinct c.doc_id, c.i from f join c on c.doc_id = f.doc_id and c.j between f.j and f.j + f.k - 1 where f.rn > 1),
k as (select e.doc_id, count(*) as n_lines, count(r.i) as n_removed,
             coalesce(string_agg(case when r.i is null then e.x end, chr(10) order by e.i), '') as kept
      from e left join r on r.doc_id = e.doc_id and r.i = e.i group by e.doc_id),
s as (select doc_id, count(*) as n_runs from (select doc_id, i, lag(i) over (partition by doc_id order by i) as b from r)
      where b is null or b <> i - 1 group by doc_id)
select k.doc_id, n_lines, n_removed, coalesce(n_runs, 0) as n_runs, sha256(kept) as kept_sha256
from k left join s using (doc_id)
"""

def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens, sources mixed by their share of tokens."""
    from public_tokenizers import path

    out = packing.packed(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset", "source")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again; digests of ids and texts."""
    from public_tokenizers import path

    model = path("piece_bpe_32k.model")
    rows = sentencepieces.decoded(sentencepieces.encoded(table(spark, sf_dir, "documents"), model), model)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def _split(column: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts == rest


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels of held-out rows are not learned."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.trained(docs, table(spark, sf_dir, "labels").where(~_split("doc_id", 5, 0)))
    return toxicity.scored(docs, machine).select("doc_id", _split("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels of held-out rows are not learned."""
    docs = table(spark, sf_dir, "documents")
    model = quality.trained(docs, table(spark, sf_dir, "labels").where(~_split("doc_id", 3, 1)))
    return quality.scored(docs, model).select("doc_id", _split("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extracted(pages, html_text.learned(pages))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings."""
    return vector_dedup.linked(table(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate texts among all documents by five-word shingles."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_links", "component_id", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings removed from all documents."""
    out = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda s: s["hi"] - s["lo"])
    return out.select("doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all usable embeddings along the four largest components."""
    out = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from all documents in each order, by language."""
    classes = filter_audit.document_classes(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.interactions(classes, filter_audit.Rules.names, {"good_lost": "good", "toxic_lost": "toxic"})


OP12_SQL = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^ 	-
]+') as ws from d),
m as (select doc_id, part, len(ws) < 200 as a, 100 * len(list_distinct(ws)) < 50 * len(ws) as b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
             coalesce(doc_id > min(doc_id) over (partition by t), false) as e from w),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
k as (select part, a, b, c, d, e, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
      from m left join l using (doc_id) group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (select p.f || q.f || r.f || s.f || u.f as filter_order from x p, x q, x r, x s, x u
      where q.f <> p.f and r.f not in (p.f, q.f) and s.f not in (p.f, q.f, r.f) and u.f not in (p.f, q.f, r.f, s.f)),
g as (select k.*, filter_order, least(case when a then instr(filter_order, 'A') else 9 end, case when b then instr(filter_order, 'B') else 9 end,
             case when c then instr(filter_order, 'C') else 9 end, case when d then instr(filter_order, 'D') else 9 end,
             case when e then instr(filter_order, 'E') else 9 end) as gone, a::int + b::int + c::int + d::int + e::int as fails from k, o),
h as (select *, substr(filter_order, step, 1) as f,
             case substr(filter_order, step, 1) when 'A' then a when 'B' then b when 'C' then c when 'D' then d else e end as failing
      from g, (select unnest(range(1, 6)) as step)),
s as (select part, filter_order, step::int as step, any_value(f) as f,
             sum(case when gone > step then n else 0 end)::bigint as kept, sum(case when gone = step then n else 0 end)::bigint as removed,
             sum(case when failing and gone < step then n else 0 end)::bigint as redundant,
             sum(case when failing and fails = 1 then n else 0 end)::bigint as unique_fails,
             sum(case when gone = step and good then n else 0 end)::bigint as good_lost,
             sum(case when gone = step and toxic then n else 0 end)::bigint as toxic_lost from h group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, f))::bigint as shapley from s
"""


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings of every one whose vec_id is divisible by 100, among all."""
    rows = table(spark, sf_dir, "embeddings")
    return hamming_search.nearest(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_nearest": op13_nearest,
}
ORACLES: dict[str, str] = {"op6_exact_dedup": OP6_SQL, "op9_line_dedup": OP9_SQL, "op12_filter_audit": OP12_SQL}
