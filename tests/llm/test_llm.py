"""Each operator against a brute-force version, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from encore.llm import (exact_dedup, filter_audit, hamming_search, html_text, jaccard_join, line_dedup, links, packing, quality, sentencepieces,
                        substring_dedup, toxicity, vector_dedup, whitening)

A = " ".join(f"word{i}" for i in range(60))
TEXTS = ["", None, "   \n\t", "short", A, A, A.replace("word30 ", "other "), "Ä" + A + "\n\n" + A, "ab" * 400, "x\ny\nz\nw\nx\ny\nz",
         "q\nx\ny\nz", "x\ny\nz\nw", "a  b ▁ c\n\n d   e", "日本語 text <|endoftext|> 😀", "z " * 3000, A.replace(" ", "  ")]
SCHEMA = "id long, doc_id long, text string, source string, key string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(7, i, t, f"s{i % 3}" if i % 4 else None, "k", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [(7, None, "no key", "s", "k", 1)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return {i: t or "" for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_groups(docs, empty, bits):
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs, id_bits=bits).collect()}
    groups = defaultdict(list)
    norm = {i: t.translate({ord(c): None for c in " \t\n\x0b\x0c\r"}) for i, t in texts().items()}
    for i, t in norm.items():
        groups[t].append(i)
    for i, t in norm.items():
        keep = min(groups[t], key=lambda k: (-len(texts()[k]), k))
        assert tuple(got[i]) == (i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest())
    assert len(got) == len(TEXTS) and not exact_dedup.exact_groups(empty).count()


def test_chunks_make_up_the_text(spark):
    rows = [(" ".join(f"w{i}." if i % 3 else f"w{i}" for i in range(500)).replace(" ", ""),), ("x" * 5000,), ("",), (".",), ("a..b.",)]
    for r in exact_dedup.with_chunks(spark.createDataFrame(rows, "norm string")).collect():
        assert "".join(r.chunks) == r.norm and all(len(c) <= 5000 for c in r.chunks)


def test_lines(spark, docs, empty):
    long = " ".join(f"w{i}" for i in range(80))
    half = [" ".join(f"{c}{i}" for i in range(30)) for c in "pqr"]
    more = ["own\n" + long, "other\n" + long + "\nend", long, half[0] + "\n" + half[1] + "\nx", "y\n" + half[0] + "\n\n" + half[1], half[0] + "\n" + half[2],
            half[1] + "\n" + half[0], long + "\nshort tail", "z\n" + long + "\nshort tail"]
    rows = [(7, 200 + i, t, "s", "k", 1) for i, t in enumerate(more)]
    every = texts() | {200 + i: t for i, t in enumerate(more)}
    docs = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in line_dedup.without_repeated_lines(docs).collect()}
    seen: set = set()
    for i, t in every.items():
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for j in range(len(full)):
            for size in (1, 2, 3):
                w = tuple(lines[k] for k in full[j:j + size])
                if len(w) == size and (size == 3 or sum(len(x.split()) for x in w) >= 50):
                    gone |= set(full[j:j + size]) if w in seen else set()
                    seen.add(w)
        assert got[i].text == "\n".join(x for k, x in enumerate(lines) if k not in gone), i
        assert (got[i].n_lines, got[i].n_removed) == (len(lines), len(gone))
    assert got[201].n_removed == 1 and got[202].n_removed == 1 and got[204].n_removed == 2 and got[205].n_removed == got[206].n_removed == 0
    assert got[208].n_removed == 2 and not line_dedup.without_repeated_lines(empty).count()


@pytest.mark.parametrize("mixture", [None, {"s0": 1.0, "s1": 5.0}])
def test_packing(docs, empty, mixture):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, by, seq = Tokenizer.from_file(path), defaultdict(list), defaultdict(list)
    for r in packing.packed(docs, path, window=128, segment=50, mixture=mixture).collect():
        by[r.doc_id].append(r)
        seq[r.sequence_id].append((r.offset, r.length))
    for i, t in texts().items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], dtype="<u4")
        p = sorted(by[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in p) == ids.tobytes() and all(r.doc_tokens == len(ids) for r in p)
    for s, p in seq.items():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))]
        assert s == max(seq) or sum(n for _, n in p) == 128
    assert not packing.packed(empty, path).count()


def test_packing_meets_the_mixture(spark):
    rows = [(1, i, "word " * 100, "ab"[i % 2], "k", 1) for i in range(400)]
    out = packing.packed(spark.createDataFrame(rows, SCHEMA), public_tokenizers.path("byte_bpe_50k.json"), window=512, segment=32,
                         mixture={"a": 3.0, "b": 1.0}).where("sequence_id < 50").groupBy("source").agg(F.sum("length").alias("n"))
    n = {r.source: r.n for r in out.collect()}
    assert abs(n["a"] / (50 * 512) - 0.75) < 0.01


def test_sentencepiece(docs, empty):
    import sentencepiece as spm

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = spm.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in sentencepieces.decoded(sentencepieces.encoded(docs, path), path).collect()}
    for i, t in texts().items():
        assert list(got[i].ids) == sp.encode(t) and got[i].decoded == sp.decode(sp.encode(t)), i
    assert not sentencepieces.encoded(empty, path).count()


@pytest.mark.parametrize("group", [4096, 1])
def test_repeated_substrings(spark, docs, empty, group):
    rng = np.random.default_rng(3)
    base = bytes(rng.integers(97, 100, 4000).astype(np.uint8)).decode()
    more = [base[a:a + 300] + base[b:b + 150] for a, b in rng.integers(0, 3500, (30, 2))]
    d = docs.unionByName(spark.createDataFrame([(7, 100 + i, t, "s", "k", 1) for i, t in enumerate(more)], SCHEMA))
    spans = {r.doc_id: r.spans for r in substring_dedup.repeated_spans(d, group=group).collect()}
    seen: set = set()
    for i, t in [*texts().items(), *((100 + i, t) for i, t in enumerate(more))]:
        data, want = t.encode(), set()
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                want |= set(range(s, s + 100))
            seen.add(data[s:s + 100])
        assert {k for x in spans.get(i) or () for k in range(x.lo, x.hi)} == want, i
    kept = {r.doc_id: bytes(r.kept) for r in substring_dedup.without_repeats(docs).collect()}
    assert kept[4] == A.encode() and kept[5] == b"" and not substring_dedup.without_repeats(empty).count()


def test_rows_that_repeat_a_doc_id(spark):
    import corpus_pipeline

    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    phrase = word(60)
    one, two, three = (f"{word(200)}{phrase}{word(200)}" for _ in range(3))
    # a row twice; two texts of one doc_id, of which one repeats lines of doc 1 and the other a passage of it
    lines = "\n".join(["first line", "second line", "third line"])
    rows = [(1, one + "\n" + lines), (1, one + "\n" + lines), (2, two), (3, three + "\n" + lines), (3, "own start\n" + one[:150] + word(90).upper())]
    docs = spark.createDataFrame([(i, t, str(k), len(t)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string, n_chars long")
    plain = sorted(bytes(r.kept).decode() for r in substring_dedup.without_repeats(docs).collect())
    assert plain == sorted([*(t for _, t in rows[:4]), "own start\n" + rows[4][1][160:]])
    kept = {r.rest.source: bytes(r.kept).decode() for r in substring_dedup.without_repeats(docs, rest=["source"]).collect()}
    assert kept == {str(k): t for k, (_, t) in enumerate(rows[:4])} | {"4": "own start\n" + rows[4][1][160:]}

    out = corpus_pipeline.drop_lines(spark, docs, "").collect()
    assert {r.source: r.text for r in out} == {str(k): t for k, (_, t) in enumerate(rows)} | {"3": three}
    assert all(r.n_chars == len(r.text) for r in out)
    assert {r.source: r.text for r in corpus_pipeline.drop_substrings(spark, docs, "").collect()} == kept


def test_no_large_group_is_indexed(spark, monkeypatch):
    """A hot passage between different texts: one window of many rows never reaches the index as one key."""
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    hot, group, index = word(130), 8, substring_dedup._index

    def limited(length):
        def run(batches):
            def seen(b):
                if b.num_rows and max(np.unique(b.column("key").to_numpy(), return_counts=True)[1]) > group:
                    raise ValueError("a large group in one key")
                return b

            return index(length)(map(seen, batches))

        return run

    monkeypatch.setattr(substring_dedup, "_index", limited)
    rows = [(i, f"{word(120)}{hot}{word(120)}") for i in range(40)]
    spans = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), group=group).collect()
    got = {r.doc_id: {k for x in r.spans for k in range(x.lo, x.hi)} for r in spans}
    seen, want = set(), {}
    for i, t in rows:
        for s in range(len(t) - 99):
            if t[s:s + 100] in seen:
                want.setdefault(i, set()).update(range(s, s + 100))
            seen.add(t[s:s + 100])
    assert got == want and len(want) == 39


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(docs, empty, block):
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(docs, block=block).collect()}
    sets = {}
    for i, t in texts().items():
        w = t.lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    near = {i: {j for j, b in sets.items() if j != i and a and b and len(a & b) >= 0.8 * len(a | b)} for i, a in sets.items()}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            fresh = near[todo.pop()] - reach
            reach |= fresh
            todo += fresh
        assert (got[i].n_links, got[i].component_id) == (len(near[i]), min(reach)), i
    assert not jaccard_join.near_duplicates(empty).count()


def test_one_id_with_several_texts_or_vectors(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a.replace("a30 ", "x ")), (3, b.replace("b30 ", "y ")), (4, "own text of its own here"), (1, a)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    at = defaultdict(list)
    for r in got:
        at[r.doc_id].append((r.n_links, r.component_id, r.kept))
    assert sorted(at[1]) == [(1, 1, True), (2, 1, True), (2, 1, True)] and at[2] == [(2, 1, False)] and at[3] == [(1, 1, False)] and at[4] == [(0, 4, True)]
    x, y = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    vec = [(1, x), (1, y), (2, [1.0, 0.1] + [0.0] * 6), (3, [0.1, 1.0] + [0.0] * 6), (4, [0.0] * 7 + [1.0])]
    got = [tuple(r) for r in vector_dedup.linked(spark.createDataFrame(vec, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_whole_characters():
    text = "aä\ufffd日😀b"
    data = text.encode()
    for lo in range(len(data) + 1):
        for hi in range(lo, len(data) + 1):
            kept, at = "", 0
            for c in text:
                n = len(c.encode())
                kept += c if at + n <= lo or at >= hi or lo == hi else ""
                at += n
            assert substring_dedup.whole_characters([data[:lo], data[hi:]] if lo < hi else [data]) == kept


def test_chosen_path_recall():
    assert jaccard_join.miss(0.8, 3) ** jaccard_join.runs(0.8, 3, 0.999) <= 0.001


@pytest.mark.parametrize("block", [1024, 3])
def test_vectors(spark, block):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(4, 16))
    v = [(centre[i % 4] + rng.normal(size=16) * 0.25).tolist() for i in range(40)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] * 16, [1e300] * 16, [2e300] * 16, [1.0] * 8, v[0]]
    rows = [(i, x, i) for i, x in enumerate(v + odd)]
    got = {r.vec_id: r for r in vector_dedup.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int"), tables=8, block=block).collect()}
    unit = {i: np.array(x) / max(x) / np.linalg.norm(np.array(x) / max(x)) for i, x, _ in rows
            if x and all(y is not None and np.isfinite(y) for y in x) and any(x)}
    unit = {i: u if np.dot(u, rows[i][1]) > 0 else -u for i, u in unit.items()}
    for i, _, _ in rows:
        near = {j for j in unit if j != i and i in unit and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9}
        assert got[i].n_links == len(near), i
        assert got[i].component_id <= min(near | {i})
    assert not vector_dedup.linked(spark.createDataFrame([], "vec_id long, embedding array<float>")).count()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(139, 150)]
    got = {r.id: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in [*range(100, 140), 150])


PAGE = ("<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class='cookie-notice'>Cookies</div><nav><ul><li>a<li>b</ul></nav>"
        "<main><article><h1>Head &amp; line</h1><p>One two<br>three&nbsp;four <b>bo</b>ld.<p>Second <a href='x'>link</a>.<div class=\"ad\">buy</div>"
        "<ul><li>x<li>y</ul><form><input><label>mail</label></form><script>var p='<p>';</script><p>Last.</p><section id='comments'><p>nice</p></section>"
        "</article></main><aside>side</aside><footer>&copy; foot</footer></body></html>")


def test_html(spark):
    rows = [(1, "u", PAGE, 9), (None, None, PAGE, 9), (2, "u", None, 9), (3, "u", "<nav>only menu</nav>", 9), (1, "u", "plain   words", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_text.extracted(pages, html_text.learned(pages)).collect()
    want = "Head & line\n\nOne two three four bold.\n\nSecond link.\n\nx\n\ny\n\nLast."
    assert sorted(r.text for r in got) == sorted([want, want, "", "", "plain words"])
    assert all(r.n_chars == len(r.text) for r in got) and sum(r.page_id is None for r in got) == 1


def _labelled(spark, module, bad, column):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("aeiourstln"), 5))
    rows = [(1, i, bad(i, " ".join(word() for _ in range(rng.integers(5, 80)))), "s", "k", 1) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1, 1000, None, "s", "k", 1), (1, None, "x", "s", "k", 1)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400)] + [(None, 1), (5, None)], f"doc_id long, {column} int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = module.trained(docs, labels.where(~held))
    got = {r.doc_id: r for r in module.scored(docs, model).collect()}
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    return got, np.mean([got[i].predicted == int(i % 4 == 0) for i in out])


def test_toxicity_held_out(spark):
    got, right = _labelled(spark, toxicity, lambda i, t: t + " nasty fool" if i % 4 == 0 else t, "toxic")
    assert right > 0.95 and len(got) == 401 and 0 <= got[1000].score <= 1


def test_pairs_of_neutral_terms_are_learned():
    rng = np.random.default_rng(0)
    for kind in ("agree", "and"):
        rows, label = [], []
        for _ in range(4000):
            a, b = rng.random(2) < 0.5
            x = set(rng.integers(100, 2100, rng.integers(5, 60)).tolist()) | ({1} if a else set()) | ({2} if b else set())
            rows.append(np.array(sorted(x), dtype=np.int32))
            label.append(int(a == b) if kind == "agree" else int(a and b))
        y = np.array(label)
        m = toxicity.fit(rows[:3000], y[:3000])
        known = [p[p >= 0] for p in (m.places[r] for r in rows[3000:])]
        z, t = m.margin(np.concatenate(known), np.cumsum([len(k) for k in known])), y[3000:]
        place = np.argsort(np.argsort(z))
        assert (place[t == 1].sum() - t.sum() * (t.sum() - 1) / 2) / (t.sum() * (1 - t).sum()) > 0.95, kind


def test_quality_held_out(spark):
    got, right = _labelled(spark, quality, lambda i, t: t.capitalize() + "." if i % 4 == 0 else t.replace(" ", "$$ "), "quality")
    assert right > 0.95 and len(got) == 401 and 0 <= got[1000].score <= 1


def test_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.scored(docs, toxicity.trained(docs, none)).count() == len(TEXTS)
    assert quality.scored(docs, quality.trained(docs, none)).count() == len(TEXTS)


def test_pipeline_keeps_columns_and_runs(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, sf).cache()
        assert new.columns == docs.columns and 0 < new.count() <= docs.count(), name
        docs = spark.createDataFrame(new.collect(), new.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == docs.count()


AWKWARD = [None, [], [0.0] * 6, [float("nan")] * 6, [float("-inf")] + [1.0] * 5, [1.0, None, 2.0, 3.0, 4.0, 5.0]]


def _awkward_vectors(spark, n=70, seed=4):
    """(id, vector) rows of two lengths with copies, ties, repeated ids, null ids and unusable vectors; and their table."""
    rng = np.random.default_rng(seed)
    v = [(rng.normal(size=6) * (1 + i % 3)).tolist() for i in range(n)]
    rows = list(enumerate(v)) + [(100 + i, v[5]) for i in range(15)] + [(200 + i, x) for i, x in enumerate(AWKWARD)]
    rows += [(300 + i, rng.normal(size=3).tolist()) for i in range(8)] + [(0, v[1]), (5, v[5]), (None, v[2]), (400, [2.0] + [0.0] * 5), (410, [-2.0] + [0.0] * 5)]
    return rows, spark.createDataFrame([(i, x, 1, "c") for i, x in rows], "vec_id long, embedding array<double>, label int, score string")


def _fine(x):
    return bool(x) and all(c is not None and np.isfinite(c) for c in x)


def test_bit_planes_count_exactly():
    rng = np.random.default_rng(2)
    for low, high, rows in [(-5, 6, 1), (-300, 300, 200), (0, 1, 65), (-(1 << 62), 1 << 62, 70), (7, 8, 64)]:
        x = rng.integers(low, high, (rows, 5), dtype=np.int64)
        s, c = whitening.scatter(x)
        big = x.astype(object)
        assert (s == big.sum(axis=0)).all() and (c == big.T @ big).all()


def test_whitened(spark):
    rows, df = _awkward_vectors(spark)
    got = defaultdict(list)
    for r in whitening.whitened(df).collect():
        got[r.vec_id].append(r)
    for d in (6, 3):
        xs = [(i, np.floor(256 * np.array(x)).astype(int)) for i, x in rows if _fine(x) and len(x) == d]
        fit = np.unique([x for _, x in xs], axis=0)
        n, s = len(fit), fit.sum(axis=0)
        c = (n * fit - s) / n
        e, u = np.linalg.eigh(c.T @ c / n)
        e, u = e[::-1], u[:, ::-1]
        k = min(4, d)
        for i in {i for i, _ in xs}:
            mine = [(n * x - s) for j, x in xs if j == i]
            for comp in range(k):
                r = [x for x in got[i] if x.component == comp + 1]
                assert len(r) == len(mine) and {x.n for x in r} == {n} and sorted(int(x.deviation) for x in r) == sorted(int((m ** 2).sum()) for m in mine)
                want = sorted(abs(m / n @ u[:, comp]) / np.sqrt(e[comp]) for m in mine)
                assert np.allclose(sorted(abs(x.whitened) for x in r), want) and abs(r[0].explained - e[comp] / e.sum()) < 1e-9
                assert r[0].identity_error < 1e-9
    assert set(got) == {i for i, x in rows if _fine(x)}
    assert not whitening.whitened(df.limit(0)).count()


def test_whitened_without_variance(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)] + [(9, [1.0, 2.0, 1e308])], "vec_id long, embedding array<double>")
    got = whitening.whitened(df).collect()
    assert len(got) == 4 * 2 + 3 and all(r.whitened == 0 and r.explained == 0 and r.n == 1 and r.identity_error == 1 for r in got)


AUDIT = [("en", "Word " * 250 + "a"), ("en", " ".join(f"w{i}" for i in range(250))), (None, ""), ("de", None), ("de", "x#y"), ("en", "Word " * 250 + "a"),
         ("fr", "ABC " + " ".join(f"Ärger{i}\x0bz" for i in range(300))), ("fr", "|" + " ".join(f"w{i}" for i in range(201))), ("de", "x#y"), ("", "tie tie\ttie")]


@pytest.mark.parametrize("long_text", [1 << 20, 10])
def test_filter_audit(spark, monkeypatch, long_text):
    import itertools
    import re

    monkeypatch.setattr(filter_audit, "LONG_TEXT", long_text)
    rows = [(i, t, p, 1) for i, (p, t) in enumerate(AUDIT)] + [(None, "x#y", "de", 1), (4, "x#y", "de", 1), (4, "other", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, weight int")
    labels = [(0, 1, 0), (5, 1, 1), (4, 0, 1), (4, 1, None), (None, 1, 1), (7, None, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.interactions(
        filter_audit.document_classes(docs, lab), "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"}).collect()}
    items = []
    for i, t, p, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _, _ in rows)}
        items.append((p or "", {f for f in fails if fails[f]}, any(j == i and q == 1 for j, q, _ in labels if j is not None),
                      any(j == i and x == 1 for j, _, x in labels if j is not None)))
    want, total = {}, defaultdict(int)
    for part in {x[0] for x in items}:
        for o in map("".join, itertools.permutations("ABCDE")):
            left = [x for x in items if x[0] == part]
            for s, f in enumerate(o, 1):
                out, seen = [x for x in left if f in x[1]], [x for x in items if x[0] == part]
                left = [x for x in left if f not in x[1]]
                want[part, o, s] = (len(left), len(out), sum(f in x[1] for x in seen) - len(out), sum(x[1] == {f} for x in seen),
                                    sum(x[2] for x in out), sum(x[3] for x in out))
                total[part, f] += len(out)
    assert got == {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    none = filter_audit.document_classes(docs.limit(0), lab)
    assert not filter_audit.interactions(none, "ABCDE", {"good_lost": "good"}).count()


@pytest.mark.parametrize("block", [32768, 4])
def test_nearest_vectors(spark, block):
    rows, df = _awkward_vectors(spark)
    asking = df.where("vec_id % 5 = 0")
    got = defaultdict(list)
    # radii that reach all neighbours make the search exact
    for r in hamming_search.nearest(df, asking, k=10, block=block, reach=1.0, first=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    good = [(i, np.array(x)) for i, x in rows if i is not None and _fine(x) and any(x)]
    for q in {i for i, _ in good if i % 5 == 0}:
        best = {}
        for i, x in good:
            for j, y in good:
                if i == q and j != q and len(x) == len(y):
                    d = float(np.sqrt(((x - y) ** 2).sum()))
                    best[j] = min(d, best.get(j, d))
        want = sorted((d, j) for j, d in best.items())[:10]
        assert [r.rank for r in got[q]] == list(range(1, len(want) + 1))
        assert np.allclose([r.score for r in got[q]], [d for d, _ in want]) and {r.vec_id for r in got[q]} == {j for _, j in want}, q
    assert set(got) == {i for i, _ in good if i % 5 == 0}
    assert not hamming_search.nearest(df.limit(0), asking).count() and not hamming_search.nearest(df, asking.limit(0)).count()


def test_nearest_recall_and_large_values(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(float)
    got = defaultdict(set)
    for r in hamming_search.nearest(df, df.where("vec_id % 50 = 0"), sample=1000, block=256, first=64).collect():
        got[r.query_id].add(r.vec_id)
    found = 0
    for q in range(0, 3000, 50):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        found += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert found / (60 * 10) >= 0.95
    big = spark.createDataFrame([(0, [1e300, 0.0]), (1, [-1e300, 0.0]), (2, [0.0, 1e300]), (3, [1e-310, 1e-310])], "vec_id long, embedding array<double>")
    near = {r.vec_id: r.score for r in hamming_search.nearest(big, big.where("vec_id = 0")).collect()}
    assert set(near) == {1, 2, 3} and np.allclose([near[1], near[2], near[3]], [2e300, 2 ** 0.5 * 1e300, 1e300])


def test_pipeline_stages_against_brute_force(spark):
    """Rows that repeat a doc_id, odd characters and copies: each stage by itself on a table of its own."""
    import corpus_pipeline as cp

    rng = np.random.default_rng(12)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    prose = lambda n: " ".join(word(6) for _ in range(n))
    a, b, c = prose(80), prose(80), prose(80)
    swap = lambda t, k: " ".join("other" if i == k else w for i, w in enumerate(t.split()))
    rows = [(1, a), (5, b), (5, swap(a, 40)), (6, swap(b, 3)), (7, c), (7, c), (8, "orig \ufffd mark " + prose(20)), (9, ""), (10, None)]
    docs = spark.createDataFrame([(i, t, "x", f"s{k}", len(t or ""), k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, version int")
    got = cp.drop_near(spark, docs, "")
    assert got.columns == docs.columns
    # 5's second text is near 1, 6 is near 5's first; of 7's equal rows one stays
    left = sorted(r.version for r in got.collect())
    assert [k for k in left if k not in (4, 5)] == [0, 1, 6, 7, 8] and len(left) == 6
    passage = word(110)
    odd = [(1, "ü" + passage + "日 \ufffd end"), (2, "x\ufffd" + passage + "日 \ufffd tail"), (3, "own " + "日" * 40), (3, "another " + "日" * 40 + "!")]
    docs = spark.createDataFrame([(i, t, "x", f"s{k}", len(t)) for k, (i, t) in enumerate(odd)], docs.schema.fieldNames()[:5])
    out = {r.source: r for r in cp.drop_substrings(spark, docs, "").collect()}
    seen: set = set()
    for k, (i, t) in enumerate(odd):
        data, gone = t.encode(), set()
        for s in range(len(data) - 99):
            gone |= set(range(s, s + 100)) if data[s:s + 100] in seen else set()
            seen.add(data[s:s + 100])
        want, at = "", 0
        for ch in t:
            n = len(ch.encode())
            want += "" if gone & set(range(at, at + n)) else ch
            at += n
        assert out[f"s{k}"].text == want and out[f"s{k}"].n_chars == len(want), k
    # toxic rows go by their own text, whatever their key
    bad = [(i, prose(30) + (" vile slur" if i % 4 == 0 else "")) for i in range(200)] + [(1, prose(30) + " vile slur"), (None, prose(30)), (None, "vile slur")]
    docs = spark.createDataFrame([(i, t, "x", f"s{k}", len(t)) for k, (i, t) in enumerate(bad)], docs.schema.fieldNames())
    import tempfile

    folder = tempfile.mkdtemp()
    spark.createDataFrame([(i, int(i % 4 == 0), 0) for i in range(200) if i != 1], "doc_id long, toxic int, quality int").write.parquet(folder + "/labels.parquet")
    kept = {r.source for r in cp.drop_toxic(spark, docs, folder).collect()}
    assert kept == {f"s{k}" for k, (_, t) in enumerate(bad) if "slur" not in t}


def test_stages_leave_other_queries_alone(spark, docs):
    import corpus_pipeline as cp

    before = exact_dedup.exact_groups(docs)
    plain = docs.select("doc_id", "text", "source")
    cp.drop_lines(spark, plain, "").count()
    cp.drop_near(spark, plain, "").count()
    assert before.count() == len(TEXTS)


def test_empty_tables(spark, empty):
    import corpus_pipeline as cp

    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert not toxicity.scored(empty, toxicity.trained(empty, none)).count() and not quality.scored(empty, quality.trained(empty, none)).count()
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert not html_text.extracted(pages, html_text.learned(pages)).count()
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:]:
        if name != "packing":  # a stage's rows are written before the next one begins
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and not out.collect(), name
    assert not cp.STAGES[-1][1](spark, docs, "").count()


STORY = "<p>" + " ".join(f"story{i}" for i in range(120)) + "</p>"


@pytest.mark.parametrize("page, want", [
    (f"<body><div><article class='card'><h2>Teaser one</h2></article><article class='card'><h2>Teaser two</h2></article></div><div class='story'>{STORY}</div></body>", "story"),
    (f"<body><div class='content-sidebar-wrap'><div>{STORY}</div><nav>menu entries</nav></div></body>", "story"),
    (f"<body class='has-sidebar'><div class='search-result'><h1>Title</h1>{STORY}</div></body>", "Title story"),
    (f"<body><article>{STORY}<div class='comments'>{'<p>nice text here</p>' * 90}</div></article></body>", "story"),
    ("<body><article><p title=don't>one two three</p><p>it's four</p></article></body>", "one two three it's four"),
    ("<body><article><p data-x='a > b' class=x/y>one</p><a href=/u?a=1&b=2>two</a> < three</article></body>", "one two < three"),
])
def test_html_regions(page, want):
    labelled = f"<body><article><h1>Some title</h1>{STORY}</article><div>{'<h2>More of this</h2>' * 30}</div></body>"
    got = html_text.main_text(page, html_text.weights(html_text.counts(labelled))).split()
    story = [f"story{i}" for i in range(120)]
    assert got == [w for t in want.split() for w in (story if t == "story" else [t])]


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<div>" * 50_000 + "</span>" * 50_000, "<span>" * 50_000 + "<p></p>" * 50_000,
                                  "<p><div>" + "<span>" * 50_000 + "<p></p>" * 50_000, '<a x="' * 100_000, "<!--" * 100_000, "<li>" * 50_000])
def test_hostile_pages_take_time_in_proportion(page):
    import time

    def seconds(p):
        t = time.process_time()
        html_text.main_text(p, {})
        return time.process_time() - t

    least = min(seconds(page[:len(page) // 8]) for _ in range(2))
    assert seconds(page) < 5 and seconds(page) < 24 * max(least, 0.02)  # eight times the page; sixty-four times if it were quadratic
