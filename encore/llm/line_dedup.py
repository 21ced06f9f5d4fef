"""Line dedup by winnowing over line hashes (DataFrame functions only).

A run of lines counts at ``min_lines`` lines or ``min_words`` words. Windows are the shortest runs that count, one from each line on and one up to each
line: together they cover every run that counts, as a match found in one window is extended by the windows around it. In each window the
line with the smallest hash (the last of equal ones) is a fingerprint, so two documents that share a run share
a fingerprint in it. Fingerprints met once are dropped. The others' positions are joined on the fingerprint and matched by the
lines around; the earliest place of each window stays, and the neighbouring later ones make up the longest repeated
run, which goes.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, each_once, stored, texts, versions, with_version

MIN_LINES, MIN_WORDS = 3, 50


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, removed): numbers (from 0) of the lines to remove, for documents that have some.

    A line goes when it belongs to consecutive lines, ``min_lines`` of them or of ``min_words`` words together, that also start
    earlier (in a document of smaller doc_id, or higher up in the same one); so one long line can go by itself. Words stand between white space. Lines end at \\n
    and are compared whole. Lines of white space alone are not counted: they do not
    interrupt a run and are never removed. Null and empty texts have no such lines. Rows that repeat a doc_id
    and its text are taken once; different texts of one doc_id are documents of their own, numbered by ``version``
    (see :func:`common.versions`). A very frequent line or run is counted in each task before it
    moves, and never gathered in one place.
    """
    base = texts(docs, key, text)
    return _runs(base, versions(base, "op9"), min_lines, min_words)


def _windows(t: int, least: int) -> Column:
    """Shortest windows that count, from each line on and up to each line, over ``words`` (of the lines in order): first line * 2^8 + lines, each once."""
    n = F.size("words")

    def shortest(i: Column, step: int) -> Column:
        """Lines of the shortest window with line ``i`` at its beginning (step 1) or end (step -1); more than there are if none."""
        out = F.lit(t)
        for k in range(t - 1, 0, -1):
            # beyond the text a word count is null, and the window does not count
            words = [F.get("words", i + step * j) for j in range(k)]
            out = F.when(reduce(lambda a, b: a + b, words) >= least, k).otherwise(out)
        return out

    every = F.sequence(F.lit(0), n - 1)
    ahead = F.filter(F.transform(every, lambda i: F.struct(i.alias("s"), shortest(i, 1).alias("k"))), lambda w: w["s"] + w["k"] <= n)
    back = F.filter(F.transform(every, lambda i: F.struct((i + 1 - shortest(i, -1)).alias("s"), shortest(i, -1).alias("k"))), lambda w: w["s"] >= 0)
    number = lambda w: w["s"].cast("long") * 256 + w["k"]
    return F.array_union(F.transform(ahead, number), F.transform(back, number))


def _runs(all_rows: DataFrame, numbers: DataFrame | None, t: int, least: int) -> DataFrame:
    if not 1 <= t < 256:
        raise ValueError("min_lines must be between 1 and 255")
    lines = F.split("text", "\n")
    full = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                    lambda s: F.trim(F.translate(s["x"], "\t\r\x0b\x0c", "    ")) != "")
    base = each_once(all_rows, numbers).select("doc_id", "version", full.alias("full"))
    hashed = base.select("doc_id", "version", F.transform("full", lambda s: s["i"]).alias("at"),
                         F.transform("full", lambda s: F.xxhash64(s["x"])).alias("h"),
                         F.transform("full", lambda s: F.xxhash64(F.lit(7), s["x"])).alias("g"),
                         F.transform("full", lambda s: F.size(F.split(F.trim(F.translate(s["x"], "\t\r\x0b\x0c", "    ")), " +"))).alias("words"))
    hashed = stored(hashed.where(F.size("h") > 0), "op9-lines")

    starts = hashed.select("doc_id", "version", "h", "g", F.explode(_windows(t, least)).alias("w"))
    starts = starts.select("doc_id", "version", "h", "g", F.shiftright("w", 8).cast("int").alias("s"), F.col("w").bitwiseAND(255).cast("int").alias("k"))
    window = starts.select(
        "doc_id", "version", "s", "k",
        F.array_min(F.transform(F.slice("h", F.col("s") + 1, F.col("k")),
                                lambda x, i: F.struct(x.alias("fp"), (-(i + F.col("s"))).alias("back")))).alias("m"),
        F.xxhash64(F.slice("h", F.col("s") + 1, F.col("k"))).alias("w1"),
        F.xxhash64(F.slice("g", F.col("s") + 1, F.col("k"))).alias("w2"))
    window = stored(window.select("doc_id", "version", "s", "k", "m.fp", (-F.col("m.back")).alias("p"), "w1", "w2"), "op9-windows")

    # positions of a fingerprint: neighbouring windows with the same minimum are one
    position = window.groupBy("doc_id", "version", "p", "fp").agg(F.lit(1).alias("one"))
    frequent = stored(position.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "op9-frequent")
    met = stored(window.join(frequent, "fp", "left_semi"), "op9-met")
    first = (met.groupBy("fp", "k", "w1", "w2").agg(F.min(F.struct("doc_id", "version", "s")).alias("first"), F.count("*").alias("n"))
             .where("n > 1"))
    first = stored(first.select("fp", "k", "w1", "w2", F.col("first.doc_id").alias("d0"), F.col("first.version").alias("v0"),
                                F.col("first.s").alias("s0")), "op9-first")
    later = (met.join(first, ["fp", "k", "w1", "w2"]).where("doc_id <> d0 or version <> v0 or s <> s0")
             .groupBy("doc_id", "version").agg(F.collect_set(F.struct("s", "k")).alias("starts")))
    covered = F.array_distinct(F.flatten(F.transform(
        "starts", lambda w: F.transform(F.sequence(w["s"], w["s"] + w["k"] - 1), lambda j: F.element_at("at", j + 1)))))
    return (later.join(hashed.select("doc_id", "version", "at"), ["doc_id", "version"])
            .select("doc_id", "version", F.array_sort(covered).alias("removed")))


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                           min_lines: int = MIN_LINES, rest: Sequence[str] = (), min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: doc_id, text (lines left, joined by \\n), n_lines, n_removed, n_runs.
    With ``rest``, also a struct ``rest`` of the row's columns of these names.

    See :func:`repeated_runs`. ``n_lines`` counts all lines, ``n_runs`` the stretches of removed lines
    with no other line between (a line of white space counts as one). A text without removed lines stays byte for byte; an empty
    table gives no rows.
    """
    more = ["rest"] if rest else []
    rows = texts(carried(docs, list(rest)), key, text, *more)
    numbers = versions(rows.select("doc_id", "text"), "op9")
    runs = stored(_runs(rows.select("doc_id", "text"), numbers, min_lines, min_words), "op9-runs")
    none = F.array().cast("array<int>")
    d = (with_version(rows, numbers).join(runs, ["doc_id", "version"], "left")
         .select("doc_id", F.split("text", "\n").alias("lines"), F.coalesce("removed", none).alias("removed"), *more))
    d = d.select("doc_id", "lines", "removed", *more,
                 F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed").alias("left"))
    return d.select(
        "doc_id", F.array_join(F.transform("left", lambda i: F.element_at("lines", i + 1)), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.size(F.array_except("removed", F.transform("removed", lambda i: i + 1))).cast("long").alias("n_runs"), *more)
