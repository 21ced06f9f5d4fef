"""Repeated substrings by interval expansion on a Burrows-Wheeler transform.

Every window of ``length`` bytes has an anchor: its short gram of the smallest hash (the first of equal
ones). Equal windows have equal anchors at equal offsets, so only neighbours of anchors met
twice or more can repeat. Neighbouring windows of one anchor make a stretch; equal stretches are
counted before they move, and all but the first of them go whole. The distinct stretches of
an anchor are indexed together: on the Burrows-Wheeler transform of their text, boundaries between
suffixes are derived breadth first, by common prefixes of 0, 1, 2, ... bytes, each from a boundary
one shorter by one backward extension. At ``length`` the expansion stops: what no boundary has parted
are the repeated windows.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, discard, each_once, stored, texts, versions, with_version

LENGTH, GRAM = 100, 24
#: Stretches of one anchor that are indexed together; more are first parted by what stands around.
GROUP = 4096
#: Bytes indexed together, bytes read at once.
INDEX, CHUNK = 1 << 16, 1 << 22

#: Different texts of one doc_id: places of version k of a text are counted from k << VERSION.
VERSION = 40
PLACE = (1 << VERSION) - 1

SPAN = "array<struct<lo:long,hi:long>>"


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows, anchor place) of the stretches of ``data`` (bytes, at least ``length``)."""
    v = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    y = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(32)
    n = len(data) - GRAM + 1
    h = y[:n] * np.uint64(0x9E3779B97F4A7C15)
    h += y[8:n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += y[16:n + 16] * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    # place in the low bits: of equal grams the first is the smallest
    low = np.uint64((1 << 24) - 1)
    m = (h & ~low) | np.arange(n, dtype=np.uint64)
    width, have = length - GRAM + 1, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[:len(m) - (width - have)], m[width - have:])
    place = (m & low).astype(np.int64)
    lo = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return h[place[lo]].astype(np.int64), lo, np.diff(np.concatenate([lo, [len(place)]])), place[lo]


def repeated(stretches: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(class, start): the class of each window of ``length`` bytes of the stretches, and its start in their
    text with one byte between. Windows are equal exactly when their classes are."""
    size = np.array([len(s) for s in stretches])
    text = np.frombuffer(b"\0".join(stretches) + b"\0", dtype=np.uint8)
    n = len(text)
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    count = size - length + 1
    windows = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())

    # suffixes in the order of their first 2 ** k >= length bytes, around the end
    around = np.concatenate([text, np.resize(text, 8)])
    rank = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | around[k:n + k].astype(np.uint64)
    have = 8
    while have < length:
        _, rank = np.unique(rank, return_inverse=True)
        rank = (rank.astype(np.uint64) << np.uint64(32)) | np.roll(rank, -have).astype(np.uint64)
        have *= 2
    order = np.argsort(rank, kind="stable")

    # the transform, its characters' blocks and counts up to each place
    bwt = text[order - 1]
    chars, code = np.unique(bwt, return_inverse=True)
    occ = np.zeros((n + 1, len(chars)), dtype=np.int32)
    occ[np.arange(1, n + 1), code] = 1
    np.cumsum(occ, axis=0, out=occ)
    total = occ[n].copy()
    block = np.concatenate([[0], np.cumsum(total)[:-1]]).astype(np.int32)

    boundary = np.zeros(n, dtype=bool)
    boundary[block] = True
    new = block[1:]  # suffixes on either side share a prefix of no byte
    for _ in range(1, length):
        if not len(new):
            break
        r = occ[new]
        # a character before suffixes on both sides parts its own block one byte later
        at = (r + block)[(r > 0) & (r < total)]
        at = at[~boundary[at]]
        boundary[at] = True
        new = np.unique(at)
    cls = np.empty(n, dtype=np.int64)
    cls[order] = np.cumsum(boundary)
    return cls[windows], windows


def later_windows(stretches: list[bytes], doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, windows) of the runs of windows that also start earlier in one of the stretches."""
    cls, _ = repeated(stretches, length)
    count = np.array([len(s) for s in stretches]) - length + 1
    own = np.repeat(np.arange(len(stretches)), count)
    at = start[own] + np.arange(len(own)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    order = np.lexsort((at, doc[own], cls))
    later = np.zeros(len(own), dtype=bool)
    later[order[1:]] = cls[order[1:]] == cls[order[:-1]]
    edge = np.diff(np.concatenate([[0], later.astype(np.int8), [0]]))
    # a run ends with its stretch
    edge_own = np.flatnonzero(own[1:] != own[:-1]) + 1
    lo = np.union1d(np.flatnonzero(edge == 1), edge_own[later[edge_own]])
    hi = np.union1d(np.flatnonzero(edge == -1), edge_own[later[edge_own - 1]])
    return doc[own[lo]], at[lo], hi - lo


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def rows(doc_id: int, data: bytes, base: int) -> pa.RecordBatch:
            h, lo, count, place = anchors(np.frombuffer(data, dtype=np.uint8), length)
            ends = (lo + count + length - 1).tolist()
            digest = np.fromiter((xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(lo.tolist(), ends)), np.uint64, len(lo))
            return pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(digest.astype(np.int64)), pa.array(np.full(len(lo), doc_id)), pa.array(lo + base),
                 pa.array(count.astype(np.int32)), pa.array((place - lo).astype(np.int32))],
                ["anchor", "digest", "doc_id", "start", "windows", "place"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            for d, t, k in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "version"))):
                data = t.encode("utf-8", "surrogatepass")
                # a long text goes in pieces that share all but one byte of a window
                for base in range(0, max(1, len(data) - length + 1), CHUNK):
                    piece = data[base:base + CHUNK + length - 1]
                    if len(piece) >= length:
                        held.append(rows(d, piece, base + (k << VERSION)))
                if sum(x.num_rows for x in held) > 50_000:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return run


#: Ranges that the anchor's offset in a window is cut into, to see which stretches can share a window at all.
CELLS = 4
FETCHED = "key long, lo int, hi int, doc_id long, start long, windows int, place int, bytes binary, cells array<long>"


def cells(data: bytes, windows: int, place: int, length: int) -> list[int]:
    """For each range of offsets that occurs, a hash of the bytes that all windows of that range share."""
    import xxhash

    out, top = [], length - GRAM
    for c in range(CELLS):
        lo, hi = c * (top + 1) // CELLS, (c + 1) * (top + 1) // CELLS - 1
        if max(0, place - hi) <= min(windows - 1, place - lo):
            out.append(xxhash.xxh64_intdigest(data[place - lo:place - hi + length], seed=c) - (1 << 63))
    return out


def _fetch(length: int):
    """The bytes of the stretches listed with each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in FETCHED.split(", ")]
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                out: list[tuple] = []
                for d, t, wanted in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "wanted"))):
                    data = t.encode("utf-8", "surrogatepass")
                    for w in wanted:
                        at = w["start"] & PLACE
                        piece = data[at:at + w["windows"] + length - 1]
                        out.append((w["anchor"], 0, length - GRAM, d, w["start"], w["windows"], w["place"], piece,
                                    cells(piece, w["windows"], w["place"], length)))
                cols = list(zip(*out)) or [()] * len(names)
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names)

    return run


def _part(length: int):
    """Halves of stretches by the anchor's offset in the window, with a key of the bytes that all windows
    of that half and key share. A half of one offset is one window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            out: list[dict] = []
            for x in b.to_pylist():
                mid = (x["lo"] + x["hi"]) // 2
                for lo, hi in ((x["lo"], mid), (mid + 1, x["hi"])):
                    # window i has its anchor at offset place - i
                    first, last = max(0, x["place"] - hi), min(x["windows"] - 1, x["place"] - lo)
                    if first > last:
                        continue
                    shared = x["bytes"][x["place"] - lo:x["place"] - hi + length]
                    key = xxhash.xxh64_intdigest(shared + bytes([lo, hi])) - (1 << 63)
                    out.append({"key": key, "lo": lo, "hi": hi, "doc_id": x["doc_id"], "start": x["start"] + first,
                                "windows": last - first + 1, "place": x["place"] - first, "bytes": x["bytes"][first:last + length], "cells": []})
            yield pa.RecordBatch.from_pylist(out, schema=b.schema)

    return run


def _index(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole keys, then the last key's rows so far

        def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks()
            found = later_windows(t.column("bytes").to_pylist(), t.column("doc_id").to_numpy(), t.column("start").to_numpy(), length)
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in found], ["doc_id", "start", "windows"])

        size, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("key").to_numpy()
            weight = np.cumsum(b.column("windows").to_numpy() + length)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), b.num_rows]
            begin = 0
            for lo, hi in zip(cuts, cuts[1:]):
                if key[lo] != last and size >= INDEX:
                    if lo > begin:
                        held.append(b.slice(begin, lo - begin))
                    yield work(held)
                    held, size, begin = [], 0, lo
                last = key[lo]
                size += int(weight[hi - 1] - (weight[lo - 1] if lo else 0))
            held.append(b.slice(begin))
        if held:
            yield work(held)

    return run


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, version, spans): for documents that have any, bytes covered by a ``length``-byte string of the text in UTF-8 that
    also starts earlier (smaller doc_id, or the same document further up), as unordered, overlapping spans [lo, hi).

    Strings are judged on the texts as given and never cross documents. Null, empty and short texts have no
    spans. Rows that repeat a doc_id and its text are taken once; different texts of one doc_id are documents of their
    own, numbered by ``version`` (see :func:`common.versions`). Rows without doc_id are left
    out; an empty table gives no rows. Other columns are not read.
    """
    base = texts(docs, key, text)
    return _spans(base, versions(base, "op4"), length, group)


def _spans(all_rows: DataFrame, numbers: DataFrame | None, length: int, group: int) -> DataFrame:
    if not GRAM <= length <= 255:
        raise ValueError(f"length must be between {GRAM} and 255")
    base = each_once(all_rows, numbers)
    seen = stored(base.where(F.octet_length("text") >= length).mapInArrow(
        _anchored(length), "anchor long, digest long, doc_id long, start long, windows int, place int"), "op4-anchors")
    often = seen.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    met = stored(seen.join(often.hint("shuffle_hash"), "anchor"), "op4-met")
    discard(seen)

    # equal stretches: the first is left, the others go whole
    first = stored(met.groupBy("anchor", "digest").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"), F.first("windows").alias("windows"),
        F.first("place").alias("place")).select("anchor", "digest", "first.*", "n", "windows", "place"), "op4-first")
    more = first.where("n > 1").select("anchor", "digest", F.col("doc_id").alias("d0"), F.col("start").alias("s0"))
    copies = met.join(more, ["anchor", "digest"]).where("doc_id <> d0 or start <> s0").select("doc_id", "start", F.col("windows").cast("long"))

    # distinct stretches of one anchor: indexed together
    several = first.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    wanted = first.join(several, "anchor").groupBy("doc_id", F.shiftright("start", VERSION).alias("version")).agg(
        F.collect_list(F.struct("anchor", "start", "windows", "place")).alias("wanted"))
    rows = stored(base.join(wanted, ["doc_id", "version"]).mapInArrow(_fetch(length), FETCHED), "op4-stretches")
    # only stretches that have the bytes around their anchor in common with another can share a window
    around = rows.select("key", "doc_id", "start", F.explode("cells").alias("cell"))
    common = around.groupBy("key", "cell").agg(F.count("*").alias("n")).where("n > 1").select("key", "cell")
    close = around.join(common, ["key", "cell"]).select("doc_id", "start").distinct()
    pruned = stored(rows.join(close, ["doc_id", "start"], "left_semi").select(*[f.split()[0] for f in FETCHED.split(", ")]), "op4-close")
    discard(rows)
    rows = pruned
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        large = stored(rows.groupBy("key", "lo", "hi").agg(F.count("*").alias("n")).where(F.col("n") > group)
                       .select("key", "lo", "hi"), "op4-large")
        rest = rows.join(large, ["key", "lo", "hi"], "left_anti")
        copies = copies.unionByName(
            rest.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_index(length), "doc_id long, start long, windows long"))
        if large.isEmpty():
            break
        halves = stored(rows.join(large, ["key", "lo", "hi"], "left_semi").mapInArrow(_part(length), FETCHED), "op4-stretches")
        rows = halves.where("lo < hi")
        # one offset left: a row is one window, equal to another exactly when their bytes are; no index, however many they are
        single = halves.where("lo = hi")
        same = (single.groupBy("lo", "bytes").agg(F.min(F.struct("doc_id", "start")).alias("first")).select("first.*"))
        copies = copies.unionByName(single.join(same, ["doc_id", "start"], "left_anti").select(
            "doc_id", "start", F.col("windows").cast("long")))
    place = F.col("start").bitwiseAND(F.lit(PLACE))
    return copies.groupBy("doc_id", F.shiftright("start", VERSION).alias("version")).agg(F.collect_list(F.struct(
        place.alias("lo"), (place + F.col("windows") + length - 1).alias("hi"))).alias("spans"))


def whole_characters(pieces: Sequence[bytes]) -> str:
    """Text of what is left between removed spans: bytes of a character that a span's edge cut in two go, all other bytes stay."""
    out = []
    for i, p in enumerate(pieces):
        lo, hi = 0, len(p)
        while i and lo < min(3, hi) and p[lo] & 0xC0 == 0x80:
            lo += 1
        if i < len(pieces) - 1:
            for back in range(1, min(3, hi - lo) + 1):
                b = p[hi - back]
                if b >= 0xC0:  # a character's first byte: all of it must follow
                    hi -= back if back < (2 if b < 0xE0 else 3 if b < 0xF0 else 4) else 0
                    break
                if b < 0x80:
                    break
        out.append(p[lo:hi])
    return b"".join(out).decode("utf-8", "replace")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    rest: Sequence[str] = (), characters: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, removed (maximal spans [lo, hi) in order), kept (binary: the other bytes).
    With ``rest``, also a struct ``rest`` of the row's columns of these names. With ``characters``, ``kept`` is text: see
    :func:`whole_characters`. See :func:`repeated_spans`; a text without repeats stays whole."""
    rows = texts(carried(docs, list(rest)), key, text, *(["rest"] if rest else []))
    numbers = versions(rows.select("doc_id", "text"), "op4")
    spans = stored(_spans(rows.select("doc_id", "text"), numbers, length, GROUP), "op4-spans")
    schema = T.StructType.fromDDL(f"doc_id long, n_bytes long, removed {SPAN}, kept {'string' if characters else 'binary'}")
    if rest:
        schema = schema.add(rows.schema["rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                size, gone, kept = [], [], []
                for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    data = t.encode("utf-8", "surrogatepass")
                    runs: list[list[int]] = []
                    for x in sorted((x["lo"], x["hi"]) for x in s or ()):
                        if runs and x[0] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], x[1])
                        else:
                            runs.append(list(x))
                    edges = [0, *(e for r in runs for e in r), len(data)]
                    size.append(len(data))
                    gone.append([{"lo": lo, "hi": hi} for lo, hi in runs])
                    pieces = [data[lo:hi] for lo, hi in zip(edges[::2], edges[1::2])]
                    kept.append(whole_characters(pieces) if characters else b"".join(pieces))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(gone, kind), pa.array(kept, pa.string() if characters else pa.binary()),
                     *([part.column("rest")] if rest else [])], schema.names)

    return with_version(rows, numbers).join(spans, ["doc_id", "version"], "left").mapInArrow(run, schema)
