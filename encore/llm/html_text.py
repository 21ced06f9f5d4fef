"""Main text of web pages by a maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words score positive (less so in links and in places
where labelled pages have boilerplate), tags negative; the weights are log odds of lying inside
the marked article of labelled pages. One linear scan finds the contiguous run of the highest
sum, widened to whole blocks. What is boilerplate by its element never enters the text, wherever the run lies; what is so
by its name enters only if it wraps the page's content; article elements count if they hold most of the words.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from itertools import accumulate
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled pages (with an article or main element) that the weights are learned from:
#: those with the smallest hashes of their ids.
MAX_LABELLED = 4_000

# Elements of HTML by their part in a page.
RAW = "script style noscript template iframe svg math object canvas textarea select option video audio".split()
LEFT_OUT = "head title nav footer aside form button menu dialog label input".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = ("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
          "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
          "tfoot th thead title tr ul caption").split()
SAME = {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
FENCE = "ul ol table dl div section article main body blockquote".split()
#: Words in class, id or role that name boilerplate.
NAMES = ("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments respond reply replies "
         "disqus discussion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login sidebar "
         "side widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share "
         "sharing social related recommended recommendations popup modal overlay pagination pager banner hidden search form "
         "complementary contentinfo dialog").split()
#: Weights where no labelled page tells otherwise.
WORD, LINK_WORD, TAG, EDGE = 1.0, -0.5, -0.2, 4.0

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: One attribute: a name, and a value in quotes or up to white space or the tag's end. A quote that is not closed runs to the page's end.
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]?[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]*)))?")
_SPECIAL = re.compile(r"<(?=[a-zA-Z!?]|/[a-zA-Z])")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NAMES, _BLOCKS, _RAW, _OUT, _VOID, _FENCE = set(NAMES), set(BLOCKS), set(RAW), set(LEFT_OUT), set(VOID), set(FENCE)


def tag_end(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """(attributes, self-closing, end) of the tag whose name ends at ``at``, by the tokenizer rules of HTML; the end is beyond
    the page where nothing closes the tag. Each character is read once."""
    found: dict[str, str] = {}
    n = len(page)
    while at < n:
        if page[at] == ">":
            return found, page[at - 1] == "/", at + 1
        m = _ATTRIBUTE.match(page, at)
        if m.end() == at:
            at += 1
            continue
        if m.group(1):
            found.setdefault(m.group(1).lower(), next((v for v in m.groups()[1:] if v is not None), ""))
        at = m.end()
    return found, False, n + 1


def hidden(attrs: dict[str, str]) -> bool:
    return ("hidden" in attrs or attrs.get("aria-hidden", "").strip().lower().startswith("true")
            or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I) is not None)


def named(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element's class, id or role names boilerplate."""
    values = [attrs[k] for k in ("class", "id", "role") if k in attrs]
    if tag in ("html", "body", "main", "p") and not any(w in v for v in attrs.values() for w in ("comment", "notice", "ad")):
        return False
    return any(w.lower() in _NAMES for v in values for w in _WORD.findall(v))


class Page:
    """A page as items (kind, value, block, in_link) in order and spans of elements over them; kind is 'text', 'tag' or 'break'
    (a tag that ends a block). Unclosed and crossing elements are closed as browsers mostly do. Time grows with the page
    alone, whatever it nests or leaves open."""

    def __init__(self, page: str) -> None:
        self.items: list[tuple[str, str, str, bool]] = []
        #: (what, first item, item after the last) of elements that are 'out', 'named', 'article', 'header' or 'h1'
        self.spans: list[tuple[str, int, int]] = []
        stack: list[tuple[str, str, int]] = []  # element, what, first item
        places: dict[str, list[int]] = {}  # of each open element's tag
        fences: list[int] = []
        blocks: list[int] = []
        at, n = 0, len(page)

        def close(k: int) -> None:
            for i in range(len(stack) - 1, k - 1, -1):
                tag, what, first = stack.pop()
                places[tag].pop()
                if fences and fences[-1] == i:
                    fences.pop()
                if blocks and blocks[-1] == i:
                    blocks.pop()
                if what:
                    self.spans.append((what, first, len(self.items)))

        def last(tags: tuple[str, ...]) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=-1)

        def block() -> str:
            return stack[blocks[-1]][0] if blocks else "body"

        def link() -> bool:
            return bool(places.get("a"))

        while at < n:
            m = _SPECIAL.search(page, at)
            if m is None or m.start() > at:
                self.items.append(("text", page[at:m.start() if m else n], block(), link()))
            if m is None:
                break
            at = m.start()
            t = _TAG.match(page, at)
            if t is None:  # comment or declaration
                if page.startswith("<!--", at):
                    e = page.find("-->", at + 4)
                    at = n if e < 0 else e + 3
                else:
                    e = page.find(">", at)
                    at = n if e < 0 else e + 1
                continue
            tag, ends = t.group(1).lower(), page[at + 1] == "/"
            attrs, empty, at = tag_end(page, t.end())
            if at > n:
                break  # a tag that never ends is no text
            if tag in _RAW and not ends:
                if not empty:
                    e = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
                    at = e.end() if e else n
                self.items.append(("tag", tag, block(), link()))
                continue
            if ends:
                if places.get(tag):
                    close(places[tag][-1])
            elif tag not in _VOID:
                if tag in _BLOCKS:
                    k = last(SAME.get(tag, ("p",)))
                    if k > (fences[-1] if fences else -1):
                        close(k)
                    if tag in SAME and tag != "p":
                        k = last(("p",))
                        if k >= 0 and k > last(tuple(FENCE)):
                            close(k)
                if not empty:
                    what = ("out" if tag in _OUT or hidden(attrs) else "header" if tag == "header" else "named" if named(tag, attrs)
                            else "article" if tag in ("article", "main") else "h1" if tag == "h1" else "")
                    stack.append((tag, what, len(self.items)))
                    places.setdefault(tag, []).append(len(stack) - 1)
                    if tag in _FENCE or what in ("out", "named", "header"):
                        fences.append(len(stack) - 1)
                    if tag in _BLOCKS:
                        blocks.append(len(stack) - 1)
            self.items.append(("break" if tag in _BLOCKS else "tag", tag, tag if tag in _BLOCKS and not ends else block(), link()))
        close(0)

    def marks(self) -> tuple[list[bool], list[bool], bool]:
        """(left out, in the article, whether the page marks its article) for each item.

        Elements that are boilerplate by their kind go, and those so named unless they wrap the page's content: an article, its only
        h1, or, where no article is marked, most words. Article elements mark the page's article if they hold at least as
        many words as there are besides; teasers beside a longer text do not.
        """
        size = [len(v.split()) if k == "text" else 0 for k, v, _, _ in self.items]

        def over(spans: list[tuple[int, int]]) -> list[bool]:
            edge = [0] * (len(size) + 1)
            for lo, hi in spans:
                edge[lo] += 1
                edge[hi] -= 1
            return [v > 0 for v in accumulate(edge[:-1])]

        kinds: dict[str, list[tuple[int, int]]] = {}
        for what, lo, hi in self.spans:
            kinds.setdefault(what, []).append((lo, hi))
        out = over(kinds.get("out", []))
        words = [0, *accumulate(0 if o else w for w, o in zip(size, out))]
        first = sorted(lo for lo, hi in kinds.get("article", []))
        titles = kinds.get("h1", [])

        def wraps(lo: int, hi: int) -> bool:
            i = bisect_left(first, lo)
            if i < len(first) and first[i] < hi:
                return True
            if first:
                return False
            return len(titles) == 1 and lo <= titles[0][0] < hi or 5 * (words[hi] - words[lo]) >= 3 * words[-1] > 0

        gone = over(kinds.get("out", []) + [x for x in kinds.get("named", []) if not wraps(*x)])
        article = over([x for x in kinds.get("article", []) if not gone[x[0]]] if gone else [])
        headers = [x for x in kinds.get("header", []) if not article[x[0]]] if article else []
        above = over(headers)
        gone = [a or b for a, b in zip(gone, above)]
        inside = sum(w for w, a, g in zip(size, article, gone) if a and not g)
        outside = sum(w for w, a, g in zip(size, article, gone) if not a and not g)
        marked = any(article) and inside >= outside
        return gone, (article if marked else [False] * len(size)), marked


def parts(page: str) -> list[tuple[str, str, str, bool, bool, bool]]:
    """(kind, value, block, in_link, in_article, left_out) in page order; see :class:`Page`."""
    read = Page(page)
    gone, article, _ = read.marks()
    return [(*item, a, g) for item, a, g in zip(read.items, article, gone)]


def place(block: str, in_link: bool) -> str:
    return f"{block if block in _BLOCKS else 'other'}{' a' if in_link else ''}"


def counts(page: str) -> dict[tuple[str, bool], int]:
    """Words by place and tags by name, inside and outside the marked article; nothing for other pages."""
    found: dict[tuple[str, bool], int] = {}
    marked = False
    for kind, value, block, link, article, out in parts(page):
        marked |= article
        if kind == "text":
            key, k = ("out" if out else place(block, link)), len(value.split())
        else:
            key, k = "<" + (value if value in _BLOCKS | _VOID else "other"), int(not out)
        if k:
            found[key, article and not out] = found.get((key, article and not out), 0) + k
    return found if marked else {}


def weights(seen: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Smoothed log odds of lying inside; of words within their bounds, of tags negative."""
    inside, outside = sum(v for k, v in seen.items() if k[1]) + 1, sum(v for k, v in seen.items() if not k[1]) + 1
    out: dict[str, float] = {}
    for key in {k for k, _ in seen}:
        odds = math.log((seen.get((key, True), 0) + 1) / inside) - math.log((seen.get((key, False), 0) + 1) / outside)
        out[key] = max(-WORD, min(TAG, odds)) if key[0] == "<" else max(-EDGE, min(EDGE, odds))
    return out


def main_text(page: str, weight: dict[str, float]) -> str:
    """Blocks of the best run, each with its white space made single spaces, joined by two line ends."""
    items = list(parts(page))
    marked = any(x[4] for x in items)
    best = total = 0.0
    lo = hi = start = -1
    for i, (kind, value, block, link, article, out) in enumerate(items):
        if out:
            s = 0.0
        elif kind != "text":
            s = TAG if article else weight.get("<" + (value if value in _BLOCKS | _VOID else "other"), TAG)
        else:
            w = weight.get(place(block, link), LINK_WORD if link else WORD)
            if marked:  # the page says where its article is
                w = max(w, WORD) if article else -abs(w)
            s = w * len(value.split())
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, lo, hi = total, start, i
    if hi < 0:
        return ""
    while lo > 0 and items[lo - 1][0] != "break":
        lo -= 1
    while hi + 1 < len(items) and items[hi + 1][0] != "break":
        hi += 1
    blocks, now = [], []
    for kind, value, _, _, article, out in items[lo:hi + 1]:
        if kind == "break":
            blocks.append("".join(now))
            now = []
        elif kind == "tag":
            now.append(" " if value in ("br", "img", "input") else "")
        elif not out and (article or not marked):
            now.append(html.unescape(value))
    blocks.append("".join(now))
    return "\n\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def learned(pages: DataFrame, key: str = "page_id", page: str = "html", max_labelled: int = MAX_LABELLED) -> dict[str, float]:
    """Weights from pages that mark their article, at most ``max_labelled``; sums of a few hundred
    places and tags come to the driver. Without such pages there are none, and fixed weights hold."""
    labelled = (pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{page}`").cast("string").alias("html"))
                .where(F.col("html").rlike("(?i)<(article|main)[\\s>]")))
    chosen = labelled.select("k").orderBy(F.xxhash64("k"), "k").limit(max_labelled).distinct()

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            got = [(k[0], k[1], v) for h in pdf["html"] for k, v in counts(h).items()]
            yield pd.DataFrame(got, columns=["place", "inside", "n"])

    sums = (labelled.join(chosen, "k", "left_semi").select("html").mapInPandas(run, "place string, inside boolean, n long")
            .groupBy("place", "inside").agg(F.sum("n").alias("n")).collect())
    return weights({(r["place"], r["inside"]): r["n"] for r in sums})


def extracted(pages: DataFrame, weight: dict[str, float], key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row, from its whole page.

    Null and empty pages, and pages of boilerplate alone, give an empty text. Keys and urls are passed
    on as they are, null or repeated; an empty table gives no rows; other columns are not read.
    """
    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo:lo + 256]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": [main_text(h, weight) for h in part["html"]]})

    d = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{page}`").cast("string"), F.lit("")).alias("html"))
    # a null page_id would make pandas turn the column to floats, so it goes through as text
    d = d.withColumn("page_id", F.col("page_id").cast("string"))
    out = d.mapInPandas(run, "page_id string, url string, text string")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
