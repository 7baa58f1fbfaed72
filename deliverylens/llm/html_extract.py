"""HTML extraction: a host suffix array beside the page's own markup.

A page is cut into blocks of three kinds: ``MAIN`` (inside ``article``, or
``main`` if there is none), ``CHROME`` (menus, headers, footers, side bars,
notices, adverts, forms, reader comments, by tag, role, class or id) and
``OPEN`` (everything else). The token streams of the CHROME and OPEN blocks of
a host's pages are concatenated; a suffix array over them finds the substrings
of ``LEAST_TOKENS`` tokens or more that stand on ``LEAST_PAGES`` or more
distinct pages. OPEN tokens covered by such a substring are boilerplate; the
unique runs that remain, and all MAIN blocks, are the main text. Markup alone
decides on MAIN blocks: articles quote and copy each other, so repetition says
nothing against them.

The suffix array is built over the pages of a host that a task holds, by
doubling, and to a depth of ``LEAST_TOKENS`` tokens: a token
lies in a long repeated substring exactly if it lies in a repeated one of
``LEAST_TOKENS`` tokens, so each task emits one row per distinct prefix of
that length and host, with some of its pages; counts per (host, prefix) join
what tasks have found, and a host of any size needs no task of its own.

Edge cases: null or empty html gives the empty text; a null or odd url counts
as the empty host; pages with equal texts count as one page for repetition, and
so do pages with open blocks whose texts are near copies (``NEAR_PERCENT`` of
their ``NEAR_WORDS``-word shingles, directly or over others), so copies of a
page do not erase it; a tag cut off by the end of the page is
dropped; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import mix64, staged, table
from deliverylens.llm.jaccard_join import cluster

LEAST_TOKENS = 6
LEAST_PAGES = 3
#: Pages are near copies if their sets of so many words are so similar, in per cent.
NEAR_WORDS, NEAR_PERCENT = 5, 80
MAIN, OPEN, CHROME = 0, 1, 2

#: Elements by what they do to the text.
SILENT = {"script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "head",
          "title", "select", "option", "button", "textarea", "audio", "video", "math", "xmp"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr",
    "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "pager", "pagination", "popup", "promo", "recommended", "related", "replies", "respond",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
    "toolbar", "widget"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
                "alert", "menu", "menubar"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
          "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
          "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
          "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Closed by the next block's start, if left open.
LOOSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "li"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|xmp|textarea|title|noscript|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[a-z0-9]+")
_HOST = r"(?s)^.*?://([^/?#]*)"


def _is_chrome(tag: str, attrs: str, inside: bool) -> bool:
    """``inside``: within the article, whose own header is no page header."""
    if tag in CHROME_TAGS or tag in SILENT or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            found = CHROME_WORDS.intersection(_PART.findall(value))
            if found if tag != "article" else found & {"comment", "comments"}:
                return True
        elif name == "role" and value in CHROME_ROLES or name == "hidden":
            return True
        elif name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks(html: str | None) -> list[tuple[int, str]]:
    """The page's blocks in order: (kind, text)."""
    if not html:
        return []
    out: list[tuple[int, int, str]] = []  # (within: 2 article, 1 main, 0 neither; chrome; text)
    stack: list[tuple[str, bool, int, list[str] | None]] = []  # (tag, chrome, within, text it interrupts)
    text: list[str] = []
    at = 0

    def flush() -> None:
        if text:
            line = " ".join(unescape("".join(text)).split())
            if line:
                _, chrome, within, _ = stack[-1] if stack else ("", False, 0, None)
                out.append((within, int(chrome), line))
            text.clear()

    def unwind(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in BLOCKS or stack[-1][3] is not None:
                flush()
            before = stack.pop()[3]
            if before is not None:
                text[:] = [*before, " "]

    for m in _TAG.finditer(html):
        if m.start() > at:
            text.append(html[at:m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            text.append(" ")
        if tag in VOID or m[4].endswith("/"):
            continue
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    unwind(k)
                    break
                if stack[k][0] in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                    break
            continue
        if tag in BLOCKS:
            while stack and stack[-1][0] in LOOSE and (stack[-1][0] not in ("li", "dd", "dt") or tag == stack[-1][0]):
                stack.pop()
        _, chrome, within, _ = stack[-1] if stack else ("", False, 0, None)
        hidden = chrome or _is_chrome(tag, m[4], within > 0)
        if tag in BLOCKS or tag in SILENT or hidden and not chrome:
            before = None
            if tag not in BLOCKS:  # what it interrupts goes on after it
                before = text[:]
                text.clear()
            stack.append((tag, hidden, max(within, {"article": 2, "main": 1}.get(tag, 0)), before))
    if at < len(html):
        text.append(html[at:])
    unwind(0)
    flush()
    best = max((w for w, c, _ in out if not c), default=0)
    return [(CHROME if c else MAIN if w == best > 0 else OPEN, t) for w, c, t in out]


def tokens(text: str) -> list[str]:
    return text.split()


def _hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    import xxhash

    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def prefix_names(stream: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of the ``length``-token prefixes of all suffixes that have one."""
    n = len(stream) - length + 1
    name = np.zeros(max(0, n), np.uint64)
    for k in range(length):
        name = mix64(name * np.uint64(0x9E3779B97F4A7C15) + stream[k:k + len(name)])
    return name


def suffix_ranks(stream: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes with at least ``length`` tokens by their first
    ``length`` ones, equal where these are: ranks of prefixes are doubled until
    they cover the length."""
    if len(stream) < length:
        return np.zeros(0, np.int64)
    rank, done = np.unique(stream, return_inverse=True)[1].astype(np.int64), 1
    while done < length:
        step = min(done, length - done)
        rank = np.unique(rank[:-step] * (len(stream) + 1) + rank[step:], return_inverse=True)[1].astype(np.int64)
        done += step
    return rank


def suffix_runs(streams: list[np.ndarray], length: int, most: int, pages: np.ndarray | None = None
                ) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the concatenated streams, to a depth of ``length`` tokens:
    the names of the different prefixes, each with up to ``most`` of the pages
    that hold it. ``pages``: the page of each stream, if several are one."""
    size = np.array([len(s) for s in streams], np.int64)
    pages = np.arange(len(streams)) if pages is None else np.asarray(pages)
    whole = np.concatenate([*streams, np.zeros(0, np.uint64)])
    inside = np.arange(len(whole)) + length <= np.repeat(np.cumsum(size), size)  # ends in its own stream
    rank, at = suffix_ranks(whole, length), np.flatnonzero(inside)
    owner = np.repeat(pages, size)[at]
    order = np.lexsort((owner, rank[at]))
    at, owner = at[order], owner[order]
    new = np.ones(len(at), bool)
    new[1:] = rank[at[1:]] != rank[at[:-1]]
    other = new.copy()
    other[1:] |= owner[1:] != owner[:-1]
    at, owner, new = at[other], owner[other], new[other]
    first = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return prefix_names(whole, length)[at[place < most]], owner[place < most]


def _stream(kinds, texts, known: dict[str, int], wanted: set[int]) -> np.ndarray:
    """Tokens of the wanted blocks; a random-looking break stands between blocks."""
    parts = []
    for i, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        if kind in wanted:
            parts += [_hashes(tokens(text), known), mix64(np.array([i + 1], np.uint64))]
    return np.concatenate([*parts, np.zeros(0, np.uint64)])


def parse(pages: DataFrame) -> DataFrame:
    """row (unique), page_id, url, host, kinds and texts of the blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [blocks(h) for h in pdf["html"]]
            pdf["kinds"] = [[k for k, _ in b] for b in found]
            pdf["texts"] = [[t for _, t in b] for b in found]
            yield pdf.drop(columns="html")

    host = F.coalesce(F.lower(F.regexp_extract("url", _HOST, 1)), F.lit(""))
    return pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), "url",
                        host.alias("host"), "html").mapInPandas(
        run, "row long, page_id long, url string, host string, kinds array<int>, texts array<string>")


def repeated(parsed: DataFrame, length: int, least_pages: int) -> DataFrame:
    """(host, name): the prefixes on enough distinct pages of a host.

    A task names at most ``least_pages`` pages for a prefix: more decide nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for pdf in batches:
            if len(known) > 500_000:
                known.clear()
            for host, part in pdf.drop_duplicates(["host", "copy"]).groupby("host"):
                streams = [_stream(k, t, known, {OPEN, CHROME})
                           for k, t in zip(part["kinds"], part["texts"], strict=True)]
                name, page = suffix_runs(streams, length, least_pages, part["page"].to_numpy())
                yield pd.DataFrame({"host": host, "name": name.view(np.int64), "page": page})

    copy = F.xxhash64("kinds", "texts")
    is_open = F.array_contains("kinds", OPEN)
    # copies have one hash and are one page; near copies too, where all they say may be open
    alike = cluster(parsed.where(is_open).select(F.col("row").alias("doc_id"), F.array_join("texts", " ").alias("text")),
                    NEAR_WORDS, NEAR_PERCENT).select(F.col("doc_id").alias("row"), F.xxhash64("component_id").alias("page"))
    names = ["host", "page", "copy", "kinds", "texts"]
    pages = parsed.where(~is_open).select("host", copy.alias("page"), copy.alias("copy"), "kinds", "texts").unionByName(
        parsed.where(is_open).join(alike, "row").withColumn("copy", copy).select(*names))
    return (pages.mapInPandas(run, "host string, name long, page long").distinct().groupBy("host", "name")
            .agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages).select("host", "name"))


def extract(pages: DataFrame, length: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text (main text) and n_chars of every page."""
    parsed = staged(parse(pages), "html-blocks")  # read three times, parsed once
    is_open = F.array_contains("kinds", OPEN)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for pdf in batches:
            if len(known) > 500_000:
                known.clear()
            for r in pdf.itertuples():
                name = prefix_names(_stream(r.kinds, r.texts, known, {OPEN}), length)
                yield pd.DataFrame({"row": r.row, "host": r.host, "start": np.arange(len(name)),
                                    "name": name.view(np.int64)})

    opened = parsed.where(is_open).select("row", "host", "kinds", "texts").mapInPandas(
        windows, "row long, host string, start long, name long")
    hits = (opened.join(repeated(parsed, length, least_pages), ["host", "name"])
            .groupBy("row").agg(F.sort_array(F.collect_list("start")).alias("starts")))

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(k, t, s, length) for k, t, s in
                    zip(pdf["kinds"], pdf["texts"], pdf["starts"], strict=True)]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text,
                                "n_chars": [len(t) for t in text]})

    # open blocks need what was found for their page; the other pages need no join
    out = "page_id long, url string, text string, n_chars long"
    none = F.lit(None).cast("array<long>").alias("starts")
    plain = parsed.where(~is_open).select("page_id", "url", "kinds", "texts", none)
    mixed = parsed.where(is_open).join(hits, "row", "left").select("page_id", "url", "kinds", "texts", "starts")
    return plain.unionByName(mixed).mapInPandas(assemble, out)


def main_text(kinds, texts, starts, length: int) -> str:
    """MAIN blocks, and of OPEN blocks the tokens no repeated substring covers."""
    covered: set[int] = set()
    for s in [] if starts is None else starts:
        covered.update(range(s, s + length))
    out, at = [], 0
    for kind, text in zip(kinds, texts, strict=True):
        if kind == MAIN:
            out.append(text)
        elif kind == OPEN:
            words = tokens(text)
            left = [w for i, w in enumerate(words, at) if i not in covered]
            at += len(words) + 1
            if left:
                out.append(" ".join(left))
    return "\n".join(out)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
