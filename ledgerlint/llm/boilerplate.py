"""Main text of web pages.

Markup decides where it speaks: a page's blocks lie in its article, in furniture
(menus, headers, footers, sidebars, notices, adverts, forms, comments), or are
open. An article ends the furniture it lies in, unless that is hidden, a list of
comments or of links, or a menu, sidebar or footer element. A class or id alone does
not make furniture outside an article: such blocks are open.
Where a page marks its article, that is its main text. The open blocks of
other pages are decided by a suffix array of the host: the token streams of all
pages of a host are laid end to end, and a substring of ``RUN`` tokens or more that
enough distinct pages of the host repeat is boilerplate; the unique runs are kept.
Enough are ``LEAST`` pages and ``SHARE`` of the host's: a passage that two articles
share is no boilerplate. Near copies count as one page: pages agree in two least
hashes of their runs, so that copies do not erase each other; pages with a marked
article are told apart by the whole of it.

The array holds a row for each suffix of a stream, by host. It is partitioned by
ranges of (host, leading tokens) and sorted; the common prefixes of neighbours are
measured, and neighbours with ``RUN`` tokens or more in common form an interval: the
places of a repeat. An interval that the end of a range cuts adds up again, so a hot
host or repeat is spread over many tasks. The order is settled by the first ``RUN``
tokens: where a longer substring repeats, so do the ``RUN`` tokens at each of its
places on at least as many pages, and these cover all of it. Suffixes that a
family of pages has alike are one row. Furniture is in the array as evidence, on all
pages of the hosts that have open blocks to judge; articles are not.

Cases: a null or empty page has an empty text; a page without host is compared
with the others without one; markup that is cut off ends with the page; repeated
rows get equal texts; columns of any name are kept, but for text, which is replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import mix64, packed, row_key, small_batches
from ledgerlint.sources.staging import stage

#: Tokens of the shortest substring that counts as long.
RUN = 8
#: Distinct pages that boilerplate must be on, and their share of the host's.
LEAST = 3
SHARE = 0.1

_HIDDEN = {"script", "style", "noscript", "template", "iframe", "svg", "math", "head", "title", "object",
           "canvas", "audio", "video", "textarea", "select", "datalist", "map"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
_BLOCK = {"p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl",
          "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "hr",
          "figure", "figcaption", "address", "details", "summary", "fieldset", "body", "html", "center"} | _FURNITURE
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
          "alertdialog", "menu", "menubar", "toolbar"}
_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "adbox", "sponsor", "sponsored", "promo", "promoted",
          "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header",
          "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
          "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment",
          "comments", "commentlist", "disqus", "respond", "reply", "replies", "widget", "toolbar", "pagination",
          "pager", "skip", "banner", "copyright", "legal", "paywall", "disclaimer"}
#: Furniture that holds articles of its own, which are not the page's.
_LASTING = {"nav", "aside", "footer", "menu", "dialog", "button"}
_LASTING_ROLES = {"navigation", "complementary", "contentinfo", "dialog", "alertdialog", "menu", "menubar"}
_LASTING_NAMES = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "related", "recommended",
                  "ad", "ads", "advert", "adverts", "advertisement", "sponsored", "promoted"}
_ARTICLE_NAMES = {"articlebody", "postbody", "entrycontent", "postcontent", "articlecontent", "maincontent"}
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|</[^>]*>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
_WORD_BREAK = re.compile(r"[^a-z]+")


def _marks(tag: str, raw: str) -> tuple[str, bool]:
    """How an element is furniture, if it is, and whether it is an article.

    Furniture is ``plain`` or ``lasting`` by its markup, ``named`` or ``listed`` by a
    class or id alone. An article does not end what is lasting or listed.
    """
    if not raw.strip(" /\t\r\n"):
        sort = "lasting" if tag in _LASTING else "plain" if tag in _FURNITURE else ""
        return sort, tag in ("article", "main")
    found = {}
    for name, a, b, c, bare in _ATTRIBUTE.findall(raw):
        found.setdefault((name or bare).lower(), a or b or c)
    role = found.get("role", "").strip().lower()
    named = f"{found.get('class', '')} {found.get('id', '')}".lower()
    tokens = set(_WORD_BREAK.split(named))
    article = (
        tag in ("article", "main") or role in ("main", "article")
        or found.get("itemprop", "").lower() == "articlebody"
        or any(_WORD_BREAK.sub("", x) in _ARTICLE_NAMES for x in named.split())
    )
    hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
    if tag in ("html", "body") and not hidden:
        return "", article
    if tag in ("article", "main") and not hidden and not tokens & {"comment", "comments", "related", "ad", "ads"}:
        return "", article
    if hidden or tag in _LASTING or role in _LASTING_ROLES:
        return "lasting", False
    if tag in _FURNITURE or role in _ROLES:
        return "lasting" if tokens & _LASTING_NAMES else "plain", False
    if tokens & _NAMES:
        # An article's own mark outweighs a name, unless the name is of a list of articles.
        if article and not tokens & _LASTING_NAMES:
            return "", True
        return "listed" if tokens & _LASTING_NAMES else "named", False
    return "", article


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(kind, text) of each block in page order; kind is main, open or furniture."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str, bool]] = []  # open elements, and kind and lasting before each
    # Depths at which each tag is open, and those of paragraphs and blocks: no search of the stack.
    places: dict[str, list[int]] = {}
    outline: list[int] = []
    kind, hidden, lasting = "open", 0, False
    text: list[str] = []

    def flush() -> None:
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append((kind, joined))
        text.clear()

    def close(depth: int) -> None:
        """Close the innermost elements down to ``depth``."""
        nonlocal kind, hidden, lasting
        while len(stack) > depth:
            name, before, lasted = stack.pop()
            places[name].pop()
            if outline and outline[-1] == len(stack):
                outline.pop()
            if name in _BLOCK or before != kind:
                flush()
            if name in _HIDDEN:
                hidden -= 1
            kind, lasting = before, lasted

    def innermost(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else -1

    page = page or ""
    at, end, last_closing = 0, len(page), (page or "").rfind(">")
    while at < end:
        opens = page.find("<", at)
        if opens < 0:
            opens = end
        if opens > at and not hidden:
            text.append(page[at:opens])
        if opens == end:
            break
        token = _TOKEN.match(page, opens)
        if token is None:
            if opens > last_closing and page[opens + 1 : opens + 2].isalpha() or page[opens + 1 : opens + 2] == "/":
                break  # a tag that the end of the page cuts off
            if not hidden:
                text.append("<")
            at = opens + 1
            continue
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            depth = innermost(tag)
            if tag == "p" and depth < 0:
                flush()
            held = tag in ("p", "li", "span", "b", "i", "a", "div") and any(
                innermost(x) > depth for x in ("article", "main", "table")
            )
            if depth >= 0 and not held:
                close(depth)
            continue
        raw = token[3]
        if tag == "br":
            text.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _BLOCK:
            flush()
            # A new block ends an open paragraph and all it holds.
            if outline and stack[outline[-1]][0] == "p":
                close(outline[-1])
        closing = _CLOSED_BY.get(tag)
        if closing and stack and stack[-1][0] in closing:
            close(len(stack) - 1)
        if raw.endswith("/") and tag not in _BLOCK and tag not in _RAW:
            continue
        if tag in _RAW:
            # Its content is no markup; only its own end tag ends it.
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        sort, article = _marks(tag, raw)
        before, lasted = kind, lasting
        if sort and not (kind == "main" and tag == "header"):
            # Outside an article, a name or a form may hold the whole page.
            if kind == "main" or sort in ("plain", "lasting") and tag != "form":
                if kind != "furniture":
                    flush()
                kind = "furniture"
            lasting = lasting or sort in ("lasting", "listed")
        elif article and kind != "main" and not lasting:
            flush()
            kind = "main"
        if tag in _HIDDEN:
            hidden += 1
        places.setdefault(tag, []).append(len(stack))
        if tag == "p" or tag in _BLOCK:
            outline.append(len(stack))
        stack.append((tag, before, lasted))
    flush()
    return out


def _tokens(texts: list[str]) -> np.ndarray:
    """Hashes of the tokens of a stream."""
    tokens = " ".join(texts).lower().split()
    known: dict[str, int] = {}
    for t in tokens:
        if t not in known:
            known[t] = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little")
    return np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))


def _names(heads: np.ndarray) -> np.ndarray:
    """One number for each row of RUN hashed tokens."""
    total = np.zeros(len(heads), np.uint64)
    for i in range(RUN):
        total = mix64(total ^ heads[:, i])
    return total.view(np.int64)


def _of_suffixes(tokens: np.ndarray) -> np.ndarray:
    """Names of the first RUN tokens of every suffix of a stream that has as many."""
    if len(tokens) < RUN:
        return np.empty(0, np.int64)
    return _names(np.lib.stride_tricks.sliding_window_view(tokens, RUN))


def _windows(texts: list[str]) -> np.ndarray:
    return _of_suffixes(_tokens(texts))


def _family(windows: np.ndarray, content: list[str]) -> int:
    """A number that a page shares with its near copies: two least hashes of its runs.

    Pages with shares j of their runs in common agree in it with probability j * j.
    """
    if len(windows):
        views = windows.view(np.uint64)
        least = np.array([views.min(), mix64(views ^ np.uint64(1)).min()])
        digest = hashlib.blake2b(least.tobytes(), digest_size=8).digest()
    else:
        digest = hashlib.blake2b("\n".join(content).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _parse(pages: pd.Series) -> pd.DataFrame:
    """Main text, open blocks where there is none, family, windows and streams of each page."""
    rows = []
    for page in pages:
        found = blocks(page)
        main, unsure, furniture = ([t for k, t in found if k == kind] for kind in ("main", "open", "furniture"))
        content, unsure = main + unsure, [] if main else unsure
        # Where markup decides, a page is told by its whole article.
        stream = _tokens(unsure)
        own = _of_suffixes(stream)
        streams = [x.view(np.int64) for x in (stream, _tokens(furniture))]
        rows.append(("\n\n".join(main), unsure, _family(own, content), np.unique(own), *streams))
    return pd.DataFrame(rows, columns=["text", "unsure", "family", "windows", "stream", "furniture"])


def unique_runs(texts: list[str], repeated: set[int]) -> list[str]:
    """The blocks of a stream without the long runs that repeated windows cover.

    A window may reach over the end of a block: what it covers there goes if it
    is the whole block or a long run of its own.
    """
    starts = np.isin(_windows(texts), np.fromiter(repeated, np.int64, len(repeated)))
    words = [t.split() for t in texts]
    covered = np.zeros(sum(map(len, words)), dtype=bool)
    for i in np.flatnonzero(starts):
        covered[i : i + RUN] = True
    out, at = [], 0
    for block in words:
        gone = covered[at : at + len(block)]
        at += len(block)
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
        gone = np.zeros(len(block), dtype=bool)
        for a, b in edges.reshape(-1, 2):
            gone[a:b] = b - a >= min(RUN, len(block))
        kept = " ".join(w for w, g in zip(block, gone) if not g)
        if kept:
            out.append(kept)
    return out


def common_prefixes(hosts: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Tokens that each suffix has in common with the one before it; 0 for the first and on another host."""
    lcp = np.zeros(len(heads), np.int64)
    alike = heads[1:] == heads[:-1]
    lcp[1:] = np.where(hosts[1:] == hosts[:-1], np.cumprod(alike, axis=1).sum(axis=1), 0)
    return lcp


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, w (name of the run), held (suffixes) and open of each interval of a sorted batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        hosts = np.array(batch.column("host").to_pylist(), dtype=object)
        heads = batch.column("head").flatten().to_numpy(zero_copy_only=False).reshape(-1, RUN)
        starts = np.flatnonzero(common_prefixes(hosts, heads) < RUN)
        yield pa.RecordBatch.from_pydict({
            "host": pa.array(hosts[starts], pa.string()),
            "w": pa.array(_names(heads[starts].view(np.uint64)), pa.int64()),
            "held": pa.array(np.diff(np.r_[starts, len(heads)]), pa.int64()),
            "open": pa.array(np.maximum.reduceat(batch.column("open").to_numpy(zero_copy_only=False), starts), pa.bool_()),
        })


def suffix_array(parsed: DataFrame) -> DataFrame:
    """host, head (first RUN tokens), family and open of the suffixes of each host, in order.

    ``parsed`` has host, family, stream (of open blocks) and furniture.
    """
    judged = parsed.where(F.size("stream") > 0).select("host").distinct()
    streams = parsed.join(judged, "host", "left_semi").select(
        "host", "family", F.inline(F.array(
            F.struct(F.col("stream").alias("tokens"), F.lit(True).alias("open")),
            F.struct(F.col("furniture").alias("tokens"), F.lit(False).alias("open")),
        ))
    )
    starts = F.explode(F.sequence(F.lit(1), F.size("tokens") - RUN + 1)).alias("start")
    suffixes = streams.where(F.size("tokens") >= RUN).select("host", "family", "open", "tokens", starts)
    rows = suffixes.select("host", F.slice("tokens", F.col("start"), F.lit(RUN)).alias("head"), "family", "open")
    # What a family repeats is one row; a family's pages are combined on the map side.
    rows = rows.groupBy("host", "head", "family").agg(F.max("open").alias("open"))
    order = ("host", "head", "family")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def repeated_runs(parsed: DataFrame) -> DataFrame:
    """(host, w) of the runs of open blocks that enough families of a host's pages hold.

    ``parsed`` has host, family, stream and furniture.
    """
    pages = parsed.groupBy("host").agg(F.count_distinct("family").alias("pages"))
    found = suffix_array(parsed).mapInArrow(_intervals, "host string, w long, held long, open boolean")
    # Parts of an interval that lie in several batches or ranges.
    whole = found.groupBy("host", "w").agg(F.sum("held").alias("held"), F.max("open").alias("open"))
    often = whole.where((F.col("held") >= LEAST) & F.col("open"))
    return often.join(pages, "host").where(F.col("held") >= F.lit(SHARE) * F.col("pages")).select("host", "w")


def main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` without ``html`` and with text: the main text of ``html``."""

    @F.pandas_udf(
        "text string, unsure array<string>, family long, windows array<long>, stream array<long>, furniture array<long>"
    )
    def parse(column: pd.Series) -> pd.DataFrame:
        return _parse(column)

    @F.pandas_udf("string")
    def rest(column: pd.Series, repeated: pd.Series) -> pd.Series:
        return pd.Series(
            ["\n\n".join(unique_runs(list(t), set(r) if r is not None else set())) for t, r in zip(column, repeated)]
        )

    small_batches(pages.sparkSession)
    kept = pages.drop("text", html)
    host = F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    parsed = stage(
        pages.select(
            packed(kept), F.coalesce(host, F.lit("")).alias("host"), row_key(html).alias("page"), parse(html).alias("p")
        ).select("doc", "host", "page", "p.*").withColumn("open", F.size("unsure") > 0),
        "parsed",
    )
    runs = parsed.where("open").select("host", "page", F.explode("windows").alias("w"))
    covered = runs.join(repeated_runs(parsed), ["host", "w"], "left_semi")
    by_page = covered.groupBy("host", "page").agg(F.collect_set("w").alias("repeated"))
    unsure = parsed.where("open").join(by_page, ["host", "page"], "left")
    both = parsed.where("NOT open").select("doc", "text").unionByName(
        unsure.select("doc", rest("unsure", "repeated").alias("text"))
    )
    return both.select(*(F.col("doc").getField(c).alias(c) for c in kept.columns), "text")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    out = main_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
