"""Main text of web pages.

A page is cut into blocks of text. Markup says of most what they are: blocks of an article
or of the main element belong to the text; menus, headers, footers, sidebars, notices,
adverts, forms and comments do not. Forms and class words are doubtful, as they also stand on
what holds a whole page: an article or main element inside one is text where the page has no
article elsewhere, and if nothing else is left, the text least deep in such elements counts.
The host is the other signal, on every page. Blocks outside articles are laid end to end with a
separator between them, and every substring of `LONG` tokens in a block, or shorter block as a
whole, that `SHARE` of the host's different pages have, `PAGES` of them at least, is boilerplate,
as are the tokens it covers. A page without a sure article is what is left of its blocks then, so
a sentence that is quoted, or an article under two addresses, stays. Of an article a block goes
if it is long and all of it is boilerplate that the host has outside articles. Of a host with two
pages what both have is boilerplate, unless next to nothing else is left of one.

Only prefixes of `LONG` tokens of the suffixes matter for that: suffixes with such a prefix
in common stand together in the host's sorted suffix array. They are made one for each page,
host and prefix, and counted by partial sums, so a host or a menu with a third of all pages
makes no large group. Pages alike in their HTML count as one page. HTML is parsed once.

Defined cases: a null page has an empty text; a null or odd address is a host of its own;
unclosed tags are closed by what follows or by the end; an unfinished tag at the end is
dropped; rows that repeat give the same result each; an empty table gives no rows; other
columns are not touched.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stored

LONG = 8
# A run is boilerplate if this share of the host's pages have it, and so many at least, or both
# of two pages. Of two pages each keeps so many tokens, or else it stays as it is.
SHARE = 0.3
PAGES = 3
LEFT = 4
# Elements by what they are (fixed values of HTML).
HIDDEN = {"head", "script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "math"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog",
    "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "textarea", "dialog", "fieldset"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
# Words in a class or an id that mark a block as no part of the text.
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related",
    "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "widget",
}
# Quotes hold a `>` only where they follow an equals sign.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")
# Words that make a class say what a page has around its text: no-sidebar, has-header.
MODIFIERS = {"no", "has", "with", "without"}
# Elements that hold the text whatever their class says.
HOLDERS = {"html", "body", "main", "article"}
# Elements that may hold a whole page, such as the form of some servers.
DOUBTED = {"form", "fieldset"}
# An article is trusted, and found inside a doubtful element; other text there has DOUBT or, deeper, more.
TRUSTED, OPEN, OUT, FOUND, MAIN, DOUBT = range(6)
SURE = (TRUSTED, FOUND, MAIN)
# Open elements that a start tag of the same kind closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


def _outside(tag: str, attributes: str) -> int | None:
    """`OUT` or, where it is only likely, `DOUBT` if the element is no part of the text."""
    if tag in ASIDE:
        return DOUBT if tag in DOUBTED else OUT
    found = None
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in ASIDE_ROLES:
                return DOUBT if value == "form" else OUT
        elif tag not in HOLDERS:
            for part in value.split():
                words = _WORD.findall(part)
                if not MODIFIERS.intersection(words) and ASIDE_WORDS.intersection(words):
                    found = DOUBT
    return found


def _main_role(attributes: str) -> bool:
    return "main" in attributes and any(
        name.lower() == "role" and "".join(value).lower() == "main"
        for name, *value in _ATTRIBUTE.findall(attributes)
    )


def blocks(page: str) -> list[tuple[int, str]]:
    """Kind and text of every block that has text, in order."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    # Element, kind inside, hidden, and whether an article inside is no article of the page.
    stack: list[tuple[str, int, bool, bool]] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((stack[-1][1] if stack else OPEN, text))

    def close(depth: int) -> None:
        if any(t in BLOCKS or k == FOUND for t, k, _, _ in stack[depth:]):
            flush()
        del stack[depth:]

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not (stack and stack[-1][2]):
            held.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        if m[2] is None or m[4] != ">":
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                close(depth)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            flush()
        if tag in VOID:
            continue
        shut = CLOSES.get(tag)
        if shut:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in shut:
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        kind, hidden, sealed = stack[-1][1:] if stack else (OPEN, False, False)
        outside = _outside(tag, m[3])
        main = tag == "main" or _main_role(m[3])
        if outside is None and not sealed and (tag == "article" or main and kind not in SURE):
            flush()
            if hidden or kind not in (OPEN, MAIN):
                kind, hidden = FOUND, False
            else:
                kind = MAIN if main else TRUSTED
        elif outside is not None and kind != OUT:
            if tag not in BLOCKS and "-" not in tag:
                hidden = True  # inside a line: the line goes on after it
            else:
                flush()
                kind = OUT if outside == OUT or kind in SURE else max(kind + 1, DOUBT)
        sealed = sealed or outside == OUT or tag in HIDDEN or tag == "article"
        stack.append((tag, kind, hidden or tag in HIDDEN, sealed))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
            stop = end.start() if end else len(page)
            if not stack[-1][2]:
                held.append(html.unescape(page[at:stop]))
            at = stop
    flush()
    return out


def _used(kinds: list[int]) -> tuple[int, ...] | None:
    """The kinds of the blocks that are the text by markup; None if the host decides."""
    if TRUSTED in kinds:
        return (TRUSTED, MAIN)
    if MAIN in kinds or OPEN not in kinds and FOUND in kinds:
        return (FOUND, MAIN)
    return None if set(kinds) - {OUT} else ()


def _units(words: list[str]) -> list[tuple[int, str]]:
    """Place and text of the substrings by which a block meets others; the separator stands
    around a block that is shorter than `LONG`."""
    if len(words) < LONG:
        return [(0, f"\n{' '.join(words)}\n")]
    return [(at, " ".join(words[at : at + LONG])) for at in range(len(words) - LONG + 1)]


def _keyed(df: DataFrame) -> DataFrame:
    body = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))
    return df.select("page_id", "url", body.alias("_html"), F.xxhash64(body).alias("_hash"), host.alias("_host"))


def _parsed(df: DataFrame) -> DataFrame:
    """Per page `kinds` and `texts` of its blocks, beside its host and a hash of its HTML."""
    pages = _keyed(df)
    ids = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    names = ["page_id", "url", "_host", "_hash", "kinds", "texts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [blocks(p) for p in b.column("_html").to_pylist()]
            kinds = pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int32()))
            texts = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:4]], kinds, texts], names)

    return pages.mapInArrow(run, f"{ids}, _host string, _hash long, kinds array<int>, texts array<string>")


def _shared(parsed: DataFrame) -> DataFrame:
    """Per host and page the blocks and places whose substrings are boilerplate of the host."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, found = [], []
            pages = zip(b.column("kinds").to_pylist(), b.column("texts").to_pylist())
            for i, (kinds, texts) in enumerate(pages):
                used = _used(kinds)
                for n, (kind, text) in enumerate(zip(kinds, texts)):
                    words, sure = text.split(), kind in SURE
                    # Blocks of an article only ask, and only long ones.
                    if sure and (used is None or kind not in used or len(words) < LONG):
                        continue
                    found.extend((n, at, sure, unit) for at, unit in _units(words))
                rows.extend([i] * (len(found) - len(rows)))
                if len(found) >= 50_000 or i == b.num_rows - 1:
                    keys = [b.column(c).take(pa.array(rows, pa.int64())) for c in ("_host", "_hash")]
                    cols = list(zip(*found)) if found else [()] * 4
                    types = [pa.int32(), pa.int32(), pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [*keys, *[pa.array(c, t) for c, t in zip(cols, types)]],
                        ["_host", "_hash", "block", "place", "sure", "prefix"],
                    )
                    rows, found = [], []

    suffixes = parsed.select("_host", "_hash", "kinds", "texts").mapInArrow(
        run, "_host string, _hash long, block int, place int, sure boolean, prefix string"
    )
    p, q = F.xxhash64("prefix").alias("p"), F.hash("prefix").alias("q")
    suffixes = suffixes.select("_host", "_hash", "block", "place", "sure", p, q)
    counts = suffixes.filter(~F.col("sure")).select("_host", "p", "q", "_hash").distinct()
    counts = counts.groupBy("_host", "p", "q").agg(F.count("*").alias("n")).filter("n > 1")
    hosts = parsed.select("_host", "_hash").distinct().groupBy("_host").agg(F.count("*").alias("pages"))
    enough = (F.col("n") >= SHARE * F.col("pages")) & (F.col("n") >= F.least(F.lit(PAGES), F.col("pages")))
    several = counts.join(stored(hosts, "hosts"), "_host").filter(enough)
    several = stored(several.select("_host", "p", "q", (F.col("pages") == 2).alias("two")), "boilerplate")
    found = suffixes.join(several, ["_host", "p", "q"])
    return found.groupBy("_host", "_hash").agg(
        F.collect_set(F.struct("block", "place")).alias("places"), F.max("two").alias("two")
    )


def _covered(texts: list[str], places: list[dict]) -> list[np.ndarray]:
    """For each block which of its tokens boilerplate covers."""
    gone = [np.zeros(len(t.split()), bool) for t in texts]
    for p in places:
        gone[p["block"]][p["place"] : p["place"] + LONG] = True
    return gone


def page_text(kinds: list[int], texts: list[str], places: list[dict], two: bool = False) -> str:
    """The text of a page by markup and by what its host repeats."""
    gone, used = _covered(texts, places), _used(kinds)
    if used is not None:
        kept = (t for k, t, g in zip(kinds, texts, gone) if k in used and not (len(g) and g.all()))
        return "\n".join(kept)
    # Without open blocks those count that are least deep in doubtful elements.
    open_kind = OPEN
    if OPEN not in kinds and FOUND not in kinds:
        open_kind = min((k for k in kinds if k >= DOUBT), default=OPEN)
    left = []
    for kind, text, g in zip(kinds, texts, gone):
        if kind == FOUND:
            left.append(text)
        elif kind == open_kind:
            left.append(" ".join(w for w, covered in zip(text.split(), g) if not covered))
    if two and places and sum(len(t.split()) for t in left) < LEFT:
        return page_text(kinds, texts, [])
    return "\n".join(t for t in left if t)


def main_text(df: DataFrame) -> DataFrame:
    """One row per page: `page_id`, `url`, its `text` and its code points."""
    parsed = stored(_parsed(df), "pages")
    ids = ", ".join(f"{c} {parsed.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = zip(*[b.column(c).to_pylist() for c in ("kinds", "texts", "places", "two")])
            texts = [page_text(k, t, places or [], bool(two)) for k, t, places, two in pages]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    shared = stored(_shared(parsed), "shared")
    rows = parsed.join(shared, ["_host", "_hash"], "left")
    rows = rows.select("page_id", "url", "kinds", "texts", "places", "two").mapInArrow(run, f"{ids}, text string")
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
