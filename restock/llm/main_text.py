"""Main text of web pages: structure first, then a suffix array of each host for what structure leaves open.

A page is cut into blocks at block-level tags. Blocks in navigation, headers and footers of the site,
sidebars, notices, adverts, forms and comments are dropped, told by tag, role, class or id. If the page
declares its content (``article``, ``main`` and the like), the rest of that content is kept. What is left
outside of it, or on a page that declares nothing, is open: no tag or class tells what it is.

Open blocks are judged by repetition: the tokens outside declared content make one stream per page, those of
declared content another, and all streams of a host one text. Its suffixes are named by their first ``LENGTH`` tokens, by
doubling, as a suffix array is built; suffixes with one name that come from distinct pages mark a
repeated stretch. The array is not sorted but grouped by name, so a host of any size is spread over
tasks and summed up before it is shuffled. Stretches repeat in full exactly if all their suffixes do,
so longer repeats are covered too. An open block mostly covered by repeats is boilerplate; the runs
that are the page's own are kept. Beside declared content also what another page declares counts as a repeat: it is
the start or a list of other articles. A page that declares nothing may be such an article in another form, so there it
does not. Repeats inside declared content are passages of the text and stay.

Defined cases: null and empty pages give an empty text. A null or odd address is a host of its own.
Tags that are not closed or cut off at the end of the page end with it. Rows that repeat are pages of
their own, except that rows with one id count as one page, so a copy does not make its text boilerplate.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.llm.common import Places, written

LENGTH = 6
COVERED = 0.5
# The largest filter of names, in places of a bit: 8 MB.
MOST_PLACES = 1 << 26

# Names of elements and of usual classes.
HIDDEN = "script style noscript template textarea title svg iframe object canvas select option button head".split()
SITE_TAGS = frozenset("nav footer aside form menu dialog".split())
SITE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)
SITE_WORDS = frozenset(
    """nav navbar navigation menu sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored promo
    promotion banner cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup login comment
    comments commentlist disqus reply replies respond footer breadcrumb breadcrumbs pagination pager share sharing social
    related recommended toolbar masthead copyright alert form search widget""".split()
)
MAIN_WORDS = frozenset("articlebody article-body post-content entry-content post-body story-body".split())
BLOCK = frozenset(
    """address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_HIDDEN = "|".join(HIDDEN)
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_HIDDEN})\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)([^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)[^<>]*(?:>|\Z)|</?\Z",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")

SITE, MAIN, OPEN = 0, 1, 2


@dataclass
class Block:
    zone: int
    text: str


def _zones(tag: str, attributes: str, inside_main: bool) -> int | None:
    """SITE or MAIN if an element starts such a part, else none."""
    if tag in SITE_TAGS or (tag == "header" and not inside_main):
        return SITE
    words: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return SITE
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return SITE
        if name == "role":
            if value in SITE_ROLES:
                return SITE
            if value in ("main", "article"):
                return MAIN
        elif name in ("class", "id", "itemprop"):
            words.update(value.split())
    if words and tag not in ("body", "html"):
        parts = {part for word in words for part in _PARTS.split(word)}
        if parts & SITE_WORDS or ("header" in parts and not inside_main):
            return SITE
        if words & MAIN_WORDS:
            return MAIN
    return MAIN if tag in ("article", "main") else None


def blocks_of(page: str | None) -> list[Block]:
    """Blocks in page order; the text of each has single spaces and no markup."""
    found: list[Block] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    zone = OPEN
    at = 0

    def close() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append(Block(zone, text))
            pieces.clear()

    for part in _MARKUP.finditer(page or ""):
        if part.start() > at:
            pieces.append(page[at : part.start()])
        at = part.end()
        tag = (part[3] or part[6] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            close()
        if part[2] or part[5]:
            if any(tag == name for name, _ in stack):
                while (top := stack.pop())[0] != tag:
                    pass
                if top[1] != zone:
                    close()
                    zone = top[1]
        elif tag not in VOID:
            stack.append((tag, zone))
            if zone != SITE:
                new = _zones(tag, part[4] or "", zone == MAIN)
                if new is not None and new != zone:
                    close()
                    zone = new
    pieces.append((page or "")[at:])
    close()
    return found


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Names of pairs of names, in this order."""
    mixed = (first * np.uint64(0x9E3779B97F4A7C15) ^ first >> np.uint64(29)) + second
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ mixed >> np.uint64(32)


def names(tokens: list[str]) -> np.ndarray:
    """Names of the stretches of ``LENGTH`` tokens from each place, by doubling."""
    if len(tokens) < LENGTH:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    one = np.fromiter((digest(token) for token in tokens), np.uint64, len(tokens))
    done, whole = 0, np.zeros(len(tokens) - LENGTH + 1, np.uint64)
    power, size = one, 1
    while done < LENGTH:
        if LENGTH & size:
            whole = _joined(whole, power[done : done + len(whole)])
            done += size
        if 2 * size <= LENGTH:
            power = _joined(power[:-size], power[size:])
        size *= 2
    return whole.view(np.int64)


def _stream(blocks: list[Block]) -> tuple[list[str], list[int]]:
    """Tokens outside declared content and the block of each."""
    tokens: list[str] = []
    of: list[int] = []
    for number, block in enumerate(blocks):
        if block.zone != MAIN:
            words = block.text.lower().split()
            tokens += words
            of += [number] * len(words)
    return tokens, of


def _extract():
    @F.pandas_udf("text string, declares boolean, names array<bigint>, blocks array<struct<zone: int, text: string>>")
    def extract(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            blocks = blocks_of(page)
            is_open = any(block.zone == OPEN for block in blocks)
            declared = [block.text for block in blocks if block.zone == MAIN]
            text = None if is_open else " ".join(declared)
            kept = [{"zone": block.zone, "text": block.text} for block in blocks] if is_open else None
            rows.append((text, bool(declared), names(_stream(blocks)[0]), kept))
        return pd.DataFrame(rows, columns=["text", "declares", "names", "blocks"])

    return extract


def _declared(asked: Places):
    """Names of the stream of declared content, without those that are surely not asked for."""

    @F.pandas_udf("array<bigint>")
    def declared(texts: pd.Series, blocks: pd.Series) -> pd.Series:
        rows = []
        for text, listed in zip(texts, blocks, strict=True):
            if text is None:
                text = " ".join(block["text"] for block in listed if block["zone"] == MAIN)
            found = np.unique(names(text.lower().split()))
            rows.append(found[asked.hold(found.view(np.uint64))])
        return pd.Series(rows, dtype=object)

    return declared


def own_text(blocks: list[Block], repeated: set[int]) -> str:
    """Declared content and the open blocks that repeats cover less than ``COVERED`` of, in page order."""
    _, of = _stream(blocks)
    covered = np.zeros(len(of) + 1, np.int64)
    for start in repeated:
        covered[start] += 1
        covered[min(start + LENGTH, len(of))] -= 1
    marked = np.cumsum(covered)[: len(of)] > 0
    total = np.bincount(of, minlength=len(blocks))
    shares = np.bincount(of, marked, len(blocks)) / np.maximum(total, 1) if of else np.zeros(len(blocks))
    kept = [b.zone == MAIN or (b.zone == OPEN and share < COVERED) for b, share in zip(blocks, shares, strict=True)]
    return " ".join(b.text for b, is_kept in zip(blocks, kept, strict=True) if is_kept)


def _finish():
    @F.pandas_udf("string")
    def finish(blocks: pd.Series, repeated: pd.Series) -> pd.Series:
        rows = []
        for listed, places in zip(blocks, repeated, strict=True):
            own = [Block(block["zone"], block["text"]) for block in listed]
            rows.append(own_text(own, set() if places is None else set(places)))
        return pd.Series(rows, dtype=object)

    return finish


def host_of(url: Column) -> Column:
    """The host of an address in lower case, an empty one if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def repeats(streams: DataFrame) -> DataFrame:
    """(host, name, outside) of stretches that occur in distinct pages, from rows (host, page, names, inside).

    ``outside``: in distinct pages outside of declared content too.
    """
    suffixes = streams.select("host", "page", "inside", F.explode("names").alias("name"))
    beside = F.when(~F.col("inside"), F.col("page"))
    ends = {"first": F.min("page"), "last": F.max("page"), "first_beside": F.min(beside), "last_beside": F.max(beside)}
    pages = suffixes.groupBy("host", "name").agg(*[end.alias(name) for name, end in ends.items()])
    outside = F.coalesce(F.col("first_beside") < F.col("last_beside"), F.lit(False)).alias("outside")
    return pages.filter("first < last").select("host", "name", outside)


def _asked(undecided: DataFrame) -> Places:
    """Names beside the declared content of pages with open blocks, as places in a filter of bounded size."""
    names_of = written(undecided.filter("declares").select(F.explode("names").alias("name")).distinct())
    size = 1 << (16 * max(1, names_of.count()) - 1).bit_length()
    return Places.of(names_of, "name", min(max(size, 1 << 15), MOST_PLACES))


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of (page_id, url, html): page_id, url, text and n_chars."""
    rows = written(
        pages.select(
            F.monotonically_increasing_id().alias("row"), "page_id", "url", host_of(F.col("url")).alias("host"),
            _extract()("html").alias("found"),
        ).select("row", "page_id", "url", "host", "found.*")
    )
    page = F.coalesce(F.concat(F.lit("="), F.col("page_id").cast("string")), F.col("row").cast("string"))
    undecided = rows.filter(F.col("text").isNull())
    beside = rows.select("host", page.alias("page"), "names", F.lit(False).alias("inside"))
    declared = _declared(_asked(undecided))("text", "blocks").alias("names")
    inside = rows.filter("declares").select("host", page.alias("page"), declared, F.lit(True).alias("inside"))
    found = repeats(beside.unionByName(inside))
    places = undecided.select("row", "host", "declares", F.posexplode("names").alias("at", "name"))
    repeated = places.join(found, ["host", "name"]).filter("outside OR declares")
    covered = repeated.groupBy("row").agg(F.collect_list("at").alias("repeated"))
    judged = undecided.join(covered, "row", "left").withColumn("text", _finish()("blocks", "repeated"))
    columns = ["page_id", "url", "text"]
    both = rows.filter(F.col("text").isNotNull()).select(columns).unionByName(judged.select(columns))
    return both.withColumn("n_chars", F.length("text").cast("long"))
