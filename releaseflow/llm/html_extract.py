"""Main text of web pages (operator 4): nearest-URL page differencing.

Within a host, pages are ordered by URL path and each is paired with the one of
its two neighbours whose path shares the longer beginning. The text lines of both
are aligned by their longest common subsequence; shared lines are page furniture
and go, unless the whole page is a copy of its neighbour.

Differencing alone deletes articles that two pages share and keeps furniture that
differs from page to page, so the page's own markup has the first word: elements
that are furniture by their tag, or by a whole class or role token (or id, outside
an article), go, and inside an ``article`` (or else ``main``) element every other
line stays. Where a furniture word is only part of a name ("share-prices"), a block
is suspect: its lines go if the neighbour shares them. Differencing decides over
pages without such an element.

The order of paths comes from a range partitioning of hosts and paths alone, so a
host of any size is spread over many tasks; neighbours exchange hashes of lines.

A null or empty html has no text; a null url counts as a host of its own. Repeated
rows each give a result row. Other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from releaseflow.llm.components import saved
from releaseflow.llm.ship import ship
from releaseflow.llm.vocab import slices

#: Share of a page's lines that its neighbour may hold before it counts as a copy.
COPY_SHARE = 0.8

# Element names and words of class, id and role attributes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
_FURNITURE = frozenset("aside button canvas dialog footer form head header iframe menu nav noscript object "
                       "select svg template textarea title".split())
_WORDS = frozenset("ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments "
                   "complementary consent contentinfo cookie cookies copyright dialog disqus footer header login "
                   "masthead menu modal nav navbar navigation newsletter notice notification pager pagination "
                   "popup promo related search share sharing sidebar signup social sponsor sponsored subscribe "
                   "toolbar widget".split())
#: Words beside which a furniture word still makes up a whole name ("share-bar").
_LAYOUT = frozenset("area bar block bottom box button buttons column container desktop fixed footer global group "
                    "header icon icons inner item items left link links list main mobile outer page panel primary "
                    "right row secondary section site sticky title top wrap wrapper".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose class may name what they merely contain.
_FRAMES = frozenset("html body main article".split())
_COMMENT_WORDS = frozenset("ad advert comment comments promo related sponsored teaser".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|/|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
_CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())


@dataclass
class Line:
    text: str
    article: bool
    main: bool
    furniture: bool
    suspect: bool = False


def _judged(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether it is suspect."""
    if tag in _FURNITURE and not (tag == "header" and in_article):
        return True, False
    if not attrs:
        return False, False
    if _HIDDEN.search(attrs):
        return True, False
    return _by_name(tag, attrs, in_article)


def _by_name(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether a class, role or id names furniture, and whether one has a furniture word in it."""
    words = _COMMENT_WORDS if tag in _FRAMES else _WORDS
    whole = part = False
    for m in _ATTR.finditer(attrs):
        kind = m[1].lower()
        if kind == "id" and in_article:
            continue
        for token in html.unescape(m[2] or m[3] or m[4] or "").lower().split():
            named = {w for w in re.split(r"[^a-z0-9]+", token) if w}
            if named & words:
                part = True
                whole = whole or (named <= words | _LAYOUT and not (kind == "id" and tag in _HEADINGS))
    return whole, part


def lines_of(page: str | None) -> list[Line]:
    """Non-empty text blocks in page order, with the kind of element around them."""
    out: list[Line] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    text: list[str] = []

    def flush() -> None:
        block = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if block:
            out.append(Line(block, *stack[-1][1:]))

    at = 0
    page = page or ""
    for m in _TOKEN.finditer(page):
        text.append(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in _INLINE:
            if tag in ("br", "img", "wbr"):
                text.append(" ")
            continue
        flush()
        if tag in _VOID:
            continue
        names = [s[0] for s in stack]
        if m["close"]:
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag):]
            continue
        if tag in _CLOSES_ITSELF and names[-1] == tag:
            stack.pop()
        elif names[-1] == "p":  # a block ends an open paragraph
            stack.pop()
        _, article, main, furniture, suspect = stack[-1]
        if not furniture:
            furniture, named = _judged(tag, m["attrs"], article)
            suspect = suspect or named
        stack.append((tag, article or tag == "article", main or tag == "main", furniture, suspect))
    text.append(page[at:])
    flush()
    return out


def line_hashes(lines: list[Line]) -> np.ndarray:
    arr = np.array([ln.text for ln in lines], dtype=object)
    return pd.util.hash_array(arr, categorize=False).astype(np.int64) if lines else np.zeros(0, np.int64)


def shared_lines(own: list[int], other: list[int]) -> set[int]:
    """Places of ``own`` in a longest common subsequence with ``other``."""
    places: dict[int, list[int]] = {}
    for k in range(len(other) - 1, -1, -1):
        places.setdefault(other[k], []).append(k)
    tails: list[int] = []
    nodes: list[tuple] = []
    chain: tuple | None
    for i, value in enumerate(own):
        for k in places.get(value, ()):
            at = bisect_left(tails, k)
            chain = (i, nodes[at - 1] if at else None)
            if at == len(tails):
                tails.append(k)
                nodes.append(chain)
            else:
                tails[at], nodes[at] = k, chain
    found, chain = set(), nodes[-1] if nodes else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def main_text(lines: list[Line], other: list[int] | None) -> str:
    """Blocks of the main text, one per line; ``other`` holds the neighbour's line hashes."""
    body = [(i, ln) for i, ln in enumerate(lines) if not ln.furniture]
    marked = next(filter(None, ([(i, ln) for i, ln in body if inside(ln)] for inside in (
        lambda ln: ln.article, lambda ln: ln.main))), [])
    shared: set[int] = set()
    if other and (not marked or any(ln.suspect for _, ln in marked)):
        shared = shared_lines(line_hashes(lines).tolist(), other)
        if len(shared) > COPY_SHARE * len(lines):
            shared = set()
    if marked:
        return "\n".join(ln.text for i, ln in marked if not (ln.suspect and i in shared))
    return "\n".join(ln.text for i, ln in body if i not in shared)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, pages in slices(batches, "html"):
        parsed = [lines_of(p) for p in pages]
        blobs = [zlib.compress(json.dumps([[ln.text, ln.article, ln.main, ln.furniture, ln.suspect] for ln in lines],
                                          ensure_ascii=False).encode("utf-8", "surrogatepass"), 1)
                 for lines in parsed]
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), part.column("id"), part.column("url"),
             pa.array([line_hashes(lines) for lines in parsed], pa.list_(pa.int64())), pa.array(blobs, pa.binary())],
            names=["key", "id", "url", "hashes", "lines"])


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text([Line(*ln) for ln in json.loads(zlib.decompress(blob).decode("utf-8", "surrogatepass"))],
                           other)
                 for blob, other in zip(batch.column("lines").to_pylist(), batch.column("other").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["id", "url", "text"])


def nearest_pages(pages: DataFrame) -> DataFrame:
    """``(key, other)``: of rows ``(key, host, path)``, the nearest other key on the same host."""
    # Equal keys are one page; the order is total, so a repeated task repeats the numbering.
    order = ["host", "path", "key"]
    placed = saved(pages.dropDuplicates(["key"]).repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("n", F.monotonically_increasing_id()))
    part = F.shiftright("n", 33).alias("part")
    edges = placed.groupBy(part).agg(F.min("n").alias("first"), F.max("n").alias("last"))
    after = Window.orderBy("part")  # one row per partition
    seam = edges.select("last", F.lead("first").over(after).alias("next")).filter("next is not null")
    pairs = placed.select("n", (F.col("n") + 1).alias("m")).union(seam.select("last", "next"))
    left = placed.select(F.col("n"), *(F.col(c).alias(f"l_{c}") for c in order))
    right = placed.select(F.col("n").alias("m"), *(F.col(c).alias(f"r_{c}") for c in order))
    common = F.expr("size(filter(sequence(1, length(l_path) + 1),"
                    " i -> substr(l_path, 1, i) = substr(r_path, 1, i)))").alias("common")
    met = pairs.join(left, "n").join(right, "m").filter("l_host = r_host").select("l_key", "r_key", common)
    both = met.select(F.col("l_key").alias("key"), F.struct("common", F.lit(1), F.col("r_key").alias("other")).alias("o"))
    both = both.union(met.select("r_key", F.struct("common", F.lit(0), "l_key")))
    return both.groupBy("key").agg(F.max("o").alias("o")).select("key", F.col("o.other").alias("other"))


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(id, url, text)``, one row per input row."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    keyed = rows.withColumn("key", F.xxhash64("id", "url", "html"))
    url = F.coalesce("url", F.lit(""))
    near = nearest_pages(keyed.select(
        "key", F.lower(F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[^:/?#]*://[^/?#]*)?([^?#]*)", 1).alias("path")))
    id_type = df.schema[id_col].dataType.simpleString()
    parsed = keyed.mapInArrow(_parse, f"key long, id {id_type}, url string, hashes array<long>, lines binary")
    hashes = parsed.select(F.col("key").alias("other"), "hashes").dropDuplicates(["other"])
    other = near.join(hashes, "other").select("key", F.col("hashes").alias("other"))
    out = parsed.select("key", "id", "url", "lines").join(other, "key", "left").select("id", "url", "lines", "other")
    return out.mapInArrow(_difference, f"id {id_type}, url string, text string").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
