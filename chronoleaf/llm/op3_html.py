"""HTML extraction by a maximum-scoring subsequence.

A page is read as a sequence of words and tags.  A word scores positive, a tag
and a word inside a link negative; elements that never hold an article (menus,
headers, footers, adverts, forms ...) score nothing, as their words are dropped
wherever they stand.  One linear scan finds the contiguous region with the
greatest total.  It is closed over the blocks at its edges and over the blocks
and lists beside it that are mostly not links, within the container that holds
it; its words, less those in such elements, are the main text.

Weights come from labelled pages: pages that mark their own content with
``<article>`` or ``<main>``.  From a bounded sample of them (LABELLED_PAGES,
chosen by a hash of the page's address) Spark counts how often each kind of
word and each tag stands inside and outside the content; the clipped log-odds
are the weights.  The markup that gives the label is itself no feature.  With
no labelled page the prior weights hold.

Defined results: null html gives an empty text; character references are
decoded; a form, or an element that only its class, id or role calls boilerplate,
is none while it holds most of the page's words (see _resolve); a link left open ends at
the next block tag, and <a name=...> is no link; white space inside a block becomes one space; blocks are joined in
page order by one space; unclosed or stray tags are read as they come; null ids
pass through; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, deque

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import small_batches, table

LABELLED_PAGES = 2000   # bound of the sample that the weights are learned from
CLIP = 4.0              # largest size of a learned weight
LEAST = 0.02            # smallest size of a weight: words stay positive, tags negative

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"                                                     # comment
    r"|<(script|style|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"       # raw element
    r"|<[!?][^>]*>?"                                                         # doctype and the like
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"             # tag
    r"|</?[a-zA-Z][^>]*>?", re.S | re.I)                                     # tag with a broken attribute
_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_BETWEEN = re.compile(r"[\W\d_]+")
_LINK = re.compile(r"<(/?)a[\s/>]", re.I)

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LABELS = frozenset(("article", "main"))
#: elements that hold no article text, and the classes, ids and roles that say the same, alone or joined with each other
#: ("ad", "ad-banner", "share_2"; not "no-sidebar" or "with-comments")
BOILERPLATE = frozenset("nav header footer aside button select dialog menu".split())
WRAPPERS = frozenset("form fieldset".split())    # the same, unless one holds most of the page's words
SKIPPED = frozenset("noscript template svg".split())   # dropped up to their closing tag, if there is one
BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement sponsor sponsored promo banner cookie cookies consent notice popup modal nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar footer header comment comments reply replies related "
    "share sharing social subscribe newsletter signup login pagination pager toolbar widget disclaimer".split())
CONTAINERS = frozenset("div section article main nav header footer aside form ul ol dl table body dialog menu fieldset "
                       "select button details figure blockquote center".split())


class Element:
    """An open container: what stands in it is boilerplate or labelled content if it or one around it is."""

    __slots__ = ("name", "parent", "depth", "at", "boiler", "label", "named", "words", "holds")

    def __init__(self, name: str, parent: Element | None, at: int, attributes: str = ""):
        self.name, self.parent, self.at = name, parent, at
        self.depth = parent.depth + 1 if parent else 0
        self.label = max(1 + (name == "article") if name in LABELS else 0, parent.label if parent else 0)   # 2: article
        self.boiler = name in BOILERPLATE or name not in LABELS and parent is not None and parent.boiler
        # by its class alone: not the body, nor what marks the content (an article inside an article is a comment on it)
        self.named = name in WRAPPERS or bool(attributes) and name != "body" and (name not in LABELS or parent.label == 2) and _named(attributes)
        self.words, self.holds = 0, name in LABELS


def _resolve(elements: list[Element]) -> None:
    """Elements that a class, id or role names, and WRAPPERS, are boilerplate, unless they hold most of the page's words (those outside
    links and BOILERPLATE): more than half of them, or nine in ten inside labelled content, which longer comments may
    follow.  Beside labelled content they are always boilerplate.  Parents come first in ``elements``."""
    for e in reversed(elements):
        if e.parent and e.name not in BOILERPLATE:
            e.parent.words += e.words
        if e.parent and e.holds:
            e.parent.holds = True
    page = elements[0]
    for e in elements[1:]:
        if e.named:
            if e.parent.label:
                e.named = e.words < 0.9 * page.words
            elif e.holds or not page.holds:
                e.named = 2 * e.words <= page.words
        e.boiler = e.name in BOILERPLATE or e.named or e.name not in LABELS and e.parent.boiler


def pieces(page: str) -> list[tuple[str, str, int, Element]]:
    """(kind, content, words, element) of every text run and tag.  kind: 'tag', 'word' (text outside links) or 'link'
    (text inside a link); content: tag name or raw text; element: the innermost container (a tag that opens or closes
    one stands in the container that is open after it)."""
    found: list[tuple[str, str, int, Element]] = []
    inner = Element("", None, -1)                         # innermost open container
    elements = [inner]
    link, closed, at = False, False, 0
    open_names: Counter = Counter()
    endings: dict[str, deque] = {}                        # where the SKIPPED elements close, read forwards once
    while m := _PIECE.search(page, at):
        if m.start() > at:
            text = page[at:m.start()]
            n = len(text.split())
            found.append(("link" if link else "word", text, n, inner))
            inner.words += 0 if link else n
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if m[1]:
                found.append(("tag", m[1].lower(), 0, inner))
            continue
        if name in SKIPPED and not m[2] and not m[4].rstrip().endswith("/"):
            if name not in endings:
                endings[name] = deque(x.end() for x in re.finditer(rf"</{name}\s*>", page, re.I))
            while endings[name] and endings[name][0] <= at:
                endings[name].popleft()
            if endings[name]:
                at = endings[name][0]
                continue
        if name == "a":
            link = not m[2] and ("href" in m[4].lower() or "name" not in m[4].lower())   # else a place, not a link
            closed = link and (after := _LINK.search(page, at)) is not None and after[1] == "/"
        elif link and not closed and name not in INLINE and name not in VOID:
            link = False                                  # a link left open ends with its block
        if name in CONTAINERS:
            if m[2]:
                while open_names[name]:                   # a stray closing tag closes nothing
                    last, inner = inner.name, inner.parent
                    open_names[last] -= 1
                    if last == name:
                        break
            elif name in LABELS or not m[4].rstrip().endswith("/"):
                if name in LABELS:                        # content ends whatever menu or link was left open
                    link = False
                inner = Element(name, inner, len(found), m[4])
                elements.append(inner)
                open_names[name] += 1
        found.append(("tag", name, 0, inner))
    if at < len(page):
        text = page[at:]
        n = len(text.split())
        found.append(("link" if link else "word", text, n, inner))
        inner.words += 0 if link else n
    if any(e.named for e in elements):
        _resolve(elements)
    return found


def _named(attributes: str) -> bool:
    """Whether a class, id or role is a name of boilerplate as a whole, or joined of such names only."""
    for _, value in _ATTR.findall(attributes):
        for name in value.strip("\"'").lower().split():
            parts = [x for x in _BETWEEN.split(name) if x]
            if parts and BOILER_NAMES.issuperset(parts):
                return True
    return False


def _feature(kind: str, content: str, boiler: bool) -> str:
    return f"tag {content}" if kind == "tag" else f"{'boilerplate ' if boiler else ''}{kind}"


#: weights before any page is seen
PRIOR = {"word": 1.0, "link": -1.0, "boilerplate word": -1.0, "boilerplate link": -1.0}


def _weight(feature: str, inside: float, outside: float, all_in: float, all_out: float) -> float:
    odds = math.log((inside + 0.5) / (all_in + 1)) - math.log((outside + 0.5) / (all_out + 1))
    odds = max(-CLIP, min(CLIP, odds))
    if feature == "word":
        return max(LEAST, odds)                           # words are positive
    return min(-LEAST, odds)                              # tags, links and boilerplate are negative


def learn_weights(pages: DataFrame, html_col: str = "html", by: str = "url", limit: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from at most ``limit`` labelled pages, the same ones whatever the partitioning; copies count once."""
    small_batches(pages.sparkSession)
    labelled = pages.where(F.lower(F.col(html_col)).rlike(r"<(article|main)[\s>]")).select(
        F.col(html_col).alias("html"), F.xxhash64(by).alias("h"), F.xxhash64(html_col).alias("g"))
    # picked by hashes alone, each text of an address once; then only the picked pages carry their html
    picked = labelled.select("h", "g").distinct().orderBy("h", "g").limit(limit)
    sample = labelled.join(F.broadcast(picked), ["h", "g"]).groupBy("h", "g").agg(F.min("html").alias("html"))

    def count(batches):
        inside, outside = Counter(), Counter()
        for pdf in batches:
            for page in pdf["html"]:
                for kind, content, n, e in pieces(page):
                    if kind == "tag" and (e.boiler or content in LABELS):
                        continue                          # tags in boilerplate are not scored
                    n = 1 if kind == "tag" else n
                    (inside if e.label and not e.boiler else outside)[_feature(kind, content, e.boiler)] += n
        names = sorted(inside | outside)
        yield pd.DataFrame({"feature": names, "inside": [float(inside[x]) for x in names],
                            "outside": [float(outside[x]) for x in names]})

    # few rows: a feature is a kind of word or a tag that the sample has; rare tags are left to the default
    rows = (sample.select("html").mapInPandas(count, "feature string, inside double, outside double")
            .groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
            .orderBy(F.desc(F.col("inside") + F.col("outside")), "feature").limit(200).collect())
    all_in, all_out = sum(r.inside for r in rows), sum(r.outside for r in rows)
    return PRIOR | {r.feature: _weight(r.feature, r.inside, r.outside, all_in, all_out) for r in rows}


def _grow(found: list[tuple[str, str, int, Element]], start: int, end: int) -> tuple[int, int]:
    """The region closed over the blocks at its edges, then at either edge over its neighbours in the container there:
    block by block, lists, tables and other containers as one, while a block has more words outside links than inside.
    Paragraphs of links are taken too unless they stand in the body itself.  From the end of a container this goes on in
    the one around it, up to the one that holds the region, and inside labelled content further outwards."""
    def block_tag(i: int) -> bool:
        return found[i][0] == "tag" and found[i][1] not in INLINE and found[i][1] not in VOID

    def cut(i: int, here: Element) -> bool:               # a block, list or other container begins or ends
        e = found[i][3]
        return block_tag(i) if e is here else e.parent is here and e.at == i

    while start > 0 and not block_tag(start - 1):
        start -= 1
    while end < len(found) and not block_tag(end):
        end += 1
    # the page is read along the tree of containers, so the one of least depth in the region holds all of it
    home = min((found[i][3] for i in range(start, end)), key=lambda e: e.depth)

    def outwards(here: Element) -> Element | None:
        return here.parent if here.parent and (here.depth > home.depth or here.parent.label) else None

    here = found[start][3].parent if found[start][3].at == start else found[start][3]
    while here:
        at, more = start, True
        while more and at > here.at + 1:
            at -= 1
            if at == here.at + 1 or cut(at, here):
                if more := _content(found, at, start, here):
                    start = at
        outer = outwards(here) if more else None
        start, here = here.at if outer else start, outer
    here = found[end - 1][3]
    while here:
        at, more = end, True
        while more and at < len(found) and found[at][3].depth >= here.depth:
            at += 1
            if at == len(found) or found[at][3].depth < here.depth or cut(at, here):
                if more := _content(found, end, at, here):
                    end = at
        here = outwards(here) if more else None
    return start, end


def _content(found: list[tuple[str, str, int, Element]], start: int, end: int, home: Element) -> bool:
    """Whether a block belongs to the region beside it; blocks without words and boilerplate do no harm."""
    words = sum(n for kind, _, n, e in found[start:end] if kind == "word" and not e.boiler)
    links = sum(n for kind, _, n, e in found[start:end] if kind == "link" and not e.boiler)
    return words > links or not links or found[start][1] in PARAGRAPHS and home.name not in ("", "body")


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The words of the greatest-scoring region, block by block."""
    if not page:
        return ""
    found = pieces(page)
    best = total = 0.0
    start, region = 0, None
    for i, (kind, content, n, e) in enumerate(found):
        if e.boiler:                                      # its words are dropped below, so they count nothing
            continue
        w = weights.get(_feature(kind, content, False))
        if w is None:
            w = -LEAST if content in INLINE or content in VOID else -1.0
        total += w * (1 if kind == "tag" else n)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    if region is None:
        return ""
    blocks, block = [], []
    for kind, content, _, e in found[slice(*_grow(found, *region))]:
        if kind == "tag":
            if content not in INLINE:
                blocks.append("".join(block))
                block = []
        elif not e.boiler:
            block.append(content)
    blocks.append("".join(block))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return " ".join(b for b in clean if b)


def extract_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """Adds ``text`` to ``pages`` (replacing a column of that name)."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(col: pd.Series) -> pd.Series:
        return col.map(lambda page: main_text(page, weights)).astype(object)

    return pages.withColumn("text", text(F.coalesce(F.col(html_col), F.lit(""))))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_text(pages, learn_weights(pages)).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


#: the test tables mark their content with one <article>: blocks are what stands between tags other than <b>
OP3_SQL = r"""
WITH a AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '<article[^>]*>(.*?)</article>', 1, 's'), '') AS body FROM pages
), b AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(body, '</?b>', '', 'g'),
      '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM a
), c AS (
  SELECT page_id, url, replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text FROM b
)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""
