"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements. Elements that are never article text (scripts, menus,
forms, elements whose class or id names an advert, a sidebar, reader comments ...) leave no blocks. The
first pass judges each block by itself from its length, its density of stop words and its share of link
text: good, bad, or undecided where it is short or says too little. In the second pass an undecided
block takes the label of the nearest decided block, of two equally near ones the good one.

Where a page marks its article (``article``, ``main``, or the like in role or class), that is the text: blocks
outside are bad, its edges count as good neighbours, and a long block without stop words is undecided
rather than bad. Elsewhere such a block is bad, unless the page has hardly any stop word at all,
as in a language without a list here; then its length alone makes it good.

Both passes run over the blocks of many pages at once, as arrays, in one pass over the table without a shuffle.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import chunks, map_arrow

#: Characters from which a block's stop words tell something, and from which many of them make it good.
LONG, FULL = 70, 140
#: Share of stop words among the words of running text, and of a page below which they decide nothing.
STOP_HIGH, STOP_NONE = 0.15, 0.03
#: Share of link text above which a block is a list of links.
LINKS = 0.5
GOOD, UNDECIDED, BAD = 1, 0, -1

#: Frequent function words of English, German, Spanish and French. Fixed values.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his in is it its not of on or she that the their this to was were
which with you
aber als am auch auf aus bei das dem den der des die ein eine einen einer er es für hat ich im ist mit nach nicht oder sich
sie sind so über um und von war wie wird zu zum zur
al como con de del el en entre es esta este fue ha la las lo los más no para pero por que se sin son su sus también un una y
au aux avec ce cette dans des du elle est et il ils je la le les leur mais ne nous ou par pas plus pour qu que qui sa se ses
son sont sur un une vous
""".split())

#: Elements whose content is never text of the page.
RAW = frozenset("script style title textarea noscript template iframe object noembed noframes xmp svg canvas math audio video select".split())
#: Elements that hold no article text.
APART = frozenset("nav aside form menu dialog button footer".split())
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead
tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role that name what is not article text.
NAMED_APART = frozenset("""
ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb
breadcrumbs sidebar footer masthead cookie cookies consent notice notices popup modal newsletter subscribe subscription signup
login comment comments disqus reply replies share sharing social related recommended recommendations pagination pager copyright
toolbar complementary contentinfo
""".split())
#: Words of class, id, role and itemprop that name the article.
NAMED_ARTICLE = frozenset("article articlebody main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^\W_]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_WORD = re.compile(r"[^\W\d_]+")


class _Page:
    """Blocks of one page: text, characters in links, and the article region each is in (-1: none)."""

    def __init__(self):
        self.texts, self.links, self.regions = [], [], []
        self.stack = []  # (element, apart, region, in a link)
        self.parts, self.linked, self.breaks, self.known = [], 0, 0, 0

    def state(self):
        return self.stack[-1][1:] if self.stack else (False, -1, False)

    def close_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.texts.append(text)
                self.links.append(min(self.linked, len(text)))
                self.regions.append(self.state()[1])
            self.parts, self.linked = [], 0
        self.breaks = 0

    def add(self, raw: str) -> None:
        apart, _, link = self.state()
        if apart or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if not text.isspace():
            self.breaks = 0
            if link:
                self.linked += len(" ".join(text.split()))

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.close_block()
            self.parts.append(" ")
            return
        if name in BLOCKS:
            self.close_block()
        if name in VOID:
            return
        if name in ("p", "li", "a"):  # implied end of one that is open
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == name:
                    del self.stack[i:]
                    break
                if self.stack[i][0] in BLOCKS:
                    break
        apart, region, link = self.state()
        named = set()
        if "=" in attributes:
            for match in _NAMES.findall(attributes):
                named.update(x.lower() for x in _PARTS.findall("".join(match)))
        if name not in ("html", "body") and not apart:
            apart = name in APART or name == "header" and region < 0 or bool(named & NAMED_APART)
            if not apart and (name in ("article", "main") or named & NAMED_ARTICLE and name in BLOCKS and region < 0):
                self.known += 1
                region = self.known
        self.stack.append((name, apart, region, link or name == "a"))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.close_block()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                del self.stack[i:]
                return
            if name not in BLOCKS and self.stack[i][0] in BLOCKS:
                return

    def read(self, page: str) -> None:
        at = 0
        while found := _TAG.search(page, at):
            self.add(page[at : found.start()])
            at = found.end()
            closing, name = found[1] or found[4], found[2] or found[5]
            if not name:
                continue
            name = name.lower()
            if closing:
                self.end(name)
            elif name in RAW:
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
            else:
                self.start(name, found[3] or found[6] or "")
        self.add(page[at:])
        self.close_block()


def _labels(page, region, chars, links, words, stops) -> np.ndarray:
    """First pass: label of each block by itself. Arrays over the blocks of many pages in order."""
    pages = int(page.max(initial=-1)) + 1
    density = stops / np.maximum(words, 1)
    prose = links <= LINKS * chars
    total = lambda x: np.bincount(page[prose], x[prose], pages)
    silent = (total(stops) < STOP_NONE * total(words))[page]
    marked = (np.bincount(page, region > 0, pages) > 0)[page]
    label = np.full(len(page), UNDECIDED)
    label[(chars >= FULL) & ((density >= STOP_HIGH) | silent)] = GOOD
    label[(chars >= LONG) & (density < STOP_HIGH) & ~silent & (region < 0)] = BAD
    label[~prose | marked & (region < 0)] = BAD
    return label


def _inherited(page, region, label) -> np.ndarray:
    """Second pass: labels of undecided blocks from the nearest decided ones of their page and region."""
    n = len(label)
    place = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = (page[1:] != page[:-1]) | (region[1:] != region[:-1])
    first = np.maximum.accumulate(np.where(new, place, 0))
    ends = np.append(new[1:], True)
    last = np.minimum.accumulate(np.where(ends, place, n)[::-1])[::-1]
    decided = label != UNDECIDED
    before = np.maximum.accumulate(np.where(decided, place, -1))
    after = np.minimum.accumulate(np.where(decided, place, n)[::-1])[::-1]
    inside = region > 0
    # an article's edges are good neighbours; elsewhere there is nothing beyond an edge
    none = np.where(inside, GOOD, UNDECIDED)
    left_in, right_in = before >= first, after <= last
    left = np.where(left_in, label[np.maximum(before, 0)], none)
    right = np.where(right_in, label[np.minimum(after, n - 1)], none)
    far = np.where(inside, 1, 2 * n)
    left_far = np.where(left_in, place - before, place - first + far)
    right_far = np.where(right_in, after - place, last - place + far)
    nearest = np.where(left_far < right_far, left, np.where(right_far < left_far, right, np.maximum(left, right)))
    # without any decided neighbour a block stays
    return np.where(decided, label, np.where(nearest == UNDECIDED, GOOD, nearest))


def main_texts(pages: list[str | None]) -> list[str]:
    """Main text of each page: the good blocks in order, joined by empty lines; empty if there is none."""
    texts, links, regions, counts = [], [], [], []
    for source in pages:
        page = _Page()
        page.read(source or "")
        texts += page.texts
        links += page.links
        regions += page.regions
        counts.append(len(page.texts))
    if not texts:
        return [""] * len(pages)
    found = [[w in STOP_WORDS for w in _WORD.findall(text.lower())] for text in texts]
    page = np.repeat(np.arange(len(pages)), counts)
    region, chars, links = np.array(regions), np.array([len(t) for t in texts]), np.array(links)
    label = _labels(page, region, chars, links, np.array([len(f) for f in found]), np.array([sum(f) for f in found]))
    kept = _inherited(page, region, label) == GOOD
    bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return ["\n\n".join(texts[i] for i in range(a, b) if kept[i]) for a, b in zip(bounds, bounds[1:])]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row, from the whole source.

    White space in a block, no-break and line-break characters included, becomes one space; two line breaks
    in a row end a block. Null and empty sources, and pages without main text, give an empty text. Ids
    and addresses are passed on, null and repeated ones too; other columns are not looked at. An
    unclosed script or comment reaches to the end of the page, as in a browser. Memory follows the longest page.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in chunks(batches, "html"):
            texts = main_texts(batch.column("html").to_pylist())
            yield [batch.column("page_id"), batch.column("url"), texts, [len(t) for t in texts]]

    return map_arrow(rows, run, schema)
