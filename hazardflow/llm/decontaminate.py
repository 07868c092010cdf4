"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may occur in a text with up to k = floor(rate * n) edits. The item is
split into k + 1 pieces; an occurrence leaves at least one of them untouched, so exact hits of the
pieces, found together by one automaton, give all places to look at. Around each hit the item's least
edit distance to any stretch of the text is computed with Myers' bit-parallel algorithm.

Items are broadcast in blocks of bounded size, one pass over the texts for each block; the texts are
never shuffled.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import chunks, map_arrow, released, ship_package

#: Characters of test items broadcast at once. More items take more passes.
BLOCK_CHARS = 8 << 20
#: Edits allowed for each character of an item.
RATE = 0.05


def normal(text: str | None) -> str:
    """Lower case, one space for each run of white space."""
    return " ".join((text or "").lower().split())


def pieces(length: int, rate: float) -> list[tuple[int, int]]:
    """The item's error budget plus one pieces, as (start, end)."""
    n = min(int(rate * length) + 1, length)
    cuts = [i * length // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def masks(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def best_match(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring, first end of such a substring)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp) & full
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
            if score < best:
                best, end = score, i
        hp = hp << 1 & full
        hn = hn << 1 & full
        vp = hn | ~(d0 | hp) & full
        vn = hp & d0
    return best, end


class Matcher:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.items, self.rate, where = [], rate, {}
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            number = len(self.items)
            self.items.append((item_id, text, int(rate * len(text)), masks(text)))
            for start, end in pieces(len(text), rate):
                where.setdefault(text[start:end], []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str | None):
        """Best match of each item in the text: (item_id, distance, end in the normalised text)."""
        if not self.items or not (text := normal(text)):
            return []
        spans: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for number, start in places:
                _, item, k, _ = self.items[number]
                begin = last + 1 - length - start
                lo, hi = max(0, begin - k), begin + len(item) + k
                found = spans.setdefault(number, [])
                if found and lo <= found[-1][1] and lo >= found[-1][0] and hi - found[-1][0] <= 4 * len(item) + 64:
                    found[-1][1] = max(hi, found[-1][1])
                else:
                    found.append([lo, hi])
        out = []
        for number, found in spans.items():
            item_id, item, k, peq = self.items[number]
            best = None
            for lo, hi in found:
                distance, end = best_match(peq, len(item), text[lo:hi])
                if distance <= k and (best is None or distance < best[0]):
                    best = distance, lo + end
                    if not distance:
                        break
            if best:
                out.append((item_id, *best))
        return out


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_CHARS):
    """The items as lists of at most about ``limit`` characters, one after another on the driver."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    items = items.filter("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = int(-(-chars // limit))
    for block in range(count):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield [(r["item_id"], r["text"]) for r in own.sort("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, end) of every row and item that occurs in it.

    ``distance`` is the least number of edits that turns the item into a stretch of the text, both
    in lower case with single spaces; at most ``rate`` times the item's length. ``end`` is where the
    first such stretch ends. Null or empty texts and items match nothing. Repeated rows and items
    give a row each for distinct (item_id, text); null ids are passed on.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())])
    found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, `end` long")
    for items in blocks(benchmark):
        given = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, given=given):
            matcher = Matcher(given.value, rate)
            for batch in chunks(batches):
                ids = batch.column("doc_id").to_pylist()
                rows = [(i, *m) for i, t in zip(ids, batch.column("text")) for m in matcher.matches(t.as_py())]
                yield list(zip(*rows)) if rows else [[], [], [], []]

        found = found.unionByName(map_arrow(docs, run, schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text: str = "text") -> DataFrame:
    """Rows of ``docs`` in whose text no item occurs; columns and their names stay."""
    for items in blocks(benchmark):
        given = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, given=given):
            matcher = Matcher(given.value, rate)
            for batch in chunks(batches, text):
                yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in batch.column(text)], pa.bool_()))

        ship_package(docs.sparkSession)
        docs = docs.mapInArrow(released(run), docs.schema)
    return docs
