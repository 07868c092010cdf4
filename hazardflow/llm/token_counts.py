"""Token counts by a two-tier lookup of pre-token lengths.

A text's count is the sum of the counts of its pre-tokens. The first tier is a hash table of the
lengths of the corpus's frequent pre-tokens, broadcast to all tasks; at most ``FREQUENT`` entries of at most
``LONGEST`` characters each, so its size has a bound. A pre-token that is not in it is encoded by the
tokenizer once and kept in the worker's own cache. Both tiers hold exact lengths, so neither the
choice of the frequent ones nor a cleared cache changes a count. No text and no pre-token of a document
is shuffled, only the bounded counts from which each task proposes frequent ones.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import least_rows, map_arrow

#: Entries of the broadcast table and characters of its longest entry.
FREQUENT, LONGEST = 60_000, 48
#: Distinct pre-tokens that a task counts side by side; beyond that it halves them, the most frequent stay.
COUNTED = 300_000
#: Entries of a worker's cache; beyond that it starts anew.
CACHED = 500_000

#: Pattern of the byte-level pre-tokenizer. Fixed value.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_workers: dict[str, "Lengths"] = {}


class Lengths(dict):
    """Pre-token -> number of tokens; encodes what it has not seen."""

    def __init__(self, definition: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.tokenizer, self.frequent = Tokenizer.from_str(definition), frequent
        self.tokenizer.encode_special_tokens = True  # special strings are cut out before

    def __missing__(self, piece: str) -> int:
        count = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 4 * LONGEST:
            if len(self) > len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[piece] = count
        return count


def worker_lengths(key: str, given) -> Lengths:
    """The lookup of this worker process, shared by the tasks of one call."""
    if key not in _workers:
        _workers.clear()
        _workers[key] = Lengths(*given.value)
    return _workers[key]


def special_strings(definition: str) -> list[str]:
    """Added tokens, which the library finds in a text before anything else."""
    given = json.loads(definition)
    splitter = given["pre_tokenizer"] or {}
    plain = not given["normalizer"] and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
    odd = [t for t in given["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
    if not plain or splitter.get("add_prefix_space") or odd:
        raise ValueError("only plain byte-level tokenizers are supported")
    return [t["content"] for t in given["added_tokens"]]


def splitter(specials: list[str]):
    """Function from a text to its pre-tokens and the number of special strings in it."""
    find = regex.compile(BYTE_LEVEL).findall
    if not specials:
        return lambda text: (find(text), 0)
    cut = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))

    def split(text: str):
        if not cut.search(text):
            return find(text), 0
        parts = cut.split(text)
        return [piece for part in parts for piece in find(part)], len(parts) - 1

    return split


def frequent_lengths(docs: DataFrame, definition: str) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all rows, at most ``FREQUENT``.

    Each task counts its own texts in bounded memory and passes on its ``FREQUENT`` most frequent ones;
    these are added up, and those of the greatest sums, of equal ones the first in order, are broadcast.
    """
    specials = special_strings(definition)
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])

    def run(batches):
        split, seen = splitter(specials), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py() or "")[0])
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = heapq.nlargest(FREQUENT, ((n, piece) for piece, n in seen.items() if len(piece) <= LONGEST))
        yield [[piece for _, piece in top], [n for n, _ in top]]

    summed = map_arrow(docs.select("text"), run, schema).groupBy("piece").agg(F.sum("n").alias("n"))
    found = least_rows(summed, FREQUENT, F.desc("n"), "piece").select("piece").collect()
    table = Lengths(definition, {})
    return {row["piece"]: table[row["piece"]] for row in found}


def count_tokens(docs: DataFrame, definition: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``definition`` is the JSON text of a byte-level tokenizer. Counts are those of its library on
    whole texts: no begin, end or padding tokens; a special string in a text is one token. A null
    text counts as empty; null and repeated ids are passed on, and an empty table gives no rows. Texts of
    any length are counted whole, one at a time.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    specials = special_strings(definition)
    given = docs.sparkSession.sparkContext.broadcast((definition, frequent_lengths(docs, definition)))
    key = uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        lengths = worker_lengths(key, given)
        split, length = splitter(specials), lengths.__getitem__
        for batch in batches:
            sizes, counts = [], []
            for value in batch.column("text"):
                value = value.as_py() or ""
                pieces, special = split(value)
                counts.append(sum(map(length, pieces)) + special)
                sizes.append(len(value.encode()))
            yield [batch.column("doc_id"), sizes, counts]

    return map_arrow(docs, run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
