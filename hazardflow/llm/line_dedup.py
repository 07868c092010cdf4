"""Repeated runs of lines, found by a suffix array over line ids and removed but for the first copy.

The corpus is a sequence of line ids, one stretch for each document; a line without a word is not in
it. Distributed prefix doubling ranks the suffixes: after round k, a position's rank is the order of
its first 2^k lines among all that occur twice or more. A round sorts the pairs (rank here, rank
2^k lines on). Positions whose run is unique drop out, since no longer run from there repeats, so the
rounds work on repeated text only.

Equal ranks are the intervals of the suffix array with a longest common prefix of 2^k lines. A run of
any length l is equal to another exactly if the intervals of its first and last 2^k lines agree,
2^k <= l < 2^(k+1). A repeated run of ``min_words`` words or more is the union of the repeated runs
inside it that reach ``min_words`` with the fewest lines, counted from a line on or back from a line
(a line of the run either has enough words after it, or enough before it, or a window around it). So
only those windows are asked for, of at most ``min_words`` lines, and the number of rounds is bounded
by log2(min_words) however long the repeated runs are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hazardflow.llm.store import chunks, map_arrow, released, ship_package, stored, text_bytes, unused
from hazardflow.llm.words import EXACT, hash_spans, spans

#: Matches a text that has a word.
WORD = r"[^ \t\n\x0B\f\r]"


def lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, doc, line, rank, on, back) of every line with a word.

    ``rank`` is the line's id. ``on`` is the fewest lines from this one on with ``min_words`` words,
    ``back`` the fewest that end with it; 0 if the document has too few.
    """
    schema = pa.schema([("id", pa.int64()), ("doc", pa.int64()), ("line", pa.int32()), ("rank", pa.int64()),
                        ("on", pa.int32()), ("back", pa.int32())])

    def run(batches):
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            n = batch.num_rows
            newline = np.flatnonzero(data == 10)
            at = np.searchsorted(offsets, newline, "right") - 1
            rows = np.concatenate([np.arange(n), at])
            starts, ends = np.concatenate([offsets[:-1], newline + 1]), np.concatenate([offsets[1:], newline])
            by_start, by_end = np.lexsort((starts, rows)), np.lexsort((ends, rows))
            rows, starts, ends = rows[by_start], starts[by_start], ends[by_end]
            _, word, _ = spans(data, offsets)
            words = np.searchsorted(word, ends) - np.searchsorted(word, starts)
            kept = words > 0
            rows, starts, ends, words = rows[kept], starts[kept], ends[kept], words[kept]
            total = np.cumsum(words)
            before = total - words
            place = np.arange(len(rows))
            last = np.searchsorted(total, before + min_words)
            on = np.where(last < len(rows), last - place + 1, 0)
            on[on > 0] *= rows[last[on > 0]] == rows[on > 0]
            first = np.searchsorted(before, total - min_words, "right") - 1
            back = np.where(first >= 0, place - first + 1, 0)
            back[back > 0] *= rows[first[back > 0]] == rows[back > 0]
            line = place - np.searchsorted(rows, rows)
            given = pa.array(rows)
            yield [batch.column("id").take(given), batch.column("doc").take(given), line.astype(np.int32),
                   hash_spans(data, starts, ends, EXACT).view(np.int64), on.astype(np.int32), back.astype(np.int32)]

    return map_arrow(docs, run, schema)


def _only_repeated(rows: DataFrame, key: list[str], rank: bool) -> DataFrame:
    """Rows whose key occurs twice or more, with the rank of the key in sort order."""
    found = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    if rank:
        found = found.sort(*key).withColumn("rank", F.monotonically_increasing_id())
    return rows.join(found, key)


def suffix_ranks(line_rows: DataFrame, rounds: int) -> DataFrame:
    """(doc, line, k, rank): ranks of the first 2^k lines of each suffix, where they repeat."""
    level = stored(_only_repeated(line_rows.select("doc", "line", "rank"), ["rank"], False), "level")
    found = level.withColumn("k", F.lit(0))
    for k in range(rounds):
        ahead = Window.partitionBy("doc").orderBy("line").rangeBetween(1 << k, 1 << k)
        pair = level.select("doc", "line", F.col("rank").alias("r1"), F.first("rank").over(ahead).alias("r2")).filter("r2 IS NOT NULL")
        level = stored(_only_repeated(pair, ["r1", "r2"], True).select("doc", "line", "rank"), "level")
        found = found.unionByName(level.withColumn("k", F.lit(k + 1)))
    return found


def repeated_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, line, length) of windows of which an equal one stands earlier; ``docs`` has id, doc, text.

    Earlier is by id (null first), then the key of the text, then the line.
    """
    rows = stored(lines(docs, min_words).distinct(), "lines")
    rounds = max(min_words, 1).bit_length() - 1
    ranks = suffix_ranks(rows, rounds)
    active = rows.join(ranks.filter("k = 0").select("doc", "line"), ["doc", "line"])
    windows = (
        active.select("id", "doc", F.explode(F.array(
            F.struct(F.col("line").alias("line"), F.col("on").alias("length")),
            F.struct((F.col("line") - F.col("back") + 1).alias("line"), F.col("back").alias("length")),
        )).alias("w")).select("id", "doc", "w.*").filter("length > 0").distinct()
        .withColumn("k", F.floor(F.log2("length") + 1e-9).cast("int"))
        .withColumn("last", F.expr("line + length - shiftleft(1, k)"))
    )
    named = windows.join(ranks.withColumnRenamed("rank", "r1"), ["doc", "line", "k"]).join(
        ranks.select("doc", F.col("line").alias("last"), "k", F.col("rank").alias("r2")), ["doc", "last", "k"])
    named = stored(named.select("id", "doc", "line", "length", "r1", "r2"), "windows")
    place = F.struct("id", "doc", "line")
    first = named.groupBy("length", "r1", "r2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return named.join(first, ["length", "r1", "r2"]).filter(place != F.col("first")).select("doc", "line", "length")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50, removed: str | None = None,
) -> DataFrame:
    """``docs`` without later copies of repeated runs of whole lines.

    A line goes if it lies in a run of lines of one text that has ``min_words`` words or more and
    stands earlier too, in another text or this one. The first copy, by id and place, stays. Lines
    are compared byte for byte; lines without a word are no part of a run and stay. All rows,
    columns and names stay, only ``text`` changes; a text that is all copy becomes empty, a null
    text stays null. Rows with equal id and text count as one row and change alike. ``removed``
    names a column to add for the number of lines removed. Rows come back in any order.
    """
    # a key for (id, text): repeated rows share it and are treated alike
    key = unused("doc_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id).cast("long"), F.col(text)))
    runs = repeated_runs(
        keyed.filter(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(key).alias("doc"), F.col(text).cast("string").alias("text")),
        min_words,
    )
    cuts = runs.groupBy(F.col("doc").alias(key)).agg(F.collect_set(F.struct("line", "length")).alias(unused("cuts", docs.columns)))
    joined = keyed.join(cuts, key, "left").drop(key)
    out = docs.withColumn(removed, F.lit(0).cast("long")) if removed else docs
    position, names = docs.columns.index(text), out.columns

    def run(batches):
        for batch in batches:
            cut_rows = batch.column(batch.num_columns - 1)
            texts, counts = batch.column(position), np.zeros(batch.num_rows, np.int64)
            changed = np.flatnonzero(cut_rows.is_valid().to_numpy(zero_copy_only=False)).tolist()
            if changed:
                values = texts.to_pylist()
                for i in changed:
                    parts = values[i].split("\n")
                    worded = [j for j, part in enumerate(parts) if part.strip(" \t\n\x0b\x0c\r")]
                    gone = {worded[j] for c in cut_rows[i].as_py() for j in range(c["line"], c["line"] + c["length"])}
                    values[i] = "\n".join(part for j, part in enumerate(parts) if j not in gone)
                    counts[i] = len(gone)
                texts = pa.array(values, texts.type)
            columns = [*batch.columns[:position], texts, *batch.columns[position + 1 : -1]]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(counts)] if removed else [])], names=names)

    ship_package(joined.sparkSession)
    return joined.mapInArrow(released(run), out.schema)
