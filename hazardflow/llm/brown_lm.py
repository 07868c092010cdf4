"""Class-based n-gram scoring in the manner of Brown clusters.

log10 P(word | previous) = log10 T(class | previous class) + log10 E(word | class)

Classes come from exchange clustering: in each round every item moves to the class under which its
left and right neighbours are likeliest, given the class transitions of the round before. Items of the
first rounds are the ``WORD_ITEMS`` most frequent words, which settle the classes and their
transitions, and the endings of all others hashed into ``ENDING_ITEMS`` groups. Then every other training
word, however many there are, starts from the class of its ending and is exchanged by its own
neighbours; these words and their classes stay a table in Spark. An ending decides only for words that
never occurred in training.

Emissions use the exact count of every training word: E = (c + 0.1) / (n + 0.1 (v + 1)) with the n
tokens and v distinct words of the class. Counts and classes of frequent words are broadcast up to a
fixed number of entries; those of all others reach their documents by a join.

Passes over the corpus: one counts words (summed over each task first), one writes each text as item
numbers, its known part of the score and the hashes of its rare words; the rounds read the item
numbers, and the texts as classes, written once, give the transitions and the scores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import chunks, crc_fold, map_arrow, stored, text_bytes
from hazardflow.llm.words import LOWER, U, hash_spans, mix, spans

#: Classes; the end of a text and its beginning have one of their own besides.
CLASSES = 48
WORD_ITEMS, ENDING_ITEMS = 12_000, 4_000
ROUNDS = 6
#: Entries of the broadcast table of word counts: 12 bytes each.
BROADCAST_WORDS = 400_000
#: Distinct words a task counts before it passes them on.
HELD_WORDS = 1_500_000
ALPHA = 0.1
#: Weight of the class's own frequency in a transition, in tokens.
BACKOFF = 5.0
ITEMS = WORD_ITEMS + ENDING_ITEMS
#: Added to the class of a word that is still to be looked up.
RARE = 64
#: Item of the end of a text, which also stands before its first word.
END = ITEMS


def _batch_words(column):
    """Row, hash and ending group of each word."""
    data, offsets = text_bytes(column)
    row, starts, ends = spans(data, offsets)
    low = LOWER[data]
    last = low[ends - 1].astype(U)
    before = np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(U)
    ending = (mix(last << U(8) | before) % U(ENDING_ITEMS)).astype(np.int64)
    return row, hash_spans(data, starts, ends).view(np.int64), ending


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Distinct words with their ending groups and summed counts."""
    word, ending, n = (np.concatenate(x) for x in zip(*parts))
    found, first, inverse = np.unique(word, return_index=True, return_inverse=True)
    return found, ending[first], np.bincount(inverse, n, len(found)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n): hash, ending group and number of occurrences of every word of the texts."""
    schema = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("n", pa.int64())])

    def run(batches):
        parts, size = [], 0
        for batch in chunks(batches):
            _, word, ending = _batch_words(batch.column("text"))
            parts.append((word, ending, np.ones(len(word))))
            size += len(word)
            if size > HELD_WORDS:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                if 2 * size > HELD_WORDS:
                    yield parts[0]
                    parts, size = [], 0
        if parts:
            yield _merged(parts)

    return map_arrow(docs.select("text"), run, schema).groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, ending groups and counts of the words above the least count that leaves at most ``most``.

    The counts' histogram decides, so words are never sorted; words of equal count go together.
    """
    histogram = counts.groupBy("n").agg(F.count("*").alias("words")).sort(F.desc("n"))
    total, least = 0, None
    for row in histogram.limit(most).collect():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    found = counts.filter(F.col("n") >= least) if least is not None else counts.limit(0)
    found = found.toArrow()
    word, ending, n = (found.column(name).to_numpy() for name in ("word", "ending", "n"))
    order = np.argsort(word)
    return word[order], ending[order], n[order]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of numbers as binaries, which pass between Spark and Arrow in one piece; ``ends`` counts numbers."""
    offsets = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all rows, and the offsets of the rows."""
    data, offsets = text_bytes(column)
    return data.view(kind), offsets // np.dtype(kind).itemsize


def item_rows(docs: DataFrame, words: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(doc_id, held_out, items, places, known, n_known, rare) of every row.

    ``words`` are the hashes of the frequent words, sorted by falling count. ``items`` are the item numbers
    of the words in text order, packed; ``places`` those of words that are no item of their own in ``words``,
    packed, -1 where they are not in it. The hashes of the latter are ``rare``. ``known`` is the sum of
    log10(c + ALPHA) of the frequent words.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("items", pa.binary()), ("places", pa.binary()),
                        ("known", pa.float64()), ("n_known", pa.int64()), ("rare", pa.list_(pa.int64()))])
    order = np.argsort(words)
    given = docs.sparkSession.sparkContext.broadcast((words[order], order.astype(np.int32), np.log10(counts + ALPHA)))

    def run(batches):
        words, places, logs = given.value
        for batch in chunks(batches):
            n = batch.num_rows
            row, word, ending = _batch_words(batch.column("text"))
            place = _lookup(words, places, word, -1)
            has = place >= 0
            other = ~has | (place >= WORD_ITEMS)
            item = np.where(other, WORD_ITEMS + ending, place).astype(np.int16)

            def ends(of):
                return np.cumsum(np.bincount(row[of], minlength=n))

            rare = np.concatenate([[0], ends(~has)]).astype(np.int32)
            yield [batch.column("doc_id"), batch.column("held_out"), _packed(item, ends(slice(None))),
                   _packed(place[other].astype(np.int32), ends(other)), np.bincount(row[has], logs[place[has]], n),
                   np.bincount(row[has], minlength=n), pa.ListArray.from_arrays(rare, pa.array(word[~has]))]

    return map_arrow(docs, run, schema)


def _tokens(column: pa.Array, kind, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of each token of packed lists, ``end`` after each row."""
    values, offsets = _unpacked(column, kind)
    n = len(column)
    row = np.repeat(np.arange(n), np.diff(offsets) + 1)
    out = np.full(len(row), end, np.int64)
    inside = np.ones(len(row), bool)
    inside[offsets[1:] + np.arange(n)] = False
    out[inside] = values
    return row, out


def _before(classes: np.ndarray) -> np.ndarray:
    """The class before each token; the first row begins after an end too."""
    before = np.roll(classes, 1)
    if len(before):
        before[0] = CLASSES
    return before


def contexts(rows: DataFrame, classes: np.ndarray, width: int) -> np.ndarray:
    """Counts [side, item, class] of the classes left (0) and right (1) of each item.

    Tasks sum densely over items x classes, which has a fixed size, and Spark adds up.
    """
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])
    given = rows.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        size = (ITEMS + 1) * width
        left, right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                _, item = _tokens(batch.column("items").slice(begin, 500), np.int16, END)
                own = given.value[item]
                left += np.bincount(item * width + _before(own), minlength=size)
                previous = np.roll(item, 1)
                if len(item):
                    previous[0] = END
                right += np.bincount(previous * width + own, minlength=size)
        both = np.concatenate([left, right])
        cell = np.flatnonzero(both)
        yield [cell, both[cell]]

    summed = map_arrow(rows.select("items"), run, schema).groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(2 * (ITEMS + 1) * width)
    for part in summed.toArrow().to_batches():  # at most 2 x items x classes
        total[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return total.reshape(2, ITEMS + 1, width)


def transitions(counts: np.ndarray) -> np.ndarray:
    """P(class | class before) from pair counts [before, class], backed off to class frequency."""
    share = (counts.sum(0) + ALPHA) / (counts.sum() + ALPHA * counts.shape[1])
    return (counts + BACKOFF * share) / (counts.sum(1, keepdims=True) + BACKOFF)


def exchange(left: np.ndarray, right: np.ndarray, log_t: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Class under which the neighbours of each item and the item itself are likeliest; of ones equal to six decimals the first.

    ``left`` and ``right`` are counts [item, class] of the classes beside the items, ``size`` the tokens of
    each class and ``own`` the items' classes, of whose sizes they are part already.
    """
    mass = left.sum(1)[:, None]
    room = np.maximum(size[None, :] + mass * (own[:, None] != np.arange(CLASSES)), 1.0)
    return np.round(left @ log_t[:, :CLASSES] + right @ log_t[:CLASSES].T - mass * np.log(room), 6).argmax(1)


def cluster(rows: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each item, pair counts of the classes) by exchange over the training rows."""
    width = CLASSES + 1
    classes = np.append(mix(np.arange(ITEMS, dtype=U)) % U(CLASSES), U(CLASSES)).astype(np.int64)
    for step in range(rounds + 1):
        left, right = contexts(rows, classes, width)
        pairs = np.zeros((width, width))
        np.add.at(pairs, classes, right)
        if step == rounds:
            return classes, pairs
        best = exchange(left[:ITEMS], right[:ITEMS], np.log(transitions(pairs)), pairs.sum(0)[:CLASSES], classes[:ITEMS])
        # all items move at once: every second one stays in the first rounds, so that classes do not swap
        moves = (np.arange(ITEMS) + step) % 2 == 0 if 0 < step < rounds - 1 else np.ones(ITEMS, bool)
        moves &= left[:ITEMS].sum(1) > 0
        classes[:ITEMS][moves] = best[moves]


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Distinct (word, cell) with summed counts."""
    word, cell, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((cell, word))
    word, cell, n = word[order], cell[order], n[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (cell[1:] != cell[:-1])
    first = np.flatnonzero(new)
    return word[first], cell[first], np.add.reduceat(n, first) if len(first) else n


def other_classes(rows: DataFrame, words: np.ndarray, classes: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(word, class, n): the class that exchange gives each training word that is no item of its own.

    Such a word starts in the class of its ending group. Counts of the classes beside it are summed over
    each task, which passes on one row a word; then the rows of a word come one after another, and
    its counts are added up in one vector of fixed size. The transitions and sizes of the classes are
    all that is broadcast beside the frequent words.
    """
    width = CLASSES + 1
    context = rows.sparkSession.sparkContext
    given, model = context.broadcast((words, classes)), context.broadcast((np.log(transitions(pairs)), pairs.sum(0)[:CLASSES]))
    # cells are side x class of the neighbour; a packed number is cell + 2 x width x count
    schema = pa.schema([("word", pa.int64()), ("start", pa.int8()), ("cells", pa.binary())])

    def beside(batches):
        words, classes = given.value
        parts, size = [], 0

        def columns(part):
            word, cell, n = part
            new = np.ones(len(word), bool)
            new[1:] = word[1:] != word[:-1]
            first = np.flatnonzero(new)
            packed = cell % (2 * width) + 2 * width * n
            return [word[first], (cell[first] // (2 * width)).astype(np.int8), _packed(packed, np.append(first[1:], len(word)))]

        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                _, item = _tokens(part.column("items"), np.int16, END)
                own = classes[item]
                other = np.flatnonzero((item >= WORD_ITEMS) & (item != END))
                if not len(other):
                    continue
                place, _ = _unpacked(part.column("places"), np.int32)
                word = np.empty(len(other), np.int64)
                word[place >= 0] = words[place[place >= 0]]
                word[place < 0] = part.column("rare").flatten().to_numpy()
                start = own[other] * 2 * width
                cells = np.concatenate([start + _before(own)[other], start + width + own[other + 1]])
                parts.append((np.tile(word, 2), cells, np.ones(len(cells), np.int64)))
                size += len(cells)
                if size > 2 * HELD_WORDS:
                    parts = [_summed(parts)]
                    size = len(parts[0][0])
                    if size > HELD_WORDS:
                        yield columns(parts[0])
                        parts, size = [], 0
        if parts:
            yield columns(_summed(parts))

    dealt = map_arrow(rows.select("items", "places", "rare"), beside, schema).repartition("word").sortWithinPartitions("word")
    found = pa.schema([("word", pa.int64()), ("class", pa.int32()), ("n", pa.int64())])

    def chosen(batches):
        log_t, size = model.value

        def columns(word, start, both):
            left, right = both[:, :width], both[:, width:]
            return [word, exchange(left, right, log_t, size, start), left.sum(1).astype(np.int64)]

        last = None  # word, start and counts of the word that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            word, start = batch.column("word").to_numpy(), batch.column("start").to_numpy().astype(np.int64)
            packed, offsets = _unpacked(batch.column("cells"), np.int64)
            new = np.ones(len(word), bool)
            new[1:] = word[1:] != word[:-1]
            number = np.cumsum(new) - 1
            cell = np.repeat(number, np.diff(offsets)) * 2 * width + packed % (2 * width)
            both = np.bincount(cell, packed // (2 * width), (number[-1] + 1) * 2 * width).reshape(-1, 2 * width)
            word, start = word[new], start[new]
            if last is not None:
                if last[0][0] == word[0]:
                    both[0] += last[2][0]
                else:
                    yield columns(*last)
            yield columns(word[:-1], start[:-1], both[:-1])
            last = word[-1:], start[-1:], both[-1:].copy()
        if last is not None:
            yield columns(*last)

    return map_arrow(dealt, chosen, found)


def class_rows(rows: DataFrame, others: DataFrame, classes: np.ndarray, frequent: np.ndarray) -> DataFrame:
    """(doc_id, held_out, classes, log_counts, n_known): packed classes of the words in order, sum of log10(c + ALPHA), words with c > 0.

    ``classes`` are those of the items, ``frequent`` those of the frequent words. Rare words get theirs and
    their counts by a join with ``others`` on the distinct rare words of a text; one that never occurred in
    training has the class of its ending.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("classes", pa.binary()), ("log_counts", pa.float64()),
                        ("n_known", pa.int64()), ("rare", pa.list_(pa.int64()))])
    given = rows.sparkSession.sparkContext.broadcast((classes.astype(np.int8), frequent.astype(np.int8)))

    def marked(batches):
        classes, frequent = given.value
        for batch in batches:
            item, offsets = _unpacked(batch.column("items"), np.int16)
            place, _ = _unpacked(batch.column("places"), np.int32)
            own = classes[item]
            kinds = own[item >= WORD_ITEMS]
            own[item >= WORD_ITEMS] = np.where(place >= 0, frequent[place], kinds + RARE) if len(frequent) else kinds + RARE
            yield [batch.column("doc_id"), batch.column("held_out"), _packed(own, offsets[1:]), batch.column("known"), batch.column("n_known"), batch.column("rare")]

    rows = map_arrow(rows, marked, schema).withColumn("row", F.xxhash64("rare"))  # rows of equal rare words share their lookup
    rare = rows.select("row", "rare").filter(F.size("rare") > 0).dropDuplicates(["row"])
    met = rare.select("row", F.explode(F.array_distinct("rare")).alias("word")).join(others, "word")
    met = stored(met.groupBy("row").agg(F.collect_list(F.struct("word", "class", "n")).alias("met")), "met", "zstd")

    def resolved(batches):
        for batch in batches:
            own, offsets = _unpacked(batch.column("classes"), np.int8)
            own = own.copy()
            log_counts, n_known = batch.column("log_counts").to_numpy().copy(), batch.column("n_known").to_numpy().copy()
            for i in np.flatnonzero(pc.list_value_length(batch.column("rare")).to_numpy()):
                places = offsets[i] + np.flatnonzero(own[offsets[i] : offsets[i + 1]] >= RARE)
                own[places] -= RARE
                word = batch.column("rare")[i].values.to_numpy()
                found = batch.column("met")[i].values
                count = np.zeros(len(word))
                if found is not None:
                    keys, kind, n = (found.field(k).to_numpy() for k in range(3))
                    order = np.argsort(keys)
                    at = _lookup(keys[order], order, word, -1)
                    has = at >= 0
                    own[places[has]] = kind[at[has]]
                    count[has] = n[at[has]]
                log_counts[i] += np.log10(count + ALPHA).sum()
                n_known[i] += (count > 0).sum()
            yield [batch.column("doc_id"), batch.column("held_out"), _packed(own, offsets[1:]), log_counts, n_known]

    return map_arrow(rows.join(met, "row", "left").drop("row"), resolved, pa.schema(list(schema)[:5]))


def class_pairs(rows: DataFrame) -> np.ndarray:
    """Counts [class before, class] over the tokens of the rows."""
    width = CLASSES + 1
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            _, own = _tokens(batch.column("classes"), np.int8, CLASSES)
            total += np.bincount(_before(own) * width + own, minlength=width * width)
        yield [np.arange(width * width), total]

    pairs = np.zeros(width * width)
    for cell, n in map_arrow(rows.select("classes"), run, schema).groupBy("cell").agg(F.sum("n")).collect():  # 49 x 49 rows
        pairs[cell] = n
    return pairs.reshape(width, width)


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out=None, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words of the whole text and one end. The model learns from the rows for which
    ``held_out`` (a boolean column expression; default crc32 of the id modulo 10 is 0) is false.
    ``base_score`` is the sum of log10 of add-0.1 unigram probabilities, ``score`` the class
    model's. A null or empty text is an end alone; null ids are in training; repeated rows count
    as often as they stand. Without any training row all counts are 0 and both scores still exist.
    Texts of any length are scored whole; an empty table gives no rows. Items of equal count are numbered
    in order of their hashes, and of equally good classes the first is taken.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    fold = crc_fold(F.col("doc_id"), 10) == 0 if held_out is None else held_out
    docs = docs.withColumn("held_out", F.when(F.col("doc_id").isNull(), False).otherwise(fold))
    spark = docs.sparkSession

    counts = stored(word_counts(docs.filter("NOT held_out")), "words")
    tokens, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    texts = docs.filter("NOT held_out").count()
    tokens, distinct = (tokens or 0) + texts, distinct + (texts > 0)
    word, _, n = _most_frequent(counts, BROADCAST_WORDS)
    top = np.lexsort((word, -n))
    word, n = word[top], n[top]
    items = min(len(word), WORD_ITEMS)
    rows = stored(item_rows(docs, word, n), "items", "zstd")
    training = rows.filter("NOT held_out")
    classes, pairs = cluster(training, rounds)
    others = stored(other_classes(training, word, classes, pairs), "classes")

    # tokens and distinct training words of each class; the end is the one word of its own class
    n_class, v_class = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    np.add.at(n_class, classes[:items], n[:items])
    np.add.at(v_class, classes[:items], 1)
    for kind, tokens_of, words_of in others.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        n_class[kind] += tokens_of
        v_class[kind] += words_of
    n_class[CLASSES], v_class[CLASSES] = texts, 1
    # the frequent words are those of the least count among them or more: at most BROADCAST_WORDS
    mid = others.filter(F.col("n") >= int(n[-1]) if len(n) else F.lit(False)).toArrow()
    keys, order = mid.column("word").to_numpy(), np.argsort(mid.column("word").to_numpy())
    frequent = np.append(classes[:items], _lookup(keys[order], mid.column("class").to_numpy()[order], word[items:], 0))
    placed = stored(class_rows(rows, others, classes, frequent), "placed", "zstd")
    log_t = np.log10(transitions(class_pairs(placed.filter("NOT held_out"))))
    log_room = np.log10(n_class + ALPHA * (v_class + 1))
    base_room = math.log10(tokens + ALPHA * (distinct + 1))
    end = math.log10(texts + ALPHA)
    given = spark.sparkContext.broadcast((log_t, log_room))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("words", pa.float64()), ("classes", pa.float64())])

    def run(batches):
        log_t, log_room = given.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                row, own = _tokens(part.column("classes"), np.int8, CLASSES)
                value = np.bincount(row, log_t[_before(own), own] - log_room[own], part.num_rows)
                yield [part.column("doc_id"), part.column("held_out"), np.bincount(row, minlength=part.num_rows),
                       part.column("n_known"), part.column("log_counts"), value]

    words = F.col("words") + F.lit(end)
    return map_arrow(placed, run, schema).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(int(texts > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(base_room)).alias("base_score"),
        (words + F.col("classes")).alias("score"),
    )
