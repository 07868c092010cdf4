"""Quality scores by a generalised additive model with pairwise interactions.

Each feature has a lookup table over its quantile bins, each chosen pair of features one over coarse
bins. Learning is cyclic gradient boosting: round after round every feature in turn gets a shallow
tree on its bins, fitted to the logistic gradient and shrunk, so no feature takes another's effect.
Then the pairs whose four-leaf tree would gain most are boosted in the same way. A text is scored by
adding up its bins, for many texts at once, and a logistic function.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import chunks, least_rows, map_arrow, text_bytes
from hazardflow.llm.words import SOLID, U, hash_spans, spans

#: Most labelled rows the model is fitted on, taken in hash order of their ids.
MOST_LABELLED = 40_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS = 80, 40
PAIRS = 8
RATE = 0.15
#: Least rows in a leaf, and weight of the pull of a leaf towards 0.
LEAST_ROWS, PULL = 5, 1.0

FEATURES = (
    "words", "word_bytes", "symbols", "marks", "upper", "digits", "stops", "distinct", "echoes",
    "same_lines", "line_words", "bars", "beyond_ascii", "repeats", "longest",
)


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


SYMBOLS, MARKS, STOPS, DIGITS = _flags("#*$%&|<>"), _flags("!?"), _flags(".,;:"), _flags("0123456789")
UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty text has zeros."""
    data, offsets = text_bytes(column)
    n = len(column)
    row, starts, ends = spans(data, offsets)
    word = hash_spans(data, starts, ends)
    words = np.bincount(row, minlength=n)
    per_word, sizes = np.maximum(words, 1), ends - starts

    def share(table):
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    solid = np.maximum(share(SOLID), 1)
    distinct, repeats = np.zeros(n), np.zeros(n)
    same = np.zeros(len(word), bool)
    if len(word):
        same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
        order = np.lexsort((word, row))
        new = np.ones(len(word), bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (row[order][1:] != row[order][:-1])
        distinct = np.bincount(row[order][new], minlength=n)
    if len(word) > 3:
        three = word[:-2] * U(3) + word[1:-1] * U(5) + word[2:] * U(7)
        inside = row[:-2] == row[2:]
        three, owner = three[inside], row[:-2][inside]
        order = np.lexsort((three, owner))
        again = np.zeros(len(three), bool)
        again[1:] = (three[order][1:] == three[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        repeats = np.bincount(owner[order][again], minlength=n)
    newline = np.flatnonzero(data == 10)
    line_row = np.concatenate([np.arange(n), np.searchsorted(offsets, newline, "right") - 1])
    line_start, line_end = np.concatenate([offsets[:-1], newline + 1]), np.concatenate([offsets[1:], newline])
    by_start, by_end = np.lexsort((line_start, line_row)), np.lexsort((line_end, line_row))
    line_row, line_start, line_end = line_row[by_start], line_start[by_start], line_end[by_end]
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_row, line = line_row[worded], hash_spans(data, line_start[worded], line_end[worded])
    order = np.lexsort((line, line_row))
    copy = np.zeros(len(line), bool)
    copy[1:] = (line[order][1:] == line[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    lines = np.maximum(np.bincount(line_row, minlength=n), 1)
    longest = np.zeros(n)
    np.maximum.at(longest, row, sizes)
    bar = (sizes == 1) & (data[starts] == 0x7C) if len(starts) else np.zeros(0, bool)
    out = np.column_stack([
        np.log1p(words), np.bincount(row, sizes, n) / per_word, share(SYMBOLS) / solid, share(MARKS) / solid,
        share(UPPER) / solid, share(DIGITS) / solid, share(STOPS) / solid, distinct / per_word,
        np.bincount(row, same, n) / per_word, np.bincount(line_row[order], copy, n) / lines, np.log1p(words / lines),
        np.bincount(row, bar, n) / per_word, share(np.arange(256) > 127) / solid, repeats / per_word, np.log1p(longest),
    ])
    out[words == 0] = 0
    return out


def _tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a shallow regression tree on ordered bins: at most 2^depth leaves."""
    value = np.full(len(gradient), gradient.sum() / (weight.sum() + PULL))
    if not depth or len(gradient) < 2:
        return value
    g, w, c = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1], np.cumsum(count)[:-1]
    gain = g**2 / (w + PULL) + (gradient.sum() - g) ** 2 / (weight.sum() - w + PULL)
    gain[(c < LEAST_ROWS) | (count.sum() - c < LEAST_ROWS)] = -1
    best = int(np.argmax(gain))
    if gain[best] <= gradient.sum() ** 2 / (weight.sum() + PULL) + 1e-9:
        return value
    cut = best + 1
    return np.concatenate([_tree(x[0], x[1], x[2], depth - 1) for x in (
        (gradient[:cut], weight[:cut], count[:cut]), (gradient[cut:], weight[cut:], count[cut:]))])


def _quarters(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best tree with one cut on each axis, and its gain."""
    size = len(gradient)
    pad = [np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight, count)]
    best, cells = 0.0, np.zeros_like(gradient)
    whole = gradient.sum() ** 2 / (weight.sum() + PULL)
    for i in range(1, size):
        for j in range(1, size):
            parts = []
            for a, b, c, d in ((0, i, 0, j), (0, i, j, size), (i, size, 0, j), (i, size, j, size)):
                parts.append(((a, b, c, d), *(p[b, d] - p[a, d] - p[b, c] + p[a, c] for p in pad)))
            if min(p[3] for p in parts) < LEAST_ROWS:
                continue
            gain = sum(g**2 / (w + PULL) for _, g, w, _ in parts) - whole
            if gain > best:
                best, cells = gain, np.zeros_like(gradient)
                for (a, b, c, d), g, w, _ in parts:
                    cells[a:b, c:d] = g / (w + PULL)
    return cells, best


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Model from feature rows and 0/1 labels. With one label only, or no rows, its share is the score."""
    n, width = x.shape
    rate = (y.sum() + 0.5) / (n + 1.0)
    model = {"base": float(np.log(rate / (1 - rate))), "cuts": [], "tables": [], "pair_cuts": [], "pairs": [], "pair_tables": []}
    if n == 0 or y.min() == y.max():
        return model
    score = np.full(n, model["base"])
    cuts = [_cuts(x[:, f], BINS) for f in range(width)]
    bins = [np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)]
    counts = [np.bincount(b, minlength=len(c) + 1) for b, c in zip(bins, cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]

    def residual():
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            gradient, weight = residual()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], gradient, size), np.bincount(bins[f], weight, size), counts[f])
            tables[f] += step
            score += step[bins[f]]
    coarse_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(width)]
    coarse = [np.searchsorted(coarse_cuts[f], x[:, f], "left") for f in range(width)]

    def histogram(a, b, values):
        return np.bincount(coarse[a] * PAIR_BINS + coarse[b], values, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    gradient, weight = residual()
    gains = []
    for a in range(width):
        for b in range(a + 1, width):
            _, gain = _quarters(histogram(a, b, gradient), histogram(a, b, weight), histogram(a, b, np.ones(n)))
            gains.append((-gain, a, b))
    pairs = [(a, b) for gain, a, b in sorted(gains)[:PAIRS] if gain < 0]
    pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            gradient, weight = residual()
            cells, _ = _quarters(histogram(a, b, gradient), histogram(a, b, weight), histogram(a, b, np.ones(n)))
            pair_tables[k] += RATE * cells
            score += RATE * cells[coarse[a], coarse[b]]
    return model | {"cuts": cuts, "tables": tables, "pair_cuts": coarse_cuts, "pairs": pairs, "pair_tables": pair_tables}


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["base"])
    for f, (cuts, table) in enumerate(zip(model["cuts"], model["tables"])):
        total += table[np.searchsorted(cuts, x[:, f], "left")]
    coarse = {f: np.searchsorted(model["pair_cuts"][f], x[:, f], "left") for pair in model["pairs"] for f in pair}
    for (a, b), table in zip(model["pairs"], model["pair_tables"]):
        total += table[coarse[a], coarse[b]]
    return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> dict:
    """Model from ``labels`` (doc_id, ``label`` 0 or 1) and the texts of ``docs`` (doc_id, text).

    Rows with a null id or label, and labels without a text row, are left out. Equal texts of an id count
    once. At most ``most`` labels are used, the first in hash order of their ids, and of their texts as
    many, in hash order of id and text, however often an id stands in ``docs``. Only features reach the driver.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    rows = rows.sort(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(rows), "doc_id").select("text", "label", F.xxhash64("doc_id", "text").alias("order"))
    schema = pa.schema([("label", pa.int32()), ("order", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for batch in chunks(batches):
            yield [batch.column("label"), batch.column("order"), pa.array(features(batch.column("text")).tolist(), pa.list_(pa.float64()))]

    found = map_arrow(joined, run, schema).dropDuplicates(["order", "label"])
    found = least_rows(found, most, "order", "label").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return train(x[order], y[order])


def predict(docs: DataFrame, model: dict, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row: the probability of label 1, and 1 if it reaches the threshold.

    A null or empty text has the features of an empty one. Null and repeated ids are passed on.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    given = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in chunks(batches):
            yield [batch.column("doc_id"), apply(given.value, features(batch.column("text")))]

    return map_arrow(docs, run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
