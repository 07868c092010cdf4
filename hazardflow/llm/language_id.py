"""Language identification by unigram pieces, summed over all segmentations.

Every language has probabilities over the pieces of a fixed public byte-level vocabulary. A text is
its words, each with a space before it; a word can be cut into pieces in many ways, and its
probability in a language is the sum over all of them, which a forward algorithm gives. Words are
scored together as columns of bytes, each distinct word of a task once. Long words, as in scripts
without spaces, go through the same sums in windows, however long they are. Since the vocabulary
holds every byte, every text has a probability in every language.

Learning is one expectation step: each word's pieces are counted by their posterior over all
segmentations (forward and backward) under equal piece weights, per language, then smoothed.
Counts are summed over each task and added up in Spark; the model is pieces x languages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hazardflow.llm.store import chunks, map_arrow, stored, text_bytes
from hazardflow.llm.words import LOWER, U, hash_spans, mix, spans

#: Words of more bytes are worked out in windows, together with others of their length.
SHORT = 48
#: Bytes of the long words that are worked out together, and of one window of them.
LOCKSTEP, WINDOW = 1 << 18, 1 << 15
#: Distinct words a task holds before it passes their counts on, or scores kept between batches.
HELD_WORDS = 200_000
#: Bytes of these words: many long ones count like many words.
HELD_BYTES = 32 << 20
#: Words whose segmentations are worked out together.
TOGETHER = 8_000
#: Added to every expected count.
SMOOTHING = 0.05
#: Most languages a model may have; it is broadcast.
MOST_LANGUAGES = 1_000
_STEP = U(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary as an open-addressing table from rolling hash to piece number."""

    def __init__(self, tokens: list[bytes]):
        kept = sorted({t for t in tokens if t} | {bytes([b]) for b in range(256)})
        self.n, self.longest = len(kept), max(map(len, kept))
        self.byte = mix(np.arange(1, 257, dtype=U))
        hashes = np.zeros(self.n, U)
        with np.errstate(over="ignore"):
            for i, token in enumerate(kept):
                h = U(0)
                for b in token:
                    h = h * _STEP + self.byte[b]
                hashes[i] = h
        self.bits = U(64 - 20)
        self.keys, self.numbers = np.zeros(1 << 20, U), np.full(1 << 20, -1, np.int32)
        slots = (mix(hashes) >> self.bits).tolist()
        self.probes = 1
        for i, slot in enumerate(slots):
            probe = 1
            while self.numbers[slot] >= 0:
                slot = (slot + 1) & ((1 << 20) - 1)
                probe += 1
            self.keys[slot], self.numbers[slot] = hashes[i], i
            self.probes = max(self.probes, probe)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers; ``n`` where no piece has the hash."""
        slot = (mix(hashes) >> self.bits).astype(np.int64)
        number = np.where(self.keys[slot] == hashes, self.numbers[slot], -2)
        number[self.numbers[slot] == -1] = -1
        open_ = np.flatnonzero(number == -2)
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << 20) - 1)
            at = slot[open_]
            here, key = self.numbers[at], self.keys[at]
            hit = (key == hashes[open_]) & (here >= 0)
            number[open_] = np.where(hit, here, np.where(here == -1, -1, -2))
            open_ = open_[number[open_] == -2]
        return np.where(number < 0, self.n, number)

    def grid(self, letters: np.ndarray, lengths: np.ndarray):
        """Piece numbers by (start, length - 1) for words sorted by falling length; one array per cell."""
        value = self.byte[letters]
        cells = {}
        for start in range(letters.shape[1]):
            rolled = None
            for size in range(1, min(self.longest, letters.shape[1] - start) + 1):
                live = int(np.searchsorted(-lengths, -(start + size), "right"))
                if not live:
                    break
                last = value[:live, start + size - 1]
                rolled = last if rolled is None else rolled[:live] * _STEP + last
                cells[start, size] = self.find(rolled)
        return cells

    def window(self, data, starts, lengths, spaced, at: int, wide: int) -> np.ndarray:
        """Piece numbers by (length - 1, word, start - at) for the starts from ``at`` on."""
        place = at + np.arange(wide + self.longest)
        letters = data[np.clip(starts[:, None] + place - spaced[:, None], 0, len(data) - 1)]
        if at == 0:
            letters[spaced.astype(bool), 0] = 0x20
        value = self.byte[letters]
        out = np.empty((self.longest, len(starts), wide), np.int32)
        rolled = np.zeros((len(starts), wide), U)
        for size in range(1, self.longest + 1):
            rolled = rolled * _STEP + value[:, size - 1 : size - 1 + wide]
            number = self.find(rolled.ravel()).reshape(rolled.shape)
            out[size - 1] = np.where(place[:wide] + size > lengths[:, None], self.n, number)
        return out


def _groups(lengths: np.ndarray) -> list[np.ndarray]:
    """Long words, the longest first, in groups of about ``LOCKSTEP`` bytes or one word."""
    long = np.flatnonzero(lengths > SHORT)
    long = long[np.argsort(-lengths[long], kind="stable")]
    groups, begin = [], 0
    while begin < len(long):
        many = max(1, LOCKSTEP // int(lengths[long[begin]]))
        groups.append(long[begin : begin + many])
        begin += many
    return groups


def _live(lengths: np.ndarray, beyond: int) -> int:
    """Number of words, sorted by falling length, that go beyond a position."""
    return int(np.searchsorted(-lengths, -beyond, "left"))


def _forward(pieces: Pieces, p: np.ndarray, data, starts, lengths, spaced, path: np.ndarray | None = None) -> np.ndarray:
    """Log sums over all segmentations of long words, by column of ``p``; ``path`` gets those of all beginnings.

    Of the sums up to positions ahead only those are kept that a piece can reach.
    """
    n, columns = len(starts), p.shape[1]
    reach, wide = pieces.longest, max(1, WINDOW // len(starts))
    ahead = np.zeros((reach + 1, n, columns))
    ahead[0] = 1.0
    scale = np.zeros((n, columns))
    for at in range(0, int(lengths[0]), wide):
        numbers = pieces.window(data, starts, lengths, spaced, at, wide)
        for t in range(at, min(at + wide, int(lengths[0]))):
            live = _live(lengths, t)
            here = np.maximum(ahead[0, :live], 1e-290)
            scale[:live] += np.log(here)
            if path is not None:
                path[:live, t] = scale[:live, 0]
            ahead[:-1, :live] = ahead[1:, :live] / here + p[numbers[:, :live, t - at]]
            ahead[-1, :live] = 0.0
            ended = _live(lengths, t + 1)
            if ended < live:
                scale[ended:live] += np.log(np.maximum(ahead[0, ended:live], 1e-290))
    return scale


def _long_counts(pieces: Pieces, total: np.ndarray, data, starts, lengths, spaced, weights: np.ndarray) -> None:
    """Adds the expected piece counts of long words to ``total``, as ``expected_counts`` does for short ones."""
    n, longest, reach = len(starts), int(lengths[0]), pieces.longest
    chance = np.log(256.0 / pieces.n)
    equal = np.append(np.full(pieces.n, 256.0 / pieces.n), 0.0)[:, None]
    forward = np.full((n, longest), -np.inf)
    whole = _forward(pieces, equal, data, starts, lengths, spaced, forward)[:, 0]
    backward = np.full((n, longest + reach + 1), -np.inf)
    backward[np.arange(n), lengths] = 0.0
    wide = max(1, WINDOW // n)
    for at in range((longest - 1) // wide * wide, -1, -wide):
        numbers = pieces.window(data, starts, lengths, spaced, at, wide)
        for t in range(min(at + wide, longest) - 1, at - 1, -1):
            live = _live(lengths, t)
            after = np.where(numbers[:, :live, t - at].T < pieces.n, backward[:live, t + 1 : t + 1 + reach], -np.inf)
            top = after.max(axis=1)
            backward[:live, t] = chance + top + np.log(np.exp(after - top[:, None]).sum(axis=1))
        width = min(wide, longest - at)
        for size in range(1, reach + 1):
            number = numbers[size - 1, :, :width]
            word, start = np.nonzero(number < pieces.n)
            gamma = np.exp(forward[word, at + start] + chance + backward[word, at + start + size] - whole[word])
            for language in range(weights.shape[1]):
                total[:, language] += np.bincount(number[word, start], gamma * weights[word, language], pieces.n)


def _letter_rows(data, starts, ends, spaced):
    """Padded bytes of words, the longest first, and the order that sorts them so."""
    lengths = ends - starts + spaced
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, spaced = starts[order], lengths[order], spaced[order]
    width = int(lengths[0])
    at = starts[:, None] + np.arange(width)[None, :] - spaced[:, None]
    letters = data[np.clip(at, 0, len(data) - 1)]
    letters[spaced.astype(bool), 0] = 0x20
    return letters, lengths, order


def _short(lengths: np.ndarray) -> np.ndarray:
    """Short words, the longest first."""
    short = np.flatnonzero(lengths <= SHORT)
    return short[np.argsort(-lengths[short], kind="stable")]


def word_scores(pieces: Pieces, log_p: np.ndarray, data, starts, ends, spaced) -> np.ndarray:
    """Natural log probability of each word in each language: the forward algorithm.

    ``log_p`` is pieces x languages. Values are rescaled at every position, so long words keep
    their precision.
    """
    p = np.vstack([np.exp(log_p), np.zeros((1, log_p.shape[1]))])
    out = np.zeros((len(starts), log_p.shape[1]))
    whole = ends - starts + spaced
    for group in _groups(whole):
        out[group] = _forward(pieces, p, data, starts[group], whole[group], spaced[group])
    by_length = _short(whole)
    for begin in range(0, len(by_length), TOGETHER):
        part = by_length[begin : begin + TOGETHER]
        letters, lengths, order = _letter_rows(data, starts[part], ends[part], spaced[part])
        n, width = letters.shape
        cells = pieces.grid(letters, lengths)
        reach = min(pieces.longest, width)
        ahead = [np.zeros((n, p.shape[1])) for _ in range(reach + 1)]
        ahead[0][:] = 1.0
        scale = np.zeros((n, p.shape[1]))
        for start in range(width):
            live = int(np.searchsorted(-lengths, -(start + 1), "right"))
            here = ahead[0][:live]
            top = np.maximum(here, 1e-290)
            scale[:live] += np.log(top)
            for later in ahead[1:]:
                later[:live] /= top
            for size in range(1, reach + 1):
                found = cells.get((start, size))
                if found is None:
                    break
                ahead[size][: len(found)] += p[found]
            done = ahead.pop(0)
            # words that end here keep their value: it moves along unread
            ahead.append(np.zeros_like(done))
            ended = int(np.searchsorted(-lengths, -(start + 2), "right"))
            scale[ended:live] += np.log(np.maximum(ahead[0][ended:live], 1e-290))
        out[part[order]] = scale
    return out


def expected_counts(pieces: Pieces, data, starts, ends, spaced, weights: np.ndarray) -> np.ndarray:
    """Expected piece counts (pieces x languages) of words weighted per language: forward and
    backward sums with the same weight, 256 / n, for all pieces."""
    prior = np.append(np.full(pieces.n, 256.0 / pieces.n), 0.0)
    total = np.zeros((pieces.n, weights.shape[1]))
    whole = ends - starts + spaced
    for group in _groups(whole):
        _long_counts(pieces, total, data, starts[group], whole[group], spaced[group], weights[group])
    by_length = _short(whole)
    for begin in range(0, len(by_length), TOGETHER):
        part = by_length[begin : begin + TOGETHER]
        letters, lengths, order = _letter_rows(data, starts[part], ends[part], spaced[part])
        n, width = letters.shape
        cells = pieces.grid(letters, lengths)
        chance = {key: prior[found] for key, found in cells.items()}
        forward = np.zeros((width + 1, n))
        forward[0] = 1.0
        backward = np.zeros((width + 1, n))
        backward[lengths, np.arange(n)] = 1.0
        for (start, size), value in chance.items():
            forward[start + size, : len(value)] += forward[start, : len(value)] * value
        for start, size in sorted(chance, reverse=True):
            value = chance[start, size]
            backward[start, : len(value)] += backward[start + size, : len(value)] * value
        share = 1.0 / backward[0]
        weight = weights[part[order]]
        numbers = np.concatenate(list(cells.values()))
        gamma = np.concatenate([
            forward[s, : len(v)] * v * backward[s + z, : len(v)] * share[: len(v)] for (s, z), v in chance.items()
        ])
        rows = np.concatenate([np.arange(len(v)) for v in chance.values()])
        keep = np.flatnonzero((numbers < pieces.n) & (gamma > 1e-9))
        numbers, gamma, rows = numbers[keep], gamma[keep], rows[keep]
        for language in range(weights.shape[1]):
            total[:, language] += np.bincount(numbers, gamma * weight[rows, language], pieces.n)
    return total


def _words(data, offsets):
    """Words as (row, start, end, 1 for the space before)."""
    row, starts, ends = spans(data, offsets)
    return row, starts, ends, np.ones(len(starts), np.int64)


def _distinct(data, starts, ends, spaced):
    """First place of each distinct word, its hash, and the word of each occurrence."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    hashes = hash_spans(data, starts, ends) + spaced.astype(U)
    found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return first, found, inverse


class _Held:
    """Distinct words of a task with their bytes and language weights."""

    def __init__(self, languages: int):
        self.languages = languages
        self.number: dict[int, int] = {}
        self.words: list[bytes] = []
        self.spaced: list[int] = []
        self.bytes = 0
        self.weights = np.zeros((1 << 12, languages))

    def add(self, data, starts, ends, spaced, hashes, weights) -> None:
        text, known = data.tobytes(), self.number
        at = np.empty(len(hashes), np.int64)
        for i, (h, s, e, sp) in enumerate(zip(hashes.tolist(), starts.tolist(), ends.tolist(), spaced.tolist())):
            n = known.get(h)
            if n is None:
                n = known[h] = len(self.words)
                self.words.append(text[s:e])
                self.spaced.append(sp)
                self.bytes += e - s
            at[i] = n
        if len(self.words) > len(self.weights):
            grown = np.zeros((2 * len(self.words), self.languages))
            grown[: len(self.weights)] = self.weights
            self.weights = grown
        self.weights[at] += weights

    def counts(self, pieces: Pieces) -> np.ndarray:
        data = np.frombuffer(b"".join(self.words), np.uint8)
        ends = np.cumsum([len(w) for w in self.words])
        starts = np.concatenate([[0], ends[:-1]])
        return expected_counts(pieces, data, starts, ends, np.array(self.spaced), self.weights[: len(self.words)])

    def bytes_seen(self) -> np.ndarray:
        """How often each byte stands in the words and before them."""
        times = self.weights[: len(self.words)].sum(axis=1)
        data = np.frombuffer(b"".join(self.words), np.uint8)
        seen = np.bincount(data, np.repeat(times, [len(w) for w in self.words]), 256)
        seen[0x20] += (times * np.array(self.spaced)).sum()
        return seen


def fit(docs: DataFrame, tokens: list[bytes], text: str = "text", lang: str = "lang") -> dict | None:
    """Model of the rows with text and language; None if there are none.

    ``languages`` (sorted), ``prior`` (log share of rows), ``log_p`` (pieces x languages), ``log_byte`` (of
    the bytes of all languages, half of the weight shared out evenly) and ``tokens``.
    """
    docs = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    found = sorted((r["lang"], r["n"]) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect())
    if not found:
        return None
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [name for name, _ in found]
    schema = pa.schema([("language", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])
    given = docs.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        pieces, number = Pieces(given.value), {name: i for i, name in enumerate(languages)}
        total, held, seen = np.zeros((pieces.n, len(languages))), _Held(len(languages)), np.zeros(256)
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            data = LOWER[data]
            row, starts, ends, spaced = _words(data, offsets)
            first, hashes, inverse = _distinct(data, starts, ends, spaced)
            language = np.array([number[x] for x in batch.column("lang").to_pylist()])[row]
            weights = np.bincount(inverse * len(languages) + language, minlength=len(first) * len(languages))
            held.add(data, starts[first], ends[first], spaced[first], hashes, weights.reshape(len(first), -1))
            if len(held.words) > HELD_WORDS or held.bytes > HELD_BYTES:
                total, seen = total + held.counts(pieces), seen + held.bytes_seen()
                held = _Held(len(languages))
        if held.words:
            total, seen = total + held.counts(pieces), seen + held.bytes_seen()
        piece, language = np.nonzero(total > 1e-6)
        yield [language, piece, total[piece, language]]
        yield [np.full(256, -1), np.arange(256), seen]

    summed = map_arrow(docs, run, schema).groupBy("language", "piece").agg(F.sum("n").alias("n"))
    pieces = Pieces(tokens)
    counts, seen = np.full((pieces.n, len(languages)), SMOOTHING), np.zeros(256)
    for part in stored(summed, "pieces").toArrow().to_batches():  # at most pieces x languages
        language, piece, n = (part.column(i).to_numpy() for i in range(3))
        known = language >= 0
        counts[piece[known], language[known]] += n[known]
        seen[piece[~known]] = n[~known]
    log_byte = np.log(0.5 * seen / max(seen.sum(), 1) + 0.5 / 256)
    shares = np.array([n for _, n in found], float)
    return {"languages": languages, "prior": np.log(shares / shares.sum()), "log_p": np.log(counts / counts.sum(0)), "log_byte": log_byte, "tokens": tokens}


def predict(
    docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), margin: bool = False,
) -> DataFrame:
    """(doc_id, lang_pred, score, *keep) of every row.

    ``score`` is the posterior probability of the predicted language. A null text, a text without
    a letter, and any text if the model is None get language ``und`` and score 0. Of equally
    likely languages the first in alphabetical order is taken. Null and repeated ids are passed on.
    A text of any length is scored whole; memory follows the longest text and its longest word.

    With ``margin`` a column of that name follows: the natural logarithm of how many times likelier the
    text is in its language than in none. Text in no learned language is the likelier of pieces with
    equal weights and of bytes drawn one by one as often as they are in all languages. The margin
    is 0 for ``und``. A kept column cannot have the name of one of these.
    """
    fields = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), *([("margin", pa.float64())] if margin else [])]
    names = [*(name for name, _ in fields), *keep]
    if len(set(names)) < len(names):
        raise ValueError(f"column names occur twice: {names}")
    letters = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    kept = [F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)]
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), letters.alias("lettered"), *kept)
    if model is None:
        zero = F.lit(0.0)
        out = docs.select("doc_id", F.lit("und"), zero, *([zero.alias("m")] if margin else []), *[f"k{i}" for i in range(len(keep))])
        return out.toDF(*names)
    schema = pa.schema([*fields, *to_arrow_schema(docs.drop("doc_id", "text", "lettered").schema)])
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = given.value
        pieces, called = Pieces(model["tokens"]), np.array([*model["languages"], "und"], object)
        log_p = model["log_p"]
        if margin:
            log_p = np.column_stack([log_p, np.full(pieces.n, -np.log(pieces.n))])
        known, scores = np.zeros(0, U), np.zeros((0, log_p.shape[1]))
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            data = LOWER[data]
            row, starts, ends, spaced = _words(data, offsets)
            first, hashes, inverse = _distinct(data, starts, ends, spaced)
            at = np.searchsorted(known, hashes)
            has = np.zeros(len(hashes), bool)
            has[at < len(known)] = known[at[at < len(known)]] == hashes[at < len(known)]
            value = np.zeros((len(hashes), scores.shape[1]))
            value[has] = scores[at[has]]
            new = np.flatnonzero(~has)
            if len(new):
                w = first[new]
                value[new] = word_scores(pieces, log_p, data, starts[w], ends[w], spaced[w])
            if len(known) + len(new) > HELD_WORDS:
                known, scores = hashes, value
            elif len(new):
                known, scores = np.concatenate([known, hashes[new]]), np.concatenate([scores, value[new]])
                order = np.argsort(known)
                known, scores = known[order], scores[order]
            total = np.column_stack([np.bincount(row, value[inverse, k], batch.num_rows) for k in range(log_p.shape[1])])
            likely = total[:, : len(called) - 1]
            odds = likely + model["prior"]
            best = odds.argmax(1)
            score = 1.0 / np.exp(odds - odds.max(1, keepdims=True)).sum(1)
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            if margin:
                sums = np.append(0.0, np.cumsum(model["log_byte"][data]))
                alone = np.bincount(row, sums[ends] - sums[starts] + model["log_byte"][0x20], batch.num_rows)
                over = likely[np.arange(len(best)), best] - np.maximum(total[:, -1], alone)
            yield [batch.column("doc_id"), called[np.where(lettered, best, len(called) - 1)].tolist(), np.where(lettered, score, 0.0),
                   *([np.where(lettered, over, 0.0)] if margin else []), *batch.columns[3:]]

    return map_arrow(docs, run, schema).toDF(*names)
