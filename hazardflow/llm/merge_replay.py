"""Byte-level BPE by replaying the merges over a corpus of words.

A batch of texts is cut into its distinct words (matches of the pre-token pattern). All words lie in
one array of symbols with links to their neighbours, and an inverted index maps the rank of a token
pair to the positions where the pair stands. The ranks that occur are taken in order; each is applied
at all its positions in all words at once, and only the pairs at the touched neighbours are looked up
and indexed anew. Words met before in the task are not replayed again.

Merging by rank over all words equals merging word by word, always the least rank first and the
leftmost of equal ones, except where a merge makes a pair of lesser rank. Such words are noticed and
encoded one by one (``encode_word``).
"""

from __future__ import annotations

import base64
import heapq
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import chunks, map_arrow, released, ship_package

#: Memory of the words whose ids a task keeps between batches, and of one word beside its characters.
KEPT_BYTES, WORD_BYTES = 48 << 20, 200
#: Text of one replay. Larger batches repeat fewer words, smaller ones need less memory.
REPLAY_BYTES = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, each at its rank. Read on the driver and broadcast: the file is fixed."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Merges:
    """Lookup tables of a vocabulary, and the replay itself."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, regex.compile(pattern)
        self.rank = {token: i for i, token in enumerate(tokens) if token}
        self.byte = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        keys, merged = [], []
        for token, i in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1 << 62))
        self.merged = np.append(np.array(merged, np.int64)[order], -1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def encode_word(self, word: bytes) -> list[int]:
        """One word: least rank first, leftmost of equal ones."""
        symbols = [word[i : i + 1] for i in range(len(word))]
        while len(symbols) > 1:
            ranked = [(self.rank.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            least, at = min(ranked)
            if least == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [self.rank[s] for s in symbols]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of ids of each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbol = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbol)
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(n, bool)
        pair = np.full(n, -1, np.int64)
        at = np.flatnonzero(after >= 0)
        pair[at] = self.pair_ranks(symbol[at], symbol[after[at]])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray) -> None:
            ranks = pair[positions]
            positions, ranks = positions[ranks >= 0], ranks[ranks >= 0]
            if not len(positions):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for begin, end, rank in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist()):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append(positions[begin:end])

        add(at)
        odd: set[int] = set()
        while heap:
            rank = heapq.heappop(heap)
            listed = index.pop(rank)
            here = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
            here = here[alive[here] & (pair[here] == rank)]
            if not len(here):
                continue
            chained = after[here[:-1]] == here[1:]
            if chained.any():  # of overlapping pairs the leftmost goes first
                place = np.arange(len(here))
                start = np.maximum.accumulate(np.where(np.append(False, chained), 0, place))
                here = here[(place - start) % 2 == 0]
            gone = after[here]
            beyond = after[gone]
            symbol[here] = rank
            alive[gone] = False
            pair[gone] = -1
            after[here] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = here[inner]
            left = before[here]
            touched = np.concatenate([left[left >= 0], here])
            if len(touched) > 1:
                touched = np.unique(touched)
            follows = after[touched]
            ranks = np.where(follows >= 0, self.pair_ranks(symbol[touched], symbol[follows]), -1)
            pair[touched] = ranks
            early = (ranks >= 0) & (ranks < rank)
            if early.any():
                odd.update(owner[touched[early]].tolist())
            add(touched)

        counts = np.bincount(owner[alive], minlength=len(words))
        ids = symbol[alive]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for word in odd:
                parts[word] = np.array(self.encode_word(words[word]), np.int64)
                counts[word] = len(parts[word])
            ids = np.concatenate(parts)
        return ids.astype(np.int32), counts


class _Codes(dict):
    """Numbers words in the order they are first seen."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return len(self) - 1


class Encoder:
    """Encodes batches of texts; keeps the ids of words between batches."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.forget()

    def forget(self) -> None:
        self.codes, self.ids, self.bytes = _Codes(), np.zeros(0, np.int32), 0
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of the texts."""
        if self.bytes > KEPT_BYTES:
            self.forget()
        code, known = self.codes.__getitem__, len(self.codes)
        used, pieces = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text and len(text) > REPLAY_BYTES:  # its words are not listed first
                found = np.fromiter((code(m[0]) for m in self.merges.pattern.finditer(text)), np.int64)
            else:
                words = self.merges.pattern.findall(text or "")
                found = np.fromiter(map(code, words), np.int64, len(words))
            pieces[i] = len(found)
            used.append(found)
        if len(self.codes) > known:
            fresh = [word.encode() for word in islice(self.codes, known, None)]
            ids, counts = self.merges.replay(fresh)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.bytes += sum(map(len, fresh)) + WORD_BYTES * len(fresh)
        used = np.concatenate(used) if used else np.zeros(0, np.int64)
        counts = self.counts[used]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        shift = self.starts[used] - (ends - counts)
        ids = self.ids[np.repeat(shift, counts) + np.arange(total)]
        bounds = np.concatenate([[0], np.cumsum(pieces)])
        return ids, np.concatenate([[0], ends])[bounds]


class Decoder:
    """Bytes of ids, for many rows at once."""

    def __init__(self, tokens: list[bytes]):
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The bytes of each row; an id outside the vocabulary raises."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.sizes):
            raise IndexError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.data[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = pa.py_buffer(ends[offsets].astype(np.int64).tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, bounds, pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _listed(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids))


def encode(
    docs: DataFrame, tokens: list[bytes], pattern: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False,
) -> DataFrame:
    """(doc_id, ids) of every row: the token ids of the whole text, no special tokens.

    Each match of ``pattern`` is encoded by itself. With ``decoded`` a third column of that name holds the
    bytes that the ids decode to, as ``decode`` gives them, made in the same pass. A null or empty text
    has no ids; a null or repeated id is passed on; other columns are not looked at; an empty table
    gives none. One pass without a shuffle. A task holds about ``REPLAY_BYTES`` of text, or one
    longer text, and words of at most ``KEPT_BYTES`` and one such batch.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), *([("decoded", pa.binary())] if decoded else [])])
    given = docs.sparkSession.sparkContext.broadcast((tokens, pattern))

    def run(batches):
        encoder, decoder = Encoder(Merges(*given.value)), Decoder(given.value[0]) if decoded else None
        for batch in chunks(batches, limit=REPLAY_BYTES):
            ids, offsets = encoder.encode(batch.column("text").to_pylist())
            yield [batch.column("doc_id"), _listed(ids, offsets), *([decoder.decode(ids, offsets)] if decoded else [])]

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, schema)


def decode(encoded: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``out``, which replaces one of that name.

    Null ids give no bytes, an id outside the vocabulary raises. The bytes are UTF-8 where the ids came
    from a text. Memory follows the batch, or the longest row.
    """
    kept = encoded.drop(out)
    given = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        decoder = Decoder(given.value)
        for batch in batches:
            found = batch.column(batch.schema.get_field_index(ids))
            offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            values = decoder.decode(found.flatten().to_numpy(zero_copy_only=False), offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, out])

    ship_package(kept.sparkSession)
    return kept.mapInArrow(released(run), kept.withColumn(out, F.lit(None).cast("binary")).schema)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows, and ``more`` of their columns."""
    return encoded.select(
        "doc_id", *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
