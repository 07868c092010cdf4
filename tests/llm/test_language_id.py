"""Language identification: sums over segmentations by enumeration, and held-out accuracy."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hazardflow.llm import language_id, merge_replay
from hazardflow.llm.store import crc_fold


@pytest.fixture(scope="module")
def tokens():
    return merge_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def segmentations(word, pieces):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield (word[:n], *rest)


def test_forward_sums_all_segmentations():
    vocabulary = [b"ab", b"abc", b"ca", b"bca", b" a", b" ab"]
    pieces = language_id.Pieces(vocabulary)
    kept = sorted({*vocabulary} | {bytes([b]) for b in range(256)})
    rnd = np.random.default_rng(1)
    p = rnd.dirichlet(np.ones(len(kept)), 2).T
    words = [b"abcab", b"c", b"abcabcabca", b"zz"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts, spaced = ends - [len(w) for w in words], np.array([1, 1, 0, 1])
    got = language_id.word_scores(pieces, np.log(p), data, starts, ends, spaced)
    weights = np.array([[1, 0], [2, 1], [0, 3], [1, 1]], float)
    counts = language_id.expected_counts(pieces, data, starts, ends, spaced, weights)
    want = np.zeros_like(counts)
    prior = 256 / len(kept)
    for i, word in enumerate(words):
        whole = (b" " if spaced[i] else b"") + word
        ways = list(segmentations(whole, set(kept)))
        for language in range(2):
            total = sum(math.prod(p[kept.index(x), language] for x in way) for way in ways)
            assert got[i, language] == pytest.approx(math.log(total))
        mass = sum(prior ** len(way) for way in ways)
        for way in ways:
            for x in way:
                want[kept.index(x)] += weights[i] * prior ** len(way) / mass
    assert counts == pytest.approx(want)


def plain_log_sum(word, p, longest):
    """Log of the sum over all segmentations of ``word``: one byte after another, rescaled as it goes."""
    ahead, scale = [1.0] + [0.0] * longest, 0.0
    for at in range(len(word)):
        here = ahead.pop(0)
        scale += math.log(here)
        ahead = [x / here for x in ahead] + [0.0]
        for size in range(1, min(longest, len(word) - at) + 1):
            ahead[size - 1] += p.get(word[at : at + size], 0.0)
    return scale + math.log(ahead[0])


def small_model(seed, columns=2):
    rnd = np.random.default_rng(seed)
    vocabulary = [b"ab", b"abc", b"ca", b"bca", b" a", b"abcabcabcabcabcabcabcabcabcabcabcabcabc", b"\xc3\xa9", b"\xa9\xc3"]
    kept = sorted({*vocabulary} | {bytes([b]) for b in range(256)})
    return language_id.Pieces(vocabulary), kept, rnd.dirichlet(np.ones(len(kept)), columns).T


@pytest.mark.parametrize("lockstep,window", [(1 << 18, 1 << 15), (200, 64), (1, 7)])
def test_long_runs_are_summed_whole(monkeypatch, lockstep, window):
    """A run of 5,000 characters without a space and others, of several lengths, in one group or many."""
    monkeypatch.setattr(language_id, "LOCKSTEP", lockstep)
    monkeypatch.setattr(language_id, "WINDOW", window)
    pieces, kept, p = small_model(2)
    rnd = np.random.default_rng(3)
    words = ["".join(rnd.choice(list("abcé"), n)).encode() for n in (5000, 49, 50, 77, 300, 20, 1)] + [b"abc" * 40, b"x" * 48, b"x" * 47]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts, spaced = ends - [len(w) for w in words], np.arange(len(words)) % 2
    got = language_id.word_scores(pieces, np.log(p), data, starts, ends, spaced)
    for i, word in enumerate(words):
        for language in range(2):
            table = dict(zip(kept, p[:, language]))
            assert got[i, language] == pytest.approx(plain_log_sum(b" " * int(spaced[i]) + word, table, pieces.longest), rel=1e-9)


def test_long_runs_are_counted_like_short_ones(monkeypatch):
    pieces, kept, _ = small_model(4)
    rnd = np.random.default_rng(5)
    words = ["".join(rnd.choice(list("abcé"), n)).encode() for n in (44, 47, 33, 21, 40, 3)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts, spaced = ends - [len(w) for w in words], np.ones(len(words), int)
    weights = rnd.integers(0, 4, (len(words), 2)).astype(float)
    short = language_id.expected_counts(pieces, data, starts, ends, spaced, weights)
    monkeypatch.setattr(language_id, "SHORT", 10)
    monkeypatch.setattr(language_id, "WINDOW", 40)
    assert language_id.expected_counts(pieces, data, starts, ends, spaced, weights) == pytest.approx(short, abs=1e-9)
    # a run whose probability no double holds: every byte is in one piece
    far = language_id.expected_counts(pieces, np.full(20_000, 0x61, np.uint8), np.array([0]), np.array([20_000]), np.array([0]), np.ones((1, 1)))
    assert sum(n * len(piece) for n, piece in zip(far[:, 0], kept)) == pytest.approx(20_000, rel=1e-6)


def test_margin_tells_a_language_that_was_not_learned(spark, sf, tokens):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(crc_fold(F.col("doc_id"), 4) != 2), tokens)
    strange = spark.createDataFrame([
        (1, "Это русский текст о погоде и природе, которого модель никогда не видела. " * 3),
        (2, "这是一段中文文本，模型从未见过这种语言，因此不应被识别为任何已学语言。" * 3), (3, "qzx vkj wqp zzxkq jjqv kxzw " * 9), (4, "12 34")], "doc_id long, text string")
    found = {r.doc_id: r for r in language_id.predict(strange, model, margin=True).collect()}
    assert all(found[i].margin < -math.log(1000) for i in (1, 2, 3)), found
    assert found[4].margin == 0 and found[4].lang_pred == "und"
    assert all(r.margin >= 0 for r in language_id.predict(docs, model, margin=True).collect())


def test_kept_columns(corpus, tokens):
    model = language_id.fit(corpus, tokens)
    renamed = corpus.withColumnRenamed("n", "lettered").withColumnRenamed("root", "k0").withColumnRenamed("piece", "a b`".strip("`"))
    got = language_id.predict(renamed, model, keep=("lettered", "k0", "text", "a b"))
    assert got.columns == ["doc_id", "lang_pred", "score", "lettered", "k0", "text", "a b"]
    assert {(r.lettered, r.k0, r["a b"]) for r in got.collect()} == {(1, 2, 3)}
    with pytest.raises(ValueError):
        language_id.predict(corpus, model, keep=("score",))
    with pytest.raises(ValueError):
        language_id.predict(corpus, None, keep=("lang", "lang"))


def test_held_out_accuracy(spark, sf, tokens):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    held = crc_fold(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.filter(~held), tokens)
    rows = language_id.predict(docs.filter(held), model, keep=("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark, corpus, tokens):
    model = language_id.fit(corpus, tokens)
    rows = language_id.predict(corpus, model).collect()
    texts = [(r.doc_id, r.text) for r in corpus.collect()]
    assert len(rows) == len(texts)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {i for i, t in texts if not any(c.isalpha() for c in t or "")}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows} <= {"en", "fr", "und"}


def test_nothing_to_learn_from(spark, corpus, tokens):
    nothing = corpus.filter("false")
    assert language_id.fit(nothing, tokens) is None
    assert {r.lang_pred for r in language_id.predict(corpus, None).collect()} == {"und"}
    assert language_id.predict(nothing, language_id.fit(corpus, tokens)).collect() == []
