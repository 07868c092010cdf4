"""Class-based scores: base sums by plain Python, and better held-out scores than the base."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hazardflow.llm import brown_lm


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def check(rows, given):
    training = Counter(t for i, text in given if not held_out(i) for t in tokens(text))
    total, distinct = sum(training.values()), len(training)
    want = []
    for i, text in given:
        own = tokens(text)
        base = sum(math.log10((training[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        want.append((-1 if i is None else i, held_out(i), len(own), sum(training[t] > 0 for t in own), total, base))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_awkward_rows(corpus):
    rows = brown_lm.score(corpus).collect()
    check(rows, [(r.doc_id, r.text) for r in corpus.collect()])
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_rare_words_come_by_join(corpus, monkeypatch):
    one = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in brown_lm.score(corpus).collect()}
    monkeypatch.setattr(brown_lm, "BROADCAST_WORDS", 40)
    for r in brown_lm.score(corpus).collect():
        known, base = one[r.doc_id, r.n_tokens]
        assert r.n_known == known and r.base_score == pytest.approx(base)


def test_held_out_texts_score_better_than_the_base(spark):
    rows = brown_lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    import numpy as np

    pairs = np.random.default_rng(1).integers(0, 50, (5, 5)).astype(float)
    assert brown_lm.transitions(pairs).sum(1) == pytest.approx(np.ones(5))


def test_empty_and_all_held_out(spark):
    assert brown_lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    held = [i for i in range(200) if held_out(i)][:3]
    frame = spark.createDataFrame([(i, "a b c") for i in held], "doc_id long, text string")
    rows = brown_lm.score(frame).collect()
    assert [(r.train_tokens, r.n_known, r.n_tokens) for r in rows] == [(0, 0, 4)] * 3
    assert all(math.isfinite(r.score) for r in rows)


def plain_scores(given, word_items, endings, frequent):
    """The model by plain loops over all tokens: {(id, text): log10 probability}."""
    classes_n, end = brown_lm.CLASSES, brown_lm.CLASSES

    def number(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(brown_lm.hash_spans(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])

    def spread(x):
        return int(brown_lm.mix(np.array([x], np.uint64))[0])

    def ending(word):
        data = word.encode()
        return "ending", spread(data[-1] << 8 | (data[-2] if len(data) > 1 else 0)) % endings

    training = [tokens(text)[:-1] for i, text in given if not held_out(i)]
    count = Counter(w for text in training for w in text)
    ranked = sorted(count, key=lambda w: (-count[w], number(w)))
    items = {w: w if k < min(word_items, frequent) else ending(w) for k, w in enumerate(ranked)}
    place = {w: k for k, w in enumerate(ranked[:word_items])} | {("ending", e): word_items + e for e in range(endings)}
    kind = {item: spread(k) % classes_n for item, k in place.items()}

    def model(own):
        pairs = np.zeros((classes_n + 1, classes_n + 1))
        left, right = defaultdict(lambda: np.zeros(classes_n + 1)), defaultdict(lambda: np.zeros(classes_n + 1))
        for text in training:
            at = [end, *map(own, text), end]
            for a, b in zip(at, at[1:]):
                pairs[a, b] += 1
            for k, w in enumerate(text):
                left[w][at[k]] += 1
                right[w][at[k + 2]] += 1
        share = (pairs.sum(0) + 0.1) / (pairs.sum() + 0.1 * (classes_n + 1))
        t = (pairs + 5.0 * share) / (pairs.sum(1)[:, None] + 5.0)
        return pairs, left, right, t

    def best(left, right, now, pairs, t):
        gains, mass = [], left.sum()
        for k in range(classes_n):
            gain = sum(left[c] * math.log(t[c, k]) + right[c] * math.log(t[k, c]) for c in range(classes_n + 1))
            gains.append(round(gain - mass * math.log(max(pairs[:, k].sum() + mass * (k != now), 1.0)), 6))
        return gains.index(max(gains))

    for step in range(brown_lm.ROUNDS):
        pairs, left, right, t = model(lambda w: kind[items[w]])
        sums = defaultdict(lambda: [0, 0])
        for w in count:
            sums[items[w]][0] += left[w]
            sums[items[w]][1] += right[w]
        moved = {item: best(*sums[item], kind[item], pairs, t) for item in sums
                 if not 0 < step < brown_lm.ROUNDS - 1 or (place[item] + step) % 2 == 0}
        kind |= moved
    pairs, left, right, t = model(lambda w: kind[items[w]])
    final = {w: kind[w] if items[w] == w else best(left[w], right[w], kind[items[w]], pairs, t) for w in count}
    t = model(lambda w: final[w])[3]
    n, v = Counter(), Counter()
    for w, k in final.items():
        n[k] += count[w]
        v[k] += 1
    n[end], v[end] = len(training), 1
    out = {}
    for i, text in given:
        own = tokens(text)[:-1]
        at = [end, *(final[w] if w in final else kind[ending(w)] for w in own), end]
        c = [*(count[w] for w in own), len(training)]
        out[i, len(own) + 1, text] = sum(
            math.log10(t[a, b]) + math.log10((x + 0.1) / (n[b] + 0.1 * (v[b] + 1))) for a, b, x in zip(at, at[1:], c))
    return out


@pytest.mark.parametrize("word_items, broadcast", [(40, 90), (40, 20), (5, 400_000), (1, 0)])
def test_scores_equal_plain_loops(spark, monkeypatch, word_items, broadcast):
    """Each tier: items of their own, broadcast words, joined words and words that training lacks."""
    rnd = np.random.default_rng(3)
    given = []
    for i in range(60):
        noun = [f"n{k}{'ab'[k % 2]}" for k in rnd.zipf(1.4, 12) % 60]
        verb = [f"v{k}{'cd'[k % 2]}" for k in rnd.zipf(1.4, 12) % 60]
        given.append((i, " ".join(w for pair in zip(noun, verb) for w in pair)))
    given += [(60, None), (61, "Only new words"), given[3]]
    endings = brown_lm.ENDING_ITEMS
    for name, value in (("WORD_ITEMS", word_items), ("ITEMS", word_items + endings), ("END", word_items + endings), ("BROADCAST_WORDS", broadcast)):
        monkeypatch.setattr(brown_lm, name, value)
    rows = brown_lm.score(spark.createDataFrame(given, "doc_id long, text string")).collect()
    texts = dict(given)
    frequent = len(brown_lm._most_frequent(brown_lm.word_counts(
        spark.createDataFrame([g for g in given if not held_out(g[0])], "doc_id long, text string")), broadcast)[0])
    want = plain_scores(given, word_items, endings, frequent)
    assert len(rows) == len(given)
    for r in rows:
        assert r.score == pytest.approx(want[r.doc_id, r.n_tokens, texts[r.doc_id]], rel=1e-9)
