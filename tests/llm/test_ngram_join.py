"""The n-gram join against all pairs, on the awkward corpus and on planted chains."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hazardflow.llm import ngram_join
from hazardflow.llm.words import U


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def expected(rows, percent=80):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for (i, (a, x)), (j, (b, y)) in itertools.combinations(enumerate(sets), 2):
        if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y):
            links[i] += 1
            links[j] += 1
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((-1 if i is None else i, len(s), -1 if i is None else (find(i) if s else i), n) for (i, s), n in zip(sets, links))


def answer(frame):
    none = lambda x: -1 if x is None else x
    return sorted((none(r.doc_id), r.n_shingles, none(r.component_id), r.n_links) for r in frame.collect())


def test_awkward_rows(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    assert answer(ngram_join.near_duplicates(corpus)) == expected(rows)


def test_sizes_around_the_threshold(spark):
    """Sets of all small sizes with every number of changed words, and chains of near copies."""
    rnd = random.Random(3)
    rows = []
    for n in (1, 2, 4, 5, 8, 9, 12, 16, 24, 40, 70):
        for copy in range(5):
            base = [f"{n}x{copy % 2}y{k}" for k in range(n)]
            for _ in range(copy):
                at = rnd.choice((0, n - 1))
                base[at] = f"z{rnd.randrange(3)}"
            rows.append((len(rows), " ".join(base)))
        rows.append((len(rows), rows[-1][1] + f" more{n}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert answer(ngram_join.near_duplicates(frame)) == expected(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(empty).collect() == []
    assert ngram_join.keep_one(empty).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(corpus):
    kept = ngram_join.keep_one(corpus)
    assert kept.columns == corpus.columns
    groups = {i: c for i, _, c, _ in answer(ngram_join.near_duplicates(corpus)) if i != -1}
    ids = {r.doc_id for r in kept.collect() if r.doc_id is not None}
    assert ids == {i for i, c in groups.items() if i == c}


@pytest.mark.parametrize("near", [False, True])
def test_similar_sets_share_a_piece(near, monkeypatch):
    """The pigeonhole itself, with and without one-deletion neighbourhoods, over random sets."""
    monkeypatch.setattr(ngram_join, "band_plan", lambda band, percent: ((1 << band) // 5 + 1 if near else (1 << band) // 2 + 1, near))
    rnd = np.random.default_rng(5)
    for n in list(range(4, 60)) + [130, 300]:
        x = np.unique(rnd.integers(1, 1 << 62, n, dtype=np.int64).astype(U))
        drop = rnd.integers(0, len(x) // 5 + 1)
        y = np.unique(np.concatenate([rnd.permutation(x)[drop:], rnd.integers(1, 1 << 62, rnd.integers(0, len(x) // 8 + 1), dtype=np.int64).astype(U)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both) or np.array_equal(x, y):
            continue
        owner, values = np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x, y])
        sizes = np.array([len(x), len(y)])
        seeds = {b: ngram_join.MOST_SEEDS for b in range(20)}  # a set whose pieces hold too few units comes to the last
        pieces, members = ngram_join._rows(owner, values, sizes, np.array([1, 2], U), 80, seeds)
        ids, unit = members & np.int64(ngram_join.SET_ID), members < 0
        lists = [set(map(int, pieces[(ids == k)])) for k in (1, 2)]
        units = [set(map(int, pieces[(ids == k) & unit])) for k in (1, 2)]
        assert units[0] & lists[1] or units[1] & lists[0]


def _text(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def test_texts_of_one_id_join_their_components(spark):
    a, b, c, d = map(_text, range(4))
    rows = [(3, a), (7, a), (7, b), (9, b + " more"), (9, c), (11, c), (12, d), (12, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(ngram_join.near_duplicates(frame)) == expected(rows)
    assert {i: c for i, _, c, _ in expected(rows)} == {3: 3, 7: 3, 9: 3, 11: 3, 12: 12}


def test_keep_one_drops_rows_not_ids(spark):
    """A clean text stays beside a copy with its id; of equal or similar rows of one id one stays."""
    a, b, c, d = map(_text, range(4))
    rows = [(3, a, "x"), (7, a, "x"), (7, b, "x"), (8, c, "x"), (8, c, "y"), (8, c + " more", "x"), (9, d, "z"), (9, d, "z"),
            (None, a, "x"), (None, a, "x"), (10, "", "x"), (10, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, root string").repartition(4)
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(frame).collect()), key=str)
    eight = [x for x in got if x[0] == 8]
    assert len(eight) == 1 and eight[0][1] in (c, c + " more")
    assert [x for x in got if x[0] != 8] == sorted([(3, a), (7, b), (9, d), (None, a), (None, a), (10, ""), (10, "")], key=str)
    every = [r.doc_id for r in ngram_join.keep_one(frame, equal_rows=True).collect()]
    assert every.count(9) == 2 and every.count(8) in (1, 2) and every.count(7) == 1 and every.count(3) == 1


@pytest.mark.parametrize("percent", [30, 50, 51, 80, 100])
def test_thresholds(spark, percent):
    """Against all pairs, also where no cut into segments can hold the units."""
    rnd = random.Random(percent)
    rows = []
    for group in range(12):
        base = [f"g{group}w{k}" for k in range(rnd.choice((5, 6, 9, 20, 45)))]
        for _ in range(5):
            copy = base[: rnd.randrange(2, len(base) + 1)] + [f"x{rnd.randrange(10**6)}" for _ in range(rnd.randrange(3))]
            rows.append((len(rows), " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(ngram_join.near_duplicates(frame, percent=percent)) == expected(rows, percent)


@pytest.mark.parametrize("percent", [-1, 0, 101])
def test_impossible_thresholds(corpus, percent):
    with pytest.raises(ValueError):
        ngram_join.near_duplicates(corpus, percent=percent)
    with pytest.raises(ValueError):
        ngram_join.keep_one(corpus, percent=percent)


def test_texts_of_two_alternating_words(spark):
    """Thue-Morse order and its complement, on which sums of powers of an odd number modulo 2^64 agree."""
    order = [bin(i).count("1") % 2 for i in range(4096)]
    one, two = (" ".join(f"{'ab'[b ^ flip]}{'cd'[b ^ flip]}" + ("" if i % 5 else f"q{flip}") for i, b in enumerate(order)) for flip in (0, 1))
    glued = ["".join("ab"[b ^ flip] for b in order) for flip in (0, 1)]
    rows = [(1, one), (2, two), (3, glued[0]), (4, glued[1]), (5, glued[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(ngram_join.near_duplicates(frame)) == expected(rows)


@pytest.mark.parametrize("cells", [1, 40, 4_000_000])
def test_links_of_two_blocks(monkeypatch, cells):
    """Any stretch of shingles gives the same counts; sets of one block are not compared in a group of two."""
    monkeypatch.setattr(ngram_join, "TABLE_CELLS", cells)
    rnd = random.Random(4)
    rows, expect = [], []
    for root, (one, two) in enumerate([(0, 0), (0, 1), (2, 2)]):
        group = []
        for k in range(9):
            values = sorted(rnd.sample(range(12), rnd.randrange(9, 13)))
            group.append((root, one, two, rnd.choice((one, two)), 100 * root + k, rnd.randrange(1, 4), values))
        rows += group
        for r in group:
            near = [q for q in group if q is not r and (one == two or q[3] != r[3])]
            expect.append(sum(q[5] for q in near if 100 * len({*q[6]} & {*r[6]}) >= 80 * len({*q[6]} | {*r[6]})))
    batch = pa.RecordBatch.from_arrays(
        [*(pa.array([r[i] for r in rows], pa.int64()) for i in range(6)), pa.array([r[6] for r in rows], pa.list_(pa.int64()))],
        names=["root", "one", "two", "block", "set_id", "weight", "shingles"])
    ids, links = ngram_join._block_links(batch, 80)
    assert (ids.tolist(), links.tolist()) == ([r[4] for r in rows], expect) and sum(expect)


@pytest.mark.parametrize("sets, shingles", [(256, 10**6), (7, 10**6), (256, 500)])
def test_links_of_a_large_group(spark, monkeypatch, sets, shingles):
    """Near copies of one text, copies of them, and a chain, counted in one block and in many."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
    rnd = random.Random(sets)
    base, texts = _text(1, 80).split(), []
    for _ in range(60):
        copy = list(base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(len(copy))] = f"z{rnd.randrange(50)}"
        texts += [" ".join(copy)] * rnd.choice((1, 1, 3))
    texts += [" ".join(_text(2, 120).split()[k : k + 60]) for k in range(0, 40, 4)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert answer(ngram_join.near_duplicates(frame)) == expected(rows)
