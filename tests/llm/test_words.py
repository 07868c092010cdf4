"""Hashes of words and lines: equal bytes, and only they, give equal hashes."""

import random

import numpy as np

from hazardflow.llm.words import EXACT, hash_spans, spans, words


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def hashed(texts, table=EXACT):
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    return hash_spans(np.frombuffer(data, np.uint8), np.append(0, ends[:-1]), ends, table).tolist()


def test_structured_texts_differ():
    texts = []
    for n in (512, 1024, 2048, 4096, 8192, 70_000):
        order = thue_morse(n)
        texts += ["".join("ab"[b ^ flip] for b in order) for flip in (0, 1)]
        texts += [" ".join(("one", "two")[b ^ flip] for b in order) for flip in (0, 1)]
    texts += ["a" * n for n in range(40)] + ["a" * n for n in (4095, 4096, 4097, 8192, 50_000, 50_001)] + ["\0" * n for n in range(1, 20)]
    texts += ["b" * 4096 + "a" * 4096, "a" * 4096 + "b" * 4096]
    assert len(set(texts)) == len(texts) == len(set(hashed(texts)))


def test_equal_bytes_give_equal_hashes_anywhere():
    rnd = random.Random(1)
    pool = ["".join(rnd.choice("ab é") for _ in range(rnd.choice((0, 1, 7, 8, 9, 30, 5000, 9000)))) for _ in range(40)]
    texts = [rnd.choice(pool) for _ in range(300)]
    seen = {}
    for text, value in zip(texts, hashed(texts)):
        assert seen.setdefault(text, value) == value
    assert hashed(["", ""])[0] == hashed([""])[0]


def test_words_ignore_case_and_lines_do_not():
    data = b"Word word WORD wOrd\xc3\x89 wOrd\xc3\xa9"
    row, hashes = words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert len(set(hashes.tolist())) == 3 and len(row) == 5
    assert len(set(hashed(["Word", "word"]))) == 2
    assert [len(x) for x in spans(np.zeros(0, np.uint8), np.array([0]))] == [0, 0, 0]
