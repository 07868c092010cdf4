"""Pigeonhole edit matching against the plain edit-distance table."""

import random

from hazardflow.llm import decontaminate


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rnd = random.Random(2)
    for _ in range(300):
        pattern = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 90)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 120)))
        assert decontaminate.best_match(decontaminate.masks(pattern), len(pattern), text)[0] == distance(pattern, text)


def test_finds_every_item_within_its_budget(spark):
    rnd = random.Random(4)
    items = [(i, " ".join("".join(rnd.choice("abcdeé") for _ in range(5)) for _ in range(rnd.choice((1, 4, 20))))) for i in range(12)]
    items += [(90, None), (91, "  "), (None, "an item without an id that is long enough"), (3, items[3][1])]
    texts = []
    for i, (_, item) in enumerate(items):
        s = list(item or "")
        for _ in range(rnd.randint(0, 1 + len(s) // 15)):
            at = rnd.randrange(len(s)) if s else 0
            s[at : at + rnd.randint(0, 1)] = rnd.choice(["", "z"])
        texts.append((i, "Before   it\n" + "".join(s).upper() + " after " * 30))
    texts += [(200, None), (201, ""), (None, items[2][1]), (203, "word " * 9000 + items[4][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, text in texts:
        for j, item in items:
            a, b = decontaminate.normal(item), decontaminate.normal(text)
            if a and b and len(b) < 2000 and distance(a, b) <= int(0.05 * len(a)):
                want.add((i, j, distance(a, b)))
    want.add((203, 4, 0))
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in texts} - {i for i, _, _ in want}


def test_blocks_give_the_same(spark, corpus, monkeypatch):
    bench = corpus.selectExpr("doc_id AS item_id", "substring(text, 1, 150) AS text").filter("doc_id % 3 = 0")
    one = sorted(map(str, decontaminate.leaks(corpus, bench).collect()))
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", 400))
    assert sorted(map(str, decontaminate.leaks(corpus, bench).collect())) == one
    assert one


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, bench).collect() == []
    assert decontaminate.clean(docs, bench).collect() == []
