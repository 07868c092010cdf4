"""Line dedup against every run of lines of every text."""

import random

import pytest

from hazardflow.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def worded(text):
    return [(j, part) for j, part in enumerate(text.split("\n")) if part.strip(SPACE)]


def expected(rows, least):
    """Longest run from each line that also starts earlier; all its lines go if it has enough words."""
    texts = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    lines = [worded(t) for _, t in texts]
    out = {}
    for d, own in enumerate(lines):
        gone = set()
        for p in range(len(own)):
            best = 0
            for e in range(d + 1):
                for q in range(len(lines[e]) if e < d else p):
                    k = 0
                    while p + k < len(own) and q + k < len(lines[e]) and own[p + k][1] == lines[e][q + k][1]:
                        k += 1
                    best = max(best, k)
            run = own[p : p + best]
            if sum(len(part.split()) for _, part in run) >= least:
                gone |= {j for j, _ in run}
        parts = texts[d][1].split("\n")
        out[texts[d]] = "\n".join(x for j, x in enumerate(parts) if j not in gone), len(gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(8)] + ["", "   "]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))) for i in range(14)]
    rows += [(50, rows[3][1]), (51, rows[3][1] + "\n" + rows[5][1]), (52, "\n".join(["a b c"] * 40)), (53, None), (54, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = expected(rows, 10)
    got = line_dedup.remove_repeats(frame, min_words=10, removed="n").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n) == ((None, 0) if r.text is None else want[r.doc_id, dict(rows)[r.doc_id]])


def test_awkward_rows_keep_columns_and_clean_texts(corpus):
    got = line_dedup.remove_repeats(corpus, removed="removed_lines")
    assert got.columns == [*corpus.columns, "removed_lines"]
    rows, given = got.collect(), corpus.collect()
    assert len(rows) == len(given)
    texts = {(r.doc_id, r.text) for r in given}
    changed = [r for r in rows if r.removed_lines]
    assert all((r.doc_id, r.text) in texts for r in rows if not r.removed_lines)
    starts = [r.text for r in rows if (r.text or "").startswith("start ")]
    assert sorted(len(t.split("\n")) for t in starts) == [2, 2, 9]
    assert any((r.text or "").startswith("same line") for r in changed)


def test_empty_table(spark):
    assert line_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lines_of_two_alternating_words_are_no_copies(spark):
    """Thue-Morse order and its complement are different lines; a true copy goes."""
    order = [bin(i).count("1") % 2 for i in range(2048)]
    texts = [" ".join(("to", "be")[b ^ flip] for b in order) for flip in (0, 1)]
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[0] + "\nand more")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_repeats(frame).collect()}
    assert got == {1: texts[0], 2: texts[1], 3: "and more"}
