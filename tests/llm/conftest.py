import random

import pytest

SYLLABLES = "ba ko ri ne tu la mo si pe da".split()


def words(rnd, n):
    return [rnd.choice(SYLLABLES) + rnd.choice(SYLLABLES) + rnd.choice("abc") for _ in range(n)]


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows that hold every awkward case: nulls, empty and long texts, copies, near copies, repeated
    rows, a text without letters, shared passages, and columns with names the operators use inside."""
    rnd = random.Random(7)
    passage = "\n".join(" ".join(words(rnd, 9)) for _ in range(7))
    base = [" ".join(words(rnd, rnd.choice((3, 6, 30, 90, 240)))) for _ in range(24)]
    texts = [*base, None, "", "   \n\t ", "12 34 -- !!", base[3], base[3], base[3].upper()]
    for k in range(4):  # near copies of one text, each some words away from it
        near = base[9].split()
        for _ in range(1 + k):
            near[rnd.randrange(len(near))] = rnd.choice(words(rnd, 3))
        texts.append(" ".join(near))
    for k in range(3):
        texts.append("\n".join([f"start {k} " + " ".join(words(rnd, 12)), passage, "end " + " ".join(words(rnd, 5))]))
    texts.append(" ".join(words(rnd, 30_000)))
    texts.append("x" * 50_000)
    texts.append("same line of words here\n" * 30)
    texts.append("Ünïcödé tèxt <|endoftext|> ßtraße 你好 😀 it's\x1c\x85\xa0end")
    rows = [(100 + i, t, "en" if i % 2 else "fr", "s0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "a row without id but with words in it", "en", "s1", 5), (rows[4][0], "other text of a repeated id", None, None, None)]
    rows = [(*r, 1, 2, 3, 4) for r in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n int, root int, piece int, score int")
    return frame.repartition(3).cache()
