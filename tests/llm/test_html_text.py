"""Block rules on hand-made pages, and the two passes against plain loops."""

import random

import numpy as np
import pytest

from hazardflow.llm import html_text

LONG = "This is the first of the paragraphs that a reader came to the page for, and it has the usual words of running text in it, as they are in a story."
MORE = "The second one is as long as the first and says that there was a house by the river with a garden in which they had planted the trees."
PLAIN = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   \n ", ""), ("no markup at all", "no markup at all"),
    (f"<nav><ul><li><a href=/a>Home</a></ul></nav><article><h1>A title</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; me</footer>",
     f"A title\n\n{LONG}\n\nShort."),
    # an article without a single good block, its unclosed elements, words without stop words
    (f"<body><p>{LONG}</p><article><p><b>Reorea.<br><p>In.</article><div class=ad>{MORE}</div>", "Reorea.\n\nIn."),
    (f"<article><p>{PLAIN}</p></article>", PLAIN),
    # adverts, comments, forms, notices and sidebars inside and outside
    (f'<article><p>{LONG}</p><div class="box ad-slot"><p>{MORE}</p></div><p>End.</p><section id="comments"><article class="comment">{MORE}</article></section></article>',
     f"{LONG}\n\nEnd."),
    (f"<div id='cookie-notice'>{MORE}</div><div class=wrap><h2>Head</h2><p>{LONG}</p><p>Short one.</p></div><aside>{MORE}</aside><form>{MORE}<input></form>",
     f"Head\n\n{LONG}\n\nShort one."),
    # no article: links, words that are no text, and short blocks between
    (f"<p>Home | <a href=a>All of the news</a> | <a href=b>About</a></p><p>tiny</p><div>{PLAIN}</div><p>by me</p><p>{LONG}</p><p>so</p><p>{MORE}</p>",
     f"by me\n\n{LONG}\n\nso\n\n{MORE}"),
    (f"<div><p>{PLAIN}</p><p>{PLAIN}</p></div>", f"{PLAIN}\n\n{PLAIN}"),  # no known language: length decides
    # references, white space, scripts, markup in comments and attributes, raw text
    ("<article><p>a &amp; b&nbsp;&#233;\n\t c &lt;p&gt;<br>d<br> <br>e</p></article>", "a & b é c <p> d\n\ne"),
    ("<article><script>var t='</p><p>x';</script><p title='a > b'>one<!-- <p>two</p> --> three</p><style>p{}</style></article>", "one three"),
    ("<article><p>one</p><script>never closed <p>two</p>", "one"),
    ("<ARTICLE><P>Upper < case</ARTICLE>", "Upper < case"),
    ("<article><p>a <a href=x>b</a> c d e f</p><ul><li><a href=y>All links</a></ul><p>end of it</p></article>", "a b c d e f\n\nend of it"),
])
def test_pages(page, text):
    assert html_text.main_texts([page]) == [text]
    # whatever stands before and after in the batch
    assert html_text.main_texts(["<p>x</p>", page, None, f"<article>{LONG}</article>"])[1] == text


def plain_pass(region, label):
    out = []
    for i, mine in enumerate(label):
        if mine != html_text.UNDECIDED:
            out.append(mine)
            continue
        best = None
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(label) and region[j] == region[i] and label[j] == html_text.UNDECIDED:
                j += step
            inside = 0 <= j < len(label) and region[j] == region[i]
            if inside or region[i] > 0:
                found = (abs(j - i), -(label[j] if inside else html_text.GOOD))
                best = min(best, found) if best else found
        out.append(-best[1] if best else html_text.GOOD)
    return out


def test_second_pass_equals_plain_loops():
    rnd = random.Random(1)
    for _ in range(300):
        sizes = [rnd.randrange(9) for _ in range(4)]
        page = np.repeat(range(4), sizes)
        region = np.array([rnd.choice((-1, -1, 1, 2)) for _ in page], int)
        label = np.array([rnd.choice((-1, 0, 0, 0, 1)) for _ in page], int)
        want = [x for p in range(4) for x in plain_pass(region[page == p].tolist(), label[page == p].tolist())]
        assert html_text._inherited(page, region, label).tolist() == want


def test_table(spark):
    rows = [(1, "u", f"<article>{LONG} 😀</article>", "t", 9), (1, "u", f"<article>{LONG} 😀</article>", "t", 9), (None, None, None, None, None), (2, "", "<p>" * 20_000 + "x" * 100_000, "", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2)
    got = sorted((tuple(r) for r in html_text.extract(frame).collect()), key=str)
    text = f"{LONG} 😀"
    assert got == sorted([(1, "u", text, len(text)), (1, "u", text, len(text)), (None, None, "", 0), (2, "", "x" * 100_000, 100_000)], key=str)
    assert html_text.extract(frame.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark, sf):
    """Every paragraph of every article of the table, and nothing from around it."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for row in html_text.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        article = re.search("<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(p for p in parts if p) and row.n_chars == len(row.text)
