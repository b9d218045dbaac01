import html
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from wortfund.llm import html_text as H
from wortfund.llm.queries import op13_html_extraction

LONG = "The river rose through the night, and by the morning most of the lower fields stood under water."


def test_least_cut_against_all_cuts():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(1, 9)
        costs = [rng.randint(-9, 9) for _ in range(n)]
        between = {(i, j): rng.randint(1, 6) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4}

        def value(side):
            terminals = sum(abs(c) for c, s in zip(costs, side) if (c > 0) != s and c)
            return terminals + sum(w for (i, j), w in between.items() if side[i] != side[j])

        assert value(H.min_cut(costs, between)) == min(map(value, itertools.product([False, True], repeat=n)))


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        (" \n ", ""),
        (None, ""),
        ("<html><head><title>t</title></head><body></body></html>", ""),
        # an unclosed paragraph, formatting without end, a break, references, white space
        (f"<article><h1>A &amp; B</h1><p><b>First&nbsp;one.<br><p>{LONG}\n {LONG}</article>", f"A & B\nFirst one.\n{LONG} {LONG}"),
        # a short paragraph between long ones, and an advert between paragraphs
        (f"<main><p>{LONG}<p>Yes.<div class='ad'>{LONG}</div><p>{LONG}</main>", f"{LONG}\nYes.\n{LONG}"),
        # scripts, styles and comments with markup in them; attributes with > and without quotes
        (f'<body><script>if (a < b) document.write("<p>no</p>")</script><style>p > b {{}}</style><!-- <p>no</p> --><article><p title="a > b" id=x>{LONG}</p></article>', LONG),
        # comments of readers, each an article of its own
        (f"<main><article><p>{LONG}</article><section id=comments><article class=comment><p>{LONG}</article></section></main>", LONG),
        (f"<header><a href=/>Home</a></header><nav><a href=a>a</a></nav><article><p>{LONG}</article><aside><p>{LONG}</aside><footer>&copy; x</footer>", LONG),
        (f'<div role="alert">{LONG}</div><div class="cookie-notice">{LONG}</div><article><p>{LONG}</p></article><form><p>{LONG}<input></form>', LONG),
        # cut anywhere
        (f"<article><p>{LONG}</p><p>And so &am", f"{LONG}\nAnd so &am"),
        (f"<article><p>{LONG}</p><foot", LONG),
        (f"<article><p>{LONG}</p><!-- never", LONG),
        # without any telling element: text density and neighbours decide
        (f"<div><div><a href=1>Home</a> <a href=2>News</a></div><div><h1>What happened</h1><p>{LONG}<p>{LONG}<p>So it goes.<p>{LONG}</div><div><a href=3>Imprint</a></div></div>", f"What happened\n{LONG}\n{LONG}\nSo it goes.\n{LONG}"),
        # a form around the whole page, a class name on the body
        (f"<body class='has-sidebar'><form><main><p>{LONG}</p></main></form></body>", LONG),
        ("<article><ul><li>One thing.<li>Another thing.</ul><table><tr><td>Cell one.<td>Cell two.</table></article>", "One thing.\nAnother thing.\nCell one.\nCell two."),
    ],
)
def test_main_text(page, text):
    assert H.main_text(page) == text


def test_long_and_deep_pages():
    page = "<div>" * 20_000 + f"<article><p>{LONG}</p>" * 3_000 + "<a " * 5_000 + "</b>" * 5_000
    assert H.main_text(page).count("\n") == 2_999


def test_frame(spark, empty):
    rows = [(1, f"<article><p>{LONG}</article>"), (2, None), (None, ""), (1, f"<article><p>{LONG}</article>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({"row": F.lit(1), "main_text": F.lit("x")})
    out = H.extract(df)
    assert out.columns == ["page_id", "html", "row", "main_text"]
    assert sorted((r.page_id or 0, r.main_text) for r in out.collect()) == [(0, ""), (1, LONG), (1, LONG), (2, "")]
    assert H.extract(df.limit(0), keep_html=False).columns == ["page_id", "row", "main_text"]
    assert H.extract(df.select("html"), keep_html=False).columns == ["main_text"]
    assert H.extract(empty, "text").count() == 0


def test_query_against_the_article_element(spark, sf):
    """The given pages mark their article, so that its text can be cut out by patterns alone."""

    def plain(page):
        article = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
        parts = re.split(r"</?(?:p|h1)>", article[1] if article else "")
        parts = [" ".join(html.unescape(re.sub(r"</?br?>", lambda m: " " if "br" in m[0] else "", p)).split()) for p in parts]
        return "\n".join(p for p in parts if p)

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = op13_html_extraction(spark, sf)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = out.collect()
    assert len(found) == len(pages)
    for r in found:
        want = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))
