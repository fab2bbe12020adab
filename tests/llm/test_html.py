import random
from itertools import product

import pytest

from numberplace.llm import html_text as X

from .conftest import SF, rows_of

LONG = "This is a sentence of a long paragraph with many plain words in it. "


def content(html):
    return X.content_blocks(html, X._PRIOR)


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 8)
        odds = [rng.choice([-3, -1, 0, 1, 2.5, rng.uniform(-2, 2)]) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(side):
            cut = sum(w for i, j, w in edges if side[i] != side[j])
            return cut + sum(max(o, 0) if not s else max(-o, 0) for o, s in zip(odds, side, strict=True))

        best = min(cost(s) for s in product([False, True], repeat=n))
        assert cost(X.minimum_cut(odds, edges)) == pytest.approx(best)


@pytest.mark.parametrize("outer", ["<div id=main>{}</div>", "<article>{}</article>", "<main>{}</main>", "{}"])
def test_parts_that_are_not_the_article_go(outer):
    inner = (f"<h1>Head &amp; line</h1><p>{LONG * 3}</p><aside><p>{LONG}</p></aside><div class='cookie-notice'><p>{LONG}</p></div>"
             f"<p>Second &lt;b&gt; <i>x</i><br>y\n\t z. {LONG}</p><form><p>{LONG}<input></p></form><script>var x = '</p>';</script>"
             f"<!-- <p>{LONG}</p> --><style>p {{}}</style><section id=comments><h2>Comments</h2><p>{LONG}</p></section>")
    page = ("<!doctype html><html><head><title>Title</title></head><body class=post><header><a href=/>Site</a></header>"
            f"<nav><ul><li><a href=/a>Menu</a></li></ul></nav>{outer.format(inner)}<div class=ad>Buy now. {LONG}</div><footer>{LONG}</footer>")
    text = LONG.strip()
    assert content(page) == ["Head & line", " ".join([text] * 3), f"Second <b> x y z. {text}"]


def test_awkward_pages(spark, clashing):
    pages = [None, "", "<p>", "<<<>>&&&;", "<p " * 50, "<script>x", "<div>" * 2_000 + LONG, "<p>" + LONG * 2_000, "\x00", LONG,
             f"<p><b>{LONG}<br><p>{LONG}</article></div>"]
    rows = [(k, f"u{k}", p) for k, p in enumerate(pages)] + [(1, None, pages[-1]), (None, "u", pages[-1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = rows_of(X.main_text(df))
    text = LONG.strip()
    by_id = {r[0]: r for r in found if r[0] is not None and r[0] > 1}
    assert by_id[10][2] == f"{text}\n\n{text}" and by_id[6][2] == text and by_id[9][2] == text
    assert by_id[7][3] == len(" ".join([text] * 2_000)) and by_id[2][2:] == ("", 0) and len(found) == len(rows)
    assert rows_of(X.main_text(clashing(df).drop("text"))) == found
    assert rows_of(X.main_text(df.limit(0))) == []


def test_given_pages(spark):
    """An article is its headline and what its paragraphs hold."""
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in X.main_text(pages).collect()}
    for r in pages.collect():
        head, rest = re.search(r"<article><h1>(.*?)</h1>(.*?)</article>", r.html, re.S).groups()
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in [head, *rest.split("<p>")]]
        assert found[r.page_id] == "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize("outer", ["page has-sidebar", "post no-comments", "layout with-banner"])
def test_class_words_around_an_article_do_not_hide_it(outer):
    text = LONG.strip()
    page = (f"<body><nav><a href=/>Menu</a></nav><div class='{outer}'><article><h1>Head line</h1><p>{LONG * 2}</p><p>{LONG}</p>"
            f"</article><aside><p>{LONG}</p></aside></div><footer>{LONG}</footer>")
    assert content(page) == ["Head line", f"{text} {text}", text]
    comments = f"<article><h1>Head line</h1><p>{LONG}</p><section class=comments><article><p>{LONG}</p></article></section></article>"
    assert content(comments) == ["Head line", text]


def test_formulas_and_buttons_of_an_article():
    found = content(f"<article><p>{LONG}<math><mi>x</mi><mo>=</mo><mn>2</mn></math> is so.</p><form><button>Send</button></form></article>")
    assert found == [f"{LONG}x=2 is so."]


def test_edges_decide_what_the_classifier_alone_gets_wrong(monkeypatch):
    """A short line between paragraphs is content by its neighbours alone."""
    short = f"<body><div><p>{LONG * 2}</p>two words<p>{LONG * 2}</p></div>"
    text = LONG.strip()
    assert content(short) == [f"{text} {text}", "two words", f"{text} {text}"]
    for name in ("SAME", "OTHER", "SIBLING"):
        monkeypatch.setattr(X, name, 0.0)
    assert content(short) != [f"{text} {text}", "two words", f"{text} {text}"]
