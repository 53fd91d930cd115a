"""HTML extraction: the linear scanner, learned weights, and the article of every page."""

import html
import re
import time

import pytest

from pedalytics.llm import html_extraction

SF = "/root/testdata/sf0.001"


def learned(*pages):
    weights = {}
    for _ in range(2):
        seen = {}

        class Counts(dict):
            def __missing__(self, key):
                return self.setdefault(key, [0, 0])

        seen = Counts()
        for page in pages:
            html_extraction.count_labels(page, seen, weights)
        weights = html_extraction.weigh({k: tuple(v) for k, v in seen.items() if sum(v)})
    return weights


LABELLED = (
    '<html><body><nav><ul><li>menu one</li><li>menu two</li></ul></nav><div class="ad">buy this thing now</div>'
    "<article><h1>Title</h1><p>some words of the article that go on</p></article><footer>imprint and more</footer></body></html>")
WEIGHTS = learned(*[LABELLED] * 5)


def test_menus_are_blamed_and_lists_are_not():
    assert WEIGHTS["nav"] == WEIGHTS["div.ad"] == WEIGHTS["footer"] == WEIGHTS[html_extraction.BESIDE] == -3.0
    assert "ul" not in WEIGHTS and "li" not in WEIGHTS and WEIGHTS["article"] == 3.0 and WEIGHTS["<p"] == 0


@pytest.mark.parametrize("inner", [
    '<div class="share-price">the share price rose</div>', "<b class=ad-hoc>ad hoc</b>", '<figure class="widget">a figure</figure>',
    "<ul><li>one</li><li>two</li></ul>", "<header><p>by someone</p></header>"])
def test_nothing_of_the_article_is_lost(inner):
    page = f"<body><nav>x y z</nav><article><p>some words here</p>{inner}<p>and the end of it</p></article></body>"
    plain = [t for t in re.sub("<[^>]*>", "\n", page[page.index("<article>") : page.index("</article>")]).split("\n") if t]
    assert html_extraction.extract(page, WEIGHTS).replace("\n", " ") == " ".join(plain)


def test_what_stands_beside_the_article_goes():
    page = '<body><article><p>the article</p></article><div class="col2">a long side column of words</div><div id="discussion">me too</div></body>'
    assert html_extraction.extract(page, WEIGHTS) == "the article"


def test_pages_without_article_go_by_their_elements():
    page = '<body><header>site</header><nav>a b</nav><div><p>first words of it</p><ul><li>a point</li></ul></div><div class="ad">buy</div><footer>c</footer></body>'
    assert html_extraction.extract(page, WEIGHTS) == "first words of it\na point"


def test_broken_pages_take_linear_time():
    pages = ["<a " * 350_000, '<a href="' * 120_000, "<div>" * 200_000 + "</p>" * 200_000, "<div>x " * 140_000,
             "<!--" * 250_000, "<p '\">" * 150_000, "<script>" * 120_000, "</x" * 300_000, "<a \"'>" * 170_000]
    for page in pages:
        began = time.time()
        html_extraction.extract(page, WEIGHTS)
        html_extraction.extract("<article>" + page, WEIGHTS)
        html_extraction.count_labels("<article>" + page, __import__("collections").defaultdict(lambda: [0, 0]), WEIGHTS)
        assert time.time() - began < 15, page[:20]


def test_text_that_is_no_tag_stays():
    page = "<article><p>a < b &amp; c > d</p><p title='x > y'>e</p><p>f <unended"
    assert html_extraction.extract(page, WEIGHTS) == "a < b & c > d\ne\nf <unended"
    assert list(html_extraction.tokens("<p x='a>b\">c")) == [("open", "p", " x='a"), ("text", "b\">c", "")]


def test_every_article_of_the_table(spark):
    """The pages mark their article; without its markup it is what comes out, exactly."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html_extraction.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) > 0
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        text = "\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub("<[^>]*>", "", b)).split())))
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (text, len(text), r["url"])


def test_clashing_columns_and_empty_tables(spark):
    rows = [(1, "u", LABELLED, "w", 3), (2, None, None, None, None), (None, "v", "", "w", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, html_extraction.main_text(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "Title\nsome words of the article that go on", 42), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert html_extraction.main_text(pages.limit(0)).count() == 0
