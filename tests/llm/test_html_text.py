import html
import re
from itertools import product

import pytest

from genrec.llm import html_text as q
from genrec.llm.common import table
from tests.llm.conftest import SF001


def article(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())


def test_pages_give_their_articles(spark):
    pages = table(spark, SF001, "pages")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in q.extract(pages).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_held_out_layouts(spark):
    sample = [r.html for r in table(spark, SF001, "pages").collect()]
    model = q.train(q.labelled_pages(sample[:30], 300))
    right = wrong = missed = 0
    for page in q.labelled_pages(sample[30:], 120, seed=5):
        for b, y in zip(page, model.decode(page), strict=True):
            right += y and b.label
            wrong += y and not b.label
            missed += b.label and not y
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_viterbi_is_the_best_labelling():
    model = q.Field({"a": 1.3, "b": -0.7, "c": 0.2}, [[0.9, -0.4], [-0.3, 0.8]])
    blocks = [q.Block("x", (), frozenset(), 0, features=list(f)) for f in ("a", "bc", "b", "ac", "bb", "c")]

    def score(y):
        return sum(model.emit[f] for b, k in zip(blocks, y, strict=True) if k for f in b.features) + sum(
            model.move[i][j] for i, j in zip(y, y[1:], strict=False))

    assert score(model.decode(blocks)) == pytest.approx(max(map(score, product((0, 1), repeat=6))))


def test_blocks_of_broken_markup():
    page = "<div>a&amp;b <b>c</b>d<p>e\n f<p>g<script>x < y</script><style>p{}</style><!-- z --><li>h<li>i</div>&nbsp;<br>j &lt; k"
    assert [b.text for b in q.leaf_blocks(page)] == ["a&b cd", "e f", "g", "h", "i", "j < k"]
    assert q.leaf_blocks(None) == [] and q.leaf_blocks("") == [] and q.leaf_blocks("<html><script>never closed") == []


ARTICLE = "<article><h1>Title of it</h1><p>One long sentence about things, and more.</p>{}<p>Two stays, with a few more words.</p></article>"


@pytest.mark.parametrize("inside", [
    "<p>One.<noscript><p><img></p></noscript></p>", "<p>One.<svg><p></p>", "<p>One.<math><mi>x", "<![foo[x]]><p>One.", "<![CDATA[x]]><p>One.",
    '<div data-article-label="x"><p>One.</p></div>', "<p>One.<template><div><p>no</template>", "<p>One.</b></i></span></p>", "<p>One.<object><p>no</object>"])
def test_no_text_is_lost_after_odd_markup(inside):
    texts = [b.text for b in q.leaf_blocks(ARTICLE.format(inside))]
    assert texts[0] == "Title of it" and texts[-1] == "Two stays, with a few more words." and "One." in texts and "no" not in texts


def test_marks_count_in_labelled_pages_only():
    page = '<div data-article-label="1"><p>x</p></div>'
    assert [b.label for b in q.leaf_blocks(page)] == [None] and [b.label for b in q.leaf_blocks(page, marked=True)] == [1]


@pytest.mark.parametrize("opening, closing", [("<div>", ""), ('<div class="menu x">', "</nav>"), ("<b>", "<p>t</p></i>"), ("<p><b>", "")])
def test_depth_costs_no_squares(opening, closing):
    import time

    def took(n):
        start = time.perf_counter()
        blocks = q.leaf_blocks((opening + "t " + closing) * n)
        return time.perf_counter() - start, len(blocks)

    took(500)
    small, large = took(5000), took(40000)
    assert large[0] < 30 * max(small[0], 0.01) and large[1] >= 1


def test_ids_next_to_null_ids(spark):
    rows = [(9007199254740993, "u", "<p>x"), (None, "u", "<p>y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = q.extract(df, q.train(q.labelled_pages([], 50))).collect()
    assert sorted((r.page_id is None, r.page_id) for r in got) == [(False, 9007199254740993), (True, None)]


def test_edges(spark):
    long = "<article><p>" + "word " * 50000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<<<>>&&"), (None, "u", "<p>x"), (4, "u", long), (4, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as text", "1 as n_chars")
    model = q.train(q.labelled_pages([], 150))
    got = q.extract(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 6
    by = {r.page_id: r for r in got.collect()}
    assert by[1].text == "" and by[2].n_chars == 0 and by[4].text == ("word " * 50000).strip()
    assert q.extract(df.limit(0)).count() == 0
