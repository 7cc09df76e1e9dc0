import html
import itertools
import re
from collections import Counter

import numpy as np

from obsframe.llm import html_text as H
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def text(page):
    return H.main_texts([page], H.trained())[0]


def brute(page):
    """The given pages mark their article."""
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(x for b in blocks if (x := " ".join(html.unescape(b).split())))


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = QUERIES["op3_main_text"](spark, SF_SMALL).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.text == brute(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_layouts_not_trained_on():
    pages = H.labelled_pages(120, seed=1234)
    hit = miss = extra = 0
    for (page, content), got in zip(pages, H.main_texts([p for p, _ in pages], H.trained())):
        a, b = Counter(x for x in got.split("\n\n") if x), Counter(content)
        hit, miss, extra = hit + (a & b).total(), miss + (b - a).total(), extra + (a - b).total()
    assert hit / (hit + miss) > 0.97 and hit / (hit + extra) > 0.95


def test_marginals_against_enumeration():
    tree = H.parse("<body><nav class=menu><a href=x>a</a></nav><div id=main><p>one two.</p><p>three</div></body>")
    model, forest = H.trained(), H.Forest([tree])
    got = forest.pass_messages(model["w"], model["pair"])[0]
    unary, n = forest.unary(model["w"]), forest.n
    weight, total = np.zeros(n), 0.0
    for y in itertools.product((0, 1), repeat=n):
        e = np.exp(sum(unary[i] * y[i] for i in range(n)) + sum(model["pair"][y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0))
        total += e
        weight += e * np.array(y)
    assert np.allclose(got, weight / total)


def test_text_rules():
    wrap = "<html><head><title>t<style>x</style></head><body><nav><a href=a>Home</a> <a href=b>News</a></nav><article>{}</article><footer>&copy; me</footer></body></html>"
    assert text(wrap.format("<h1>A &amp; B</h1><p>x\n  y&nbsp;z<br>w</p><p>caf&eacute; &#x1F600; &lt;p&gt;</p>")) == "A & B\n\nx y z w\n\ncafé 😀 <p>"
    assert text(wrap.format("<p>One<p>Two <b>bold</b>, <i>it</i><!-- no --><script>var a='<p>no</p>'</script> end")) == "One\n\nTwo bold, it end"
    assert text(wrap.format("<p>In<div class='advert'>Buy this now</div><p>Out<form><label>Mail</label><input></form>")) == "In\n\nOut"
    assert text(wrap.format("<p>Story text here.</p><section class='comments'><h3>2 comments</h3><div class=comment><p>First of all, thanks for this.</p></div><div class=comment><p>No.</p></div></section>")) == "Story text here."


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>inside</p>" + "</div>" * 3000
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<html><head><title>t</title></head></html>"), (4, "u", "</p></div>just text"), (5, "u", deep),
            (6, "u", "<article><p>" + "long words " * 200_000 + "</p></article>"), (7, "u", "<!doctype html><body><article><p>ok"), (None, "u", "<article><p>a\x00b</p></article>"),
            (8, "u", "<p><<>&&amp;&#xFFFFFFFF; <a <b>")] + [(9, "u", "<article><p>same</p></article>")] * 3
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    out = H.extract(df)
    assert sorted(out.columns) == sorted(df.columns)
    got = {r.page_id: r for r in out.collect()}
    assert [got[i].text for i in (1, 2, 3, 9)] == ["", "", "", "same"] and got[1].n_chars == 0
    assert got[6].n_chars == len("long words " * 200_000) - 1
    assert got[7].text == "ok"
    assert H.extract(df.limit(0)).count() == 0


def test_formula_stays_in_its_paragraph():
    words = "a sentence of plain words that belongs to the article and goes on for a while"
    tex = "<annotation encoding=application/x-tex>\\alpha</annotation>"
    page = f"<body><article><p>{words}</p><p>{words} where <math><semantics><mi>x</mi>{tex}</semantics></math> is {words}</p></article></body>"
    assert text(page).split("\n\n")[1] == f"{words} where x is {words}"
