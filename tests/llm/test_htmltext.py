"""Main text of pages: the parser, the network against a plain form of it, and held-out pages."""

import html
import math
import re

import numpy as np
import pytest
from frames import SF, read

from fareline.llm import htmltext
from fareline.llm.queries import op11_html_text

SF_LARGER = "/root/testdata/sf0.01"


def texts(page):
    return [leaf.text for leaf in htmltext.leaves_of(page)]


def article_of(page):
    """The article of a test page by its element, the only place that has main text there."""
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    parts = (html.unescape(re.sub(r"<[^>]+>", "", part)).split() for part in re.split(r"</?(?:p|h1|br)\b[^>]*>", inside))
    return " ".join(" ".join(words) for words in parts if words)


@pytest.mark.parametrize(("page", "expected"), [
    (None, []), ("", []), (" \n\t", []), ("plain <b>t</b>ext", ["plain text"]),
    ("<p>one<p>two<br>three</p>four", ["one", "two", "three", "four"]),
    ("a&amp;amp;&lt;b&gt;&#8364;&copy;&nbsp;&nbsp;x", ["a&amp;<b>€© x"]),
    ("<script>var t='</p><p>no';</script>yes<style>p{}</style><!-- <p>no --><p>x<!--", ["yes", "x"]),
    ("<SCRIPT>no</SCRIPT >yes<textarea><p>no</textarea><title>no</title>", ["yes"]),
    ("<head><title>no</title><meta x><p>yes", ["yes"]), ("<head>yes", ["yes"]), ("<head><link><body>yes", ["yes"]),
    ('<p title="a > b" class=x>in</p><p data-x=\'>"\'>out', ["in", "out"]), ("1 < 2 and <3 > 2", ["1 < 2 and <3 > 2"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]), ("<td>a<td>b<tr><td>c", ["a", "b", "c"]),
    ("x</div></b>y</p>z<", ["x", "y", "z<"]), ("<p>un\n  closed &am", ["un closed &am"]), ("<p", []),
    ('<a href="x>never closed', []), ("<select><option>no</select>yes", ["yes"])])
def test_blocks(page, expected):
    assert texts(page) == expected


def test_paths_name_elements_classes_and_roles():
    leaves = htmltext.leaves_of('<div class="main-Content x" id=top><p>one <a href=x>two</a></p><span class=ad><p>three</p></span>')
    assert [leaf.path for leaf in leaves] == [
        ("<div>", "class:main", "class:content", "class:x", "id:top", "<p>"),
        ("<div>", "class:main", "class:content", "class:x", "id:top", "class:ad", "<p>")]
    assert [leaf.linked for leaf in leaves] == [3, 0]


def test_deep_and_long_pages_take_time_in_proportion():
    deep = "<div>" * 30_000 + "x" + "</div><p>y" * 30_000
    assert len(texts(deep)) == 30_001
    assert texts("<p>" + "word " * 400_000) == ["word " * 399_999 + "word"]
    assert texts('<a x="' + "q" * 1_000_000) == []


def plain_scores(leaves, model):
    """The network leaf by leaf, gate by gate."""
    w, features, hidden = model.weights, htmltext.Features(), htmltext.HIDDEN
    inputs = []
    for i, leaf in enumerate(leaves):
        path = sum((w["path"][k] * 0.5 for k in features.path(leaf)), np.zeros(htmltext.PATH_DIM))
        words = features.words(leaf)
        word = sum((w["word"][k] / len(words) for k in words), np.zeros(htmltext.WORD_DIM))
        inputs.append(np.concatenate([path, word, features.shape(leaf, i, len(leaves))]))
    states = {}
    for way, order in (("ahead", range(len(leaves))), ("back", range(len(leaves) - 1, -1, -1))):
        h, c = np.zeros(hidden), np.zeros(hidden)
        for t in order:
            gates = inputs[t] @ w[f"{way}_in"] + w[f"{way}_bias"] + h @ w[f"{way}_state"]
            i, f, o = (np.array([1 / (1 + math.exp(-x)) for x in gates[k * hidden:(k + 1) * hidden]]) for k in range(3))
            c = f * c + i * np.tanh(gates[3 * hidden:])
            h = o * np.tanh(c)
            states[way, t] = h
    return [1 / (1 + math.exp(-float(np.concatenate([states["ahead", t], states["back", t], inputs[t]]) @ w["out"][:, 0] + w["bias"][0])))
            for t in range(len(leaves))]


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.fit(read(spark, SF_LARGER, "pages"))


def test_network_against_a_plain_form(model):
    layout = htmltext._Layout(["One two three, four. Five six"], 3)
    pages = [layout.labelled()[0] for _ in range(12)] + [[]]
    together = htmltext.label(pages, model, htmltext.Features())
    for leaves, scores in zip(pages, together, strict=True):
        assert np.allclose(scores, plain_scores(leaves, model), atol=1e-4)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    weights = {k: v.astype(np.float64) for k, v in htmltext._initial_weights(rng).items()}
    layout = htmltext._Layout(["One two three, four. Five six"], 4)
    pages = [layout.labelled() for _ in range(3)]
    batch = htmltext.Batch.of([p[0] for p in pages], htmltext.Features())
    labels = np.zeros(batch.mask.shape)
    for i, (_, told) in enumerate(pages):
        labels[i, :len(told)] = told

    def loss():
        p = np.clip(htmltext._scores(batch, weights), 1e-9, 1 - 1e-9)
        return -(np.where(labels == 1, np.log(p), np.log(1 - p)) * batch.mask).sum() / batch.mask.sum()

    for name, slope in htmltext._gradients(batch, labels, weights).items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before = weights[name][at]
        weights[name][at] = before + 1e-2
        up = loss()
        weights[name][at] = before - 1e-2
        down = loss()
        weights[name][at] = before
        assert abs((up - down) / 2e-2 - slope[at]) < 2e-3 + 0.05 * abs(slope[at]), name


def test_articles_of_the_test_pages(spark):
    """Trained on at most 300 pages of a table, exact on all of it."""
    for sf_dir in (SF, SF_LARGER):
        want = {r.page_id: article_of(r.html) for r in read(spark, sf_dir, "pages").collect()}
        got = op11_html_text(spark, sf_dir).collect()
        assert {r.page_id: r.text for r in got} == want
        assert all(r.n_chars == len(r.text) for r in got)


def test_held_out_layouts(model, spark):
    """Pages laid out by other draws, of the texts of a table that was not learned from."""
    pieces = [leaf.text for r in read(spark, SF, "pages").collect() for leaf in htmltext.leaves_of(r.html)]
    layout = htmltext._Layout(pieces, 1234)
    pages = [layout.labelled() for _ in range(300)]
    scores = htmltext.label([p[0] for p in pages], model, htmltext.Features())
    right = [bool((s >= 0.5) == t) for (_, told), by in zip(pages, scores, strict=True) for s, t in zip(by, told, strict=True)]
    assert sum(right) / len(right) > 0.97


WHOLE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
<header class="site-header"><a href="/">The Daily News</a><nav><ul><li><a href=/a>World</a></li><li><a href=/b>Sports</a></li></ul></nav></header>
<div class="cookie-notice">We use cookies to improve this site. <button>Accept</button></div>
<form action="/s"><label>Search</label><input name=q><button>Go</button></form>
<{main}><h1>A long day at the harbour</h1><p>The ships came in early, and nobody had expected them &mdash; not even the pilots.</p>
<div class="ad">Buy two lamps and pay for one.</div>
<p>By noon the quay was full.</p><ul><li>Three ships from the north</li><li>Two from the south</li></ul></{end}>
<aside class="sidebar"><h3>Related articles</h3><a href=/x>What the pilots say</a></aside>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>I was there and it was a wonderful sight.</p></div></section>
<footer>&copy; 2024 The Daily News. All rights reserved.</footer><script>done()</script></body></html>"""
ARTICLE = ("A long day at the harbour The ships came in early, and nobody had expected them — not even the pilots. By noon the quay was "
           "full. Three ships from the north Two from the south")


@pytest.mark.parametrize("main", ["article", "main", 'div class="article-body"', "div id=content", 'article class="post"', "section"])
def test_a_page_with_every_kind_of_boilerplate(spark, model, main):
    page = WHOLE.format(main=main, end=main.split()[0])
    rows = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert htmltext.extract(rows, model).first().text == ARTICLE


def test_awkward_pages(spark, model):
    """Null and empty html, null ids, repeated rows, a very long page, clashing columns, no rows."""
    long = "<article>" + "".join(f"<p>Sentence number {i} of a long article stands here.</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<nav><a href=x>Home</a></nav>"), (3, "v", long), (3, "v", long), (4, "w", "a\x00<p>b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS `Blocks`", "3 AS path")
    got = htmltext.extract(pages, model, with_blocks=True).collect()
    assert len(got) == 6
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[None].text == by_id[2].text == "" and by_id[2].blocks[0].text == "Home"
    assert by_id[3].text == " ".join(f"Sentence number {i} of a long article stands here." for i in range(5000))
    assert htmltext.extract(pages.filter("false"), model).collect() == []
    empty = htmltext.fit(pages.filter("page_id = 1"), laid_out=40)
    assert htmltext.extract(pages, empty).count() == 6
