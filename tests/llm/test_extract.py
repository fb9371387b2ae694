import html as entities
import re

import numpy as np
import pytest

from zonewright.llm import boosting, extract
from zonewright.llm.html import parse

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


@pytest.fixture(scope="module")
def trees(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    return extract.fit_on(pages)


def runs(html):
    return [n.text for n in parse(html) if n.text]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p>a<p>b", ["a", "b"]),
        ("<p>a <b>b</b>c<br>d</p>", ["a bc d"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("<script>var t='</p><p>x'; a</script><style>p{}</style><p>y", ["y"]),
        ("<script>never closed <p>x</p>", []),
        ("a &amp;amp; &eacute;&#233; &lt;b&gt;", ["a &amp; éé <b>"]),
        ("<!-- <p>x</p> --><p>y</p><!-- open", ["y"]),
        ("<head><title>t</title><body>b", ["b"]),
        ("<div a='>' b=\">\">x</div>", ["x"]),
        ("<p>a</div></p>b</article>", ["a", "b"]),
        ("x < y and <3", ["x < y and <3"]),
        ("<p>cut <a href='", ["cut"]),
        ("<select><option>a<option>b</select>c<textarea><p>d</textarea>", ["c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("", []),
    ],
)
def test_runs_of_text(html, want):
    assert runs(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        ("<a href=\"x\"\">Kept words here</a><p>More kept</p> <a href=\"y\">kept", ["Kept words here", "More kept", "kept"]),
        ("<p title=it's>one</p><p>two</p><p title='x'>three", ["one", "two", "three"]),
        ("<p \"a>one</p><p>two", ["one", "two"]),
        ("<p a=\"x>one</p><p>two", ["one", "two"]),
        ("<p a=b=\"x>one</p><p b=\"y\">two", ["one", "two"]),
        ("<p =\"x>one</p><p b=\"y\">two", ["one", "two"]),
        ("<div a = '>' b=\">\"c='>'/d=\"'>\">x</div>", ["x"]),
        ("<p a=>one</p>", ["one"]),
    ],
)
def test_stray_quotes_end_no_text(html, want):
    assert runs(html) == want


@pytest.mark.parametrize("tag", ["button", "select", "svg", "object", "noscript", "template", "datalist"])
def test_an_unclosed_hidden_element_ends_with_the_block_around_it(tag):
    assert runs(f"<div><p>a</p><{tag}>b<x>c</div><p>d</p>") == ["a", "d"]
    assert runs(f"<div><{tag}><x>b</x></div>c<div><{tag}>d</{tag}>e</div>") == ["c", "e"]
    # What is closed inside stays hidden.
    assert runs(f"<p>a</p><{tag}><foreignObject><div>b<div>c</div>d</div>e</foreignObject>f</{tag}><p>g</p>") == ["a", "g"]


def test_hidden_elements_that_others_end():
    assert runs("<div><button>a<button>b</button>c</div>d") == ["c", "d"]
    assert runs("<body><svg><path d='x'><p>a</p><p>b</p></body>") == ["a", "b"]
    assert runs("<table><tbody><tr><td><object><table><tr><td>a</tbody></table>b</object>c</table>") == ["c"]


def article_of(html):
    inside = re.search("<article>(.*?)</article>", html, re.DOTALL).group(1)
    blocks = [re.sub("<[^>]+>", "", b) for b in re.split("</?(?:p|h1)>|<br>", inside)]
    return " ".join(" ".join(entities.unescape(b).split()) for b in blocks if b.strip())


def test_articles_of_the_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract.extract_main_text(pages).collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] == article_of(html[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


def test_composed_pages_not_fitted_on(spark, trees):
    sentences = [f"{a} {b} is a sentence about {c}." for a in ("One", "Some", "No") for b in ("cat", "house") for c in ("rain", "trade", "old roads")]
    composer = extract.Composer(sentences, 99)
    exact, n = 0, 200
    for _ in range(n):
        page = composer.page()
        want = " ".join(" ".join(t.replace(extract._MARK, "").split()) for t in runs(page) if extract._MARK in t)
        exact += extract.main_texts([page.replace(extract._MARK, "")], trees) == [want]
    assert exact >= 0.8 * n


def test_nothing_is_kept_below_what_is_dropped(trees):
    pages = [parse(p) for p in ("<div><p>a</p><aside><p>b</p></aside></div>", "", "<nav><ul><li>x</ul></nav><article><h1>t</h1><p>text</article>")]
    forest = extract.Forest(pages)
    rng = np.random.default_rng(0)
    for _ in range(50):
        odds = rng.normal(0, 3, len(forest.nodes))
        kept = forest.kept(odds)
        assert (kept[forest.parent] >= kept).all()
        # No single closed choice of one subtree does better.
        yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
        value = np.where(kept, yes, no).sum()
        for i in np.flatnonzero(~forest.root):
            other = kept.copy()
            if kept[i]:
                other[i : forest.end[i]] = False
            elif kept[forest.parent[i]]:
                other[i] = True
            assert np.where(other, yes, no).sum() <= value + 1e-9


def test_odd_pages(spark, trees):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "<article><p>one &amp; two</p></article>"), (4, "u", "no tags at all"),
        (5, "u", "<article><p>" + "long words here. " * 40_000 + "</p></article>"), (4, "u", "no tags at all"), (6, "u", "<div>" * 3000 + "deep"),
    ]
    pages = spark.createDataFrame([(*r, "t", "9") for r in rows], SCHEMA)
    out = extract.extract_main_text(pages, trees)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: r for r in out.collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[1]["n_chars"] == 0
    assert got[None]["text"] == "one & two"
    assert got[5]["n_chars"] == 17 * 40_000 - 1
    assert out.count() == 7
    assert extract.extract_main_text(pages.limit(0)).count() == 0


def test_boosting_learns_a_rule_of_two_features():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((model.log_odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
