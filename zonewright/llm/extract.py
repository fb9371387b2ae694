"""The main text of web pages: boosted trees over DOM nodes, decoded over the tree as a whole."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm import boosting
from zonewright.llm.common import small_batches
from zonewright.llm.html import Node, parse

# Pages of the table that the trees are fitted on at most, chosen by hash from those of at most
# so many characters, and pages that are composed from their sentences.
SAMPLE = 300
SAMPLE_CHARS = 200_000
COMPOSED = 700
SEED = 5

# Name parts (of class, id and role) and elements that tell a block's purpose.
NAMES = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs sitemap skip links",
    "head": "header masthead topbar logo branding site hero tagline",
    "foot": "footer copyright legal bottom colophon imprint credits",
    "side": "sidebar aside side rail widget widgets complementary related recommended recommendations popular trending teaser",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall warning toast",
    "form": "form search login signin register field input contact",
    "comment": "comment comments commentlist reply replies respond response discussion disqus thread feedback",
    "share": "share social sharing follow tags toolbar print tools",
    "main": "article content main post entry story body text prose page",
}
ELEMENTS = {
    "nav": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form",
    "dialog": "notice", "menu": "nav", "article": "main", "main": "main",
}
KINDS = list(NAMES)
_KIND_OF = {name: i for i, kind in enumerate(KINDS) for name in NAMES[kind].split()}
_MARK = "\x01"


@lru_cache(maxsize=100_000)
def purpose(tag: str, tokens: tuple[str, ...]) -> tuple[float, ...]:
    """How often each purpose is named by an element and its attributes."""
    out = [0.0] * len(KINDS)
    if tag in ELEMENTS:
        out[KINDS.index(ELEMENTS[tag])] += 2
    for t in tokens:
        if t in _KIND_OF:
            out[_KIND_OF[t]] += 1
    return tuple(out)


class Forest:
    """The nodes of many pages as arrays, each page's in document order, so that a subtree is a
    range of nodes."""

    def __init__(self, pages: list[list[Node]]) -> None:
        nodes = [n for page in pages for n in page]
        starts = np.cumsum([0, *map(len, pages)])
        self.first = np.repeat(starts[:-1], [len(p) for p in pages])
        self.last = np.repeat(starts[1:], [len(p) for p in pages])
        self.depth = np.array([n.depth for n in nodes], dtype=np.int64)
        parent = np.array([n.parent for n in nodes], dtype=np.int64)
        self.parent = np.where(parent >= 0, parent + self.first, np.arange(len(nodes)))
        self.root = parent < 0
        self.nodes = nodes
        # A subtree ends where the next node that is not deeper begins.
        self.end = np.empty(len(nodes), dtype=np.int64)
        stack: list[int] = []
        depth = self.depth.tolist()
        for i, d in enumerate(depth):
            while stack and depth[stack[-1]] >= d:
                self.end[stack.pop()] = i
            stack.append(i)
        for i in stack:
            self.end[i] = len(nodes)
        self.levels = [np.flatnonzero(self.depth == d) for d in range(1, int(self.depth.max(initial=0)) + 1)]

    def subtree(self, value: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros((1, *value.shape[1:])), np.cumsum(value, axis=0)))
        return sums[self.end] - sums[: len(value)]

    def features(self) -> np.ndarray:
        nodes, parent, n = self.nodes, self.parent, len(self.nodes)
        own = np.array([purpose(x.tag, x.tokens) for x in nodes]).reshape(n, len(KINDS))
        above = own.copy()
        for level in self.levels:
            above[level] += above[parent[level]]
        above -= own
        chars = np.array([len(x.text) for x in nodes], dtype=float)
        linked = np.array([x.linked for x in nodes], dtype=float)
        words = np.array([x.text.count(" ") + 1 if x.text else 0 for x in nodes], dtype=float)
        stops = np.array([x.text.count(".") + x.text.count(",") for x in nodes], dtype=float)
        elements = np.array([x.tag != "" for x in nodes], dtype=float)
        is_ = {
            name: np.array([x.tag in tags for x in nodes], dtype=float)
            for name, tags in {
                "text": {""}, "p": {"p"}, "heading": {"h1", "h2", "h3", "h4", "h5", "h6"}, "item": {"li", "dd", "dt"},
                "list": {"ul", "ol", "dl"}, "table": {"table", "tbody", "thead", "tr", "td", "th"}, "box": {"div", "section"},
                "page": {"html", "body", "#root"}, "quote": {"blockquote", "pre", "figure", "figcaption"},
            }.items()
        }
        many = self.subtree(np.stack([chars, linked, words, stops, elements, is_["p"], is_["item"], is_["heading"]], axis=1))
        all_chars, all_linked, all_words, all_stops, all_elements = many[:, :5].T
        below = np.concatenate((self.subtree(own) - own, above), axis=1)
        whole = all_chars[self.first]
        # Sisters: nodes of one parent in order; runs of equal parents after a stable sort.
        order = np.lexsort((np.arange(n), parent))
        place = np.empty(n)
        group = np.concatenate(([True], parent[order][1:] != parent[order][:-1])) if n else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(group, np.arange(n), 0)) if n else np.zeros(0, int)
        place[order] = np.arange(n) - begin
        sisters = np.bincount(parent, minlength=n)[parent].astype(float)
        before, after = np.zeros(n), np.zeros(n)
        if n > 1:
            same = ~group[1:]
            before[order[1:]] = np.where(same, all_chars[order[:-1]], 0)
            after[order[:-1]] = np.where(same, all_chars[order[1:]], 0)
        safe = np.maximum(all_chars, 1)
        columns = [
            *is_.values(), *many[:, 5:].T,
            self.depth, place, sisters, place / np.maximum(sisters, 1),
            np.log1p(all_chars), np.log1p(all_words), all_linked / safe, all_stops / np.maximum(all_words, 1),
            all_chars / np.maximum(all_words, 1), all_elements, all_chars / np.maximum(all_elements, 1),
            all_chars / np.maximum(whole, 1), all_chars / np.maximum(all_chars[parent], 1),
            np.log1p(before), np.log1p(after), np.log1p(chars),
            (np.arange(n) - self.first) / np.maximum(self.last - self.first, 1),
            all_linked[parent] / np.maximum(all_chars[parent], 1), own[parent].sum(axis=1),
        ]
        return np.concatenate((own, below, np.stack(columns, axis=1)), axis=1)

    def kept(self, log_odds: np.ndarray) -> np.ndarray:
        """The likeliest choice of nodes in which no node is kept below one that is not: a node is
        worth keeping if it and the best of its subtree are likelier than none of it."""
        z = np.clip(log_odds, -12, 12)
        yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
        drop = self.subtree(no)
        keep = yes.copy()
        for level in reversed(self.levels):
            np.add.at(keep, self.parent[level], np.maximum(keep[level], drop[level]))
        out = keep > drop
        out[self.root] = True
        for level in self.levels:
            out[level] &= out[self.parent[level]]
        return out

    def texts(self, kept: np.ndarray) -> list[str]:
        out: list[list[str]] = [[] for _ in range(int(self.root.sum()))]
        page = np.cumsum(self.root) - 1
        for i in np.flatnonzero(kept):
            if self.nodes[i].text:
                out[page[i]].append(self.nodes[i].text)
        return [" ".join(t) for t in out]


class Composer:
    """Pages with known main text, from sentences of the given pages: blocks of every purpose, under
    their usual elements and names or none, around and inside an article."""

    def __init__(self, sentences: list[str], seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.sentences = sentences or ["Text"]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def sentence(self) -> str:
        return self.pick(self.sentences)

    def lines(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(int(self.rng.integers(low, high + 1))))

    def brief(self) -> str:
        return " ".join(self.sentence().split()[: int(self.rng.integers(1, 5))])

    def links(self) -> str:
        n = int(self.rng.integers(2, 10))
        if self.chance(0.7):
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.brief()}</a></li>' for i in range(n)) + "</ul>"
        return " | ".join(f'<a href="/{i}">{self.brief()}</a>' for i in range(n))

    def box(self, kind: str, inside: str, semantic: float = 0.5) -> str:
        tags = [t for t, k in ELEMENTS.items() if k == kind and t not in ("menu", "fieldset")]
        noise = self.pick(["", "", "wrap", "box", "inner", "col", "module", "container"])
        if tags and self.chance(semantic):
            tag, names = self.pick(tags), noise
        else:
            tag = self.pick(["div", "div", "section"])
            names = self.pick(["{0}", "{0} {1}", "{0}-{1}", "{1}-{0}", "{0}_box"]).format(
                self.pick(NAMES[kind].split()), noise or "block"
            )
        attribute = f' {self.pick(["class", "class", "id"])}="{names}"' if names else ""
        return f"<{tag}{attribute}>{inside}</{tag}>"

    def aside(self, kind: str) -> str:
        rng = self.rng
        title = f"<{self.pick(['h2', 'h3', 'h4'])}>{self.brief()}</{self.pick(['h2', 'h3', 'h4'])}>" if self.chance(0.4) else ""
        if kind == "nav":
            inside = self.links()
        elif kind == "head":
            inside = f'<a href="/">{self.brief()}</a>' + (f"<p>{self.sentence()}</p>" if self.chance(0.5) else "") + (self.links() if self.chance(0.4) else "")
        elif kind == "foot":
            inside = self.pick(["&copy; {0} &middot; {1}", "<p>{1}</p><p>{0}</p>", "<p>&copy; {1}</p>"]).format(self.brief(), self.lines(1, 3)) + (self.links() if self.chance(0.4) else "")
        elif kind == "side":
            inside = title + (self.links() if self.chance(0.6) else "".join(f"<p>{self.lines(1, 4)}</p>" for _ in range(int(rng.integers(1, 4)))))
        elif kind == "comment":
            one = ["<div class=\"comment\"><b>{0}</b><p>{1}</p></div>", "<li><p>{0}</p><p>{1}</p></li>", "<p>{1}</p>", "<article><h4>{0}</h4><p>{1}</p></article>"]
            form = self.pick(one)
            inside = title + "".join(form.format(self.brief(), self.lines(1, 6)) for _ in range(int(rng.integers(1, 7))))
        elif kind == "form":
            inside = f"<label>{self.brief()}</label><input name=q>" + (f"<p>{self.lines(1, 2)}</p>" if self.chance(0.5) else "") + f"<button>{self.brief()}</button>"
        elif kind == "share":
            inside = " ".join(f'<a href="#">{self.brief()}</a>' for _ in range(3))
        else:
            inside = title + self.pick(["{0}", "<p>{0}</p>", "<p>{0}</p><p>{0}</p>"]).format(self.lines(1, 4))
        return self.box(kind, inside)

    def article(self) -> str:
        rng = self.rng

        def main(text: str) -> str:
            return _MARK + text

        parts = []
        if self.chance(0.85):
            h = f"<h1>{main(self.pick([self.brief(), self.sentence()]))}</h1>"
            parts.append(f"<header>{h}</header>" if self.chance(0.15) else h)
        for _ in range(int(rng.integers(1, 13))):
            form = rng.random()
            text = self.lines(1, 7)
            if form < 0.55:
                parts.append(f"<p>{main(text)}</p>")
            elif form < 0.65:
                parts.append(f"<p><b>{main(self.sentence())}<br><p>{main(text)}</p>")
            elif form < 0.72:
                parts.append(f"<h2>{main(self.brief())}</h2><p>{main(text)}")
            elif form < 0.8:
                items = "".join(f"<li>{main(self.sentence())}</li>" for _ in range(int(rng.integers(2, 5))))
                parts.append(f"<ul>{items}</ul>")
            elif form < 0.85:
                parts.append(f"<blockquote><p>{main(text)}</p></blockquote>")
            elif form < 0.89:
                cells = "".join(f"<tr><td>{main(self.brief())}</td><td>{main(self.brief())}</td></tr>" for _ in range(3))
                parts.append(f"<table>{cells}</table>")
            elif form < 0.93:
                parts.append(f"<p>{main(self.brief())}</p>")
            elif form < 0.96:
                parts.append(f'<p>{main(self.sentence())} <a href="/x">{self.brief()}</a> {self.sentence()}</p>')
            else:
                parts.append(f"<div>{main(text)}</div>")
            if self.chance(0.07):
                parts.append(self.aside(self.pick(["advert", "advert", "share", "side", "notice", "nav", "form"])))
        inside = "".join(parts)
        if self.chance(0.1):
            inside += self.aside(self.pick(["comment", "share", "foot"]))
        wrapped = self.pick(["<article>{0}</article>"] * 3 + ["<main>{0}</main>", "<main><article>{0}</article></main>", "{1}", "{1}", "{1}", "<div>{0}</div>"])
        return wrapped.format(inside, self.box("main", inside, 0.0))

    def page(self) -> str:
        before = [k for k, p in (("notice", 0.25), ("head", 0.45), ("nav", 0.75), ("advert", 0.45), ("form", 0.15), ("side", 0.15)) if self.chance(p)]
        after = [k for k, p in (("share", 0.2), ("advert", 0.2), ("comment", 0.35), ("side", 0.35), ("nav", 0.1), ("form", 0.15), ("notice", 0.15), ("foot", 0.8)) if self.chance(p)]
        if self.chance(0.2):
            self.rng.shuffle(before)
        body = "".join(self.aside(k) for k in before) + self.article() + "".join(self.aside(k) for k in after)
        for _ in range(int(self.rng.integers(0, 3))):
            body = f'<div class="{self.pick(["wrapper", "container", "page", "layout", "outer", "row"])}">{body}</div>'
        return f"<html><head><title>{self.brief()}</title></head><body>{body}</body></html>"


def known_from_elements(page: list[Node]) -> list[bool] | None:
    """Which runs of text are the article's, for a page that marks it up: those in its article or
    main element and in none of another purpose. None if it has no such element."""
    if not any(n.tag in ("article", "main") for n in page):
        return None
    inside, out = [], []
    for n in page:
        up = inside[n.parent] if n.parent >= 0 else 0
        named = purpose(n.tag, n.tokens)
        other = max(v for v, k in zip(named, KINDS, strict=True) if k != "main") > 0
        # 0 outside, 1 inside, -1 inside something else.
        state = -1 if up < 0 or other else 1 if up or n.tag in ("article", "main") else 0
        inside.append(state)
        out.append(bool(n.text) and state > 0)
    return out


def fit(htmls: list[str]) -> boosting.Trees:
    """Trees for the nodes of marked-up sample pages and of pages composed from their sentences. A
    node counts as content if there is main text in it."""
    real = [parse(h) for h in htmls]
    sentences = [s.strip() + "." for page in real for n in page for s in n.text.split(". ") if 2 < len(s) < 400]
    composer = Composer(sentences[:20_000], SEED)
    pages, runs = [], []
    for page in real:
        known = known_from_elements(page)
        if known is not None:
            pages.append(page)
            runs += known
    for _ in range(COMPOSED):
        page = parse(composer.page())
        runs += [_MARK in n.text for n in page]
        for n in page:
            n.text = n.text.replace(_MARK, "")
        pages.append(page)
    forest = Forest(pages)
    label = (forest.subtree(np.asarray(runs, dtype=float)) > 0).astype(float)
    size = (forest.last - forest.first).astype(float)
    return boosting.fit(forest.features(), label, 1.0 / np.sqrt(size) * np.sqrt(size.mean()))


def fit_on(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> boosting.Trees:
    """The trees fitted on ``SAMPLE`` pages at most, those with the smallest hash of their key. Of
    large tables only about twice as many rows, by hash, are sorted and reach the driver."""
    whole, scale = F.col(html).cast("string"), 1 << 30
    rows = pages.where(F.length(whole) <= SAMPLE_CHARS).select(
        F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(scale)).alias("h"), F.xxhash64(whole).alias("g"), whole.alias("html")
    )
    rows = rows.where(F.col("h") < int(scale * min(1.0, 2 * SAMPLE / max(1, pages.count()))))
    return fit([r["html"] for r in rows.orderBy("h", "g").limit(SAMPLE).collect()])


def main_texts(htmls: list[str | None], trees: boosting.Trees) -> list[str]:
    forest = Forest([parse(h or "") for h in htmls])
    if not len(forest.nodes):
        return []
    return forest.texts(forest.kept(trees.log_odds(forest.features())))


def extract_main_text(
    pages: DataFrame, trees: boosting.Trees | None = None, *, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``key, url, text, n_chars`` for every row of ``pages``.

    A page is parsed into block elements and runs of text. Trees, fitted once on a bounded sample
    unless given, score each node from its element, the parts of its class, id and role, its
    depth, its sisters and what its subtree holds. Then the likeliest choice of nodes is taken
    in which nothing is kept inside what is dropped. The kept runs, character references
    decoded and white space drawn together, are joined by a space in page order.

    A null or empty html, and one without main text, gives an empty text; a null key or url
    stays; repeated rows are repeated; no rows give no rows. Other columns are not looked at.
    """
    known = trees or fit_on(pages, key=key, html=html)

    @F.pandas_udf("string")
    def main_text(htmls: pd.Series) -> pd.Series:
        # In portions, as a batch of long pages has many nodes.
        return pd.Series([t for at in range(0, len(htmls), 100) for t in main_texts(htmls.iloc[at : at + 100].tolist(), known)], dtype=object)

    small_batches(pages.sparkSession)
    return pages.select(
        F.col(key), F.col(url), main_text(F.col(html).cast("string")).alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
