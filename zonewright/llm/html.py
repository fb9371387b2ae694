"""HTML as a tree of block elements and the runs of text in them."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Fixed values of the HTML standard: elements without content, with raw content, and those that
# stand in a line of text; what else there is, is a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark meter nobr output picture "
    "progress q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements whose content is no text of the page.
UNSEEN = frozenset(
    "script style head title template noscript textarea select option button iframe object svg math canvas audio video "
    "noembed noframes xmp datalist optgroup".split()
)
# Unseen elements that cannot hold one of their own name: another opening tag takes their place.
UNNESTED = frozenset("button select option".split())
# Unseen elements that are not HTML inside: an opening tag of the second list ends them, unless an
# element of the third is open in them.
FOREIGN = frozenset("svg math".split())
NOT_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu nobr ol p pre ruby "
    "s small span strong strike sub sup table tt u ul var".split()
)
HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
# Elements that may stand in the head; any other ends it.
IN_HEAD = frozenset("base link meta noscript script style template title head html".split())
# An opening tag ends open elements of these names, up to the nearest of the others.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

# A quote opens a string only where a value begins, and only if it is closed; else it is a
# character like others, and the tag ends at the next ``>``.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))?+)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


@dataclass
class Node:
    """A block element, or (``tag`` empty) a run of text between blocks."""

    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...] = ()
    text: str = ""
    linked: int = 0


def name_tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case parts of an element's class, id and role."""
    out: list[str] = []
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label"):
            out += (p.lower() for p in _NAME_PART.findall(unescape(value.strip("\"'"))))
    return tuple(out)


class _Builder:
    def __init__(self) -> None:
        self.nodes = [Node("#root", -1, 0)]
        self.open: list[tuple[str, int]] = [("#root", 0)]
        self.links = 0
        self.run: list[tuple[str, bool]] = []

    def block(self) -> int:
        return self.open[-1][1]

    def end_run(self) -> None:
        """What has been read since the last block began or ended is a run of the open block."""
        if not self.run:
            return
        text = " ".join("".join(t for t, _ in self.run).split())
        if text:
            linked = sum(len(t.strip()) for t, in_link in self.run if in_link)
            at = self.block()
            self.nodes.append(Node("", at, self.nodes[at].depth + 1, (), text, linked))
        self.run = []

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            name, at = self.open[-1]
            if name == "a":
                self.links -= 1
            if at != self.open[-2][1]:
                self.end_run()
            self.open.pop()

    def find(self, names: tuple[str, ...], stop: tuple[str, ...] = ()) -> int:
        """Place on the stack of the innermost open element of one of ``names``, or 0."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] in names:
                return depth
            if self.open[depth][0] in stop:
                return 0
        return 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.run.append((" ", False))
            return
        inline = tag in INLINE
        if not inline and (depth := self.find(("p",), ("table", "button", "object"))):
            self.close_to(depth)
        if tag in ENDS and (depth := self.find(*ENDS[tag])):
            self.close_to(depth)
        if tag in VOID:
            if not inline:
                self.end_run()
            return
        if inline:
            self.open.append((tag, self.block()))
            self.links += tag == "a"
            return
        self.end_run()
        at = self.block()
        self.nodes.append(Node(tag, at, self.nodes[at].depth + 1, name_tokens(attributes)))
        self.open.append((tag, len(self.nodes) - 1))

    def end(self, tag: str) -> None:
        if depth := self.find((tag,)):
            # An inline end tag does not end blocks that it is outside of.
            if tag in INLINE and any(at != self.open[depth][1] for _, at in self.open[depth:]):
                return
            self.close_to(depth)


def parse(html: str) -> list[Node]:
    """Nodes in document order, the root first. Elements that are not seen are left out with all
    they hold; open elements end with the text; an unfinished tag at the end is no text. An element
    that is not seen and not closed ends with the block around it."""
    build = _Builder()
    at, hidden, raw = 0, "", ""
    hidden_depth = 0
    # What is open in the hidden element, as a stack and by name.
    inner: list[str] = []
    inside: Counter[str] = Counter()
    while at < len(html):
        if raw:
            end = re.compile(rf"</{re.escape(raw)}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            at, raw = (end.start() if end else len(html)), ""
            continue
        found = _TOKEN.search(html, at)
        if not hidden and (text := html[at : found.start() if found else len(html)]):
            build.run.append((unescape(text), build.links > 0))
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3)
        if not name:
            continue
        tag = name.lower()
        if hidden == "head" and not closing and tag not in IN_HEAD:
            hidden = ""
        if hidden in FOREIGN and not closing and tag in NOT_FOREIGN and not any(inside[t] for t in HTML_INSIDE):
            hidden = ""
        if hidden and closing and tag != hidden and not inside[tag] and (tag not in INLINE or hidden in FOREIGN):
            # A table's body may be closed that was never opened.
            if build.find((tag,)) and not (tag == "tbody" and inside["table"]):
                hidden = ""
        if hidden:
            if tag == hidden:
                if closing:
                    hidden_depth -= 1
                elif tag not in UNNESTED:
                    hidden_depth += 1
                if not hidden_depth:
                    hidden = ""
            elif closing:
                while inside[tag]:
                    last = inner.pop()
                    inside[last] -= 1
                    if last == tag:
                        break
            elif tag in RAW:
                raw = tag
            elif tag not in VOID:
                inner.append(tag)
                inside[tag] += 1
        elif closing:
            build.end(tag)
        elif tag in UNSEEN and not attributes.endswith("/"):
            hidden, hidden_depth = tag, 1
            inner, inside = [], Counter()
            raw = tag if tag in RAW else ""
        elif tag not in UNSEEN:
            build.start(tag, attributes)
    build.close_to(1)
    build.end_run()
    return build.nodes
