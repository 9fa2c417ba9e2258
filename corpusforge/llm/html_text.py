"""HTML extraction by tree scoring.

A page becomes a tree. Every paragraph passes points for its length and its commas to its parent, half of them to
the grandparent and so on upwards; a node's points are discounted by the share of its text that stands in links. The
best container is kept, with those of its siblings that look like parts of the same article; a container inside an
article or main element stands for that. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and comments are known by tag, role or the words of class and id, and outside of articles by lists that are nearly all
links; they neither score nor appear. All counts go up the tree once, from the last element to the first, so the time
grows with the page however deep it is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul head caption legend option select button noscript".split()
)
#: A start tag ends an open element of the same list, unless one of the second list stands between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)), "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
SCOPE = frozenset("table td th caption html body article section div button".split())
DROPPED = frozenset("nav header footer aside form button select input label fieldset dialog object embed canvas audio video map menu head".split())
#: Words of class and id that mark what isn't the article.
MARKS = frozenset(
    "nav navbar navigation navigator menu menubar header masthead footer sidebar aside ad ads adv advert adverts advertisement advertising adsense adslot banner banners cookie cookies consent gdpr notice notices notification notifications alert "
    "popup modal overlay promo sponsor sponsored comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager paging "
    "subscribe subscription newsletter signup login signin search searchbox searchform toolbar widget widgets copyright skip skiplink outbrain taboola tagcloud".split()
)
#: Words that also stand in the names of an article's own parts: they count for boxes outside of articles only.
WEAK_MARKS = frozenset("tags byline dateline rating print paywall form toc hidden promoted promotion foot note".split())
BOXES = frozenset("div section ul ol table aside span".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar note tablist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote div section article li dd main body".split())
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
#: What a tag is read on by: its end, or an attribute's opening quote.
TAG_STEP = re.compile(r""">|=\s*(["'])""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
LEAST_LENGTH = 25
PASSING = frozenset("ul ol dl blockquote".split())


class Node:
    __slots__ = ("tag", "parent", "dropped", "points", "chars", "linked", "links", "order", "kept", "scope", "opened", "article", "holder", "home")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, order: int) -> None:
        self.tag, self.parent, self.dropped, self.order = tag, parent, dropped, order
        #: the nearest element, itself included, that inline end tags don't reach beyond; it counts what is open in it
        self.scope = self if parent is None or tag in SCOPE else parent.scope
        self.opened: dict[str, int] | None = {} if self.scope is self else None
        self.article = tag == "article" or parent is not None and parent.article
        #: the nearest block, itself included
        self.holder = self if parent is None or tag in BLOCKS else parent.holder
        #: the nearest element, itself included, that points are given to: lists and quotations pass theirs on
        self.home = parent.home if parent is not None and tag in PASSING else self
        self.points, self.chars, self.linked, self.links, self.kept = 0.0, 0, 0, 0, False


def tag_end(page: str, at: int) -> int:
    """Position of the > that ends the tag starting at at; quoted ones don't count, unless a quote never closes. -1 if there is none."""
    here = at
    while step := TAG_STEP.search(page, here):
        if step[0] == ">":
            return step.start()
        closed = page.find(step[1], step.end())
        if closed < 0:
            return page.find(">", at)
        here = closed + 1
    return page.find(">", at)


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of any article."""
    weak = tag in BOXES and not in_article
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in WORDS.findall(one)]
                if any((w in MARKS or weak and w in WEAK_MARKS) and not (i and words[i - 1] in ("with", "has", "no", "without", "entry", "post", "article")) for i, w in enumerate(words)):
                    return True
        elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """All elements in page order, and the page's blocks of text: (element, text, characters in links)."""
    root = Node("#root", None, False, 0)
    nodes, blocks, now = [root], [], root
    pieces: list[str] = []
    holder, linked, anchor = root, 0, 0
    opened: dict[str, int] = {}
    at, size, lower = 0, len(page), None

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                blocks.append((holder, text, min(linked, len(text))))
        linked = 0

    def say(text: str) -> None:
        nonlocal holder, linked
        if not text or now.dropped:
            return
        text = html.unescape(text) if "&" in text else text
        if not pieces:
            holder = now.holder
        pieces.append(text)
        if anchor:
            linked += len(text.strip())

    def leave(node: Node) -> None:
        """Close now, and all above it up to node."""
        nonlocal now, anchor
        while True:
            if now.tag in BLOCKS:
                flush()
            if now.tag == "a":
                anchor = max(0, anchor - 1)
            opened[now.tag] -= 1
            above = (now.parent or root).scope.opened
            above[now.tag] -= 1
            last, now = now, now.parent or root
            if last is node:
                return

    def close(tags: tuple[str, ...], stops: tuple[str, ...] | frozenset[str]) -> None:
        # what isn't open isn't looked for: a walk up the tree that finds nothing would be made again and again
        if not any((now.scope.opened if stops is SCOPE else opened).get(t) for t in tags):
            return
        node = now
        while node.parent is not None and node.tag not in tags:
            if node.tag in stops:
                return
            node = node.parent
        if node.parent is not None:
            leave(node)

    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            say(page[at:])
            break
        say(page[at:tag])
        mark = page[tag + 1 : tag + 2]
        if mark == "!" or mark == "?":
            if page.startswith("<!--", tag):
                end = page.find("-->", tag + 2)
                at = end + 3 if end >= 0 else size
            else:
                end = page.find(">", tag)
                at = end + 1 if end >= 0 else size
            continue
        ending = mark == "/"
        found = NAME.match(page, tag + 1 + ending)
        if not found:
            if ending:
                end = page.find(">", tag)
                at = end + 1 if end >= 0 else size
            else:
                say("<")
                at = tag + 1
            continue
        end = tag_end(page, found.end())
        if end < 0:
            break
        name, at = found[0].lower(), end + 1
        if ending:
            if name == "br":
                say(" ")
            elif name not in VOID:
                if name in BLOCKS:
                    flush()
                node = now if (opened if name in BLOCKS else now.scope.opened).get(name) or now.tag == name else root
                while node.parent is not None and node.tag != name:
                    if name not in BLOCKS and node.tag in SCOPE:
                        break
                    node = node.parent
                if node.parent is not None and node.tag == name:
                    leave(node)
            continue
        if name in RAW and not page[end - 1 : end] == "/":
            lower = page.lower() if lower is None else lower
            shut = lower.find(f"</{name}", at) if len(lower) == size else page.find(f"</{name}", at)
            end = page.find(">", shut) if shut >= 0 else -1
            at = end + 1 if end >= 0 else size
            continue
        if name in BLOCKS:
            flush()
            close(("p",), SCOPE)
        if name in ENDS:
            close(*ENDS[name])
        if name == "br" or name == "hr":
            flush() if name == "hr" else say(" ")
            continue
        if name in VOID:
            continue
        if name == "a":
            close(("a",), SCOPE)
        opened[name] = opened.get(name, 0) + 1
        now.scope.opened[name] = now.scope.opened.get(name, 0) + 1
        now = Node(name, now, now.dropped or _unwanted(name, page[found.end() : end], now.article), len(nodes))
        nodes.append(now)
        if name == "a":
            anchor += 1
            now.links = 1
    flush()
    return nodes, blocks


def _above(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def best_nodes(nodes: list[Node], blocks: list[tuple[Node, str, int]]) -> list[Node]:
    """The best container and its kept siblings; empty without any text."""
    for node, text, linked in blocks:
        node.chars += len(text)
        node.linked += linked
    for node in reversed(nodes):  # children stand behind their parents
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.links += node.links
    for node in nodes:
        if not node.article and node.tag in ("ul", "ol", "dl", "table", "div", "p") and node.links >= 3 and node.linked >= 0.8 * node.chars:
            node.dropped = True
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
    for node, text, linked in blocks:
        if node.dropped or node.tag in HEADINGS or node.tag not in PARAGRAPHS:
            continue
        own = node if node.tag in ("div", "section", "article", "main", "td", "body") else node.parent.home
        own.points += (text.count(",") + text.count("，") + min(len(text) / 100, 3) + (len(text) >= LEAST_LENGTH)) * (1 - linked / len(text))
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.points += node.points / 2
    value = lambda n: n.points * (1 - n.linked / max(1, n.chars))
    usable = [n for n in nodes if not n.dropped and n.points > 0 and n.tag not in ("html", "#root")] or [n for n in nodes if not n.dropped and n.points > 0]
    if not usable:
        return [n for n in nodes[:1] if blocks]
    best = max(usable, key=lambda n: (value(n), -n.order))
    best = next((up for up in _above(best) if up.tag == "article"), None) or next((up for up in _above(best) if up.tag == "main"), best)
    kept = [best]
    least = max(4.0, 0.2 * value(best))
    for node in nodes:
        if node.parent is best.parent and node is not best and not node.dropped and best.tag not in ("body", "html"):
            good = node.tag == best.tag and value(node) >= least or node.tag in HEADINGS and best.tag != "article"
            if good or node.tag in ("p", "pre", "blockquote") and node.chars > 80 and node.linked < 0.25 * node.chars and best.tag != "article":
                kept.append(node)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by newlines; empty if there is none."""
    if not page:
        return ""
    nodes, blocks = parse(page)
    for node in best_nodes(nodes, blocks):
        node.kept = True
    for node in nodes:
        node.kept = (node.kept or node.parent is not None and node.parent.kept) and not node.dropped
    return "\n".join(text for node, text, _ in blocks if node.kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text and n_chars (code points of text), one row for each row; the page's html is not passed on.

    A null or empty page, and one without any article, gives an empty text. Pages are read whole whatever their
    length; broken markup is closed as browsers do. Character references are decoded, white space within a block
    becomes one space. Rows are independent: ties and repeats need no rule. Other columns are passed on.
    """

    @arrow_udf("string")
    def article(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()).encode("utf-8", "replace").decode() for x in column], pa.string())

    out = pages.withColumn("text", article(F.col(html_col))).withColumn("n_chars", F.length("text").cast("long"))
    return out.drop(html_col) if html_col != "text" else out
