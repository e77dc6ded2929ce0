"""Operator 2: main text of web pages by composite text density.

A page becomes a tree.  Elements that are never article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments of
readers) are cut off by tag, role or leading class name; none of these cuts an
article, as in an element that was never closed, where no other article stands,
and a form or a name cuts nothing that holds most of the text.  For every remaining node the
composite density relates its characters to its tags, weakened by the share of
link text; a node's density sum adds up its children's densities.  The subtree
with the largest sum is the content, the least density on its path to the body
being the threshold for what stands beside that path, runs of bare text included
(headings there, and paragraphs beside a chosen paragraph, need none).  An article or main around the content, or articles
that make up half of it, are kept whole.

Text: character references decoded, white space inside a block turned into one
space, blocks joined in page order by one space.

Edge cases: a null or empty html, or a page without article text, gives an
empty text; markup that is not closed, or broken off, is read as far as it
goes; a null page id or url stays null; repeated rows give repeated results;
only the three named columns are read; an empty table gives an empty table;
pages of any length and depth are read whole, in time that grows with their
length (the tree is walked without recursion, and no tag walks up twice).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary "
                  "table tbody td tfoot th thead tr ul".split())
PARAGRAPHS = frozenset(("p", "pre", "blockquote"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CUT_TAGS = frozenset("head script style noscript template button select textarea iframe object svg canvas audio video "
                     "title".split())
SOFT_TAGS = frozenset("nav aside footer dialog menu".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert".split())
CUT_NAMES = re.compile(
    r"(?:^|\s)(?:ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|sidebar|"
    r"side-bar|footer|masthead|site-header|page-header|comments?|disqus|replies|cookies?|consent|notice|popup|modal|"
    r"newsletter|subscribe|signup|share|sharing|social|related|recommended|widget|toolbar|skip-link|"
    r"pagination|pager)(?:$|\s|[_-](?!(?:open|opened|closed|visible|hidden|enabled|disabled|active|on|off)(?:$|\s)))", re.I)
#: Start tags that end an open paragraph; tags that end an open one of their group.
ENDS_P = BLOCK - {"br", "body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"} | {"li", "dd", "dt"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
_P = {"p"}
BARRIERS = frozenset(("article", "body", "main"))
SCOPE = frozenset("article section div main body html table td th ul ol dl blockquote aside nav header footer form".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.cut, self.named = tag, parent, cut, 0
        self.parts: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


class Page(HTMLParser):
    """Builds the tree; ``nodes`` holds parents before their children.

    What is open is counted by tag: in all (``counts``), since the innermost
    barrier for end tags of inline elements (``barriers``) and since the
    innermost scope for implied ends (``scopes``), so that a tag that closes
    nothing takes no walk, and a walk closes all that it passes."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html", None, False)
        self.nodes = [self.root]
        self.counts: Counter = Counter()
        self.barriers: list[Counter] = [Counter()]
        self.scopes: list[tuple[str, Counter]] = [("html", Counter())]
        self.feed(html)
        self.close()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        # As browsers do: everything up to the next ">" is no text.
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html" or tag == "body" and self.counts["body"]:
            return
        if tag in ENDS_P:
            self._end(_P)
        if tag in ENDS:
            self._end(ENDS[tag])
        about = dict(attrs)
        node = Node(tag, self.open, self.open.cut or _cut(tag, about))
        node.named = _named(tag, about, self.open)
        self.open.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open = node
            self.counts[tag] += 1
            self.barriers[-1][tag] += 1
            self.scopes[-1][1][tag] += 1
            if tag in BARRIERS:
                self.barriers.append(Counter())
            if tag in SCOPE:
                self.scopes.append((tag, Counter()))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash closes void elements only.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        # An inline element does not end across an article's, main's or the body's start.
        if (self.counts if tag in BLOCK else self.barriers[-1])[tag]:
            self._close({tag})

    def handle_data(self, data: str) -> None:
        self.open.parts.append(data)

    def _close(self, tags: set) -> None:
        """Close the nearest open element of these tags, and all inside it."""
        while True:
            n = self.open
            self.open = n.parent
            if n.tag in SCOPE:
                self.scopes.pop()
            if n.tag in BARRIERS:
                self.barriers.pop()
            self.counts[n.tag] -= 1
            self.barriers[-1][n.tag] -= 1
            self.scopes[-1][1][n.tag] -= 1
            if n.tag in tags:
                return

    def _end(self, tags: set) -> None:
        """Close the nearest open element of these tags in the same block."""
        scope, counts = self.scopes[-1]
        if scope in tags or any(counts[t] for t in tags):
            self._close(tags)


def _cut(tag: str, attrs: dict) -> bool:
    return tag in CUT_TAGS or attrs.get("hidden", 0) != 0 or attrs.get("aria-hidden") == "true"


#: How an element that is no article text by its tag, role or name is cut: even if it holds most of the text, or not.
BY_TAG, BY_NAME = 1, 2


def _named(tag: str, attrs: dict, parent: Node) -> int:
    """Whether tag, role, class or id say that the element is no article text."""
    if tag in ("article", "main", "body"):
        return 0
    # An article's own heading is text.
    if tag in SOFT_TAGS or tag == "header" and parent.tag != "article":
        return BY_TAG
    if (attrs.get("role") or "").lower() in CUT_ROLES:
        return BY_TAG
    if tag == "form":
        return BY_NAME
    return BY_NAME if tag != "header" and any(CUT_NAMES.search(attrs.get(k) or "") for k in ("class", "id")) else 0


def _cut_named(page: Page) -> None:
    """Cut the elements that tags, roles and names give away, but none that
    holds an article that stands nowhere else, as an element that was never
    closed does, and by its name or as a form none that holds most of the
    characters."""
    kept = [n for n in page.nodes if not n.cut]
    chars, holds, under = ({id(n): 0 for n in kept} for _ in range(3))
    for n in kept:
        under[id(n)] = n.parent is not None and bool(n.parent.named or under[id(n.parent)])
    for n in reversed(kept):
        chars[id(n)] += sum(_size(p) for p in n.parts if isinstance(p, str))
        holds[id(n)] += n.tag in ("article", "main")
        if n.parent is not None:
            chars[id(n.parent)] += chars[id(n)]
            holds[id(n.parent)] += holds[id(n)]
    free = {id(n) for n in kept if n.tag in ("article", "main") and not under[id(n)] and chars[id(n)]}
    above = {}          # free articles around a node
    most = chars[id(page.root)]
    for n in kept:
        above[id(n)] = 0 if n.parent is None else above[id(n.parent)] + (id(n.parent) in free)
        n.cut = n.parent is not None and n.parent.cut
        if n.named and not n.cut:
            if holds[id(n)] or n.named == BY_NAME and 2 * chars[id(n)] > most:
                n.cut = len(free) > above[id(n)]
            else:
                n.cut = True


def _size(text: str) -> int:
    return 0 if text.isspace() else len(text) - text.count(" ")


def density(chars: int, tags: int, link_chars: int, link_tags: int, linked: float) -> float:
    """Composite density; ``linked``: the body's share of link text."""
    if not chars:
        return 0.0
    t, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + linked * chars + math.e)
    return max(0.0, chars / t * math.log(chars / lc * t / lt) / max(math.log(base), 0.01))


def measure(page: Page) -> Node:
    """Fill in the densities; returns the body."""
    _cut_named(page)
    kept = [n for n in page.nodes if not n.cut]
    for n in reversed(kept):
        n.chars += sum(_size(p) for p in n.parts if isinstance(p, str))
        if n.tag == "a":
            n.link_chars = n.chars
            n.link_tags += 1
        if (up := n.parent) is not None:
            up.chars += n.chars
            up.tags += n.tags + 1
            up.link_chars += n.link_chars
            up.link_tags += n.link_tags
    body = next((n for n in kept if n.tag == "body"), page.root)
    linked = body.link_chars / max(body.chars, 1)
    for n in kept:
        if n.chars:
            n.density = density(n.chars, n.tags, n.link_chars, n.link_tags, linked)
        if n.parent is not None:
            n.parent.total += n.density
    return body


def content(body: Node, page: Page) -> list:
    """The nodes, and lists of parts for bare text, that hold the main text, in
    page order."""
    best = max((n for n in page.nodes if not n.cut and n.chars), key=lambda n: n.total, default=None)
    if best is None:
        return []
    path = []
    n = best
    while n is not None:
        path.append(n)
        if n is body:
            break
        n = n.parent
    threshold = min(x.density for x in path)
    # An article is not cut into parts: the chosen subtree is widened to the one
    # around it, or is the articles that make up half of it.
    chosen = {id(best)}
    around = next((x for x in path if x.tag in ("article", "main") and x.chars), None)
    if around is not None:
        chosen = {id(around)}
    else:
        below, article = {id(best)}, set()          # nodes under the chosen one; nodes in an article
        inner = []
        for n in page.nodes:
            if n.parent is not None:
                if id(n.parent) in below:
                    below.add(id(n))
                if n.parent.tag == "article" or id(n.parent) in article:
                    article.add(id(n))
            if n.tag == "article" and not n.cut and n.density >= threshold and id(n) in below and id(n) not in article:
                inner.append(n)
        if inner and 2 * sum(n.chars for n in inner) >= best.chars:
            chosen = {id(n) for n in inner}
    on_path = {id(x) for x in path}
    for n in page.nodes:
        if id(n) in chosen:
            while (n := n.parent) is not None and id(n) not in on_path:
                on_path.add(id(n))
    inside = on_path | chosen
    linked = body.link_chars / max(body.chars, 1)
    out: list = []
    todo: list = [path[-1]]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            out.append(x)
        elif id(x) in chosen:
            out.append(x)
        elif id(x) in on_path:
            todo.extend(reversed(_beside(x, inside, threshold, linked)))
        else:
            out.append(x)
    return out


def _beside(x: Node, inside: set, threshold: float, linked: float) -> list:
    """The parts of a path element to go into or keep: those of ``inside``,
    child elements and runs of bare text over the threshold, headings."""
    out: list = []
    run: list = []
    # Paragraphs beside a chosen one go with it however short, unless they are links.
    paragraphs = any(isinstance(c, Node) and c.tag in PARAGRAPHS and id(c) in inside for c in x.parts)

    def end() -> None:
        nodes = [p for p in run if isinstance(p, Node)]
        chars = sum(_size(p) if isinstance(p, str) else p.chars for p in run)
        if any(isinstance(p, str) and not p.isspace() for p in run) and density(
                chars, sum(n.tags + 1 for n in nodes if n.tag != "br"), sum(n.link_chars for n in nodes),
                sum(n.link_tags for n in nodes), linked) >= threshold:
            out.append(list(run))
        else:
            out.extend(n for n in nodes if n.chars and n.density >= threshold)
        run.clear()

    for c in x.parts:
        if isinstance(c, str):
            run.append(c)
        elif c.cut:
            continue
        elif id(c) in inside:
            end()
            out.append(c)
        elif c.tag == "br" or c.tag not in BLOCK:
            run.append(c)
        else:
            end()
            if c.chars and (c.density >= threshold or c.tag in HEADINGS
                            or paragraphs and c.tag in PARAGRAPHS and 2 * c.link_chars <= c.chars):
                out.append(c)
    end()
    return out


def text_under(node) -> str:
    out: list[str] = []
    todo: list = node[::-1] if isinstance(node, list) else [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut:
            edge = " " if x.tag in BLOCK else ""
            todo.append(edge)
            todo.extend(reversed(x.parts))
            out.append(edge)
    return " ".join("".join(out).split())


def main_text(html: str) -> str:
    page = Page(html)
    body = measure(page)
    return " ".join(filter(None, map(text_under, content(body, page))))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 2):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([main_text(h) for h in b.column(2).to_pylist()], pa.string())],
                ["page_id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_of(html).alias("html")).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
