"""Main-text extraction by tree scoring.

A page is parsed into a tree. Subtrees that by tag, role, hidden state or name are menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments go.
Every text block passes points (1, one for each comma, one for each 100 characters) to the
containers above it: all to the nearest, a half to the next, then a third and so on, up to
``REACH`` levels; a container's points are discounted by its share of link text. The container of the most
points is the best. An ``article`` or ``main`` element around it is kept with those siblings
that score at least a fifth of it (and headings directly before it). Without one, the best is
kept with all its siblings, be they blocks, leaves or bare text, but those of mostly link
text; a level further up is kept in the same way when text lies there directly or when the
best is in one of several like sections. The blocks of what is kept are the text.

A name counts in full where a class or id consists of such words, apart from words that only say where
or what kind of box it is (``site-footer``, ``ad-slot``). A class that joins them with other words
(``post-header``, ``notice-of-motion``, ``social-history``) only drops what its content does not speak for: an
element without an ``h1`` that is mostly links or, outside of an article, holds less than ``FEW_CHARS`` unlinked characters.

A name or a form does not drop an element that holds most of the page's unlinked text and
looks like the page's wrapper: it holds an ``h1``, or no ``h1`` is outside of it and it has
several blocks or four fifths of the text. With a name for reader comments it also has to hold
an ``h1`` or to have no text before it.

Inside a block runs of white space, line breaks and table cells become one space; blocks
are joined by an empty line.

Defined results: null and empty pages and pages without text give an empty text; a page
cut off inside a tag loses that tag only; very long and very deep pages are parsed whole; of
containers with equal points the one that text reaches first is the best; repeated rows are extracted each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template nav footer aside button select textarea input iframe object "
                    "embed svg canvas audio video dialog menu head title header".split())
LEAVES = frozenset("p pre blockquote li dd dt tr td th caption figcaption h1 h2 h3 h4 h5 h6 summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are text of the page wherever they lie, unless they are mostly links.
PROSE = LEAVES - {"tr", "td", "th"} | {"ul", "ol", "dl"}
BLOCKS = LEAVES - {"td", "th"} | frozenset(
    "html body div article section main header footer aside nav ul ol dl table thead tbody tfoot form fieldset figure "
    "address details hr center hgroup".split())
#: A start tag ends an open element of the same row without an end tag, up to the fence.
ENDED_BY = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"),
            "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDED_BY = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDED_BY.items()}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
NAMES = frozenset("""nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer sidebar aside
ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr
notice notification popup modal overlay newsletter subscribe subscription share sharing social related recommended
recommendations login signup search toolbar pagination pager widget""".split())
#: Words of a class or id that say nothing of the content; digits neither.
PLACES = frozenset("""site page main global primary secondary top bottom left right upper lower inner outer wrapper wrap container
box block slot unit area section panel bar list items item links link buttons button row col column group content body
js sticky fixed mobile desktop default style text""".split())
REACH = 64
FEW_CHARS = 200
REMARKS = frozenset("comment comments commentlist disqus respond replies".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "gone", "points", "chars", "linked", "in_link", "plain", "before",
                 "leaves", "titles", "block", "links")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.gone, self.points, self.chars, self.linked = False, 0.0, 0, 0
        self.in_link, self.plain, self.before, self.leaves, self.titles = False, 0, 0, 0, 0
        self.links = 0
        self.block = self if tag in BLOCKS or parent is None else parent.block  # the block element it lies in


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("html", {}, None)
        self.open: Counter[str] = Counter()     # open elements by tag, so that stray end tags cost nothing

    def _close(self, node: Node) -> None:
        """End ``node`` and everything open inside of it."""
        while self.here is not node:
            self.open[self.here.tag] -= 1
            self.here = self.here.parent
        self.open[node.tag] -= 1
        self.here = node.parent

    def _end(self, tags: frozenset[str], fence: frozenset[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        node = self.here
        while node.parent is not None and node.tag not in fence:
            if node.tag in tags:
                self._close(node)
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        block = self.here.block
        if block.parent is not None and (tag in BLOCKS and block.tag == "p" or tag in HEADINGS and block.tag in HEADINGS):
            self._close(block)
        if tag in HEADINGS and self.here.block.tag in HEADINGS:
            self._close(self.here.block)
        if tag in ENDED_BY:
            self._end(*ENDED_BY[tag])
        if tag == "html":
            return
        if tag == "body":
            self._end(frozenset(["head"]), frozenset())
        node = Node(tag, dict(attrs), self.here)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        node = self.here
        while node.parent is not None and node.tag != tag:
            if node.tag in ("td", "th", "table") and tag not in BLOCKS:
                return
            node = node.parent
        if node.parent is not None:
            self._close(node)

    def handle_data(self, data):
        self.here.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(_CUT_TAG.sub("", html))
    builder.close()
    return builder.root


def _names(node: Node) -> set[str]:
    return {w.lower() for k in ("class", "id") for w in _NAME.findall(node.attrs.get(k) or "")}


def _named_as_part(node: Node) -> bool:
    """Whether some class or id consists of names of page parts, apart from words for places."""
    for k in ("class", "id"):
        for token in (node.attrs.get(k) or "").split():
            words = {w.lower() for w in _NAME.findall(token)} - PLACES
            if words and words <= NAMES:
                return True
    return False


def _speaks_for_itself(node: Node, in_article: bool) -> bool:
    """Whether content outweighs a name that is only part of a class: a title, or text that is not mostly links."""
    if node.titles:
        return True
    return 2 * node.links <= node.plain + node.links and (in_article or node.plain >= FEW_CHARS)


def _walk(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def _measure(nodes: list[Node]) -> None:
    """Unlinked characters in and before every element that is not gone; its leaves with such text, its h1."""
    def own(node: Node, text: str) -> int:
        return 0 if node.gone or node.in_link else len("".join(text.split()))

    def own_links(node: Node, text: str) -> int:
        return len("".join(text.split())) if node.in_link and not node.gone else 0

    for node in nodes:
        node.in_link = node.tag == "a" or node.parent is not None and node.parent.in_link
    for node in reversed(nodes):
        node.plain += sum(own(node, c) for c in node.children if isinstance(c, str))
        node.links += sum(own_links(node, c) for c in node.children if isinstance(c, str))
        node.leaves += node.tag in LEAVES and node.plain > 0
        node.titles += node.tag == "h1" and not node.gone
        if node.parent is not None:
            up = node.parent
            up.plain, up.leaves, up.titles = up.plain + node.plain, up.leaves + node.leaves, up.titles + node.titles
            up.links += node.links
    for node in nodes:
        at = node.before
        for c in node.children:
            if isinstance(c, str):
                at += own(node, c)
            else:
                c.before = at
                at += c.plain


def _wraps_page(node: Node, page: Node, remarks: bool) -> bool:
    """Whether a name or form match means the wrapper of the page and not a part beside its text."""
    if 2 * node.plain <= page.plain:
        return False
    if node.titles:
        return True
    return not page.titles and (node.leaves > 1 or 5 * node.plain >= 4 * page.plain) and not (remarks and node.before)


def _prune(nodes: list[Node], by_name: bool) -> None:
    holds_article = set()
    for node in nodes:
        if node.tag in ("article", "main") and not REMARKS & _names(node):
            up = node
            while up is not None and id(up) not in holds_article:
                holds_article.add(id(up))
                up = up.parent
    for node in nodes:
        attrs = node.attrs
        gone = (node.parent is not None and node.parent.gone) or node.tag in DROPPED
        gone = gone or "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style") or ""))
        node.gone = gone or (attrs.get("role") or "").lower() in ROLES
    _measure(nodes)
    inside: set[int] = set()     # what lies in an article
    for node in nodes:
        if node.tag in ("article", "main") or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
    for node in nodes:
        node.gone = node.gone or node.parent is not None and node.parent.gone
        if node.gone:
            continue
        if node.tag == "form" or (node.attrs.get("role") or "").lower() == "form":
            node.gone = not _wraps_page(node, nodes[0], False)
        if not node.gone and by_name and node.tag not in ("html", "body", "main"):
            names = _names(node)
            remarks = bool(names & REMARKS)
            part = bool(names & NAMES) and id(node) not in holds_article and (
                _named_as_part(node) or not _speaks_for_itself(node, id(node) in inside))
            node.gone = (remarks or part) and not _wraps_page(node, nodes[0], remarks)
    for node in nodes:  # the headline of an article stays, though it is in the article's header
        if node.tag in HEADINGS and node.gone:
            up, inside = node.parent, False
            while up is not None and (up.tag == "header" or not up.gone) and up.tag != "article":
                inside |= up.tag == "header"
                up = up.parent
            if inside and up is not None and up.tag == "article" and not up.gone:
                up = node
                while up.tag != "article":
                    up.gone = False
                    up = up.parent
                for k in node.parent.children:
                    if not isinstance(k, str) and k.tag not in HEADINGS:
                        k.gone = True


def _text_blocks(root: Node):
    """(text, link characters, block element) of every block below ``root`` in page order."""
    out, parts, linked = [], [], 0

    def flush(owner: Node) -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, min(linked, len(text)), owner))
        parts, linked = [], 0

    # a stack of (node, next child, inside a link); iterative, for pages can be nested deeply
    owner_of = [root]
    todo = [(root, iter(root.children), root.tag == "a")]
    while todo:
        node, rest, in_link = todo[-1]
        child = next(rest, None)
        if child is None:
            todo.pop()
            if node.tag in BLOCKS or node is root:
                flush(owner_of.pop())
            elif node.tag in ("td", "th"):
                parts.append(" ")
        elif isinstance(child, str):
            if not (node.tag == "header" and node is not root):
                parts.append(child)
                linked += len(" ".join(child.split())) if in_link else 0
        elif child.gone:
            continue
        elif child.tag in ("br", "hr"):
            parts.append(" ")
        elif child.tag not in VOID:
            if child.tag in BLOCKS:
                flush(owner_of[-1])
                owner_of.append(child)
            todo.append((child, iter(child.children), in_link or child.tag == "a"))
    return out


def _score(root: Node) -> Node | None:
    """Give all containers their points; the best one."""
    found, seen = [], set()
    for text, linked, owner in _text_blocks(root):
        points = 1 + sum(text.count(c) for c in ",،、，") + len(text) / 100
        node = owner.parent if owner.tag in LEAVES and owner.parent is not None else owner
        node.chars += len(text)
        node.linked += linked
        found.append(node)
        level = 1
        while node is not None and level <= REACH:
            node.points += points / level
            level += node.tag not in ("ul", "ol", "dl", "table", "tbody", "thead", "tr", "li", "dd", "blockquote")
            node = node.parent
    containers = []
    for node in found:          # in the order in which blocks first reach them
        while node is not None and id(node) not in seen:
            seen.add(id(node))
            containers.append(node)
            node = node.parent
    for node in reversed(_walk(root)):
        if node.parent is not None and node is not root:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    for node in containers:
        node.points *= 1 - node.linked / node.chars
    return max(containers, key=lambda n: n.points, default=None)


def _link_dense(node: Node) -> bool:
    blocks = _text_blocks(node)
    return 2 * sum(linked for _, linked, _ in blocks) > sum(len(text) for text, _, _ in blocks)


def _around(best: Node) -> list[str]:
    """The blocks of ``best`` and of what belongs to it on its level and above."""
    def like(node: Node, other: Node) -> bool:
        same = other.tag == "section" or (node.attrs.get("class") or "") == (other.attrs.get("class") or "") != ""
        return node.tag == other.tag and other.chars > 0 and (same or 5 * other.points >= best.points)

    def belongs(node: Node, other: Node | str) -> bool:
        if isinstance(other, str):
            return bool(other.strip())
        return other is not node and not other.gone and (other.tag in PROSE or like(node, other)) and bool(
            _text_blocks(other)) and not _link_dense(other)

    path, levels, node = [best], 1, best
    while node.parent is not None:
        path.append(node.parent)
        if len(path) > 2 and any(belongs(node, c) for c in node.parent.children):
            levels = len(path) - 1
        node = node.parent
    path = path[:levels + 1]
    for node, up in zip(path, path[1:]):
        stays = False  # what follows; a linked headline stays with its text
        for c in reversed(up.children):
            if not isinstance(c, str) and not c.gone and (c.tag in BLOCKS or c.chars) and _text_blocks(c):
                c.gone = c is not node and _link_dense(c) and not (c.tag in HEADINGS and stays)
                stays = not c.gone
    upper = {id(node) for node in path[1:]}  # their own runs of text and links are siblings as well
    return [text for text, linked, owner in _text_blocks(path[-1]) if id(owner) not in upper or 2 * linked <= len(text)]


def main_text(html: str | None) -> str:
    """The text blocks of the page's main content, joined by two line feeds."""
    if not html:
        return ""
    for by_name in (True, False):
        root = parse(html)
        _prune(_walk(root), by_name)
        best = _score(root)
        if best is not None:
            break
    else:
        return ""
    marked = None
    for tag in ("article", "main"):
        up = best
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None:
            marked = up
            break
    if marked is None:
        return "\n\n".join(_around(best))
    best, kept = marked, [marked]
    if best.parent is not None:
        siblings = [c for c in best.parent.children if not isinstance(c, str) and not c.gone]
        at = siblings.index(best)
        kept = []
        for k, node in enumerate(siblings):
            heading = node.tag in ("h1", "h2") and all(s.tag in HEADINGS for s in siblings[k:at])
            worth = node.points >= best.points / 5 and node.chars > 0 and node.tag not in LEAVES
            if node is best or k < at and heading or worth:
                kept.append(node)
    return "\n\n".join(text for node in kept for text, _, _ in _text_blocks(node))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
