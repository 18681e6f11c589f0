"""Main text of web pages by scoring the element tree.

A page is cut into tags and text and built into a tree that mends the usual
faults (missing end tags, stray end tags, a cut-off page).  Parts that are never
main text - menus, headers, footers, sidebars, notices, adverts, forms, reader
comments - are recognised by element, role or the words of class and id and left
out; inside an article or main element only by words that name such a part and
nothing else, and never a heading.  A mark is weak where it may mean something else:
a form element, or a name that a class or id holds beside other words.  A weak mark
does not count for an element with more than half of the page's paragraph points:
that is a frame around the page's text.

Every paragraph passes points for its length and its commas to the elements
around it, less to farther ones; an element's points are discounted by the share
of its text that lies in links.  The element with most points is the container; if
an article or main element surrounds it, that is.  Siblings with a fair share of
the points, paragraphs with few links or headings are kept with it.

Pages are independent rows: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import utf8, with_result

# Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("annotation annotation-xml iframe noembed noframes noscript object script style "
                "svg template textarea title xmp".split())
BLOCK = frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu
    nav ol optgroup option p pre search section select summary table tbody td tfoot th thead
    title tr ul
""".split())
NEVER_MAIN = frozenset("""
    aside audio button canvas datalist dialog fieldset footer form head input menu nav option
    search select video
""".split())
# Elements that often frame a whole page's text.
WEAK_ELEMENTS = frozenset(("fieldset", "form"))
CONTAINERS = frozenset(("article", "main"))
LISTS = frozenset(("ul", "ol", "table"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPHS = frozenset("blockquote dd div p pre section td article main body li".split())
# an opening tag of the key closes an open element of the values, up to the border
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
          "tbody": ("tr", "td", "th", "thead", "tbody"),
          "tfoot": ("tr", "td", "th", "tbody", "thead")}
BORDERS = frozenset("table ul ol dl select article section div body main blockquote".split())
ROLES = frozenset("""
    alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar
""".split())
# Words of class and id that mark what is no main text.
JUNK = frozenset("""
    ad ads advert advertisement advertising adverts banner bottombar breadcrumb breadcrumbs byad
    comment commentlist comments consent cookie cookies copyright dialog discussion disqus
    disclaimer foot footer gdpr header login masthead menu menus modal nav navbar navigation
    navigations newsletter notice notices notification overlay pager pagination paywall popup
    promo promoted promotion recommended related replies reply respond responses share sharing
    sidebar signup skip skyscraper social sponsor sponsored sponsors subscribe subscription teaser
    toolbar topbar widget widgets
""".split())
# Words of class that inside an article may be about its text.
PROSE = frozenset("""
    copyright dialog disclaimer discussion foot header promoted promotion recommended related
    response responses social teaser
""".split())
# Whole ids that mark no main text inside an article; others may repeat a heading.
MARKS = frozenset("""
    ad ads advert advertisement adverts breadcrumb breadcrumbs commentlist comments disqus footer
    masthead menu menus nav navbar newsletter pager pagination sidebar toolbar topbar
""".split())
MAIN_WORDS = frozenset("article content entry main post story text".split())
NEGATIONS = frozenset("free has no with without".split())
BESIDE = frozenset("ad ads footer header menu nav sidebar widget widgets".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Least length of a text that counts as a paragraph.
PARAGRAPH = 25
#: Elements around a paragraph that get points from it.
LEVELS = 5


# What a mark says: no main text, or perhaps none.
STRONG, WEAK = 2, 1


class Node:
    """An element; ``inside`` is the nearest article or main element around it, itself
    included, and ``junk`` the strongest mark of it and the elements around it."""

    __slots__ = ("tag", "parent", "parts", "mark", "junk", "inside", "length", "linked", "points")

    def __init__(self, tag, parent, mark=0):
        self.tag, self.parent, self.mark = tag, parent, mark
        self.junk = max(mark, parent.junk if parent else 0)
        self.inside = self if tag in CONTAINERS else parent.inside if parent else None
        self.parts: list = []  # texts and nodes in page order
        self.length = self.linked = 0
        self.points = 0.0


def _mark(tag: str, attributes: str, around: Node) -> int:
    """Whether an element is marked as no main text, and how surely."""
    whole = around.inside is not None
    found = 0
    if tag in NEVER_MAIN or (tag == "header" and not whole):
        if tag not in WEAK_ELEMENTS:
            return STRONG
        found = WEAK
    if not attributes or tag in ("body", "html") or tag in CONTAINERS:
        return found
    lowered = attributes.lower()
    if not any(k in lowered for k in ("class", "id", "role", "hidden", "style")):
        return found
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if (values.get("role", "").lower() in ROLES or values.get("aria-hidden", "").lower() == "true"
            or "hidden" in values or _HIDDEN.search(values.get("style", ""))):
        return STRONG
    if tag in HEADINGS:
        return found
    named, mark = values.get("class", ""), values.get("id", "")
    if whole and mark.strip().lower() in MARKS:
        return STRONG
    words = {w.lower() for w in _WORDS.findall(named if whole else f"{named} {mark}")}
    junk = words & JUNK
    if whole:
        junk -= PROSE
        if tag not in BLOCK:  # a comment in printed code
            junk -= {"comment"}
    if words & NEGATIONS:  # a frame that names what stands beside it
        junk -= BESIDE
    if words & MAIN_WORDS:
        junk -= {"header", "teaser"}
    if junk:  # a name that is the mark and nothing else is sure
        names = {n.lower() for n in (named.split() if whole else f"{named} {mark}".split())}
        found = STRONG if junk & names else WEAK
    return found


def parse(html: str) -> list[Node]:
    """All elements without a strong mark on or around them, in page order; the first
    is the root."""
    root = Node("html", None)
    nodes, stack, at = [root], [root], 0
    opened = Counter()  # open elements by name, so that stray end tags cost nothing

    def close(i):
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]
    while at < len(html):
        found = _TAG.search(html, at)
        start = found.start() if found else len(html)
        if start > at and stack[-1].junk < STRONG:
            stack[-1].parts.append(html[at:start])
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None or found[4] != ">":
            continue
        name = name.lower()
        if found[1]:
            if opened[name] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name))
        else:
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]|\Z", re.I).search(html, at)
                shut = html.find(">", end.start())
                at = len(html) if shut < 0 else shut + 1
                continue
            if name in BLOCK:
                while (i := _ended(stack, name, opened)) is not None:
                    close(i)
            around = stack[-1]
            node = Node(name, around, 0 if around.junk == STRONG else _mark(name, found[3], around))
            if node.junk < STRONG:
                around.parts.append(node)
                nodes.append(node)
            if name not in VOID and not found[3].rstrip().endswith("/"):
                stack.append(node)
                opened[name] += 1
    return nodes


def _unmarked(nodes: list[Node]) -> list[Node]:
    """The elements that may be main text: weak marks cut off what is below them,
    unless it has more than half of the paragraph points that weak marks leave open."""
    if not any(n.junk for n in nodes):
        return nodes
    inner = {id(n): _points(n) for n in nodes}
    total = sum(inner.values())
    for node in reversed(nodes):  # each element's points and all below it
        if node.parent is not None:
            inner[id(node.parent)] += inner[id(node)]
    kept, dropped = [], set()
    for node in nodes:
        if id(node.parent) in dropped or (node.mark and 2 * inner[id(node)] <= total):
            dropped.add(id(node))
        else:
            kept.append(node)
    for node in kept:
        node.parts = [p for p in node.parts if isinstance(p, str) or id(p) not in dropped]
    return kept


def _ended(stack: list[Node], name: str, opened: Counter) -> int | None:
    """Place of the paragraph, item or cell that an opening block tag ends."""
    closing = ("p", *CLOSES.get(name, ()))
    if any(opened[tag] > 0 for tag in closing):
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in closing:
                return i
            if tag in BORDERS or (tag in BLOCK and len(closing) == 1):
                return None
    return None


def _measure(nodes: list[Node]) -> None:
    """Lengths of text and linked text below each node, the leaves first."""
    for node in reversed(nodes):
        own = sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        node.length += own
        if node.tag == "a":
            node.linked = node.length
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked


def _points(node: Node) -> int:
    """Points of an element's own text if it is a paragraph."""
    if node.tag not in PARAGRAPHS:
        return 0
    text = "".join(_inline(node))
    if len(text) < PARAGRAPH:
        return 0
    return 1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) // 100, 3)


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        points = _points(node)
        if not points:
            continue
        first = node if node.tag not in ("p", "pre", "li", "td", "dd") else node.parent
        level, around = 1, first
        while around is not None and level <= LEVELS:
            around.points += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
            around, level = around.parent, level + 1


def _inline(node: Node):
    """Texts of a node and of the inline elements in it, not of blocks."""
    waiting = [iter(node.parts)]
    while waiting:
        part = next(waiting[-1], None)
        if part is None:
            waiting.pop()
        elif isinstance(part, str):
            yield part.strip()
        elif part.tag not in BLOCK:
            waiting.append(iter(part.parts))


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _value(node: Node) -> float:
    return node.points * (1 - _density(node))


def _chosen(nodes: list[Node]) -> list[Node]:
    """The best container with the siblings that belong to it."""
    best = max(nodes, key=_value)
    if _value(best) <= 0:
        texts = [n for n in nodes if n.tag in CONTAINERS and n.length]
        return [max(texts, key=lambda n: n.length)] if texts else [nodes[0]]
    outer = best.inside
    while outer is not None and outer.parent is not None and outer.parent.inside is not None:
        outer = outer.parent.inside
    if outer is not None:
        return [outer]
    if best.parent is None:
        return [best]
    least = max(3.0, 0.2 * _value(best))
    kept = []
    for node in (p for p in best.parent.parts if not isinstance(p, str)):
        if (node is best or node.tag in HEADINGS or _value(node) >= least
                or (_density(node) < 0.25 and (node.length >= PARAGRAPH and node.tag in LISTS
                                               or _has_paragraph(node)))):
            kept.append(node)
    return kept


def _has_paragraph(node: Node) -> bool:
    """Whether an element is or holds a paragraph with text."""
    waiting = [node]
    while waiting:
        node = waiting.pop()
        if node.tag in ("p", "pre", "blockquote") and node.length:
            return True
        waiting.extend(p for p in node.parts if not isinstance(p, str))
    return False


def _blocks(node: Node):
    """Texts of the blocks below a node, in page order, their references decoded.
    Outside an article or main element a list of links is left out, unless it follows a
    heading or paragraph of the element that holds it."""
    held: list[str] = []
    whole = node.inside is not None

    def flush():
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        return text
    waiting = [(node, iter(node.parts))]
    texts = set()  # elements with a heading or paragraph so far
    while waiting:
        current, parts = waiting[-1]
        part = next(parts, None)
        if part is None:
            waiting.pop()
            if current.tag in BLOCK:
                yield flush()
        elif isinstance(part, str):
            held.append(part)
        elif part.tag == "br":
            held.append(" ")
        elif whole or current in texts or not (
                part.tag in ("ul", "ol") and part.length and _density(part) > 0.8):
            if part.length and (part.tag == "p" or part.tag in HEADINGS):
                texts.add(current)
            if part.tag in BLOCK:
                yield flush()
            waiting.append((part, iter(part.parts)))
    yield flush()


def main_text(html: str) -> str:
    """The main text of a page; empty if there is none."""
    nodes = _unmarked(parse(html))
    _measure(nodes)
    _score(nodes)
    return " ".join(b for node in _chosen(nodes) for b in _blocks(node) if b)


def _extract(pages):
    texts = [main_text((p or b"").decode("utf-8", "replace")) for p in utf8(pages)]
    return [texts, [len(t) for t in texts]]


def extract(pages: DataFrame, keep: list[str] | None = None, out: str = "main") -> DataFrame:
    """``keep`` columns (all by default) and the struct ``out``: the main text of
    the ``html`` column and its length in code points.  One row per row; null and
    empty pages and pages without main text give an empty text."""
    return with_result(pages, ["html"], pages.columns if keep is None else keep, out,
                       "text string, n_chars bigint", _extract)


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, one row per row of ``pages``; as in
    :func:`extract`.  Repeated pages and ids are answered each."""
    return extract(pages, ["page_id", "url"]).select(
        "page_id", "url", F.col("main.text").alias("text"), F.col("main.n_chars").alias("n_chars"))
