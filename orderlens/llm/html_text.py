"""Main text of web pages by composite text density.

Each node of a page's tree has a density: characters per tag, adjusted for the share of characters and
tags in links. The container whose children's densities sum highest is taken; its ancestors are taken
instead as long as no density on the way falls below the threshold, the lowest on the path from the
body. What can't be main text by its tag or role is no part of the tree that is measured; what a class
or id names as apart is none either, unless it holds the page's article or most of its text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame

from orderlens.llm.common import map_rows

SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOT_TEXT = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video head title nav footer aside "
    "form button select textarea input label menu dialog noembed noframes xmp".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CONTAINERS = frozenset("html body article main section div td table tbody tr center blockquote".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
SIBLINGS |= {"td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
SCOPES = frozenset("ul ol dl table td th html body article section div main select".split())

_ASIDE_WORDS = (
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted sidebar aside comment "
    "comments disqus reply replies respond nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
    "topbar notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup share "
    "sharing social related recommended pagination pager toolbar widget login search skip"
).split()
_WHERE = "site|global|left|right|top|bottom|primary|secondary|[0-9]+"
_WORD = "|".join(_ASIDE_WORDS)
_NAMED = re.compile(rf"(?<![^\s])(?:(?:{_WHERE})-+)*(?:{_WORD})(?:-+(?:{_WORD}|{_WHERE}))*(?![^\s])")
"""A whole name made of these words, and of where it stands: ``cookie-notice``, not ``has-sidebar``."""
_PART = "|".join(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted comment comments disqus reply "
    "replies cookie cookies consent gdpr newsletter subscribe signup share sharing social related recommended".split()
)
_COMPOUND = re.compile(rf"(?<![^\s])(?!(?:has|with|no|without|hide|show)-)(?:[a-z0-9]+-+)*(?:{_PART})(?:-+[a-z0-9]+)*(?![^\s])")
"""A name with one of these words anywhere in it, ``user-comments`` or ``ad-slot``, unless it only says that
there are such parts: a wrapper's ``has-comments``."""
_MENTIONED = re.compile(rf"(?<![a-z])(?:{_WORD})(?![a-z])")
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>\x00]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "aside", "named", "inside", "density", "total")

    def __init__(self, tag: str, parent: Node | None, aside: bool, named: bool = False):
        self.tag, self.parent, self.aside, self.named = tag, parent, aside, named
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_aside(tag: str, attributes: str, inside_text: bool) -> bool:
    """Whether an element is apart from the main text by its tag, its role or being hidden."""
    if tag in NOT_TEXT or tag == "header" and not inside_text:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in _ROLES:
            return True
    return False


def _is_named(tag: str, attributes: str) -> bool:
    """Whether an element's class or id names it as apart from the main text.

    An article is named by any such word in a name: readers' comments are often articles.
    """
    if tag in ("html", "body", "main") or not attributes:
        return False
    patterns = (_MENTIONED,) if tag == "article" else (_NAMED, _COMPOUND)
    names = [value for name, value in _ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id")]
    names = [value.strip("\"'").lower().replace("_", "-") for value in names]
    return any(pattern.search(name) for name in names for pattern in patterns)


def _judge_names(root: Node) -> None:
    """Set aside what is named so, but for what holds the page's article or most of its text.

    The article is the ``main`` or ``article`` with the most text outside links, one whose name
    mentions none of the words if there is any; most is more than half. What stays is told by its density.
    """
    order, stack, plain = [], [(root, False)], {}
    while stack:
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.tag == "a"
        plain[node] = 0 if linked else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        stack += [(c, linked) for c in node.children if isinstance(c, Node) and not c.aside]
    for node in reversed(order):
        if node.parent is not None:
            plain[node.parent] += plain[node]
    articles = [n for n in order if n.tag in ("article", "main") and plain[n]]
    holds = set(_up(max(articles, key=lambda n: (not n.named, plain[n])))) if articles else set()
    for node in order:
        if node.named and node.tag != "article" and node not in holds and 2 * plain[node] <= plain[root]:
            node.aside = True


class _Open:
    """The element that is open, and how many of each tag are open since the innermost scope and in all.

    The counts tell at once that an end tag closes nothing, so elements are walked over only to be closed.
    """

    def __init__(self, root: Node):
        self.root = self.here = root
        self.counts: Counter[str] = Counter()
        self.scoped: list[Counter[str]] = [Counter()]

    def push(self, node: Node) -> None:
        self.here = node
        self.counts[node.tag] += 1
        if node.tag in SCOPES:
            self.scoped.append(Counter())
        else:
            self.scoped[-1][node.tag] += 1

    def pop_to(self, parent: Node) -> None:
        """Close what is open below an element."""
        while self.here is not parent:
            tag = self.here.tag
            self.counts[tag] -= 1
            if tag in SCOPES:
                self.scoped.pop()
            else:
                self.scoped[-1][tag] -= 1
            self.here = self.here.parent

    def end(self, tag: str) -> None:
        """An end tag: closes the innermost element of its tag, for all but scopes within the scope."""
        if not (self.counts if tag in SCOPES else self.scoped[-1])[tag]:
            return
        node = self.here
        while node.tag != tag:
            node = node.parent
        self.pop_to(node.parent)

    def imply_ends(self, tag: str) -> None:
        """Give the end tags that a new element implies."""
        ends = SIBLINGS.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        if tag == "body":
            ends = ends | {"head"}
        if not any(self.counts[end] for end in ends):
            return
        # An end that is no scope lies within the innermost scope or is not reached.
        if not any(self.scoped[-1][end] for end in ends) and not ends & SCOPES and self.here.tag not in ends:
            return
        node, last = self.here, None
        while node is not self.root:
            if node.tag in ends:
                last = node
            elif node.tag in SCOPES:
                break
            node = node.parent
        if last is not None:
            self.pop_to(last.parent)


def parse(html: str) -> Node:
    """The page's tree. End tags that are left out are implied; unmatched ones are ignored."""
    root = Node("html", None, False)
    open_ = _Open(root)
    at, size, named = 0, len(html), False
    while at < size:
        found = _TOKEN.search(html, at)
        start = found.start() if found else size
        if start > at:
            open_.here.children.append(html[at:start])
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            open_.end(tag)
            continue
        attributes = found[3] or found[6] or ""
        if tag == "html" or tag == "body" and open_.counts["body"]:
            continue
        open_.imply_ends(tag)
        here = open_.here
        if tag in VOID:
            here.children.append(Node(tag, here, False))
            continue
        aside = here.aside or _is_aside(tag, attributes, here.inside)
        node = Node(tag, here, aside, not aside and _is_named(tag, attributes))
        named = named or node.named
        here.children.append(node)
        if tag in RAW:
            end = _END[tag].search(html, at)
            node.children.append(html[at : end.start() if end else size])
            at = end.end() if end else size
        elif not attributes.endswith("/") or tag not in ("svg", "math"):
            open_.push(node)
    if named:
        _judge_names(root)
    return root


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _measure(root: Node) -> list[Node]:
    """Characters and tags below each node, inline elements and what is aside left out of the tree.

    Returns the nodes in page order. Deep pages are no risk: nothing here recurses.
    """
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.tag == "a"
        for child in node.children:
            if isinstance(child, str):
                n = len("".join(child.split()))
                node.chars += n
                node.link_chars += n * linked
        node.tags += 1
        node.link_tags += node.tag == "a"
        stack += [(c, linked) for c in reversed(node.children) if isinstance(c, Node) and not c.aside]
    for node in reversed(order):
        if node.parent is not None:
            for name in ("chars", "tags", "link_chars", "link_tags"):
                setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))
    body_links, body_chars = root.link_chars, max(root.chars, 1)
    for node in order:
        chars, links = node.chars, max(node.link_chars, 1)
        if not chars:
            continue
        tags, link_tags = node.tags, max(node.link_tags, 1)
        plain = max(chars - node.link_chars, 1)
        base = math.log(chars / plain * node.link_chars + body_links / body_chars * chars + math.e)
        adjust = math.log(max(chars / links * tags / link_tags, 1.0)) / max(math.log(base), 1e-9) if base > 1 else 0.0
        node.density = chars / tags * (adjust if node.link_chars else max(adjust, 1.0))
    for node in order:
        if node.parent is not None:
            node.parent.total += node.density
    return order


def main_node(root: Node) -> Node | None:
    """The container of the main text; None where the page has no text."""
    order = _measure(root)
    places = [n for n in order if n.tag in CONTAINERS and n.chars]
    if not places:
        return root if root.chars else None
    best = max(places, key=lambda n: n.total)
    path = list(_up(best))
    threshold = min(n.density for n in path)
    # Sections of one text stand side by side: go up while a sibling's density reaches the threshold.
    while best.tag not in ("article", "main", "body") and best.parent is not None:
        beside = [c for c in best.parent.children if isinstance(c, Node) and c is not best and not c.aside]
        if best.parent.tag in ("article", "main") or any(c.chars and c.density >= threshold for c in beside):
            best = best.parent
        else:
            break
    return best


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node in page order, white space evened out."""
    out: list[str] = []
    open_: list[str] = []

    def close() -> None:
        text = " ".join("".join(open_).split())
        if text:
            out.append(text)
        open_.clear()

    stack: list[Node | str | None] = [node]
    while stack:
        part = stack.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            open_.append(unescape(part))
        elif part is node or not part.aside:
            if part.tag == "br":
                open_.append(" ")
            elif part.tag in INLINE:
                stack += reversed(part.children)
            else:
                close()
                stack.append(None)
                stack += reversed(part.children)
    close()
    return out


def extract(html: str | None) -> str:
    """Main text of a page; empty where there is none."""
    if not html:
        return ""
    node = main_node(parse(html))
    return " ".join(blocks(node)) if node else ""


def _extract(page_id: int | None, url: str | None, html: str | None) -> Iterator[tuple]:
    text = extract(html)
    yield page_id, url, text, len(text)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, the main text, and its code points.

    A null, empty or textless html gives an empty text. A page that breaks off, or leaves out end tags,
    is read as far as it goes. Nulls in page_id and url pass through, repeated rows stay, further
    columns are not read.
    """
    return map_rows(pages.select("page_id", "url", "html"), _extract, SCHEMA)
