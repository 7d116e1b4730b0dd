"""Main text of web pages by tree scoring.

Every paragraph earns points for its length and commas. Its points pass to its
ancestors, in full to the parent, by half to the next and by a third of that to
each further one, discounted by the share of the paragraph's text that stands in
links. The container with the most points is the article; siblings that score
well beside it, or read like prose, are kept with it. What a page marks as
furniture (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) neither scores nor is kept. Marks in class names and
ids can mislead: where nothing is left without them, they are not heeded.

Pages are parsed and scored in one sweep each, whatever their depth.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
DROPPED = RAW | frozenset("nav aside footer form button select object svg math canvas audio video menu dialog datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption option head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = frozenset("p pre blockquote td dd li".split())
WHOLE = frozenset(("article", "main"))
# A start tag of the key closes an open tag of the values that stands nearer than any container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("article main section div body html ul ol dl table blockquote nav aside footer header form".split())
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|header|masthead|comments?|disqus|respond|replies|cookies?|consent|notices?|alert|popup|modal|overlay|"
    r"subscribe|subscription|newsletter|sign-?up|login|share|sharing|social|related|recommend\w*|widget|pagination|"
    r"pager|toolbar|skip|legal|copyright|disclaimer|gdpr|paywall|toc)(?=$|[\s_-])", re.I)
# Class names that say what a page or article has, lacks or is about, or what wraps it.
ABOUT = re.compile(r"^(?:has|no|not|with|without|is|hide|hidden|category|cat|tag|topic|type|format|layout|theme|lang)[_-]|"
                   r"[_-](?:wrap|wrapper|container|layout|enabled|disabled|open|closed|active|on|off)$", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")

MIN_SHARE = 0.2       # of the best container's points, for a sibling to be kept
PROSE_CHARS = 80      # a sibling paragraph this long with few links is kept too
LINKED = 0.5          # blocks with a larger share of link text earn nothing


class Node:
    __slots__ = ("tag", "parent", "block", "kids", "near", "far", "chars", "linked", "gone", "whole", "inside")

    def __init__(self, tag: str, parent: Node | None, gone: bool, whole: bool) -> None:
        self.tag, self.parent, self.gone, self.whole = tag, parent, gone, whole
        # The nearest block around it, and whether it lies in a marked article.
        self.block: Node | None = None if parent is None else parent if parent.tag in BLOCK or parent.parent is None else parent.block
        self.inside = parent is not None and (parent.whole or parent.inside)
        self.kids: list[Node | str] = []
        self.near, self.far, self.chars, self.linked = 0.0, 0.0, 0, 0

    @property
    def points(self) -> float:
        return self.near + self.far


def _furniture(tag: str, attributes: str, names: bool) -> tuple[bool, bool]:
    """Whether an element is furniture (by class and id too, with ``names``), and whether it is marked as the whole article."""
    if tag in DROPPED:
        return True, False
    if not attributes:
        return False, tag in WHOLE
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    role = got.get("role", "").lower()
    whole = tag in WHOLE or role == "main" or got.get("itemprop", "").lower() == "articlebody"
    if role in ROLES or "hidden" in got or got.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none", got.get("style", ""), re.I):
        return True, False
    if not names or whole or tag in ("html", "body") or tag in HEADINGS:
        return False, whole
    named = f"{got.get('class', '')} {got.get('id', '')}".split()
    return any(FURNITURE.search(n) and not ABOUT.search(n) for n in named), whole


def _parse(page: str, names: bool = True) -> Node:
    root = Node("#root", None, False, False)
    at, here, end = 0, root, len(page)
    lower = None
    # Open elements by tag: what isn't open is not looked for.
    opened: dict[str, int] = {}

    def shut_to(node: Node) -> Node:
        """Close all elements from ``here`` up to ``node``; its parent."""
        up = here
        while True:
            opened[up.tag] -= 1
            if up is node:
                return node.parent
            up = up.parent

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            here.kids.append(page[at:])
            break
        if lt > at:
            here.kids.append(page[at:lt])
        mark = page[lt + 1:lt + 2]
        if mark == "!" or mark == "?":
            if page.startswith("<!--", lt):
                shut = page.find("-->", lt + 4)
                at = end if shut < 0 else shut + 3
            else:
                shut = page.find(">", lt)
                at = end if shut < 0 else shut + 1
            continue
        closing = mark == "/"
        name = NAME.match(page, lt + 1 + closing)
        if not name:
            if closing:
                shut = page.find(">", lt)
                at = end if shut < 0 else shut + 1
            else:
                here.kids.append("<")
                at = lt + 1
            continue
        tag = name[0].lower()
        tail = TAG_END.match(page, name.end())
        shut = tail.end() if tail else page.find(">", name.end()) + 1
        if not shut:
            break  # a tag that the page's end cuts off
        attributes, at = page[name.end():shut - 1], shut
        if closing:
            if opened.get(tag):
                node = here
                while node.tag != tag:
                    node = node.parent
                here = shut_to(node)
            continue
        if tag in BLOCK and tag not in ("html", "head", "body") and opened.get("p"):
            node = here
            while node.parent is not None and node.tag not in SCOPE and node.tag != "p":
                node = node.parent
            if node.tag == "p":
                here = shut_to(node)
        if tag in CLOSES and any(opened.get(x) for x in CLOSES[tag]):
            node = here
            while node.parent is not None and node.tag not in CLOSES[tag] and node.tag not in SCOPE:
                node = node.parent
            if node.tag in CLOSES[tag]:
                here = shut_to(node)
                if tag == "tr" and here.tag == "tr":
                    here = shut_to(here)
        gone, whole = _furniture(tag, attributes, names)
        node = Node(tag, here, gone, whole)
        here.kids.append(node)
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            stop = lower.find(f"</{tag}", at) if len(lower) == end else page.find(f"</{tag}", at)
            if stop < 0:
                break
            at = page.find(">", stop) + 1 or end
        elif tag not in VOID and not attributes.endswith("/"):
            here = node
            opened[tag] = opened.get(tag, 0) + 1
    return root


def _score(root: Node) -> list[Node]:
    """All kept nodes in page order, with characters, link characters and points."""
    order: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        order.append(node)
        for k in reversed(node.kids):
            if isinstance(k, Node) and not k.gone:
                if k.tag == "header":  # an article's own header keeps its headings, a page's header nothing
                    k.gone = not k.inside
                    if k.gone:
                        continue
                todo.append(k)
    commas: dict[int, int] = {}
    for node in reversed(order):
        for k in node.kids:
            if isinstance(k, str):
                if not k.isspace():
                    node.chars += len(k)
                    commas[id(node)] = commas.get(id(node), 0) + k.count(",") + k.count("،") + k.count("，")
            elif not k.gone:
                node.chars += k.chars
                node.linked += k.linked
                if k.tag not in BLOCK:
                    commas[id(node)] = commas.get(id(node), 0) + commas.get(id(k), 0)
        if node.tag == "a":
            node.linked = node.chars
    for node in reversed(order):  # a node's own points are complete when it passes them on
        own = node.tag in PARAGRAPH or ((node.tag in BLOCK or node.parent is None) and any(isinstance(k, str) and not k.isspace() for k in node.kids))
        if own and node.chars and node.tag not in HEADINGS and (links := node.linked / node.chars) <= LINKED:
            worth = (min(node.chars, 25) / 25 + commas.get(id(node), 0) + min(node.chars / 100, 3)) * (1 - links)
            to = node.block if node.tag in PARAGRAPH else node
            if to is not None:
                to.near += worth
    for node in reversed(order):
        if (node.tag in BLOCK) and node.block is not None:
            node.block.far += node.near / 2 + node.far / 3
    return order


def _kept(order: list[Node]) -> list[Node]:
    """The roots of what stays, in page order."""
    rated = [n for n in order if n.points > 0 and n.tag not in PARAGRAPH and n.tag in BLOCK]
    if not rated:
        rated = [n for n in order if n.points > 0]
    if not rated:
        return [n for n in order if n.whole][:1]
    best = max(rated, key=lambda n: n.points * (1 - n.linked / max(n.chars, 1)))
    up: Node | None = best
    while up is not None and not up.whole:
        up = up.parent
    if up is not None:
        # The marked article, and others that score well beside it.
        return [k for k in up.parent.kids if k is up or (isinstance(k, Node) and k.whole and not k.gone and k.points >= MIN_SHARE * up.points)]
    if best.parent is None or best.tag == "body":
        return [best]
    out = []
    for k in best.parent.kids:
        if not isinstance(k, Node) or k.gone:
            continue
        links = k.linked / max(k.chars, 1)
        prose = k.tag == "p" and links < 0.25 and k.chars > PROSE_CHARS
        if k is best or k.points >= MIN_SHARE * best.points or prose or k.tag in HEADINGS:
            out.append(k)
    return out


def _blocks(top: Node) -> Iterator[str]:
    """The blocks below a node in page order, references decoded and white space evened."""
    held: list[str] = []
    todo: list[Node | str | None] = [top]
    while todo:
        k = todo.pop()
        if k is None or (isinstance(k, Node) and k.tag in BLOCK):
            if held:
                if block := " ".join(entities.unescape("".join(held)).split()):
                    yield block
                held = []
        if isinstance(k, str):
            held.append(k)
        elif k is not None and not k.gone:
            if k.tag in ("br", "wbr", "img"):
                held.append(" " if k.tag == "br" else "")
                continue
            if not top.whole and k.tag in ("ul", "ol", "table", "dl") and k.chars and k.linked / k.chars > 0.8:
                continue  # a list of links is a menu, but for an article's own
            if k.tag in BLOCK:
                todo.append(None)
            kids = k.kids
            if k.tag == "header":
                kids = [x for x in _below(k) if x.tag in HEADINGS]
            todo.extend(reversed(kids))
    if held and (block := " ".join(entities.unescape("".join(held)).split())):
        yield block


def _below(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        for k in todo.pop().kids:
            if isinstance(k, Node) and not k.gone:
                yield k
                todo.append(k)


def main_text(page: str | None) -> str:
    """The article of one page: its blocks joined by a line feed; an empty string where there is none."""
    if not page:
        return ""
    for names in (True, False):  # without regard to class names, if they leave nothing
        if text := "\n".join(b for top in _kept(_score(_parse(page, names))) for b in _blocks(top)):
            return text
    return ""


@F.pandas_udf(T.StringType())
def _texts(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in it:
        yield pd.Series([main_text(x) for x in pages], dtype=object)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in ``into`` (replaced if it is there already).

    One row out for each row in, so repeated pages repeat. Null, empty and
    text-free pages give an empty text. Whole pages are read, however long, one
    Arrow batch at a time; tags that the page's end cuts off are left out.
    """
    return pages.withColumn(into, _texts(F.col(html)))
