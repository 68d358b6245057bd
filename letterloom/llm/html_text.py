"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by how they take part.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var ruby rb rt rp rtc img wbr br nobr object map "
    "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mfenced mstyle semantics".split()
)
DROPPED = frozenset(
    "script style noscript template iframe embed applet canvas svg head title nav footer aside form "
    "button select option textarea input dialog menu noembed noframes audio video".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
# Words of class and id names, and roles, of what is not the article.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side widget widgets footer masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay comment comments disqus replies related recommended share sharing social subscribe newsletter "
    "signup login search pagination pager toolbar".split()
)
SIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split()
)

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
#: Beside one of these a word of a name tells of something that is not there, or that stands next to the element.
DENIED = frozenset("no non not without with has free hide hidden".split())
NAME_PARTS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")


class Element:
    """A node of the page: ``parts`` are its texts and elements in order."""

    __slots__ = (
        "tag", "side", "parts", "parent", "chars", "link_chars", "tags", "link_tags", "density", "total", "named", "hint",
        "shown", "holds",
    )

    def __init__(self, tag: str, side: bool, parent: Element | None, hint: int = 0):
        self.tag, self.side, self.parent, self.parts, self.hint = tag, side, parent, [], hint
        self.shown, self.holds = 0, False
        self.named = tag in ("article", "main") or (parent is not None and parent.named)
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _aside(tag: str, attributes: dict[str, str], inside: set[str]) -> bool:
    """Whether an element is a menu, notice, advert and so on by its tag or role."""
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if tag == "header" and not inside & {"article", "main"}:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return attributes.get("role", "").lower() in SIDE_ROLES


def _hint(attributes: dict[str, str]) -> int:
    """2 where a whole class or id is a side word, 1 where a part of one is, beside no denial; else 0."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    if any(name.lower() in SIDE_WORDS for name in names):
        return 2
    parts = [{part.lower() for part in NAME_PARTS.split(name) if part} for name in names]
    return int(any(p & SIDE_WORDS and not p & DENIED for p in parts))


def judge(root: Element) -> None:
    """Settles which named elements are aside, from what they hold.

    No element that holds a main element, or an article without such a name itself, is aside by its name.
    Where only a part of the name tells, an element with half of the page's characters or more is none.
    """
    nodes = _in_order(root)
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.shown += len(SPACE.sub("", part))
            elif not part.side:
                node.shown += part.shown
                node.holds |= part.holds or part.tag == "main" or part.tag == "article" and not part.hint
    for node in nodes:
        if node.hint and not node.holds and node.tag not in ("html", "body", "article", "main"):
            node.side = node.hint == 2 or 2 * node.shown < root.shown


def _attributes(source: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from a place inside a tag, and the place after the tag."""
    found: dict[str, str] = {}
    while True:
        match = ATTRIBUTE.match(source, at)
        if match is None:
            end = source.find(">", at)
            return found, len(source) if end < 0 else end + 1
        name = match[1].lower()
        found.setdefault(name, html.unescape(match[2] or match[3] or match[4] or ""))
        at = match.end()


def parse(source: str) -> Element:
    """The page as a tree, in one pass; unclosed and stray tags are mended, comments left out."""
    root = here = Element("html", False, None)
    open_tags: dict[str, int] = {}
    at, end = 0, len(source)
    lowered = None
    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            here.parts.append(source[at:])
            break
        if lt > at:
            here.parts.append(source[at:lt])
        match = TAG.match(source, lt)
        if match is None:
            nxt = source[lt + 1 : lt + 2]
            if source.startswith("<!--", lt):
                close = source.find("-->", lt + 4)
                at = end if close < 0 else close + 3
            elif nxt and nxt in "!?/":
                close = source.find(">", lt)
                at = end if close < 0 else close + 1
            else:
                here.parts.append("<")
                at = lt + 1
            continue
        tag = match[2].lower()
        attributes, at = _attributes(source, match.end())
        if match[1]:
            here = _close(here, tag, open_tags)
            continue
        if tag in CLOSES_P:
            here = _close(here, "p", open_tags, up_to=("table", "td", "th", "button"))
        for same in CLOSED_BY_SAME.get(tag, ()):
            here = _close(here, same, open_tags, up_to=("ul", "ol", "dl", "table", "select"))
        if tag in ("html", "body"):  # one of each at most; what they hold counts
            if tag == "html" or open_tags.get("body"):
                continue
        node = Element(tag, _aside(tag, attributes, {t for t, n in open_tags.items() if n}), here, _hint(attributes))
        here.parts.append(node)
        if tag in RAW:
            lowered = lowered if lowered is not None else _lower_ascii(source)
            close = lowered.find(f"</{tag}", at)
            close = end if close < 0 else close
            if tag == "xmp":  # shown as it is written
                node.parts.append(source[at:close].replace("&", "&amp;"))
            at = close
        elif tag not in VOID:
            here = node
            open_tags[tag] = open_tags.get(tag, 0) + 1
    judge(root)
    return root


def _lower_ascii(source: str) -> str:
    """Lower case without a change of length."""
    return source.translate({code: code + 32 for code in range(65, 91)})


def _close(here: Element, tag: str, open_tags: dict[str, int], up_to: tuple[str, ...] = ()) -> Element:
    """Closes the innermost open ``tag``, if there is one, with all that is open inside it."""
    if not open_tags.get(tag):
        return here
    node = here
    while node.parent is not None and node.tag != tag:
        if node.tag in up_to:
            return here
        node = node.parent
    if node.parent is None:
        return here
    while here is not node:
        open_tags[here.tag] -= 1
        here = here.parent
    open_tags[tag] -= 1
    return node.parent


def _in_order(root: Element) -> list[Element]:
    """The elements that are not aside, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [p for p in reversed(node.parts) if isinstance(p, Element) and not p.side]
    return out


def measure(root: Element) -> list[Element]:
    """Densities of all nodes that are not aside: link-adjusted characters per tag, and child sums.

    With C, LC the characters and linked characters of a node, T, LT its tags and link tags and b those
    of the body, the density is C/T * log(C/LC * T/LT) to the base log(C/(C-LC) * LC + LCb/Cb * C + e),
    each divisor 1 at least.
    """
    nodes = _in_order(root)
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(SPACE.sub("", part))
            elif not part.side:
                node.chars += part.chars
                node.link_chars += part.link_chars
                node.tags += part.tags + 1
                node.link_tags += part.link_tags + (part.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    whole = nodes[0]
    share = whole.link_chars / max(1, whole.chars)
    for node in reversed(nodes):
        c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            node.density = c / t * max(0.0, math.log(c / max(1, lc) * t / lt)) / base
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Element) and not p.side) or node.density
    return nodes


def _listing(node: Element) -> bool:
    """A list or block that is links for the most part: a menu without a name."""
    return node.tag in ("ul", "ol", "dl", "div", "table", "section") and node.link_tags > 1 and node.link_chars > 0.7 * node.chars


def content_roots(root: Element) -> list[Element]:
    """The subtrees that hold the main text, in page order.

    The node with the largest sum of its children's densities is found, the first of equals, and stays
    whole. The smallest density on its path to the body is the threshold. On each level of the path, blocks
    beside it stay only when they reach the threshold; headings and texts without a block of their own,
    which have no density to speak of, stay too. An article that holds the node stays whole, with those
    articles beside it that reach the threshold and nothing from further out; a main element bounds
    the path in the same way, but is cleaned inside.
    """
    nodes = measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    inner = [n for n in _in_order(body) if n.chars and n.tag not in INLINE]
    if not inner:
        return []
    best = max(inner, key=lambda n: n.total)
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    articles = [k for k, n in enumerate(path) if n.tag == "article"]
    outer = max((k for k, n in enumerate(path) if n.tag in ("article", "main")), default=None)
    if outer is not None and path[outer].tag == "article":
        beside = path[outer].parent.parts
        same = [p for p in beside if isinstance(p, Element) and p.tag == "article" and not p.side and p.chars]
        return [p for p in same if p is path[outer] or p.density >= threshold]
    path = path[articles[-1] if articles else 0 : None if outer is None else outer + 1]
    before, after = [], []
    for level in range(len(path) - 1, 0, -1):
        at = next(k for k, p in enumerate(path[level].parts) if p is path[level - 1])
        before += _dense(path[level], path[level].parts[:at], threshold)
        after.append(_dense(path[level], path[level].parts[at + 1 :], threshold))
    return [*before, path[0], *(p for level in reversed(after) for p in level)]


def _dense(parent: Element, parts: list, threshold: float) -> list[Element]:
    """Of the parts beside the path those that stay; runs of text outside blocks become a block."""
    out: list[Element] = []
    run: Element | None = None
    for part in parts:
        if isinstance(part, str) or part.tag in INLINE:
            if run is None:
                run = Element("div", False, parent)
                out.append(run)
            run.parts.append(part)
            continue
        run = None
        heading = len(part.tag) == 2 and part.tag[0] == "h" and part.tag[1] in "123456"
        if not part.side and part.chars and (heading or part.density >= threshold and not _listing(part)):
            out.append(part)
    return [p for p in out if p.chars or p.parts]


def blocks(root: Element) -> list[str]:
    """The texts of a subtree, one per block, references decoded and white space as one space.

    Lists and blocks of links are left out, but not in an article or main element.
    """
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list = [root]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        elif not item.side and (item is root or item.named or not _listing(item)):
            block = item.tag not in INLINE
            if block:
                flush()
                stack.append(None)
            stack += reversed(item.parts)
    flush()
    return out


def main_text(source: str | None) -> str:
    """The article of a page; empty for a page without text, or null."""
    if not source:
        return ""
    return "\n\n".join(b for root in content_roots(parse(source)) for b in blocks(root))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(key, url, text, n_chars): one row per page, whatever its size; no shuffle.

    Null, empty and textless pages have an empty text. Rows that repeat a key are rows like others;
    an empty table gives no rows; further columns are not read.
    """

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(value) for value in column], dtype=object)

    read = pages.select(F.col(key), F.col(url).alias("url"), text_of.asNondeterministic()(F.col(source)).alias("text"))
    return read.withColumn("n_chars", F.char_length("text").cast("long"))
