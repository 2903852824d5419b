"""Main text of HTML pages by tree scoring.

The page becomes a tree of its block elements. Each paragraph earns points
for its length and its commas and passes them on to its ancestors, fewer the
farther they are; a container's points are discounted by the share of its
text that is links. The container with the most points is the article, and
those of its siblings that earn enough stay with it. Elements that never hold
an article (menus, headers and footers of the page, sidebars, notices,
adverts, forms, scripts, styles, comments) are left out beforehand, by their
tag, role or class.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import small_batches
from .words import slices

# HTML's element names by how they are treated.
RAW = frozenset("script style textarea title xmp noembed noframes iframe plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var""".split())
SKIPPED = frozenset("""head nav footer aside form script style noscript template textarea iframe object embed svg math
canvas audio video select option button input dialog menu title xmp noembed noframes""".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset("""address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table tbody td tfoot th thead
tr ul""".split())
#: An opening tag ends an open element of these names, up to the listed parents.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
}
#: Words of a class, id or role that mark what is no article.
BOILERPLATE = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notification popup modal overlay sidebar side rail widget nav navbar navigation menu
menubar breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar header comment comments disqus reply
replies respond share sharing social related recommended recommendations newsletter subscribe signup login search
searchbox skip hidden outbrain taboola byline-ads contentinfo complementary alert alertdialog paywall tags
tagcloud copyright""".split())
#: Those that mark a heading, a paragraph, a quote or words in a line, too.
CERTAIN = frozenset("""ad ads advert advertisement adverts advertising sponsored cookie cookies gdpr hidden newsletter
outbrain taboola""".split())
#: Last parts of a class that say nothing of their own, as in sidebar-left.
SHAPES = frozenset("""area bar block bottom box button buttons container content form group holder icon icons inner
item items left link links list panel right row section top widget wrap wrapper zone""".split())
#: First parts of a class that name the article, as in post-header.
OWN = frozenset("article body content entry main post section story text".split())
KEPT_WHOLE = frozenset("html body main article".split())
CONTENT = frozenset("""blockquote caption code dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup p pre table tbody td
tfoot th thead tr""".split())
#: A page's parts that never hold an article of their own: one that opens inside ends them.
FRAMES = frozenset("nav header footer menu".split())
STARTS = frozenset("article div h1 h2 h3 h4 h5 h6 main p section table".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>?", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "up", "down", "skipped", "points", "chars", "linked", "inner", "unclosed")

    def __init__(self, tag: str, up: Node | None, skipped: bool):
        self.tag, self.up, self.skipped = tag, up, skipped
        self.down: list = []   # nodes, and (text, linked) pairs of the node's own text
        self.points = 0.0
        self.chars = self.linked = 0
        self.inner = 0          # open inline elements of its name inside an inline element
        self.unclosed = False   # left out, and never closed in the page


def _named_boilerplate(word: str, tag: str) -> bool:
    """Whether a word of a class, id or role marks the element: by itself, by
    its last part, or by its first before one that only tells a shape."""
    words = CERTAIN if tag in INLINE or tag in CONTENT else BOILERPLATE
    if word.lower() in words:
        return True
    parts = _PARTS.findall(_CAMEL.sub(" ", word).lower())
    if len(parts) < 2:
        return bool(parts) and parts[0] in words
    if parts[0] in OWN and parts[-1] == "header":
        return False
    return parts[-1] in words or parts[0] in words and all(x in SHAPES or x in words for x in parts[1:])


def _marked(tag: str, attributes: str) -> bool:
    """Whether class, id, role or style mark the element as no article."""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if _UNSHOWN.search(value):
                return True
        elif name in ("class", "id", "role") and tag not in KEPT_WHOLE:
            if any(_named_boilerplate(word, tag) for word in value.split()):
                return True
    return False


def _inline(here: Node, tag: str) -> Node | None:
    """The nearest open inline element of that name around ``here`` that has a
    node of its own, looking through other inline ones only."""
    while here.tag in INLINE:
        if here.tag == tag:
            return here
        here = here.up
    return None


def tree(page: str) -> Node:
    """The page's block elements; inline ones only mark whether text is a link,
    unless their attributes leave them out. An element that is left out ends
    with its closing tag, with its block's, or, if a menu, header or footer of
    the page is never closed, where the next block or article begins."""
    root = here = Node("html", None, False)
    links, at, n = 0, 0, len(page)
    closings: dict[str, int] = {}

    def never_closed(tag: str) -> bool:
        if tag not in closings:
            closings[tag] = max((m.start() for m in re.finditer(rf"</{re.escape(tag)}", page, re.I)), default=-1)
        return closings[tag] < at
    while at < n:
        lt = page.find("<", at)
        found = _TOKEN.match(page, lt) if lt >= 0 else None
        if lt < 0 or found is None:  # text to the end, or a bare "<"
            upto = n if lt < 0 else lt + 1
            if not here.skipped:
                here.down.append((page[at:upto], links > 0))
            at = upto
            continue
        if lt > at and not here.skipped:
            here.down.append((page[at:lt], links > 0))
        at = found.end()
        closing, opening, attributes = found.groups()
        if closing:
            tag = closing.lower()
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                node = _inline(here, tag)
                if node is not None and node.inner:
                    node.inner -= 1
                elif node is not None:
                    here = node.up
            elif tag == "br" or tag in ("p",) and not _inside(here, "p"):
                here.down.append((" ", False))
            elif tag not in VOID:
                node = here
                while node is not None and node.tag != tag:
                    node = node.up
                if node is not None and node.up is not None:
                    here, links = node.up, 0
        elif opening:
            tag = opening.lower()
            if tag == "a":
                links = 1
            if tag in ("br", "hr", "wbr", "img"):
                if tag != "wbr":
                    here.down.append((" ", False))
                if tag == "hr":
                    here = _closed(here, {"p"}, ())
            elif tag in INLINE and not (_marked(tag, attributes) if attributes else False):
                node = _inline(here, tag)
                if node is not None and not attributes.rstrip().endswith("/"):
                    node.inner += 1
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                at = page.find(">", end.start()) + 1 if end else n
                at = at or n
            elif tag not in VOID:
                if tag in ENDS_P:
                    here = _closed(here, {"p"}, ("td", "th", "table"))
                if tag in ENDED_BY:
                    here = _closed(here, *ENDED_BY[tag])
                if here.skipped and tag in STARTS:
                    here = _recovered(here, tag)
                skipped = here.skipped or tag in SKIPPED or bool(attributes) and _marked(tag, attributes) \
                    or tag == "header" and not _inside(here, "article", "main")
                if tag in INLINE and attributes.rstrip().endswith("/"):
                    continue
                node = Node(tag, here, skipped)
                node.unclosed = skipped and not here.skipped and tag in FRAMES and never_closed(tag)
                here.down.append(node)
                here, links = node, 0
    return root


def _recovered(here: Node, tag: str) -> Node:
    """Where a block that opens inside something left out belongs: outside of
    an unclosed part of the page, or of any if the block is an article."""
    node = here
    while node is not None and node.skipped:
        if node.unclosed or node.tag in FRAMES and tag in ("article", "main"):
            return node.up
        node = node.up
    return here


def _inside(node: Node | None, *tags: str) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.up
    return False


def _closed(here: Node, tags: set[str], stops) -> Node:
    """Where we are after the nearest open element of ``tags`` below ``stops`` ends."""
    node = here
    while node is not None and node.tag not in stops:
        if node.tag in tags and node.up is not None:
            after = node.up
            return after if after.tag not in tags else _closed(after, tags, stops)
        node = node.up
    return here


def _clean(parts: list[tuple[str, bool]]) -> str:
    return " ".join(html.unescape("".join(t for t, _ in parts)).split())


def _walk(root: Node) -> Iterator[tuple[Node, list[tuple[str, bool]]]]:
    """(node, its text parts) of every stretch of text without a block in it,
    in page order; a stack, as trees may be deep."""
    stack = [(root, 0, [])]
    while stack:
        node, k, parts = stack.pop()
        while k < len(node.down):
            child = node.down[k]
            k += 1
            if isinstance(child, tuple):
                parts.append(child)
                continue
            if child.skipped:
                continue
            if child.tag not in INLINE:
                if parts:
                    yield node, parts
                    parts = []
            stack.append((node, k, parts))
            stack.append((child, 0, []))
            break
        else:
            if parts:
                yield node, parts


def _score(root: Node) -> tuple[list[tuple[Node, str]], dict[int, Node]]:
    blocks, scored = [], {}
    for node, parts in _walk(root):
        text = _clean(parts)
        if not text:
            continue
        blocks.append((node, text))
        linked = len(_clean([p for p in parts if p[1]]))
        up = node
        while up is not None:
            up.chars += len(text)
            up.linked += linked
            up = up.up
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        share, up = 1.0, node if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd", "dt", "h1", "h2", "h3",
                                                  "h4", "h5", "h6", "figcaption") else node.up
        level = 0
        while up is not None:
            up.points += points * share
            scored[id(up)] = up
            level += 1
            share = 1 / (2 * level)
            up = up.up
    return blocks, scored


#: Points of a container by its element; HTML's own names for the article weigh most.
HEAD_START = {"article": 25.0, "main": 12.0, "section": 1.0, "div": 1.0, "body": -2.0, "html": -5.0,
              "ul": -3.0, "ol": -3.0, "table": -2.0}


def main_text(page: str | None) -> str:
    """The article's text: its blocks in page order, joined by one blank."""
    if not page:
        return ""
    root = tree(page.replace("\x00", ""))
    blocks, scored = _score(root)
    if not blocks:
        return ""

    def worth(node: Node) -> float:
        density = node.linked / node.chars if node.chars else 0.0
        return (node.points + HEAD_START.get(node.tag, 0.0)) * (1 - density)
    best = max(scored.values(), key=worth, default=root)
    while best.up is not None and best.up.tag not in ("body", "html") and best.up.chars == best.chars:
        best = best.up  # a wrapper around nothing else
    level = worth(best)
    kept = {id(best)}
    for other in best.up.down if best.up is not None else ():
        if not isinstance(other, Node) or other is best or other.skipped:
            continue
        density = other.linked / other.chars if other.chars else 1.0
        if other.tag == best.tag == "article" or worth(other) >= max(10.0, 0.2 * level) \
                or other.tag == "p" and density < 0.25 and other.chars > 80:
            kept.add(id(other))
    out = []
    for node, text in blocks:
        up, lists = node, None
        while up is not None and id(up) not in kept:
            if up.tag in ("ul", "ol", "dl"):
                lists = up
            up = up.up
        menu = lists is not None and lists.chars and lists.linked / lists.chars > 0.5
        if up is not None and not (menu and not _inside(lists, "article", "main")):
            out.append(text)
    return " ".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Null and empty html, and pages without text, give an empty text; repeated
    rows are worked out each; ties between containers go to the first in the
    page. A page without tags is one block. Other columns are ignored.
    """
    small_batches(pages.sparkSession, 256)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
