"""Main text of web pages by tree scoring.

The tags of a page become a tree of block elements. Each paragraph scores points for its length and its commas;
they go to its parent, half of them to the grandparent, a third to the next, and each container's points are
discounted by the share of its text that stands in links. The best container and those of its siblings that score
too, or read like a paragraph, are kept; if the best lies in an `article` or `main`, all of that is, and all of a `main`
or `article` around it that has another article which scores.

Before that, what is never article text goes: scripts, styles, navigation, headers, footers, sidebars, notices,
adverts, forms, reader comments (by element, ARIA role or the words of class and id), and hidden elements. Some of those
words mean other things as well (`share`, `legal`, `header`): a name with one of them counts only if its other words say
nothing else, so `share-buttons` goes and `market-share` stays. Lists and tables that are mostly links have no part in the
choice of the container, but stay where they lie inside it.

Each page is handled by itself, in batches, in time in proportion to its length; nothing is shuffled.

Defined results: null and empty html give the empty text. Repeated rows give repeated rows, an empty table none, and
other columns may have any name. Broken markup is read as a browser would in the common
cases: unclosed elements end with their parent, raw text ends at its own end tag or the end of the page. Text of any
length is kept whole.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math object canvas audio video select title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
DROPPED_TAGS = frozenset("nav header footer aside form button dialog menu fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars sidenav aside footer header masthead banner cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments "
    "commentlist disqus respond replies reply related recommended recommendations pagination pager toolbar widget widgets "
    "skip copyright legal disclaimer form search".split()
)
#: Words among them that mean other things too, and words that may stand beside one of those.
AMBIGUOUS_WORDS = frozenset("share sharing social legal notice notices header footer banner form search copyright disclaimer alert skip reply aside".split())
PLAIN_WORDS = frozenset(
    "bar box block button buttons link links list section container wrapper wrap area site page global top bottom left right main item items "
    "icons icon inner outer row col content holder panel group js fixed sticky mobile desktop primary secondary".split()
)
#: Start tags that end an open paragraph; others that end an open element of their own kind.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section summary table ul li dt dd tr td th tbody thead tfoot".split()
)
ENDS_OWN = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table body html article section main div".split())
ARTICLES = frozenset(("article", "main"))
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
#: Share of a list's text in links beyond which it is a menu, and points of a sibling, as a share of the best, to be kept.
MENU_SHARE, SIBLING_SHARE = 0.6, 0.2


class Node:
    """A block element, or a dropped inline one: parts are texts (str), line breaks (None) and child nodes, in page order."""

    __slots__ = ("tag", "parent", "parts", "dropped", "menu", "points", "chars", "linked", "links", "holds", "nested")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.parts: list = []
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0
        self.holds = tag in ARTICLES  # itself or below an article
        self.menu = False  # a list or table that is mostly links
        self.nested = 0  # open elements of the same name inside a dropped inline one


def _is_named_away(value: str) -> bool:
    """Whether one of the names in a class or id says that an element is no part of the article."""
    for name in value.split():
        words = frozenset(_WORD.findall(name))
        if not words.isdisjoint(DROPPED_WORDS) and (words & DROPPED_WORDS - AMBIGUOUS_WORDS or words <= DROPPED_WORDS | PLAIN_WORDS):
            return True
    return False


def _is_dropped(tag: str, attributes: str) -> bool:
    if tag in DROPPED_TAGS:
        return True
    if not attributes.strip(" /"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), entities.unescape("".join(values)).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value.strip() in DROPPED_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", *ARTICLES) and _is_named_away(value):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of block elements of a page."""
    root = Node("html", None)
    node, link, link_node, at = root, 0, None, 0
    end = len(page)

    def add(text: str) -> None:
        if text:
            text = entities.unescape(text)
            node.parts.append(text)
            size = len(text.strip())
            node.chars += size
            if link:
                node.linked += size

    def close(to: Node) -> Node:
        return to.parent or root

    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        tag = _TAG.match(page, begin)
        if tag is None:  # a lone bracket is text; an unfinished tag at the end is not
            if begin + 1 < end and (page[begin + 1].isalpha() or page[begin + 1] in "/!") and ">" not in page[begin:]:
                add(page[at:begin])
                break
            add(page[at : begin + 1])
            at = begin + 1
            continue
        add(page[at:begin])
        at = tag.end()
        if tag["cdata"] is not None:
            add(tag["cdata"])
            continue
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if tag["end"]:
            if name == "a":
                link = 0
            elif name == "br":
                node.parts.append(None)
            elif name in INLINE:
                if node.tag == name:  # a dropped one
                    node, node.nested = (node, node.nested - 1) if node.nested else (close(node), 0)
            elif name not in INLINE and name not in VOID:
                up = node
                while up is not root and up.tag != name:
                    if name not in SCOPES and name not in DROPPED_TAGS and up.tag in SCOPES:
                        up = root
                        break
                    up = up.parent
                if up is not root:
                    node, link = close(up), 0
            continue
        if name in RAW:
            if not tag["attributes"].endswith("/") or name in ("script", "style"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name in VOID:
            if name in ("br", "hr"):
                node.parts.append(None)
            continue
        if name in INLINE:
            if name == "a":
                link, node.links = 1, node.links + 1
            elif node.tag == name:
                node.nested += 1
            elif node.tag not in INLINE and _is_dropped(name, tag["attributes"]):
                child = Node(name, node, True)
                node.parts.append(child)
                node = child
            continue
        if name in ("html", "body", "head"):
            continue
        if name in ENDS_PARAGRAPH:
            block = node.parent if node.tag in INLINE else node  # a dropped inline element ends with its paragraph
            if block.tag == "p":
                node, link = close(block), 0
        if name in ENDS_OWN:
            up = node
            while up is not root and up.tag not in ENDS_OWN[name] and up.tag not in SCOPES:
                up = up.parent
            while up is not root and up.tag in ENDS_OWN[name]:
                up = close(up)
                node = up
                if name != "tr":
                    break
        child = Node(name, node, _is_dropped(name, tag["attributes"]))
        if child.holds:
            up = node
            while up is not None and not up.holds:
                up.holds = True
                up = up.parent
        node.parts.append(child)
        node = child
    return root


def _walk(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    out, open_nodes = [], [root]
    while open_nodes:
        node = open_nodes.pop()
        out.append(node)
        open_nodes += [c for c in node.parts if isinstance(c, Node) and not (c.dropped and not (c.holds and c.tag not in DROPPED_TAGS))]
    return out


def _blocks(node: Node, allowed: set[int]) -> Iterator[str]:
    """Texts of the blocks of a subtree in page order."""
    held: list[str] = []
    open_parts = [iter(node.parts)]
    while open_parts:
        for part in open_parts[-1]:
            if isinstance(part, str):
                held.append(part)
            elif part is None or part.tag not in INLINE:
                yield "".join(held)
                held = []
                if part is not None and id(part) in allowed:
                    open_parts.append(iter(part.parts))
                    break
        else:
            open_parts.pop()
            yield "".join(held)
            held = []


def _scoring_articles(outer: Node, floor: float, density: dict[int, float]) -> int:
    """Articles right below a node, at any depth but not inside each other, that score and are not mostly links."""
    many, open_nodes = 0, [outer]
    while open_nodes:
        for part in open_nodes.pop().parts:
            if isinstance(part, Node) and id(part) in density:
                if part.tag in ARTICLES:
                    many += part.points >= floor and density[id(part)] < 0.3
                elif part.holds:
                    open_nodes.append(part)
    return many


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, white space made single, joined by one space."""
    if not page:
        return ""
    root = parse(page)
    nodes = _walk(root)
    # totals, children first
    chars, linked, links = {}, {}, {}
    for node in reversed(nodes):
        key = id(node)
        chars[key] = chars.get(key, 0) + node.chars
        linked[key] = linked.get(key, 0) + node.linked
        links[key] = links.get(key, 0) + node.links
        if node.tag in ("ul", "ol", "dl", "table") and links[key] > 1 and linked[key] > MENU_SHARE * chars[key]:
            node.menu = True
            chars[key] = linked[key] = links[key] = 0
        if node.parent is not None:
            up = id(node.parent)
            for total in (chars, linked, links):
                total[up] = total.get(up, 0) + total[key]
    for node in nodes:
        if node.parent is not None and node.parent.menu:
            node.menu = True
        own = " ".join(p for p in node.parts if isinstance(p, str)).strip()
        if not own or node.menu:
            continue
        points = 1 + own.count(",") + own.count("、") + min(len(own) / 100, 10)
        points *= 1 - node.linked / max(node.chars, 1)
        up, depth = (node.parent if node.tag in PARAGRAPHS or node.tag in INLINE else node), 1
        while up is not None:
            up.points += points / depth
            up, depth = up.parent, depth + 1
    density = {id(n): linked[id(n)] / max(chars[id(n)], 1) for n in nodes}
    best = max(nodes, key=lambda n: n.points * (1 - density[id(n)]) * (2 if n.tag in ARTICLES else 1), default=root)
    up = best
    while up is not None and up.tag not in ARTICLES:
        up = up.parent
    # a main with several articles is one text; so is an article of articles
    outer = up
    while up is not None and outer is not None:
        outer = outer.parent
        if outer is not None and outer.tag in ARTICLES and _scoring_articles(outer, SIBLING_SHARE * best.points, density) > 1:
            up = outer
    kept = [up or best]
    if up is None and best.parent is not None:
        floor = SIBLING_SHARE * best.points
        kept = [
            n
            for n in best.parent.parts
            if isinstance(n, Node)
            and id(n) in density
            and not n.menu
            and (n is best or (density[id(n)] < 0.3 and (n.points >= floor or n.tag in PARAGRAPHS or re.fullmatch("h[1-6]", n.tag))))
        ]
    allowed = {id(n) for n in nodes}
    texts = (_SPACE.sub(" ", block).strip() for node in kept for block in _blocks(node, allowed))
    return " ".join(t for t in texts if t)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    id_type = source.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=[main_text(h) for h in batch["html"]])

    made = source.mapInPandas(run, f"page_id {id_type}, url string, text string")
    return made.withColumn("n_chars", F.length("text").cast("long"))
