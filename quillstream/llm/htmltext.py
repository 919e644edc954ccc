"""Main-text extraction from HTML by tree scoring (operator 1).

The page is read into a tree (unclosed paragraphs, list items and cells are closed
as browsers do; scripts, styles, forms, menus, headers, footers and the like are
left out, and so are containers whose class, id or role names such a part). Every
paragraph-like block earns points for its length and its commas; they pass in full
to its parent and, halved each time, to the ancestors above. A container's points
are discounted by its link density. The best container is kept, with siblings that
look like article text; a chain of single containers above it and an ``article`` or
``main`` around it count as the same container, so a heading beside the text stays.

Text: character references are decoded, white space inside a block becomes one
blank, blocks stand in page order, one to a line.

Cases: a null, empty or text-less page has the empty text; a page without markup
is one block; equal rows give equal results; very deep pages keep a tree of at most
``MAX_DEPTH`` levels (deeper elements are siblings there); an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: element names of the HTML standard, by what they mean here
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
DROPPED = RAW | frozenset("nav footer aside form button select option dialog menu head object audio video canvas map fieldset legend label input".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr rp rt ruby".split())
CLOSED_BY = {  # an open element of the key's name ends where one of these starts
    "p": frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
}
SCOPE = frozenset("article section div body main table td th li ul ol blockquote".split())  # an end tag inside does not close what is outside
# class and id names that are not the article's, whole or as the last part of a name; with
# one of PLACES after it also as its first part ("cookie-notice", "share-buttons", but not "tag-politics")
NOT_TEXT = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|"
    r"share|sharing|social|related|recommend\w*|comments?|disqus|replies|respond|sidebar|side|widgets?|nav\w*|menu|breadcrumbs?|pagination|pager|"
    r"footer|footnav|masthead|topbar|toolbar|login|search|skip|toc|tags?)",
    re.IGNORECASE,
)
PLACES = frozenset(
    "posts links link list lists box bar items item block area section container wrapper wrap inner outer buttons button icons icon form "
    "left right top bottom primary secondary panel column unit slot row group holder thread stories articles cloud".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

# attributes without backtracking: a quote that is never closed is an ordinary character
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?+|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?>\s++|/|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+|=)*+)>|<",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "block", "article", "points", "chars", "linked", "commas", "own")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.children: list[Node | str] = []
        self.block: Node = parent.block if parent is not None and tag in INLINE else self  # the nearest element that is not inline
        self.article: bool = tag in ("article", "main") or parent is not None and parent.article
        self.points, self.chars, self.linked, self.commas, self.own = 0.0, 0, 0, 0, 0


def _names_other_text(name: str) -> bool:
    parts = re.split(r"[-_]+", name)
    if len(set(parts)) < len(parts):  # side-by-side
        return False
    last = parts[-1] if not parts[-1].isdigit() or len(parts) == 1 else parts[-2]
    if NOT_TEXT.fullmatch(last):
        return last == parts[-1] or len(parts) == 2 and last not in ("skip", "tag", "tags")
    return len(parts) > 1 and bool(NOT_TEXT.fullmatch(parts[0])) and last.lower() in PLACES


def _left_out(tag: str, attributes: str, parent: Node, by_name: bool) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not parent.article:  # of the page; the header of an article holds its heading
        return True
    if not attributes.strip():
        return False
    found = {k.lower(): (v or "").strip("\"'") for k, v in _NAMED.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if not by_name or tag in ("body", "html", "article", "main", "p", "h1", "h2"):
        return False
    return any(_names_other_text(name) for k in ("class", "id") if k in found for name in html.unescape(found[k]).split())


def parse(page: str, by_name: bool = True) -> Node:
    """The page's tree; text is kept as it stands between the tags. ``by_name``: elements
    whose class or id names something else than the article are left out."""
    root = Node("#page", None)
    node, at = root, 0
    is_open: Counter[str] = Counter()
    scan = _TAG.search
    while True:
        m = scan(page, at)
        if m is None:
            if at < len(page):
                node.children.append(page[at:])
            return root
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0] == "<":
                if page[at:at + 1].isalpha() or page[at:at + 1] == "/":
                    return root  # the page breaks off inside a tag
                node.children.append("<")  # a sign of the text
            continue
        tag = tag.lower()
        if m[1]:
            step = node if is_open[tag] else None
            while step is not None and step.tag != tag and not (step.tag in SCOPE and tag not in SCOPE):
                step = step.parent
            if step is not None and step.tag == tag:
                node = _closed(node, step, is_open)
            continue
        while (closers := CLOSED_BY.get(node.block.tag)) and tag in closers:
            node = _closed(node, node.block, is_open)
        if tag in VOID:
            node.children.append(Node(tag, node))
            continue
        attributes = m[3]
        child = Node(tag, node, node.drop or _left_out(tag, attributes, node, by_name))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        node.children.append(child)
        if not attributes.endswith("/") or tag not in ("svg", "math"):
            node = child
            is_open[tag] += 1


def _closed(node: Node, last: Node, is_open: Counter[str]) -> Node:
    """The parent of ``last``, with all open elements from ``node`` up to it closed."""
    while True:
        is_open[node.tag] -= 1
        if node is last:
            return node.parent
        node = node.parent


def _measure(node: Node) -> None:
    """Text length, linked length and commas of every subtree; points of the blocks to their ancestors."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if isinstance(c, Node) and not c.drop]
    for n in reversed(order):
        for c in n.children:
            if isinstance(c, str):
                size, commas = len(_WHITE.sub(" ", c).strip()), c.count(",")
                n.chars += size
                n.commas += commas
                n.own += size
            elif not c.drop:
                n.chars += c.chars
                n.linked += c.linked
                n.commas += c.commas
                if c.tag in INLINE:
                    n.own += c.own
        if n.tag == "a":
            n.linked = n.chars
    for n in order:
        if n.tag in INLINE or not n.own:
            continue
        points = (1 + n.commas + min(n.own / 100, 3)) * (1 - n.linked / max(n.chars, 1))
        above, share = n.parent, 1.0
        while above is not None and share > 0.01:
            above.points += points * share
            above, share = above.parent, share / 2
    for n in order:
        n.points *= 1 - n.linked / max(n.chars, 1)


def _best(root: Node) -> list[Node]:
    """The container with the most points and its article-like siblings."""
    best, todo = root, [root]
    while todo:
        n = todo.pop()
        if n.points > best.points or best is root and n.points >= best.points and n.points > 0:
            best = n
        todo += [c for c in n.children if isinstance(c, Node) and not c.drop and c.tag not in INLINE]
    # the article around the best container holds its heading and its other sections
    step = best
    while step is not None and step.tag not in ("article", "main"):
        step = step.parent
    if step is not None:
        best = step
    parent = best.parent
    if parent is None:
        return [best]
    kept = []
    for c in parent.children:
        if not isinstance(c, Node) or c.drop or not c.chars:
            continue
        density = c.linked / c.chars
        if c is best or c.points >= max(10.0, best.points * 0.2) and density < 0.3:
            kept.append(c)
        elif c.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") and (density < 0.25 and c.chars > 80 or c.tag[0] == "h" and density == 0):
            kept.append(c)
    return kept


def _blocks(nodes: list[Node]) -> Iterator[str]:
    """Texts of the blocks below ``nodes`` in page order."""
    parts: list[str] = []

    def flush() -> Iterator[str]:
        text = _WHITE.sub(" ", html.unescape("".join(parts)).replace("\xa0", " ")).strip()
        parts.clear()
        if text:
            yield text

    todo: list = list(reversed(nodes))
    while todo:
        item = todo.pop()
        if item is None:
            yield from flush()
        elif isinstance(item, str):
            parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif not item.drop:
            if item.tag not in INLINE:
                yield from flush()
                todo.append(None)
            todo += reversed(item.children)
    yield from flush()


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    for by_name in (True, False):  # a page of which the names leave nothing is read without them
        root = parse(page, by_name)
        _measure(root)
        text = "\n".join(_blocks(_best(root)))
        if text:
            break
    return text


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select("page_id", "url", F.col("html").cast("string"))
    kinds = dict(chosen.dtypes)
    return chosen.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
