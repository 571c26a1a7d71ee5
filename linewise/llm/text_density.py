"""Main text of HTML pages by composite text density.

A page becomes a tree of its elements.  The density of an element is its number
of characters per tag below it, scaled down by the share of characters and tags
that are links (composite text density); the density sum of an element is that
of its children, a run of its own text counting as a child.  The element of
the largest density sum holds the article.  The smallest density on its path
from the body is the threshold: another part of the page as dense as that gives
its own element of largest sum, so an article in several containers stays whole.

Tags are block elements and links: formatting inside a block (bold, line breaks)
neither thins its text nor is it chosen.  An element chosen inside an ``article``
stands for that whole article, and the first heading beside the way to it stays.

What a page marks as something else never counts as text: head, scripts, styles,
navigation, footers, sidebars, forms, and elements whose class, id or role says
menu, advert, notice, comments and the like, unless they hold the page's first
heading or its ``main`` (an unclosed advert, a form around the page).  A header
outside the article goes, one inside an article keeps its headings.  In the
chosen parts, lists and containers that hold hardly anything but several links
go too.

Text: character references are decoded; block elements end a block; white space
inside a block, line breaks included, is one space; empty blocks go; blocks are
joined by two newlines in page order.

Cases: a null or empty page, or one without text, gives an empty text of 0
characters; a page without markup is one block; unclosed, crossing or unknown
tags are read as browsers do in the main (a paragraph ends at the next block, a
list item at the next item); an unclosed comment or script runs to the page's
end; nesting beyond ``MAX_DEPTH`` elements is flat.  Each row is worked on alone,
so repeated rows, ties and null ids pass through; ``keep`` names the columns that
stay.  Memory is that of one page and one batch.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td tfoot th thead tr ul caption""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that never hold article text, and those that do not unless they were left open before it.
NEVER = frozenset("""head script style noscript template textarea title xmp iframe noembed noframes svg math canvas
object audio video map button select datalist""".split())
BESIDE = frozenset("nav footer aside form dialog menu search".split())
#: ARIA roles of the same kind.
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
toolbar tablist""".split())
#: Words of a class or an id that name something beside the article.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo
promoted promotion nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager footer foot
sidebar aside related recommended recommendations comment comments commentlist respond reply replies
disqus discussion cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe
subscription signup login share sharing social toolbar skip""".split())
#: The same for page headers, the words of an article's own header, and those that speak of something absent.
HEADER_MARKS = frozenset("header masthead topbar".split())
ARTICLE_MARKS = frozenset("article post entry content story page title".split())
NO_MARKS = frozenset("has with without no".split())
#: Elements that close an open paragraph, and what an item of a list or table closes up to its container.
_ENDS_P = BLOCK - frozenset("td th tr tbody thead tfoot caption option optgroup body html li dd dt legend".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"),
             "thead": ("tbody", "thead", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th")}
_HOLDS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist")}
#: A closing tag or an item does not reach beyond these.
_BORDER = frozenset("table td th article section div body html ul ol dl select".split())

MAX_DEPTH = 512
#: The page's link share counts as at least this much, so that pages without links have a scale too.
LEAST_LINK_SHARE = 0.05
#: A container with at least two links whose characters are this share of its own is a menu.
MENU_SHARE = 0.8

_TOKEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: The rest of a tag; a quote opens a value only after '='.
_TAG_END = re.compile(r"""(?>[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What an element may be: text of the page, never text, beside the article, a page header.
TEXT, GONE, ASIDE, HEADER = range(4)


class Node:
    """An element: ``parts`` are its children and the text runs between them, in page order."""

    __slots__ = ("tag", "parent", "parts", "kind", "in_link", "in_article", "holds", "chars", "tags", "link_chars",
                 "link_tags", "own", "own_links", "own_link_chars", "density", "total")

    def __init__(self, tag: str, parent: Node | None, kind: int = TEXT):
        self.tag, self.parent, self.kind = tag, parent, kind
        self.parts: list[Node | str] = []
        self.in_link = tag == "a" or parent is not None and parent.in_link
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article
        self.holds = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.own = self.own_links = self.own_link_chars = 0
        self.density = self.total = 0.0


def _kind(tag: str, attributes: str) -> int:
    """What the element's name, role, class and id say it is."""
    if tag in NEVER:
        return GONE
    if tag in BESIDE:
        return ASIDE
    if tag == "header":
        return HEADER
    if not attributes or tag in ("body", "html", "main"):
        return TEXT
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return GONE
        if name == "role" and value.lower() in ROLES:
            return ASIDE
        if name in ("class", "id"):
            for token in value.split():
                words = set(_WORDS.findall(_CAMEL.sub(" ", token).lower()))
                if words & NO_MARKS:
                    continue
                if words & MARKS:
                    return ASIDE
                if words & HEADER_MARKS and not words & ARTICLE_MARKS and tag in BLOCK - HEADINGS:
                    return HEADER
    return TEXT


def parse(page: str) -> Node:
    """The tree of a page; tags are found by linear scans."""
    root = Node("html", None)
    stack, at, size = [root], 0, len(page)

    def text(run: str) -> None:
        if run:
            stack[-1].parts.append(html.unescape(run))

    def close_to(k: int) -> None:
        del stack[k:]

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        if m[1]:
            end = page.find("-->", m.end())
            at = size if end < 0 else end + 3
            continue
        if m[2]:
            end = page.find(">", m.end())
            at = size if end < 0 else end + 1
            continue
        name, ended = m[4].lower(), _TAG_END.match(page, m.end())
        if not ended:
            break  # the page ends inside a tag
        at = ended.end()
        attributes = page[m.end():at - 1]
        if m[3]:
            if name == "br":
                text(" ")
            elif name == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].parts.append(Node("p", stack[-1]))
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == name:
                        close_to(k)
                        break
                    if name not in _BORDER and name not in BLOCK and stack[k].tag in _BORDER:
                        break  # an inline end tag without its start
                    if name == "p" and stack[k].tag in ("td", "th", "table"):
                        break
            continue
        if name in ("html", "body") or name == "head" and len(stack) > 1:
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCK and stack[-1].tag == "head":
            close_to(1)  # a body's first element ends an unclosed head
        if name in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close_to(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        if name in HEADINGS and stack[-1].tag in HEADINGS and name != "hgroup" and stack[-1].tag != "hgroup":
            close_to(len(stack) - 1)
        if name in _SIBLINGS:
            holders = _HOLDS.get(name, ("table",))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _SIBLINGS[name]:
                    close_to(k)
                    if name not in ("tr", "tbody", "thead", "tfoot"):
                        break
                elif stack[k].tag in holders:
                    break
        node = Node(name, stack[-1], _kind(name, attributes))
        stack[-1].parts.append(node)
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            if not end:
                break
            close = page.find(">", end.end())
            at = size if close < 0 else close + 1
        elif name not in VOID and not (attributes.endswith("/") and name in ("path", "use")) and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


def _order(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def _composite(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, adjusted by links; ``share`` is the page's share of link characters."""
    if not chars:
        return 0.0
    tags = max(tags, 1)
    base = math.log(math.log(chars * link_chars / max(chars - link_chars, 1) + share * chars + math.e))
    ratio = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return chars / tags * math.log(max(ratio, 1.0)) / base


def _link_share(nodes: list[Node]) -> float:
    """The page's share of link characters, menus included."""
    total = linked = 0
    for node in nodes:
        if node.kind != GONE:
            run = sum(len(p) for p in node.parts if isinstance(p, str))
            total += run
            linked += run if node.in_link else 0
    return max(linked / total if total else 0.0, LEAST_LINK_SHARE)


def _drop_asides(nodes: list[Node]) -> list[Node]:
    """Decide what goes; returns the elements that stay, parents first."""
    for node in reversed(nodes):
        if node.parent is not None and node.kind != GONE and (node.holds or node.tag in ("h1", "main")):
            node.parent.holds = True
        if node.parent is not None and node.parent.tag == "form" and node.tag == "article":
            node.parent.holds = True
    live = []
    for node in nodes:
        up = node.parent
        if up is not None and up.kind == GONE:
            node.kind = GONE
        elif node.kind == ASIDE:
            node.kind = TEXT if node.holds else GONE
        elif node.kind == HEADER:
            if up is not None and up.in_article:
                node.kind = TEXT
                node.parts = [p for p in node.parts if isinstance(p, Node)]
                for part in node.parts:
                    if part.tag not in HEADINGS and not part.holds:
                        part.kind = GONE
            else:
                inner = any(isinstance(p, Node) and p.in_article for p in node.parts)
                node.kind = TEXT if inner else GONE
        if node.kind == TEXT:
            live.append(node)
    return live


def _measure(live: list[Node], share: float) -> None:
    """Counts, densities and density sums, children before parents.

    Formatting adds its text and links to the block that holds it; a block's
    own text counts as one child.
    """
    for node in reversed(live):
        for part in node.parts:
            if isinstance(part, str):
                node.own += len(" ".join(part.split()))
            elif part.kind != TEXT:
                continue
            elif part.tag in BLOCK:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
                node.total += part.density
            else:
                node.own += part.own
                node.own_links += part.own_links
                node.own_link_chars += part.own_link_chars
                node.chars += part.chars - part.own
                node.tags += part.tags - part.own_links
                node.link_chars += part.link_chars - part.own_link_chars
                node.link_tags += part.link_tags - part.own_links
                node.total += part.total
        if node.tag == "a":
            node.own_links, node.own_link_chars = 1, node.own
        node.chars += node.own
        node.tags += node.own_links
        node.link_chars += node.own_link_chars
        node.link_tags += node.own_links
        if node.tag in BLOCK:
            node.total += _composite(node.own, node.own_links, node.own_link_chars, node.own_links, share)
            node.density = _composite(node.chars, node.tags, node.link_chars, node.link_tags, share)


def _is_menu(node: Node) -> bool:
    """A list or container of several links and hardly anything else."""
    return (node.tag in BLOCK and node.tag not in HEADINGS and node.tag != "p" and node.link_tags > 1
            and node.link_chars >= MENU_SHARE * node.chars)


def _chosen(root: Node, live: list[Node]) -> set[Node]:
    """The elements whose text is the article: largest density sums of the parts above the path's threshold."""
    blocks = [n for n in live if n.tag in BLOCK]
    best = max(blocks, key=lambda n: n.total)
    threshold, up = best.density, best.parent
    while up is not None:
        if up.tag in BLOCK:
            threshold = min(threshold, up.density)
        up = up.parent
    # The block of largest density sum in each subtree; the first one on a tie.
    place = {n: i for i, n in enumerate(live)}
    largest: dict[Node, Node | None] = {}
    for node in reversed(live):
        top = node if node.tag in BLOCK else None
        for part in node.parts:
            under = largest.get(part) if isinstance(part, Node) else None
            if under and (top is None or (under.total, -place[under]) > (top.total, -place[top])):
                top = under
        largest[node] = top
    chosen, stack = set(), [root]
    while stack:
        node = stack.pop()
        if node in chosen:
            continue
        if node.tag in BLOCK and node.chars and node.density >= threshold:
            part = top = largest[node]
            while part is not None:  # an article as a whole
                if part.tag == "article":
                    top = part
                part = part.parent
            chosen.add(top)
        stack.extend(p for p in node.parts if isinstance(p, Node) and p.kind == TEXT)
    # The page's title, where it stands beside the way to the article.
    for node in live:
        if node.tag == "h1":
            if any(node.parent is up for up in _above(best)):
                chosen.add(node)
            break
    return chosen


def _above(node: Node) -> Iterator[Node]:
    up = node.parent
    while up is not None:
        yield up
        up = up.parent


def main_text(page: str | None) -> str:
    """The article of one page as blocks joined by two newlines."""
    if not page:
        return ""
    root = parse(page)
    nodes = _order(root)
    share = _link_share(nodes)
    live = _drop_asides(nodes)
    _measure(live, share)
    chosen = _chosen(root, live)

    blocks: list[str] = []
    words: list[str] = []

    def end_block() -> None:
        block = " ".join("".join(words).split())
        words.clear()
        if block:
            blocks.append(block)

    # (part, whether the text around it is the article's); None ends a block.
    stack: list[tuple[Node | str | None, bool]] = [(root, False)]
    while stack:
        part, inside = stack.pop()
        if part is None:
            end_block()
        elif isinstance(part, str):
            if inside:
                words.append(part)
        elif part.kind == TEXT:
            if part in chosen:
                inside = True
            elif inside and _is_menu(part):
                end_block()
                continue
            if part.tag in BLOCK:
                end_block()
                stack.append((None, inside))
            stack.extend((p, inside) for p in reversed(part.parts))
    end_block()
    return "\n\n".join(blocks)


def extract_text(pages: DataFrame, *, html_col: str = "html", keep: Sequence[str] = ("page_id", "url"),
                 batch_chars: int = 4 << 20) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` (code points) of every page; see the module for the cases.

    One pass without a shuffle; results leave a task in batches of about
    ``batch_chars`` characters.  A kept column may not be named ``text`` or
    ``n_chars``.
    """
    taken = {"text", "n_chars"} & {k.lower() for k in keep}
    if taken:
        raise ValueError(f"kept columns clash with the results: {sorted(taken)}")
    table = pages.select(*[F.col(k) for k in keep], F.col(html_col).alias("__page"))
    schema = StructType([*table.schema.fields[:-1], StructField("text", StringType(), False),
                         StructField("n_chars", LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            start = size = 0
            for i, page in enumerate(batch.column(len(keep))):
                texts.append(main_text(page.as_py()))
                size += len(texts[-1])
                if size >= batch_chars or i == batch.num_rows - 1:
                    kept = batch.slice(start, len(texts))
                    yield pa.record_batch([*kept.columns[:-1], pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())],
                                          names=[*keep, "text", "n_chars"])
                    texts, start, size = [], i + 1, 0

    return table.mapInArrow(run, schema)
