"""Main text of web pages by composite text density.

Every node gets its characters per tag, adjusted by how much of them are links (a node of links
falls, a node of prose rises). A node's density sum adds up its children's densities; the node of
the highest sum holds the prose. The lowest density on its path up to the body is the threshold:
subtrees of the body that reach it are content too. Elements that never hold an article are cut out
before densities are taken. Parts whose class or id names something else (navigation, adverts,
comments, ...) are cut out unless headings, articles or their own density speak for them.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowloom.llm.texts import table, text_list

#: Elements of HTML by how they behave (fixed values of the format).
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
    "ul".split()
)
#: An open element that a start tag ends, and the element that bounds the search for it.
ENDS_OPEN = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")), "option": (("option",), ("select",)),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
}
#: Elements that never hold the article.
NOT_CONTENT = frozenset(
    "head script style noscript template nav aside footer form button select input textarea iframe "
    "svg canvas object embed dialog menu noembed noframes audio video map".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
#: Words in class and id that name something other than the article.
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices notification popup modal overlay sidebar "
    "sidenav aside menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment "
    "comments commentlist reply replies respond disqus share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search pagination pager toolbar "
    "widget widgets hidden".split()
)
#: Names of a discussion, which is prose too: density and headings do not speak for it.
DISCUSSION = frozenset(
    "comments commentlist comment-list comment_list replies respond disqus "
    "disqus_thread".split()
)
#: Words that a name may hold beside those of NAMES.
NEUTRAL = frozenset("bar block box container list".split())
HOLDERS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What short prose is in; parts of lists and tables, which are not judged by themselves.
PROSE = HEADINGS | frozenset("p ul ol dl table pre blockquote figure header hgroup".split())
WITHIN_LISTS = frozenset("p li dt dd tr td th caption figcaption summary".split())
#: Share of the body's unlinked characters below which a named part is cut whatever its density,
#: and the share for one that stands beside an article or main; beside one with a heading it is cut.
SMALL_SHARE, SMALL_BESIDE = 0.1, 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
#: What hides the rest of a page that has no more ">".
_NEVER_CLOSED = re.compile(r"<!--|<!\[CDATA\[")
_NAMING = re.compile(
    r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
    re.IGNORECASE,
)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = (
        "tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density",
        "density_sum", "named",
    )

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.density_sum = 0.0
        self.named = ""


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NOT_CONTENT or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value in _NAMING.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and value.lower() != "until-found":
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.lower().replace(" ", ""):
            return True
    return False


def _named(tag: str, attributes: str, in_article: bool) -> str:
    """"other" or "discussion" if a whole class, or the id, names something but the article."""
    if not attributes or tag in HEADINGS or tag in INLINE or tag in ("html", "body"):
        return ""
    found = ""
    for name, value in _NAMING.findall(attributes):
        name = name.lower()
        if name not in ("class", "id"):
            continue
        for token in value.strip("\"'").split():
            if token.lower() in DISCUSSION or tag in HOLDERS and token.lower() == "comment":
                return "discussion"
            # An id inside an article is an anchor.
            if tag in HOLDERS or name == "id" and in_article:
                continue
            pieces = {piece.lower() for piece in _PIECES.findall(token)}
            if pieces & NAMES and pieces <= NAMES | NEUTRAL:
                found = "other"
    return found


class _Open:
    """The open elements: the innermost one, and at what depths which tags are open.

    Every question is answered from the ends of a few lists, so deep nesting costs nothing.
    """

    def __init__(self) -> None:
        self.root = self.node = Node("#root", None)
        self.articles = 0
        self._depth = 0
        self._depths: dict[str, list[int]] = {}
        #: Depths of what is neither a paragraph nor inline; the root is such.
        self._barriers = [0]

    def add(self, child: Node, closed: bool) -> None:
        self.node.children.append(child)
        if not closed:
            self.node = child
            self._depth += 1
            self._depths.setdefault(child.tag, []).append(self._depth)
            if child.tag != "p" and child.tag not in INLINE:
                self._barriers.append(self._depth)
            self.articles += child.tag in HOLDERS

    def holds(self, tag: str) -> bool:
        return bool(self._depths.get(tag))

    def _nearest(self, tag: str) -> int:
        depths = self._depths.get(tag)
        return depths[-1] if depths else 0

    def close(self, tag: str) -> None:
        """Close open elements up to the nearest of that tag."""
        while True:
            node = self.node
            self._depths[node.tag].pop()
            if self._barriers[-1] == self._depth:
                self._barriers.pop()
            self._depth -= 1
            self.articles -= node.tag in HOLDERS
            self.node = node.parent
            if node.tag == tag:
                return

    def make_room(self, tag: str) -> None:
        """Close what a start tag ends without an end tag."""
        if tag in ENDS_PARAGRAPH:
            if self._nearest("p") > self._barriers[-1]:
                self.close("p")
        elif tag in ENDS_OPEN:
            ended, bounds = ENDS_OPEN[tag]
            inner = max(ended, key=self._nearest)
            if self._nearest(inner) > max(map(self._nearest, bounds), default=0):
                self.close(inner)


def parse(page: str) -> Node:
    """The page's tree without parts that are not content; texts are decoded strings.

    One pass: nothing behind the last ">" can end a tag, so it is not searched for one.
    """
    opened, skip, at = _Open(), False, 0
    inside: list[str] = []  # open elements inside a part that is left out
    counts: Counter = Counter()  # of their tags
    last = page.rfind(">") + 1

    def text(raw: str) -> None:
        if not skip and raw:
            opened.node.children.append(html.unescape(raw) if "&" in raw else raw)

    position = 0
    while match := _TAG.search(page, position, last):
        text(page[at:match.start()])
        at = position = match.end()
        if page.startswith("<!--", match.start()):
            if len(match[0]) < 7 or not match[0].endswith("-->"):
                return opened.root  # never closed, so the rest of the page is in it
        elif page.startswith("<![CDATA[", match.start()) and not match[0].endswith("]]>"):
            return opened.root
        if closing := match[1]:
            tag = closing.lower()
            if skip:
                if counts[tag]:
                    while (ended := inside.pop()) != tag:
                        counts[ended] -= 1
                    counts[tag] -= 1
                    skip = bool(inside)
                elif opened.holds(tag):
                    # The part was never closed: its parent ends here, and so does it.
                    skip, inside = False, []
                    counts.clear()
                    opened.close(tag)
            elif opened.holds(tag):
                opened.close(tag)
            elif tag == "p":
                opened.node.children.append(Node("p", opened.node))
            continue
        tag, attributes = match[2] or match[4], match[3] or match[5] or ""
        if not tag:
            continue
        tag = tag.lower()
        closed = tag in VOID or attributes.endswith("/") and tag in ("path", "rect", "use", "g")
        if tag in RAW_TEXT and not closed:
            end = _raw_end(tag).search(page, at, last)
            if end is None:
                return opened.root
            at = position = end.end()
            continue
        if skip:
            if not closed:
                inside.append(tag)
                counts[tag] += 1
            continue
        opened.make_room(tag)
        if _unwanted(tag, attributes, opened.articles > 0):
            opened.node.children.append(" ")
            if not closed:
                skip, inside = True, [tag]
                counts[tag] += 1
            continue
        child = Node(tag, opened.node)
        child.named = _named(tag, attributes, opened.articles > 0)
        opened.add(child, closed)
    rest = _NEVER_CLOSED.search(page, max(position, last))
    text(page[at:rest.start() if rest else len(page)])
    return opened.root


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE)


def _in_order(root: Node) -> list[Node]:
    nodes, pending = [], [root]
    while pending:
        node = pending.pop()
        nodes.append(node)
        pending += [c for c in reversed(node.children) if isinstance(c, Node)]
    return nodes


def measure(root: Node) -> list[Node]:
    """All nodes in page order, with counts, densities and density sums."""
    nodes = _in_order(root)
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body = next((n for n in nodes if n.tag == "body"), root)
    overall = body.link_chars / max(1, body.chars)
    for node in nodes:
        node.density = _density(node, overall)
    for node in nodes:
        node.density_sum = sum(c.density for c in node.children if isinstance(c, Node))
    return nodes


def _density(node: Node, overall: float) -> float:
    """Composite text density; overall is the body's share of link characters."""
    chars, tags = node.chars, max(1, node.tags)
    if not chars:
        return 0.0
    links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, chars - node.link_chars)
    base = math.log(chars / plain * links + overall * chars + math.e)
    return max(0.0, chars / tags * math.log(chars / links * tags / link_tags) / math.log(base))


def _body_path(nodes: list[Node], body: Node) -> tuple[Node, float]:
    """The node of the highest density sum, and the lowest density from it up to the body."""
    best = max(nodes, key=lambda n: (n.density_sum, n.density))
    threshold, path = best.density, best
    while path is not body and path.parent is not None and path.parent is not body:
        path = path.parent
        threshold = min(threshold, path.density)
    return best, threshold


def _cut_named(root: Node) -> list[Node]:
    """All nodes, measured, without named parts that nothing speaks for."""
    nodes = _in_order(root)
    if not any(n.named for n in nodes):
        return measure(root)
    spoken_for = set()
    for node in reversed(nodes):
        if node.parent is not None and (
            node in spoken_for or node.tag in HEADINGS
            or node.tag in HOLDERS and node.named != "discussion"
        ) and node.named != "discussion":
            spoken_for.add(node.parent)
    within: set[Node] = set()  # articles and mains and what is inside them
    for node in nodes:
        if node.tag in HOLDERS or node.parent in within:
            within.add(node)
    measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    unlinked = body.chars - body.link_chars
    cut, pending = [], [root]
    while pending:
        node = pending.pop()
        for i, child in enumerate(node.children):
            if not isinstance(child, Node):
                continue
            if child.named == "discussion" or child.named and child not in spoken_for:
                node.children[i] = " "
                cut.append((node, i, child, child.density, child.chars - child.link_chars))
            else:
                pending.append(child)
    nodes = measure(root)
    _, threshold = _body_path(nodes, body)
    held = any(n.tag in HOLDERS and n.chars for n in nodes)
    titled = any(n.tag in HEADINGS and n.chars and n in within for n in nodes)
    back = []
    for node, i, child, density, plain in cut:
        beside = held and node not in within
        if beside and titled:
            continue
        least = max(1, (SMALL_BESIDE if beside else SMALL_SHARE) * unlinked)
        if child.named != "discussion" and density >= threshold and plain >= least:
            back.append((node, i, child))
    for node, i, child in back:
        node.children[i] = child
    return measure(root) if back else nodes


def _of_links(node: Node) -> bool:
    """Whether a part is a list of links rather than prose that holds some."""
    return (
        node.tag not in INLINE and node.tag not in WITHIN_LISTS and node.tag not in HEADINGS
        and node.link_tags > 1 and 2 * node.link_chars > node.chars
    )


def content(root: Node) -> Node | None:
    """The body with only what belongs to the article; None if there is no text.

    On the path from the body to the best node, what stands beside it stays if its density
    reaches the threshold; an article, or a paragraph, list or heading below the body stays
    below it too. In what stays, and in the best node, only lists of links below the threshold go.
    Of what goes, subtrees that reach the threshold stay.
    """
    nodes = _cut_named(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    if not body.chars:
        return None
    best, threshold = _body_path(nodes, body)
    if not _below(best, body):
        best, threshold = body, body.density
    path, above = set(), best
    while above is not body:
        path.add(above)
        above = above.parent
    pending = [(body, "whole" if best is body else "path")]
    while pending:
        node, part = pending.pop()
        for i, child in enumerate(node.children):
            if isinstance(child, str):
                if part == "dense" or part == "path" and node is body:
                    node.children[i] = " "
                continue
            reaches = child.density >= threshold
            if part == "path" and child in path:
                whole = child is best or child.tag == "article"
                pending.append((child, "whole" if whole else "path"))
            elif reaches or not _of_links(child) and (
                part == "whole" or part == "path" and (
                    child.tag in HOLDERS or node is not body and child.tag in PROSE
                )
            ):
                pending.append((child, "whole"))
            else:
                pending.append((child, "dense"))
    return body


def _below(node: Node, above: Node) -> bool:
    while node is not None and node is not above:
        node = node.parent
    return node is above


def text_of(node: Node) -> str:
    """Texts of a subtree in page order; blocks and line breaks end in white space."""
    parts: list[str] = []
    pending: list[Node | str] = [node]
    while pending:
        item = pending.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag in INLINE:
            pending += reversed(item.children)
        else:
            parts.append(" ")
            pending.append(" ")
            pending += reversed(item.children)
    return "".join(parts)


def main_text(page: str) -> str:
    """The article of a page as one line; empty if there is none."""
    if not page:
        return ""
    body = content(parse(page))
    return "" if body is None else " ".join(text_of(body).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; no shuffle.

    Null and empty html, and pages without prose, give an empty text. Each row is handled by
    itself, so repeated rows and equal or null ids give equal rows; other columns are ignored.
    Broken markup is read as far as it goes; whole pages are read whatever their length. An
    empty table gives no rows.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in text_list(batch, "html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long"
    )


def op3_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
