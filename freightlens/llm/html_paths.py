"""Main text of HTML pages by tag-path ratios.

A page is read into blocks: runs of text without a block-level border inside, each with
the path of tags (and classes) above it. Text length, punctuation and link text are
summed by path and divided by the path's blocks; the ratios are smoothed over the paths
in page order and fused to one value a path. What elements say only moves that value:

* the share of the page's text that an article or main element holds is added to its
  nodes, and those outside lose that share of their value;
* side elements (menus, headers, footers, sidebars, notices, adverts, forms, comments)
  lower their nodes below any threshold; if nothing is left, names do not count, and then
  forms do not.

Nodes whose value is at or above the spread of the fused values hold content. Where no
element names the content, unmarked blocks between them, in the lowest element with nearly
all of their text, belong to it too.

Each page is worked on by itself in one pass over (page_id, url, html): no shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements and what words in class, id and role say of one.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
SKIPPED = frozenset("template svg select button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym annotation b bdi bdo big cite code data del dfn em font i ins kbd label maction mark math merror mfrac mi mn mo "
                    "mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover nobr object output q rp rt "
                    "ruby s samp semantics small span strike strong sub sup time tt u var xmp").split())
CONTAINERS = frozenset("div section aside ul ol dl table details figure center fieldset".split())
SIDE_TAGS = frozenset("nav footer aside menu dialog head fieldset".split())
ROOT_TAGS = frozenset(("article", "main"))
PAGE_TAGS = frozenset(("", "html", "body"))
SIDE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs masthead footer sidebar aside widget cookie cookies consent gdpr notice notices banner popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments disqus respond replies "
    "contentinfo complementary search dialog alert pagination pager toolbar skip").split())
HEADER_WORDS = frozenset(("header", "topbar"))
#: What a class like "with-sidebar" begins with: it tells of the layout, not of the element.
LAYOUT = ("has-", "with-", "no-", "without-", "has_", "with_", "no_")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ()}

# A tag is a name and attributes; quotes enclose a value only after an equals sign.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)"""
NAMED = r"[^\s/>][^\s/>=]*+"
TAG = rf"</?[a-zA-Z][^\s/>]*+(?:[\s/]*+{NAMED}(?:\s*+=\s*+{VALUE}?)?)*+[\s/]*+>"
MARKUP = re.compile(rf"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|{TAG}|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(rf"({NAMED})(?:\s*+=\s*+({VALUE}))?")
HEADING = re.compile(r"h[1-6]")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


#: How an element is known to be beside the content.
BY_NAME, BY_FORM, BY_TAG = 1, 2, 3
#: Elements above one another, as browsers bound them; deeper ones are read as siblings.
DEEPEST = 512


class Path:
    """The labels from the root down to an element; one object a path."""

    __slots__ = ("label", "above", "below")

    def __init__(self, label: str = "", above: "Path | None" = None):
        self.label, self.above, self.below = label, above, {}

    def __truediv__(self, label: str) -> "Path":
        if label not in self.below:
            self.below[label] = Path(label, self)
        return self.below[label]

    def __str__(self) -> str:
        return f"{self.above}/{self.label}" if self.above else self.label


class Node:
    __slots__ = ("tag", "parent", "path", "side", "has_root", "root")

    def __init__(self, tag: str, parent: "Node | None", label: str = "", side: int = 0):
        self.tag, self.parent = tag, parent
        self.path = parent.path / (label or tag) if parent else Path()
        self.root = (parent and parent.root) or (self if tag in ROOT_TAGS else None)  # the outermost article or main
        self.side, self.has_root = side, False

    def above(self) -> Iterator["Node"]:
        node = self
        while node is not None:
            yield node
            node = node.parent

    def beside(self, least: int) -> bool:
        """Whether the node or one above it is marked, by ``least`` or more."""
        return any(n.side >= least and not (n.has_root and n.side < BY_TAG) for n in self.above())


def _named(tokens: list[str], inside: bool, tag: str) -> bool:
    """Whether class, id or role tokens name a side element. Inside an article the token must
    be the word, on a container; elsewhere a word in it will do."""
    tokens = [t.lower() for t in tokens if not t.lower().startswith(LAYOUT)]
    if inside:
        return tag in CONTAINERS and any(t in SIDE_WORDS for t in tokens)
    words = {w.lower() for t in tokens for w in WORDS.findall(t)}
    return not HEADING.fullmatch(tag) and bool(words & SIDE_WORDS or words & HEADER_WORDS)


def _describe(tag: str, source: str, parent: Node) -> Node:
    """A node from a start tag: its label, and whether tag and names say it is no content."""
    inside = parent.root is not None
    side = BY_TAG if tag in SIDE_TAGS or tag in ("header", "noscript") and not inside else BY_FORM if tag == "form" else 0
    label = tag
    if len(source) > len(tag) + 2:
        tokens: list[str] = []
        for name, value in ATTRIBUTE.findall(source, len(tag) + 1, len(source) - 1):
            name, value = name.lower(), value[1:-1] if value[:1] in ("'", '"') else value
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                side = max(side, BY_TAG)
            elif name in ("class", "id", "role"):
                tokens += value.split()
                if name == "class" and value:
                    label = f"{tag}.{'.'.join(sorted(value.split()))}"
        if tokens and not side and tag not in ("html", "body", *ROOT_TAGS) and _named(tokens, inside, tag):
            side = BY_NAME
    return Node(tag, parent, label, side)


def _end_of(page: str, tag: str, at: int) -> int:
    """Behind the end tag of an element that has begun, its like inside it counted; -1 if there is none."""
    depth = 1
    for found in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*(/?)>", re.I).finditer(page, at):
        depth += -1 if found[1] else 0 if found[0].endswith("/>") else 1
        if not depth:
            return found.end()
    return -1


def blocks(page: str) -> list[tuple[Node, str, int]]:
    """(element, text, characters of links) of every block of a page, in page order."""
    top = Node("", None)
    stack, found = [top], []
    pieces: list[str] = []
    linked = at = links = 0

    def end_block() -> None:
        nonlocal links
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append((stack[-1], text, min(links, len(text))))
            pieces.clear()
        links = 0

    def take(text: str) -> None:
        nonlocal links
        if text:
            pieces.append(text)
            links += len(text) if linked else 0

    size = len(page)
    while at < size:
        match = MARKUP.search(page, at)
        if match is None:
            take(page[at:])
            break
        take(page[at:match.start()])
        source, at = match[0], match.end()
        name = TAG_NAME.match(source)
        if name is None:
            continue
        tag, closing = name[1].lower(), source[1] == "/"
        if tag in RAW or tag in SKIPPED:
            if tag in RAW and not closing:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                close = page.find(">", end.start()) if end else -1
                at = close + 1 if close >= 0 else size
            elif not closing and not source.endswith("/>"):
                at = max(at, _end_of(page, tag, at))  # one without an end takes nothing along
            continue
        if tag in ("br", "wbr"):
            take(" " if tag == "br" else "")
        elif tag in VOID:
            if tag == "hr":
                end_block()
        elif tag in INLINE:
            if tag == "a":
                linked = 0 if closing else 1
        elif closing:
            end_block()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        else:
            end_block()
            if stack[-1].tag == "p":
                stack.pop()
            for k in range(len(stack) - 1, 0, -1) if tag in SELF_CLOSING else ():
                if stack[k].tag in HOLDS[tag]:
                    break
                if stack[k].tag in SELF_CLOSING[tag]:
                    del stack[k:]
                    break
            if not source.endswith("/>"):
                stack = stack[:DEEPEST - 1] if len(stack) >= DEEPEST else stack
                stack.append(_describe(tag, source, stack[-1]))
    end_block()
    return found


def path_values(found: list[tuple[Node, str, int]]) -> tuple[dict[Path, float], float]:
    """Of every path the fused value of its smoothed text and punctuation ratios, 0 to 2, and
    the threshold: the spread of the values."""
    sums: dict[Path, list[float]] = {}
    for node, text, links in found:
        s = sums.setdefault(node.path, [0, 0, 0])
        s[0] += 1
        s[1] += len(text) - links
        s[2] += len(PUNCTUATION.findall(text))
    order = list(sums)
    ratios = [[sums[p][k] / sums[p][0] for p in order] for k in (1, 2)]
    fused = [0.0] * len(order)
    for values in ratios:
        last = len(values) - 1
        smooth = [(values[max(0, i - 1)] + 2 * v + values[min(last, i + 1)]) / 4 for i, v in enumerate(values)]
        most = max(smooth, default=0) or 1.0
        fused = [f + (v + s) / (2 * most) for f, v, s in zip(fused, values, smooth)]
    return dict(zip(order, fused)), pstdev(fused) if len(fused) > 1 else 0.0


def content_nodes(found: list[tuple[Node, str, int]]) -> set[Node]:
    """The nodes of unmarked blocks whose path's value, moved by the share of the text that
    their article or main element holds, reaches the threshold."""
    values, threshold = path_values(found)
    held: dict[Node | None, int] = {}
    for node, text, links in found:
        held[node.root] = held.get(node.root, 0) + len(text) - links
    total = sum(held.values()) or 1
    marked = 1 - held.get(None, 0) / total

    def value(node: Node) -> float:
        fused = values[node.path]
        return fused * (1 - marked) if node.root is None else fused + 2 * held[node.root] / total

    return {node for node, _, _ in found if value(node) >= threshold and value(node) > 0}


def _common(nodes: list[Node]) -> Node:
    """The lowest element above all of the nodes."""
    shared = list(nodes[0].above())
    for node in nodes[1:]:
        own = set(node.above())
        shared = [n for n in shared if n in own]
    return shared[0]


def _joined(found: list[tuple[Node, str, int]], nodes: set[Node]) -> str:
    """The blocks of the content, one a line.

    Outside article and main elements content lies in one region: the lowest element with
    nearly all of the content's text, widened to the content of the same paths. There no
    block goes that is not mostly links; on the page's own level only from the first content
    (with the headings before it) to the last.
    """
    kept = {i for i, (node, _, _) in enumerate(found) if node.root is not None and node in nodes}
    free = [(node, len(text) - links) for node, text, links in found if node.root is None and node in nodes]
    if free:
        weight: dict[Node, int] = {}
        for node, n in free:
            for above in node.above():
                weight[above] = weight.get(above, 0) + n
        total = sum(n for _, n in free)
        core = max((n for n, w in weight.items() if 5 * w >= 4 * total), key=lambda n: sum(1 for _ in n.above()))
        paths = {node.path for node, _ in free if any(a is core for a in node.above())}
        region = _common(list({node for node, _ in free if node.path in paths} | {core}))
        inside = {i for i, (node, _, _) in enumerate(found) if node.root is None and any(a is region for a in node.above())}
        if region.tag in PAGE_TAGS:
            chosen = sorted(i for i in inside if found[i][0] in nodes and found[i][0].path in paths)
            first = chosen[0]
            while first - 1 in inside and HEADING.fullmatch(found[first - 1][0].tag):
                first -= 1
            inside = {i for i in inside if first <= i <= chosen[-1]}
        kept.update(i for i in inside if 2 * found[i][2] < len(found[i][1]) or found[i][0] in nodes and found[i][0].path in paths)
    return "\n".join(found[i][1] for i in sorted(kept))


def _wrappers(everything: list[tuple[Node, str, int]]) -> None:
    """Mark the elements that hold half of the text of article and main elements or more:
    names and forms around these say nothing."""
    held: dict[Node, int] = {}
    total = 0
    for node, text, links in everything:
        if node.root is not None and not node.beside(BY_TAG):
            total += len(text) - links
            for above in node.root.above():
                held[above] = held.get(above, 0) + len(text) - links
    for node, n in held.items():
        node.has_root = 2 * n >= total > 0


def main_text(page: str) -> str:
    """The article's blocks, one a line."""
    everything = blocks(page)
    _wrappers(everything)
    for least in (BY_NAME, BY_FORM, BY_TAG):  # what marks a side element; the weaker signs go first
        found = [b for b in everything if not b[0].beside(least)]
        nodes = content_nodes(found)
        if any(len(text) > links for node, text, links in found if node in nodes):
            return _joined(found, nodes)
    return ""


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every row; other columns are not read.

    A null or empty html, and a page without content, give an empty text. Ids may be
    null or repeated, each row is worked on by itself; an empty table gives no rows.
    """
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        F.col(html_column).cast("string").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64()), pa.array((t.count("\n") + 1 if t else 0 for t in texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long, n_blocks long")
