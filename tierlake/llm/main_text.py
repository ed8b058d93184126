"""Main text of HTML pages by minimum cut.

A page becomes its blocks of text in page order. A classifier gives every block a score: how much likelier it is the
article's than boilerplate, from the elements it stands in and from its words and links. A positive score is the cost of
calling the block boilerplate (capacity from the source), a negative one that of calling it content (capacity to the sink).
Blocks that follow each other, and blocks of one parent element, are joined by smoothness edges, which cost their weight if
one end is content and the other isn't. The cheapest labelling is a minimum cut, found by maximum flow.

Before the flow, blocks whose score outweighs all their edges are settled, and their neighbours' scores take over the edge;
that leaves the cut as it is and the flow small. Of equally cheap labellings the one with the least content is taken.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Comments, declarations and tags; a quoted value may hold ">", but no "<".
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt rtc ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
SILENT = frozenset("area base basefont col embed frame img input keygen link meta param source track wbr".split())
#: Elements whose text is no part of a page's text, and of these the ones that hold raw characters up to their end tag.
DROPPED = frozenset("button datalist head iframe noscript object option select svg template canvas audio video".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
#: A start tag closes an open element of these kinds right above it.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
#: Names that mark page furniture wherever it stands, and names an article may well stand inside.
FURNITURE = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion comment comments reply replies disqus sidebar "
    "aside related recommended recommendations share sharing social footer copyright newsletter subscribe subscription "
    "cookie cookies consent gdpr paywall widget pagination pager breadcrumb breadcrumbs toc".split()
)
AROUND = frozenset(
    "nav navbar navigation menu header masthead topbar toolbar banner notice notification alert popup modal overlay dialog form "
    "login signup search".split()
)
GOOD = frozenset("article content main post entry story body text".split())
LEGAL = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.IGNORECASE)
SENTENCE = re.compile(r"[.!?;:,。，！？]")

ARTICLE_SCORE, GOOD_SCORE, FURNITURE_SCORE = 4.0, 1.5, 9.0
FOLLOWING, SIBLING, UNIT = 1.0, 0.6, 1000


@dataclass
class Element:
    """An open element: what it says of the text inside."""

    tag: str
    number: int
    parent: int
    good: float = 0.0
    around: float = 0.0
    furniture: float = 0.0
    dropped: bool = False


@dataclass
class Block:
    """One run of text, its element's number, the element's parent, and how far up the page's tree the way from the block before goes."""

    text: str
    words: int
    linked: float
    tag: str
    region: float
    inside: int
    parent: int
    hops: int


@dataclass
class _Page:
    """The open elements and the text gathered for the block at hand."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Element] = field(default_factory=lambda: [Element("", 0, -1)])
    open: dict[str, int] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)
    made: int = 0
    linked: int = 0
    link_depth: int = 0
    depth: int = 0
    lowest: int = 0

    def text(self, piece: str) -> None:
        if piece and not self.stack[-1].dropped:
            if "&" in piece:
                piece = unescape(piece)
            if self.link_depth:
                self.linked += len(piece.strip())
            self.pieces.append(piece)

    def end_block(self) -> None:
        words = "".join(self.pieces).split()
        if words:
            top, text = self.stack[-1], " ".join(words)
            depth = len(self.stack)
            hops = self.depth + depth - 2 * min(self.lowest, depth)
            region = top.good - top.around - top.furniture
            share = min(1.0, self.linked / len(text))
            self.blocks.append(Block(text, len(words), share, top.tag, region, top.number, top.parent, hops))
            self.depth = self.lowest = depth
        self.pieces, self.linked = [], 0

    def push(self, tag: str, attributes: str) -> None:
        self.end_block()
        while self.stack[-1].tag == "p" or self.stack[-1].tag in CLOSES.get(tag, ()):
            self.pop()
        if self.stack[-1].tag == "head":
            self.pop()
        over = self.stack[-1]
        self.made += 1
        element = Element(tag, self.made, over.number, over.good, over.around, over.furniture, over.dropped)
        _judge(element, attributes)
        self.stack.append(element)
        self.open[tag] = self.open.get(tag, 0) + 1

    def pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1
        self.lowest = min(self.lowest, len(self.stack))
        if self.link_depth > len(self.stack):
            self.link_depth = 0

    def close(self, tag: str) -> None:
        self.end_block()
        if self.open.get(tag):
            while self.stack[-1].tag != tag:
                self.pop()
            self.pop()


def _judge(element: Element, attributes: str) -> None:
    """What tag, class, id and role say, added to what the elements around it said."""
    tag, names, role = element.tag, set(), ""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id") and tag not in ("html", "body"):
            names.update(part.lower() for part in NAME_PART.findall(value))
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            element.dropped = True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            element.dropped = True
    if tag in ("article", "main") or role == "main":
        element.good, element.around = ARTICLE_SCORE, element.around * 0.2
    elif names & GOOD:
        element.good, element.around = max(element.good, GOOD_SCORE), element.around * 0.6
    in_article = element.good >= ARTICLE_SCORE
    if tag in ("aside", "footer") or names & FURNITURE or role in ("complementary", "contentinfo"):
        element.furniture = FURNITURE_SCORE
    if tag in ("nav", "form", "dialog", "menu") or role in ("navigation", "banner", "search", "dialog", "alert"):
        element.around = FURNITURE_SCORE
    elif tag not in ("article", "main") and names & AROUND or tag == "header":
        if not (in_article and (tag == "header" or "header" in names)):
            element.around = FURNITURE_SCORE
    if tag in DROPPED:
        element.dropped = True


def blocks(html: str) -> list[Block]:
    """The blocks of text of a page in page order; broken markup never fails."""
    page, at, size = _Page(), 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        if not found:
            page.text(html[at:])
            break
        page.text(html[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if not closing and tag in RAW:
            end = re.compile("</{}(?=[\\s/>])[^>]*>?".format(tag), re.IGNORECASE).search(html, at)
            at = end.end() if end else size
        elif tag in INLINE:
            if tag == "a":
                page.link_depth = 0 if closing else len(page.stack)
        elif tag in ("br", "hr"):
            page.end_block()
        elif tag in SILENT or tag in RAW:
            continue
        elif closing:
            page.close(tag)
        elif attributes.endswith("/") and tag in ("path", "use", "rect", "circle", "g"):
            continue
        else:
            page.push(tag, attributes)
    page.end_block()
    return page.blocks


def score(block: Block) -> float:
    """How much likelier the block is the article's than boilerplate."""
    value = block.region + min(block.words, 40) / 16 - 4.0 * block.linked
    if SENTENCE.search(block.text):
        value += 0.5
    if block.tag in ("li", "td", "th"):
        value -= 0.5
    if block.region < ARTICLE_SCORE and block.words <= 30 and LEGAL.search(block.text):
        value -= 3.0
    return value


def smoothness(found: list[Block]) -> dict[tuple[int, int], int]:
    """Weight of each edge: to the block that follows, less the further apart in the tree, and to the next in one parent."""
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for number, block in enumerate(found):
        if number:
            edges[number - 1, number] = round(UNIT * FOLLOWING / (1 + block.hops))
        before = last.get(block.parent)
        if before is not None:
            edges[before, number] = edges.get((before, number), 0) + round(UNIT * SIBLING)
        last[block.parent] = number
    return edges


def minimum_cut(scores: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """The cheapest labelling (true: content), of equal ones that with the least content."""
    near: list[dict[int, int]] = [{} for _ in scores]
    for (a, b), weight in edges.items():
        near[a][b] = near[a].get(b, 0) + weight
        near[b][a] = near[b].get(a, 0) + weight
    left, label = list(scores), [None] * len(scores)
    around = [sum(n.values()) for n in near]
    queue = deque(range(len(scores)))
    while queue:
        one = queue.popleft()
        if label[one] is not None or -around[one] < left[one] <= around[one]:
            continue
        label[one] = left[one] > 0
        for other, weight in near[one].items():
            if label[other] is None:
                left[other] += weight if label[one] else -weight
                around[other] -= weight
                queue.append(other)
    rest = [one for one, known in enumerate(label) if known is None]
    if rest:
        reached = _source_side(rest, left, near, label)
        for one in rest:
            label[one] = one in reached
    return label


def _source_side(rest: list[int], left: list[int], near: list[dict[int, int]], label: list) -> set[int]:
    """Nodes that the source still reaches after a maximum flow (shortest paths, level by level)."""
    room: dict[int, dict[int, int]] = {one: {o: w for o, w in near[one].items() if label[o] is None} for one in rest}
    supply = {one: left[one] for one in rest if left[one] > 0}
    demand = {one: -left[one] for one in rest if left[one] < 0}
    while True:
        level, queue = {one: 0 for one in supply if supply[one]}, deque(one for one in supply if supply[one])
        meets = False
        while queue:
            one = queue.popleft()
            meets = meets or bool(demand.get(one))
            for other, free in room[one].items():
                if free and other not in level:
                    level[other] = level[one] + 1
                    queue.append(other)
        if not meets:
            return set(level)
        ways = {one: list(room[one]) for one in level}  # neighbours still worth a try, from the end
        for start in supply:
            path = [start]
            while path and supply[start]:
                here = path[-1]
                if demand.get(here):
                    flow = min([supply[start], demand[here], *[room[a][b] for a, b in zip(path, path[1:])]])
                    supply[start] -= flow
                    demand[here] -= flow
                    for a, b in zip(path, path[1:]):
                        room[a][b] -= flow
                        room[b][a] += flow
                    path = [start]
                    continue
                options = ways[here]
                while options and not (room[here][options[-1]] and level.get(options[-1]) == level[here] + 1):
                    options.pop()
                if options:
                    path.append(options[-1])
                else:
                    path.pop()
                    if path:
                        ways[path[-1]].pop()


def main_text(html: str | None) -> str:
    """The blocks labelled content, joined by one space."""
    found = blocks(html or "")
    labels = minimum_cut([round(UNIT * score(block)) for block in found], smoothness(found))
    return " ".join(block.text for block, content in zip(found, labels) if content)


def extract_main_text(pages: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: row_id, the columns of ``keep``, text and n_chars (code points).

    A null or empty page, and one without any content block, has an empty text. Repeated rows and keys are rows of their
    own; null keys stay null. Whole pages are read whatever their length, one at a time in a task. Columns other than those
    named are ignored. No page gives no row.
    """
    rows = pages.select(F.col(key).alias("row_id"), *[F.col(name) for name in keep], F.col(html).alias("__html"))
    kept = [*rows.columns[:-1]]
    fields = ", ".join("`{}` {}".format(name, rows.schema[name].dataType.simpleString()) for name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(value.as_py()) for value in batch.column("__html")], pa.large_string())
            sizes = pa.array([len(value.as_py()) for value in texts], pa.int64())
            columns = [*[batch.column(name) for name in kept], texts.cast(pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars"])

    return rows.mapInArrow(run, fields + ", text string, n_chars long")
