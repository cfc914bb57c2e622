"""Main text of web pages by minimum-cut labelling of their text blocks.

A page becomes a row of blocks: runs of text between block-level tags, without scripts, styles and comments. A
linear classifier scores each block from its tags, class words, links and words. Its score is the cost of
the other label: a positive one the capacity from the source (content), a negative one the capacity to the sink
(boilerplate). Neighbours in the page, and neighbours under one parent, are joined by edges, stronger the nearer
they are in the element tree. The maximum flow's minimum cut is the cheapest labelling, and the blocks still
reachable from the source are the text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
RAW = "script|style|textarea"  # run to the end of the page if not closed
SKIPPED = "template|noscript|svg|math|iframe|object|canvas|select|button|title|option"
SKIPPED_TAGS = frozenset(SKIPPED.split("|"))
TO_NEXT_TAG = frozenset(("option", "title"))  # where not closed
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br input".split()
)
#: Their class words name the kind of page or its layout.
WHOLE_PAGE = frozenset(("html", "body", "main", "article"))
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_OWN_KIND = frozenset("p li dt dd tr td th option".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog header".split())
CONTENT_TAGS = frozenset(("article", "main"))
HEADS = CONTENT_TAGS | {"h1"}
BOILERPLATE_WORDS = re.compile(
    r"(?<![a-z])(?:ads?|advert[a-z]*|banners?|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disqus|footer|"
    r"header|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo[a-z]*|"
    r"related|repl(?:y|ies)|search|share|sharing|sidebar|signup|social|sponsor[a-z]*|subscribe|toolbar|widgets?|"
    r"alert|complementary|contentinfo)(?![a-z])"
)
CONTENT_WORDS = re.compile(r"(?<![a-z])(?:article|content|entry|main|post|story|text|body)(?![a-z])")
ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
TEXTLESS = rf"<!--.*?(?:-->|\Z)|<({RAW})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
MARKUP = re.compile(rf"{TEXTLESS}|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({ATTRIBUTES})>|<[!?/][^>]*>", re.S | re.I)
PAIRED = re.compile(rf"{TEXTLESS}|<(/?)({SKIPPED})(?![a-zA-Z0-9:-])({ATTRIBUTES})>", re.S | re.I)
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Capacities are whole numbers; a score of 1 is UNIT.
UNIT = 100
NEAR, SIBLING = 60, 40


class Element:
    """A block-level element: what its descendants inherit of it. Its rank is known when the whole page is read."""

    __slots__ = ("depth", "holds", "inside_content", "lifts", "parent", "rank", "sinks", "size", "tag")

    def __init__(self, tag: str, parent: Element | None, names: str) -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.inside_content = tag in CONTENT_TAGS or (parent.inside_content if parent else False)
        names = names.lower()
        marked = bool(names) and bool(BOILERPLATE_WORDS.search(names))
        self.sinks = marked and tag not in WHOLE_PAGE
        self.lifts = bool(names) and not self.sinks and not self.inside_content and bool(CONTENT_WORDS.search(names))
        self.size, self.holds, self.rank = 0, False, 0.0
        if tag in HEADS and not marked:  # a comment may be an article as well
            above = parent
            while above and not above.holds:
                above.holds = True
                above = above.parent

    def settle(self, total: int) -> None:
        """The rank, after that of the parent. A class word names the layout, not the part, where the element holds
        an article, main part or title and more than half of the page's text."""
        rank = self.parent.rank if self.parent else 0.0
        inside = self.parent.inside_content if self.parent else False
        if self.tag in CONTENT_TAGS:
            rank += 3
        elif self.tag in BOILERPLATE_TAGS and not (self.tag == "header" and inside):
            rank = min(rank, 0.0) - 6
        if self.sinks and not (self.holds and 2 * self.size > total):
            rank = min(rank, 0.0) - 6
        elif self.lifts:
            rank += 2
        self.rank = max(-9.0, min(rank, 5.0))


class Block:
    __slots__ = ("linked", "parent", "score", "text")

    def __init__(self, text: str, parent: Element, linked: int) -> None:
        self.text, self.parent, self.linked, self.score = text, parent, linked, 0.0
        above: Element | None = parent
        while above:
            above.size += len(text)
            above = above.parent

    def settle(self) -> None:
        words = self.text.count(" ") + 1
        kind = self.parent.tag
        score = self.parent.rank - 1 + (1.5 if kind == "p" else 0.5 if kind[0] == "h" and kind[1:].isdigit() else -0.5 if kind == "li" else 0)
        score += min(2.0, words / 20) if words >= 5 else -0.5
        score -= 4 * min(1.0, self.linked / len(self.text))
        self.score = score


def skipped_ends(page: str) -> dict[int, int]:
    """Where each closed element of ``SKIPPED`` ends, by its start. A closing tag belongs to the last open tag of its name."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for found in PAIRED.finditer(page):
        if found[3] is None:
            continue
        starts = opened.setdefault(found[3].lower(), [])
        if not found[2]:
            starts.append(found.start())
        elif starts:
            ends[starts.pop()] = found.end()
    return ends


def blocks_of(page: str) -> list[Block]:
    ends = skipped_ends(page)
    root = Element("html", None, "")
    stack, elements, pieces, out = [root], [root], [], []
    links, linked, at = 0, 0, 0

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, stack[-1], linked))
            pieces.clear()
        linked = 0

    while found := MARKUP.search(page, at):
        start = found.start()
        if start > at:
            pieces.append(page[at:start])
            if links:
                linked += start - at
        at = found.end()
        name = found[3]
        if name is None:
            continue
        tag = name.lower()
        if tag in SKIPPED_TAGS:
            if start in ends:
                at = ends[start]
            elif tag in TO_NEXT_TAG and not found[2]:
                following = page.find("<", at)
                at = len(page) if following < 0 else following
            continue
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                links = 0 if found[2] else 1
            continue
        close_block()
        if tag in EMPTY or tag == "head":  # all that a head may hold is skipped, so what else comes is of the body
            continue
        if found[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1].tag == tag and tag in CLOSED_BY_OWN_KIND or stack[-1].tag == "p":
            stack.pop()
        attributes = found[4]
        names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if attributes else ""
        stack.append(Element(tag, stack[-1], names))
        elements.append(stack[-1])
        links = 0
    pieces.append(page[at:])
    close_block()
    for part in (*elements, *out):  # parents come before their children
        part.settle(root.size) if isinstance(part, Element) else part.settle()
    return out


def tree_distance(x: Element, y: Element) -> int:
    """Edges between two elements of the tree, 12 at most."""
    steps = 0
    while x is not y and steps < 12:
        if x.depth >= y.depth:
            x = x.parent
        else:
            y = y.parent
        steps += 1
    return steps


def minimum_cut(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node stays on the source's side.

    ``excess``: capacity from the source (positive) or to the sink (negative) of each node; ``edges``: (node, node,
    capacity both ways). Dinic's algorithm: shortest paths by levels, a blocking flow in each phase.
    """
    n = len(excess)
    supply = [max(e, 0) for e in excess]
    need = [max(-e, 0) for e in excess]
    ends, room, leaving = [], [], [[] for _ in range(n)]
    for a, b, capacity in edges:
        leaving[a].append(len(ends))
        ends.append(b)
        room.append(capacity)
        leaving[b].append(len(ends))
        ends.append(a)
        room.append(capacity)
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i])
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            if need[i]:
                reached = True
                continue
            for e in leaving[i]:
                if room[e] and level[ends[e]] < 0:
                    level[ends[e]] = level[i] + 1
                    queue.append(ends[e])
        if not reached:
            return [x >= 0 for x in level]
        following = [0] * n
        for start in range(n):
            while supply[start]:
                path, node = [], start
                while not need[node]:
                    moved = False
                    while following[node] < len(leaving[node]):
                        e = leaving[node][following[node]]
                        if room[e] and level[ends[e]] == level[node] + 1:
                            path.append(e)
                            node = ends[e]
                            moved = True
                            break
                        following[node] += 1
                    if not moved:
                        if not path:
                            break
                        node = ends[path.pop() ^ 1]
                        following[node] += 1
                if not need[node]:
                    break
                amount = min(supply[start], need[node], *(room[e] for e in path)) if path else min(supply[start], need[node])
                supply[start] -= amount
                need[node] -= amount
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount


def content_blocks(page: str) -> list[str]:
    """The texts of the blocks labelled content, in page order."""
    blocks = blocks_of(page)
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            steps = tree_distance(blocks[i - 1].parent, block.parent)
            edges.append((i - 1, i, max(1, NEAR // (1 + steps))))
        group = block.parent.parent
        before = last.get(id(group))
        if before is not None and before != i - 1:
            edges.append((before, i, SIBLING))
        last[id(group)] = i
    keep = minimum_cut([round(UNIT * b.score) for b in blocks], edges)
    return [b.text for b, kept in zip(blocks, keep, strict=True) if kept]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *carried, pages = batch.columns
        for i in range(0, len(pages), 500):
            found = [content_blocks(x) for x in pages[i : i + 500].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(c[i : i + 500] for c in carried), pa.array(found, pa.list_(pa.string()))],
                names=[*batch.schema.names[:-1], "blocks"],
            )


def main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(row: the other columns of ``pages`` as a struct, blocks: content texts in page order) for every page.

    Character references are decoded and white space in a block is one space. A null or empty page, and one without
    content, has no blocks. Rows are independent: ties, repeats and ids do not matter. One page is held at a time.
    """
    others = [c for c in pages.columns if c != html_col]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.coalesce(html_col, F.lit("")).alias("html")
    )
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_texts, f"row {kind}, blocks array<string>")
