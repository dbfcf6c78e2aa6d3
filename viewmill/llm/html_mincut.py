"""Main text of web pages: a minimum cut between content and boilerplate."""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import column

# Names of HTML elements, and words in class, id and role that tell what an element is.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style noscript template textarea title svg math iframe object select option datalist canvas audio video".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset(
    "html body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th section article main nav "
    "aside header footer form fieldset legend blockquote pre figure figcaption address hr details summary menu dialog "
    "button label center".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption td th tr tbody".split())
HOLDERS = BLOCKS - TEXT_BLOCKS
CLOSES_PARAGRAPH = BLOCKS - {"html", "body", "button", "label", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
BOILERPLATE_TAGS = frozenset("nav footer aside form fieldset menu dialog button".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations teaser widget pagination pager copyright legal search toolbar skip contentinfo "
    "complementary dialog form hidden tags meta byline".split()
)
CONTENT_WORDS = frozenset("article main post entry story".split())
# Parts of a class that say what a page has or is like ("has-sidebar", "comments-open"), not what the element is.
STATE_WORDS = frozenset("has no not with without is open opened closed enabled disabled active".split())
# What is never the frame of a page, however much text it holds.
NEVER_FRAMES = frozenset("nav footer aside menu dialog button comment comments disqus reply replies respond".split())

#: Weights of the classifier (log-odds of content) and of the edges.
BIAS, PER_LOG_CHAR, LINKS, SENTENCE, INSIDE, OUTSIDE = -2.2, 0.55, -4.0, 0.8, 3.0, -8.0
ADJACENT, SAME_PARENT, SAME_CONTENT, ACROSS = 0.4, 1.2, 1.0, 0.1
#: An element that is marked as boilerplate, but holds more than this share of the page's text, may be its frame.
FRAME_SHARE = 0.5
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


@dataclass
class Mark:
    """An element that its tag, class, id or role calls boilerplate."""

    frame: bool
    holds_article: bool = False
    chars: int = 0


@dataclass
class Element:
    """An open element; ``marks``, its own and those it is inside of, and ``good`` hold for all that is inside."""

    tag: str
    marks: tuple[Mark, ...]
    good: bool
    hidden: bool
    number: int


@dataclass
class Block:
    """Text between two borders of block elements."""

    parent: int
    marks: tuple[Mark, ...]
    good: bool
    tag: str
    bad: bool = False
    parts: list[str] = field(default_factory=list)
    links: int = 0
    text: str = ""


def _names(value: str) -> set[str]:
    """Words of a class, id or role, without those of states of the page."""
    named = [{w.lower() for w in _NAME.findall(token)} for token in value.split()]
    return set().union(*[words for words in named if len(words) == 1 or not words & STATE_WORDS])


def _element(tag: str, attributes: str, above: Element, number: int) -> Element:
    good, hidden = above.good, above.hidden or tag in HIDDEN
    reasons = {tag} & BOILERPLATE_TAGS
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden |= name == "hidden"
        elif tag not in ("html", "body"):
            words = _names(value)
            reasons |= words & BOILERPLATE_WORDS
            good |= bool(words & CONTENT_WORDS)
    if tag == "header" and not good:
        reasons.add(tag)
    good |= tag in ("article", "main")
    marks = above.marks
    if tag in ("article", "main") and not reasons:
        # The article may lie in a page-wide form or in a wrapper that is named after a sidebar beside it.
        for mark in marks:
            mark.holds_article = True
    if reasons:
        marks = (*marks, Mark(not reasons & NEVER_FRAMES))
    return Element(tag, marks, good, hidden, number)


def page_blocks(page: str) -> list[Block]:
    """The visible text blocks of a page in page order; comments, scripts, styles and other hidden parts are gone."""
    stack = [Element("", (), False, False, 0)]
    blocks: list[Block] = []
    block: Block | None = None
    at, number, anchors = 0, 0, 0

    def text(part: str) -> None:
        nonlocal block
        if stack[-1].hidden or not part:
            return
        if block is None:
            if not part.strip():
                return
            holder = next((e for e in reversed(stack) if e.tag in BLOCKS), stack[0])
            # Headings, paragraphs and list items belong to what holds them, so that they are neighbours there.
            place = next((e for e in reversed(stack) if e.tag in HOLDERS), stack[0])
            top = stack[-1]
            block = Block(place.number, top.marks, top.good, holder.tag)
            blocks.append(block)
        block.parts.append(part)
        if anchors:
            block.links += len(part.strip())

    while at < len(page):
        match = _TAG.search(page, at)
        if not match:
            text(page[at:])
            break
        text(page[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        if tag in BLOCKS:
            block = None
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                anchors -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
            continue
        if tag in VOID:
            if tag == "br" and block:
                text(" ")
            continue
        closes = SAME_LEVEL.get(tag, ()) or (("p",) if tag in CLOSES_PARAGRAPH else ())
        if tag in ("li", "dt", "dd"):
            closes = (*closes, "p")
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closes:
                anchors -= sum(e.tag == "a" for e in stack[i:])
                del stack[i:]
                break
            if stack[i].tag in BLOCKS and stack[i].tag != "p":
                break
        number += 1
        if attributes.rstrip().endswith("/") and tag in ("svg", "math", "path"):
            continue
        stack.append(_element(tag, attributes, stack[-1], number))
        anchors += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            stack.pop()
    for b in blocks:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    blocks = [b for b in blocks if b.text]
    for b in blocks:
        for mark in b.marks:
            mark.chars += len(b.text)
    most = FRAME_SHARE * sum(len(b.text) for b in blocks)
    for b in blocks:
        b.bad = any(not (mark.frame and mark.holds_article and mark.chars > most) for mark in b.marks)
    return blocks


def log_odds(block: Block) -> float:
    """Of content, from the block alone."""
    n = len(block.text)
    odds = BIAS + PER_LOG_CHAR * math.log(n) + LINKS * min(1.0, block.links / n)
    odds += SENTENCE * (block.text[-1] in ".!?:;…\"”»")
    odds += INSIDE * block.good
    return odds + OUTSIDE * block.bad


def minimum_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """For each node whether a minimum cut leaves it at the source's side.

    Node i has capacity ``source[i]`` from the source and ``sink[i]`` to the sink; edges have the same capacity both
    ways. Flow is raised along shortest paths level by level. Nodes that could be on either side are at the sink's.
    """
    n = len(source)
    graph: list[list[list[int]]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, there: int, back: int) -> None:
        graph[a].append([b, there, len(graph[b])])
        graph[b].append([a, back, len(graph[a]) - 1])

    for i in range(n):
        both = min(source[i], sink[i])
        connect(n, i, source[i] - both, 0)
        connect(i, n + 1, sink[i] - both, 0)
    for a, b, capacity in edges:
        connect(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[n] = 0
        queue = deque([n])
        while queue:
            a = queue.popleft()
            for b, capacity, _ in graph[a]:
                if capacity and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[n + 1] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[list[int]] = []
        a = n
        while True:
            if a == n + 1:
                flow = min(e[1] for e in path)
                for e in path:
                    e[1] -= flow
                    graph[e[0]][e[2]][1] += flow
                path, a = [], n
                continue
            while following[a] < len(graph[a]):
                e = graph[a][following[a]]
                if e[1] and level[e[0]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(graph[a]):
                path.append(graph[a][following[a]])
                a = path[-1][0]
            elif a == n:
                break
            else:
                e = path.pop()
                a = graph[e[0]][e[2]][0]
                following[a] += 1


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks on the content side of the minimum cut.

    Nodes are runs of blocks that have one parent and look alike (marked as boilerplate or not, mostly links or not).
    A node's terminal capacities are the sums over its blocks of what either label costs by the classifier. Edges join
    nodes next to each other in the page, more strongly the closer they are in the element tree and only weakly if one of them
    is marked, and the nodes of one parent that others lie between.

    A mark counts for all that is inside the element, unless this frames the page: it holds an article or main element
    and most of the text, and is not by name a list of comments, a menu or the like.
    """
    nodes: list[list[Block]] = []
    key = None
    for block in blocks:
        this = (block.parent, block.bad, block.good, 2 * block.links > len(block.text))
        if this != key:
            nodes.append([])
            key = this
        nodes[-1].append(block)
    source, sink = [], []
    for node in nodes:
        odds = [max(-30.0, min(30.0, log_odds(b))) for b in node]
        # Costs of the labels: -log p(boilerplate) is paid by content cut off from the source, and the reverse.
        source.append(int(1000 * sum(math.log1p(math.exp(o)) for o in odds)))
        sink.append(int(1000 * sum(math.log1p(math.exp(-o)) for o in odds)))
    edges, last = [], {}
    for i, node in enumerate(nodes):
        block = node[0]
        if i:
            before = nodes[i - 1][-1]
            weight = ADJACENT + SAME_CONTENT * (block.good and before.good) + SAME_PARENT * (block.parent == before.parent)
            edges.append((i - 1, i, int(1000 * (weight if block.bad == before.bad else ACROSS))))
        other = last.get((block.parent, block.bad))
        if other is not None and other != i - 1:
            edges.append((other, i, int(1000 * SAME_PARENT)))
        last[block.parent, block.bad] = i
    side = minimum_cut(source, sink, edges)
    return [b for node, content in zip(nodes, side, strict=True) if content for b in node]


def main_text(page: str | None) -> str:
    """The main text of one page."""
    return " ".join(b.text for b in content_blocks(page_blocks(page or "")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["id", "url", "text", "n_chars"],
        )


def extract_main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages``.

    A null or empty page, or one without content, has an empty text; null ids and urls stay null; repeated rows get
    a row each. Whole pages are read, however long: parsing and building the graph take linear time. Rows are
    independent and nothing is shuffled.
    """
    inner = pages.select(
        column(id_column).alias("id"), column(url_column).cast("string").alias("url"), column(html_column).cast("string").alias("html")
    )
    kind = inner.schema["id"].dataType.simpleString()
    return inner.mapInArrow(_extract, f"id {kind}, url string, text string, n_chars long").select(
        F.col("id"), "url", "text", "n_chars"
    )
