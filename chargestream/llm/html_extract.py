"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks, each with its place in the element tree. A
linear classifier on length, links, tag and the names of the elements around a
block gives the cost of calling it content or boilerplate; these are its
capacities to the two terminals. Names are evidence, not a veto: an article
within a form or a named layout outweighs them, and a class name that says what
an element lacks or has beside it (no-sidebar, has-comments) says nothing of its text.
Neighbouring blocks, and successive blocks under one element, are joined by
smoothness edges of the same scale as these costs, which weaken with the distance
in the tree. The minimum cut is the cheapest labelling. Blocks whose own cost
outweighs all their edges are labelled first, which is exact and leaves small
graphs; max-flow settles those.

Each page is work of its own: no shuffle, and memory for one batch of pages.

Defined cases: null and empty html give the empty text. Blocks that hold only
white space do not count. Markup that is never closed ends with the page.
Repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .text import column, slices

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*+(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*?(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")

# Elements by the way HTML treats them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style template svg math noembed noframes title textarea iframe object canvas audio video head".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol option optgroup p "
    "pre section select summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body html button td th tr tbody thead tfoot caption option optgroup".split())
_ENDS_LIKE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SECTION = frozenset("article main section aside nav header footer form body".split())

# What names say about an element. Frames hold whatever is in them; weak frames give way to an article or main element within.
_FRAME_TAGS = frozenset("nav footer aside button select dialog menu label fieldset noscript".split())
_FRAME_ROLES = frozenset("navigation banner contentinfo complementary dialog alert alertdialog menu menubar toolbar".split())
_FRAME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promos promotion banner "
    "banners cookie cookies consent gdpr notice notices popular popup modal overlay newsletter subscribe subscription "
    "signup signin login nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs sidebar sidebars "
    "widget widgets related trending recommended recommendations sharing sharebar comment comments commentlist replies discussion disqus "
    "footer foot masthead toolbar topbar pagination pager pagenav searchbox skip skiplink toc paywall teaser taboola "
    "outbrain".split()
)
# Names that text of an article may have as well.
_UNSURE_NAMES = frozenset(
    "alert copyright feedback form hidden legal privacy rail register reply respond responses search share social terms".split()
)
_HEADERS = frozenset("head header".split())
_MAIN_NAMES = frozenset("article articlebody post postbody entry story main maincontent content".split())
# Parts of a name that leave its meaning as it is, and those that make it speak of something else.
_NEUTRAL = frozenset("area bar block body bottom box container inner item items left list outer right section text top wrap wrapper".split())
_MODIFIERS = frozenset("has have is no not with without".split())
_PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 dd td figcaption".split())

# Log odds.
_FRAME, _UNSURE, _MAIN_TAG, _MAIN_NAME = -6.0, -2.5, 2.5, 1.5
_MOST_FRAME = -8.0
_GIVES_WAY = 0.25
_WITHIN_FRAME = 0.75
_NEIGHBOURS, _SIBLINGS, _OTHER_SECTION = 2.0, 1.0, 0.1


class Element(NamedTuple):
    tag: str
    number: int
    parent: int
    depth: int
    section: int
    frame: float  # log odds of the frames around
    weak: float  # those of frames that give way to an article within
    main: float
    link: bool


class Block(NamedTuple):
    text: str
    element: Element
    linked: int


def _named(attributes: dict[str, str]) -> tuple[float, float, bool, bool]:
    """What class names and id say: log odds of a frame and of an unsure frame, whether they name a header, and main text."""
    frame = unsure = 0.0
    header = main = False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [part.lower() for part in _PART.findall(name)]
        if len(parts) > 1:
            parts = [part for part in parts if not part.isdigit()]
        if not parts or _MODIFIERS.intersection(parts):
            continue
        whole = name.lower()
        # The last part says what a thing is, unless it is a mere container.
        heads = [part for part in parts if part not in _NEUTRAL][-1:]
        for part in {*parts, whole}:
            share = 1.0 if part in heads or part == whole else 0.5
            if part in _FRAME_NAMES:
                frame = min(frame, share * _FRAME)
            elif part in _UNSURE_NAMES:
                unsure = min(unsure, share * _UNSURE)
            elif part in _HEADERS:
                header = header or share == 1.0
            elif part in _MAIN_NAMES and share == 1.0:
                main = True
    return (frame / 2 if main else frame), unsure, header, main


def _element(tag: str, token: str, above: Element, number: int) -> Element:
    attributes = {}
    if len(token) > len(tag) + 2:
        for name, a, b, c in _ATTRIBUTE.findall(token[len(tag) + 1 :]):
            attributes.setdefault(name.lower(), html.unescape(a or b or c))
    role = attributes.get("role", "").lower()
    article = tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"
    frame = weak = 0.0
    header = named = False
    if not article and tag not in ("html", "body") and ("class" in attributes or "id" in attributes):
        frame, weak, header, named = _named(attributes)
    if tag in _FRAME_TAGS or role in _FRAME_ROLES:
        frame = _FRAME
    # A form may be the whole page, and the header of an article holds its title.
    if tag == "form" or role in ("form", "search") or ((tag == "header" or header) and not above.main):
        weak = _FRAME
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        frame = _MOST_FRAME
    main = above.main * (_WITHIN_FRAME if frame else 1.0)
    if article:
        main = _MAIN_TAG
    elif named:
        main = max(main, _MAIN_NAME)
    return Element(
        tag,
        number,
        above.number,
        above.depth + 1,
        number if tag in _SECTION or frame else above.section,
        max(above.frame + frame, _MOST_FRAME),
        min(above.weak * (_GIVES_WAY if article else 1.0), weak),
        main,
        above.link or tag == "a",
    )


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack = [Element("", 0, -1, 0, 0, 0.0, 0.0, 0.0, False)]
    number = 0
    parts: list[str] = []
    linked = 0
    owner = stack[0]

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, owner, linked))
        parts.clear()
        linked = 0

    def close(upto: int) -> None:
        if any(e.tag in _BLOCK for e in stack[upto:]):
            flush()
        del stack[upto:]

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        upto = found.start() if found else size
        if upto > at:
            text = html.unescape(page[at:upto])
            if not parts:
                owner = stack[-1]
            elif owner.depth > stack[-1].depth:
                owner = stack[-1]
            parts.append(text)
            if stack[-1].link:
                linked += len(text)
        if not found:
            break
        token, at = found.group(), found.end()
        name = _NAME.match(token)
        if not name:
            continue
        tag = name.group(1).lower()
        if token[1] == "/":
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None)
            if where is not None:
                close(where)
            elif tag in _BLOCK or tag == "br":
                flush()
            continue
        if tag in _SKIPPED and not token.endswith("/>"):
            end = re.compile(rf"</{re.escape(tag)}\s*>|</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if tag == "head":  # ends with the body, if not before
                body = re.compile(r"<body[\s>]", re.I).search(page, at)
                if body and (not end or body.start() < end.start()):
                    at = body.start()
                    continue
            at = end.end() if end else (at if tag == "head" else size)
            continue
        if tag in _CLOSES_P:
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in _BLOCK), 0)
            if where and stack[where].tag == "p":
                close(where)
        if tag in _ENDS_LIKE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _ENDS_LIKE[tag]:
                    break
                if stack[i].tag == tag or {stack[i].tag, tag} in ({"dt", "dd"}, {"td", "th"}):
                    close(i)
                    break
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if tag in _VOID or token.endswith("/>"):
            continue
        number += 1
        stack.append(_element(tag, token, stack[-1], number))
    flush()
    return out


def score(block: Block) -> float:
    """Log odds of content against boilerplate."""
    words = len(block.text.split())
    here = block.element
    z = -1.5 + 0.5 * min(math.log2(1 + words), 6.0) + 0.8 * (here.tag in _PROSE)
    z -= 4.0 * min(block.linked / len(block.text), 1.0) * (1 if not here.main or words < 4 else 0.2)
    return z + here.frame + here.weak + here.main


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def edges(found: list[Block]) -> Iterator[tuple[int, int, float]]:
    """Smoothness between neighbours, and between successive blocks under one element."""
    last: dict[int, int] = {}
    for at, block in enumerate(found):
        here = block.element
        if at:
            before = found[at - 1].element
            near = 0 if here.parent == before.parent else 1 + abs(here.depth - before.depth)
            yield at - 1, at, _NEIGHBOURS * math.exp(-near / 2) * (1.0 if here.section == before.section else _OTHER_SECTION)
        if here.parent in last and last[here.parent] != at - 1:
            yield last[here.parent], at, _SIBLINGS
        last[here.parent] = at


def label(scores: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Of the cheapest labelling, which blocks are content."""
    content = [_softplus(z) for z in scores]  # what it costs to call it boilerplate
    frame = [_softplus(-z) for z in scores]
    beside: list[dict[int, float]] = [{} for _ in scores]
    for a, b, w in joined:
        beside[a][b] = beside[a].get(b, 0.0) + w
        beside[b][a] = beside[b].get(a, 0.0) + w
    lead = [c - f for c, f in zip(content, frame, strict=True)]
    decided = [lead[at] > 0 if abs(lead[at]) > sum(beside[at].values()) else None for at in range(len(scores))]
    for at, known in enumerate(decided):
        if known is not None:
            for other, w in beside[at].items():
                (content if known else frame)[other] += w
                del beside[other][at]
            beside[at] = {}
    open_ones = [at for at, known in enumerate(decided) if known is None]
    if open_ones:
        for at, side in zip(open_ones, _cut(open_ones, content, frame, beside), strict=True):
            decided[at] = side
    return [bool(known) for known in decided]


def _cut(nodes: list[int], content: list[float], frame: list[float], beside: list[dict[int, float]]) -> list[bool]:
    """Max-flow by shortest augmenting paths in levels; True for the source's side."""
    place = {node: i for i, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    room: list[dict[int, float]] = [{} for _ in range(len(nodes) + 2)]
    for i, node in enumerate(nodes):
        both = min(content[node], frame[node])
        room[source][i], room[i][source] = content[node] - both, 0.0
        room[i][sink], room[sink][i] = frame[node] - both, 0.0
        for other, w in beside[node].items():
            room[i][place[other]] = w
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for y, r in room[x].items():
                if r > 1e-12 and y not in level:
                    level[y] = level[x] + 1
                    queue.append(y)
        if sink not in level:
            return [i in level for i in range(len(nodes))]
        ways = {x: list(room[x]) for x in level}
        path = [source]
        while path:
            x = path[-1]
            if x == sink:
                steps = list(zip(path[:-1], path[1:], strict=True))
                flow = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= flow
                    room[b][a] += flow
                path = path[: next(i for i, (a, b) in enumerate(steps) if room[a][b] <= 1e-12) + 1]
                continue
            while ways[x] and not (room[x][ways[x][-1]] > 1e-12 and level.get(ways[x][-1]) == level[x] + 1):
                ways[x].pop()
            if ways[x]:
                path.append(ways[x][-1])
            else:
                path.pop()
                if path:
                    ways[path[-1]].pop()


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    kept = label([score(b) for b in found], list(edges(found)))
    return "\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per row of `pages`: `keep`, text and n_chars."""
    wanted = list(dict.fromkeys([*keep, "html"]))
    schema = StructType([*[pages.schema[c] for c in keep], *StructType.fromDDL("text string, n_chars long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) for page in column(batch, "html").to_pylist()]
            columns = {c: column(batch, c) for c in keep}
            columns["text"] = pa.array(texts, pa.string())
            columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return pages.select(*wanted).mapInArrow(run, schema)
