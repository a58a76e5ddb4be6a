"""Main text of web pages by minimum-cut labelling of their blocks.

A page's text blocks are nodes, and so are its zones: elements whose tag, role or class tells something about all they
hold. A linear classifier over a block's text gives its terminal capacities, towards content or towards boilerplate; a
zone's evidence gives its own. Smoothness edges join neighbours in page order, blocks with their zone and zones with the
zone around them. The maximal flow's cut labels all of them at once, so a short paragraph follows its article, and a class
word on a container is outvoted by the article inside.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .bytewords import tidy

# Names of HTML elements and of parts of pages.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no text of the page.
SKIPPED_TAGS = frozenset("script style title textarea iframe template noscript select xmp noembed noframes desc metadata annotation annotation-xml".split())
OUTSIDE_TAGS = frozenset("nav footer aside form menu button label fieldset object".split())
INSIDE_TAGS = frozenset("article main".split())
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising promo promoted sponsor sponsored".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
OUTSIDE_WORDS = ADVERT_WORDS | COMMENT_WORDS | frozenset("banner breadcrumb breadcrumbs buttons consent cookie cookies footer form gdpr header links masthead menu modal nav navbar navigation newsletter notice notices pagination popup promotion related share sharing sidebar social subscribe toolbar widget".split())
#: Of these, words that parts of an article have too: inside of one they tell little, and the text decides.
VAGUE_WORDS = frozenset("banner header links masthead share sharing social widget".split())
STORY_WORDS = frozenset("article entry post story".split())
INSIDE_WORDS = STORY_WORDS | frozenset("body content main text".split())
#: Words that make a class one of state: the element has such a part, and is none.
STATE_WORDS = frozenset("has is no with without".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar".split())
OVERLAY_ROLES = frozenset("dialog alert alertdialog".split())

#: Evidence of a zone for each of its blocks.
TAG, STORY, GENERIC, CLASS, ADVERT, HEADER, OVERLAY, HIDDEN = 60, 50, 20, 80, 100, 40, 15, 10
#: A page with an article: what stands outside of it.
REST = 30
#: Edges: neighbours of one kind, parent and zone, others of one zone, others; a zone's blocks by its evidence, the last for the page alone; zones for each block of the inner.
SIBLING, NEIGHBOUR, BORDER, ZONE_EDGES, NESTED = 10, 6, 2, ((25, 45), (10, 14), (0, 2)), 20

#: What sites say of themselves to their readers; a sign of boilerplate in a short block.
NOTICE = re.compile(r"\b(?:(?:this|our) (?:web)?site uses cookies|we (?:and our partners )?use cookies|by continuing to (?:use|browse) (?:this|our)|(?:sign up|subscribe) (?:now )?(?:to|for) (?:get |receive )?our\b|accept all cookies)", re.I)
NOTICE_LENGTH = 400

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTES = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+")
_ATTRIBUTE = re.compile(r"([a-zA-Z][a-zA-Z-]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Closed by the next of the same kind.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class _Zone:
    """``evidence`` above 0 is for content; ``hard`` zones give no evidence to an article inside; ``inside`` some zone around is for content."""

    __slots__ = ("evidence", "hard", "inside", "parent", "blocks")

    def __init__(self, evidence: float, hard: bool, parent: _Zone | None) -> None:
        self.evidence, self.parent, self.blocks = evidence, parent, 0
        self.hard = hard or bool(parent and parent.hard)
        self.inside = evidence >= GENERIC or evidence > -CLASS / 2 and bool(parent and parent.inside)


class _Element:
    __slots__ = ("tag", "block", "parent", "zone")

    def __init__(self, tag: str, attributes: str, parent: _Element | None) -> None:
        self.tag, self.parent = tag, parent
        self.block = self if tag in BLOCK_TAGS or not parent else parent.block
        self.zone = parent.zone if parent else _Zone(0, False, None)
        evidence, hard = _evidence(tag, attributes, self.zone)
        if evidence:
            self.zone = _Zone(evidence, hard, self.zone)


def _class_evidence(name: str) -> tuple[float, bool]:
    """What one class or id tells, and whether readers write what it holds."""
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    if not words or STATE_WORDS.intersection(words):
        return 0, False
    story, generic = sum(w in STORY_WORDS for w in words), sum(w in INSIDE_WORDS - STORY_WORDS for w in words)
    out = sum(w in OUTSIDE_WORDS for w in words)
    if out == len(words):
        return -(ADVERT if ADVERT_WORDS.intersection(words) else CLASS), bool(COMMENT_WORDS.intersection(words))
    if story + generic == len(words):
        return (STORY if story else GENERIC), False
    if COMMENT_WORDS.intersection(words) and not story:
        return -CLASS * out / len(words), True
    return -GENERIC * max(0, out - story - generic) / len(words), False


def _evidence(tag: str, attributes: str, around: _Zone) -> tuple[float, bool]:
    """An element's evidence for each block inside, and whether it is hard."""
    for_it, against, hard, comments = 0.0, 0.0, False, False
    if tag in INSIDE_TAGS:
        for_it = TAG
    elif tag in OUTSIDE_TAGS:
        against, hard = TAG, True
    elif tag == "header":
        against = 0 if around.inside else HEADER
    elif tag == "dialog":
        against = OVERLAY
    if attributes and not attributes.isspace():
        leaf = 0.1 if (tag == "p" or tag in HEADINGS) and around.inside else 1
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("class", "id"):
                for told, by_readers in map(_class_evidence, value.split()):
                    if around.inside and told == -CLASS and VAGUE_WORDS.issuperset(w.lower() for w in _NAME_WORD.findall(value)):
                        told = -GENERIC * (tag not in HEADINGS and "header" not in value.lower())
                    for_it += max(0, told)
                    against += max(0, -told) * (1 if told <= -ADVERT else leaf)
                    comments |= by_readers and leaf == 1
            elif name == "role":
                role = value.lower()
                hard |= role in OUTSIDE_ROLES
                for_it += TAG if role in INSIDE_TAGS else 0
                against += TAG if role in OUTSIDE_ROLES else OVERLAY if role in OVERLAY_ROLES else 0
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                against += HIDDEN
    hard |= comments and for_it < STORY + (TAG if tag in INSIDE_TAGS else 0)
    if hard or around.hard:
        for_it = 0  # a reader's comment may be an article of its own
    return max(-2 * ADVERT, min(STORY + TAG, for_it) - against), hard


class _Block:
    __slots__ = ("text", "element", "zone", "links")

    def __init__(self, text: str, element: _Element, zone: _Zone, links: int) -> None:
        self.text, self.element, self.zone, self.links = text, element, zone, links


def _tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before, name, whether it closes, attributes) of each tag, in linear time; name is empty at the page's end.

    Comments, declarations and skipped elements are left out. A tag without an end is text.
    """
    n, at, plain, ends = len(page), 0, False, {}
    parts: list[str] = []
    while at < n:
        less = page.find("<", at)
        if less < 0:
            break
        parts.append(page[at:less])
        if page.startswith("<!--", less):
            end = page.find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("/", less + 1)
        name = _NAME.match(page, less + 1 + closing)
        if name is None and not page.startswith(("!", "?", "/"), less + 1):
            parts.append("<")
            at = less + 1
            continue
        if name is None or closing or plain:
            end = page.find(">", less + 1)
        else:
            end = _ATTRIBUTES.match(page, name.end()).end()
            if end == n:  # a quotation without an end; from here on tags end at their first >
                plain, end = True, page.find(">", less + 1)
        if end < 0:
            parts.append(page[less:])
            at = n
            break
        at = end + 1
        if name is None:
            continue
        tag, attributes = name[0].lower(), page[name.end() : end]
        if tag in SKIPPED_TAGS:
            if closing:
                continue
            if ends.get(tag, at) is not None:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                ends[tag] = close.start() if close else None
            if ends[tag] is not None:
                at = page.find(">", ends[tag]) + 1 or n
            elif not attributes.endswith("/"):
                at = n
            parts.append(" " if tag in ("textarea", "select") else "")
            continue
        yield "".join(parts), tag, closing, attributes
        parts = []
    parts.append(page[at:])
    yield "".join(parts), "", False, ""


def blocks_of(page: str) -> list[_Block]:
    """Non-empty text blocks in page order; references are decoded and white space is one space."""
    out: list[_Block] = []
    at = root = _Element("html", "", None)
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links = 0

    def close() -> None:
        nonlocal links
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(_Block(text, at.block, at.zone, min(links, len(text))))
        parts.clear()
        links = 0

    def up(to: _Element) -> None:
        """Closes elements up to ``to``, which included."""
        nonlocal at
        while at is not to:
            opened[at.tag] -= 1
            at = at.parent
        opened[to.tag] -= 1
        at = to.parent

    for raw, tag, closing, attributes in _tags(page):
        if raw:
            parts.append(raw)
            links += len(raw) if opened["a"] else 0
        if tag == "br":
            parts.append(" ")
            continue
        if not tag or tag in BLOCK_TAGS or tag in OUTSIDE_TAGS:
            close()
        if not tag:
            break
        if closing:
            if opened[tag]:
                x = at
                while x.tag != tag:
                    x = x.parent
                if x.zone is not x.parent.zone:
                    close()  # an inline element with a mark of its own
                up(x)
            continue
        while at is not root and at.tag in _CLOSES.get(tag, ()):
            up(at)
        if tag == "p" and at.block.tag == "p" and at.block is not root:  # inline elements left open end with their paragraph
            up(at.block)
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            new = _Element(tag, attributes, at)
            if new.zone is not at.zone:
                close()
            at = new
            opened[tag] += 1
    return out


def _text_cost(block: _Block) -> int:
    """The classifier of a block by its text: above 0 for content, below for boilerplate."""
    text, n, tag = block.text, len(block.text), block.element.tag
    score = min(18, n // 8) + (6 if text[-1] in ".!?…:;\"'”»)。！？" else -4) + (18 if tag == "h1" else 8 if tag in HEADINGS else 4 if tag in ("p", "blockquote", "pre") else 0)
    score -= 40 if n < NOTICE_LENGTH and NOTICE.search(text) else 0
    score -= (4 if n < 25 else 0) + 40 * block.links // n + (16 if "©" in text or "all rights reserved" in text.lower() else 0)
    return max(-28, min(24, score))


def graph(blocks: list[_Block]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminal capacities of the blocks and then of their zones, and the edges between them."""
    zones: dict[int, _Zone] = {}
    for b in blocks:
        b.zone.blocks += 1
        z = b.zone
        while z is not None and id(z) not in zones:
            zones[id(z)] = z
            z = z.parent
    order = list(zones.values())
    place = {id(z): len(blocks) + i for i, z in enumerate(order)}
    depth: dict[int, int] = {}
    for z in order:  # a zone's blocks count for all zones around it, the innermost zones first
        chain = []
        while z is not None and id(z) not in depth:
            chain.append(z)
            z = z.parent
        for x in reversed(chain):
            depth[id(x)] = depth[id(x.parent)] + 1 if x.parent is not None else 0
    for z in sorted(order, key=lambda z: -depth[id(z)]):
        if z.parent is not None:
            z.parent.blocks += z.blocks
    best = max((z.evidence for z in order), default=0)
    if blocks:
        next(z for z in order if z.parent is None).evidence = -REST if best > GENERIC else -HIDDEN if best > 0 else 0
    costs = [_text_cost(b) for b in blocks] + [int(z.evidence * (z.blocks + 1)) for z in order]
    edges = []
    for i, (a, b) in enumerate(zip(blocks, blocks[1:], strict=False)):
        alike = a.element is b.element or a.element.parent is b.element.parent and a.element.tag == b.element.tag
        edges.append((i, i + 1, BORDER if a.zone is not b.zone else SIBLING if alike else NEIGHBOUR))
    edges += [(i, place[id(b.zone)], next(w for least, w in ZONE_EDGES if abs(b.zone.evidence) >= least or w == ZONE_EDGES[1][1] and b.zone.parent)) for i, b in enumerate(blocks)]
    edges += [(place[id(z)], place[id(z.parent)], NESTED * (z.blocks + 1)) for z in order if z.parent is not None]
    return costs, edges


def minimum_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the source's side: maximal sum of costs there, less the weights of cut edges.

    A node whose cost outweighs its edges is settled at once; its edges become costs of its neighbours. The maximal flow
    through what is left, along shortest paths found level by level, gives the rest. A node that both sides suit equally
    is content.
    """
    n = len(costs)
    costs, label = list(costs), [None] * n
    near: list[dict[int, int]] = [{} for _ in range(n)]
    around = [0] * n
    for a, b, w in edges:
        near[a][b] = near[b][a] = near[a].get(b, 0) + w
        around[a] += w
        around[b] += w
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(costs[i]) >= around[i] and (costs[i] or not near[i]):
            label[i] = costs[i] >= 0
            for j, w in near[i].items():
                if label[j] is None:
                    costs[j] += w if label[i] else -w
                    around[j] -= w
                    queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, content in zip(rest, _flow_cut([costs[i] for i in rest], *_inner(rest, near, label)), strict=True):
            label[i] = content
    return label


def _inner(rest: list[int], near: list[dict[int, int]], label: list) -> tuple[list[list[int]], list[list[int]]]:
    """Neighbours and weights among the nodes without a label, renumbered."""
    number = {i: k for k, i in enumerate(rest)}
    pairs = [[(number[j], w) for j, w in near[i].items() if label[j] is None] for i in rest]
    return [[j for j, _ in p] for p in pairs], [[w for _, w in p] for p in pairs]


def _flow_cut(costs: list[int], to: list[list[int]], free: list[list[int]]) -> list[bool]:
    """The cut of the maximal flow from the nodes of positive cost to those of negative cost; True where the sink can't be reached."""
    n = len(costs)
    back = [[0] * len(x) for x in to]
    where = {(i, j): k for i, x in enumerate(to) for k, j in enumerate(x)}
    for (i, j), k in where.items():
        back[i][k] = where[j, i]
    left = [max(0, c) for c in costs]  # what the source still gives
    open_end = [max(0, -c) for c in costs]  # what the sink still takes
    while True:
        level = [-1] * n  # steps to the sink
        line = deque(i for i in range(n) if open_end[i])
        for i in line:
            level[i] = 0
        while line:
            j = line.popleft()
            for k, i in enumerate(to[j]):
                if level[i] < 0 and free[i][back[j][k]]:
                    level[i] = level[j] + 1
                    line.append(i)
        starts = [i for i in range(n) if left[i] and level[i] >= 0]
        if not starts:
            return [x < 0 for x in level]
        arc = [0] * n
        for s in starts:
            path, i = [], s  # arcs (node, place) from s to i
            while left[s]:
                if level[i] == 0 and open_end[i]:
                    flow = min([left[s], open_end[i], *[free[a][k] for a, k in path]])
                    left[s] -= flow
                    open_end[i] -= flow
                    cut = None
                    for p, (a, k) in enumerate(path):
                        free[a][k] -= flow
                        free[to[a][k]][back[a][k]] += flow
                        if cut is None and not free[a][k]:
                            cut = p
                    if cut is not None:
                        i = path[cut][0]
                        del path[cut:]
                    continue
                while arc[i] < len(to[i]) and not (free[i][arc[i]] and level[to[i][arc[i]]] == level[i] - 1):
                    arc[i] += 1
                if arc[i] < len(to[i]):
                    path.append((i, arc[i]))
                    i = to[i][arc[i]]
                elif path:
                    i, _ = path.pop()
                    arc[i] += 1
                else:
                    break


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, minimum_cut(*graph(blocks)), strict=False) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages`` (page_id, url, html).

    A null or empty page, and one without an article, gives an empty text. Repeated rows stay; nothing is cut off; other
    columns are not read. An empty table gives no rows. A page is read in time linear in its length.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(tidy(task), "page_id long, url string, text string, n_chars long")
