"""Main-text extraction by minimum-cut labelling.

A page becomes a sequence of text blocks. A classifier's cost of calling a block content or
boilerplate is the capacity of its arcs to the two terminals; blocks next to each other, and blocks that share
a container in the DOM, are joined by smoothness arcs. The minimum cut, found by maximum flow, is the
labelling of least total cost.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict, deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
HIDDEN = frozenset("script style noscript template iframe title head object embed applet canvas audio video map svg math textarea "
                   "select option datalist button xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                  "thead tr ul option select".split())
#: An open <p> ends where one of these begins.
ENDS_P = BLOCK - frozenset(("br",)) | frozenset(("p",))
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",)}
SCOPE = frozenset("article aside body div section main nav header footer table ul ol dl form blockquote td th li html".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: What containers say about their text, in units of cost: boilerplate above 0, content below 0.
TAG_COST = {"nav": 9.0, "footer": 9.0, "header": 6.0, "aside": 9.0, "form": 9.0, "menu": 9.0, "dialog": 9.0, "fieldset": 9.0, "address": 3.0,
            "article": -5.0, "main": -4.0}
NAMES = re.compile(r"""(?:^|[\s_-])(?:nav\w*|menu\w*|breadcrumb\w*|footer|foot|header|masthead|banner|side\w*|widget\w*|ads?|advert\w*|sponsor\w*|promo\w*|
    cookie\w*|consent|notice\w*|alert|gdpr|modal|popup|overlay|newsletter|subscribe|signup|login|social|shar(?:e|ing)\w*|comment\w*|disqus|
    respon[sd]\w*|replies|reply|related|recommend\w*|pagination|pager|toolbar|copyright|legal|disclaimer|skip\w*|search\w*|tags?|form)(?=$|[\s_\d-])""", re.I | re.X)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main|post|story|entry|body|text|prose)(?=$|[\s_\d-])", re.I)
ROLES = {"navigation": 9.0, "banner": 6.0, "contentinfo": 9.0, "complementary": 9.0, "search": 9.0, "dialog": 9.0, "alert": 9.0, "form": 9.0, "menu": 9.0,
         "main": -4.0, "article": -5.0}
#: Names that say what a page has beside the element, not what the element is.
BESIDE = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no)[-_]\S+", re.I)
#: What may stand in a head; at anything else an open head ends.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: A start tag ends at its first ">" outside an attribute value; a quote elsewhere is part of a name.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*+)((?:
    [\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+)*+)>""", re.S | re.X)
#: Where no ">" follows, no start tag can end; what a comment, a declaration or an end tag opens runs to the end of the page.
TAIL = re.compile(r"<[!?]|</[a-zA-Z]")
#: A slash that belongs to an attribute's unquoted value.
SLASH_IN_VALUE = re.compile(r"""=\s*[^\s"'>][^\s>]*/\Z""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S)


class Block:
    """``depth``: open elements around the text; ``shared``: those of them also around the block before; ``parent``:
    number of the element around the innermost one, or 0."""

    __slots__ = ("text", "cost", "depth", "shared", "parent", "linked", "heading")

    def __init__(self, text, cost, depth, shared, parent, linked, heading):
        self.text, self.cost, self.depth, self.shared, self.parent, self.linked, self.heading = text, cost, depth, shared, parent, linked, heading


def _container_cost(tag: str, attributes: str) -> tuple[float, bool]:
    """(cost, hidden) that an element gives to the text inside."""
    cost, hidden = TAG_COST.get(tag, 0.0), tag in HIDDEN
    if attributes and tag not in ("html", "body"):
        low = attributes.lower()
        if "class" in low or "id" in low or "role" in low or "hidden" in low or "style" in low:
            for m in ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    value = BESIDE.sub(" ", value)
                    if NAMES.search(value):
                        cost = max(cost, 0.0) + 7.0
                    elif GOOD_NAMES.search(value):
                        cost -= 2.0
                elif name == "role":
                    cost += ROLES.get(value.lower(), 0.0)
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                    hidden = True
    return cost, hidden


def blocks(html: str) -> list[Block]:
    """The visible text blocks of a page, white space joined, in page order. Every element is on the stack at any
    depth; the places of the open elements are kept per tag, so that a tag costs the same at every depth."""
    out: list[Block] = []
    stack: list[tuple[str, float, bool, int]] = []  # tag, cost so far, hidden, number of the element
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a tag in the stack
    scopes, block_places = [-1], [-1]  # of the open elements in SCOPE and BLOCK
    parts: list[str] = []
    state = [0, 0, 0, 0]  # elements so far, open links, characters inside links, least depth since the last block

    def push(tag, cost, hidden):
        state[0] += 1
        k = len(stack)
        places[tag].append(k)
        if tag in SCOPE:
            scopes.append(k)
        if tag in BLOCK:
            block_places.append(k)
        if tag == "a":
            state[1] += 1
        stack.append((tag, cost, hidden, state[0]))

    def drop_to(k):
        while len(stack) > k:
            tag = stack.pop()[0]
            places[tag].pop()
            if tag in SCOPE:
                scopes.pop()
            if tag in BLOCK:
                block_places.pop()
            if tag == "a":
                state[1] -= 1
        state[3] = min(state[3], len(stack))

    def place(*tags):
        return max(places[t][-1] if places[t] else -1 for t in tags)

    def close():
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1] if stack else ("", 0.0, False, 0)
                out.append(Block(text, top[1], len(stack), state[3], stack[-2][3] if len(stack) > 1 else 0, state[2], any(s[0] in HEADINGS for s in stack[-3:])))
                state[3] = len(stack)
        state[2] = 0

    def end_head():
        if places["head"]:
            pop_to(places["head"][-1])

    def text_between(a, b):
        if b > a and places["head"] and html[a:b].strip(" \t\n\r\f"):
            end_head()
        if b > a and not (stack and stack[-1][2]):
            t = html[a:b]
            parts.append(t)
            if state[1]:
                state[2] += len(t.strip())

    def pop_to(k):
        close()
        drop_to(k)

    at, end = 0, len(html)
    closed = html.rfind(">") + 1
    while at < end:
        m = TOKEN.search(html, at, closed) if at < closed else None
        if not m and at < closed:
            text_between(at, closed)
            at = closed
            continue
        if not m:
            m = TAIL.search(html, at)
            text_between(at, m.start() if m else end)
            break
        text_between(at, m.start())
        at = m.end()
        if at == closed and m[0].startswith("<!--") and not m[0].endswith("-->"):
            break  # a comment that never ends
        if m[1]:
            tag = m[1].lower()
            if tag in ("body", "html", "br"):
                end_head()
            k = place(tag)
            if tag == "br" or tag == "p" and k < 0:
                close()
            elif k >= 0 and (tag in SCOPE or k > scopes[-1]):
                if tag in BLOCK or tag in HIDDEN or block_places[-1] > k:
                    pop_to(k)
                else:
                    drop_to(k)
        elif m[2]:
            tag, attributes = m[2].lower(), m[3]
            if tag not in IN_HEAD:
                end_head()
            if tag in RAW:  # its text runs to its own end tag
                attributes = attributes.rstrip()
                if tag in ("svg", "math") and attributes.endswith("/") and not SLASH_IN_VALUE.search(attributes):
                    continue  # only foreign elements can close themselves
                stop = re.compile(rf"</{tag}\s*>?", re.I).search(html, at)
                at = stop.end() if stop else end
                continue
            if tag in BLOCK:
                close()
            if tag in ENDS_P and place("p") > scopes[-1]:
                pop_to(place("p"))
            if tag in SAME_ENDS:
                k = place(*SAME_ENDS[tag])
                if k >= 0 and k >= scopes[-1]:
                    pop_to(k)
            if tag in VOID:
                continue
            if tag == "body" or tag == "html":
                continue
            cost, hidden = _container_cost(tag, attributes)
            above = stack[-1] if stack else ("", 0.0, False, 0)
            if cost < 0 and above[1] > 0 or tag == "header" and above[1] < 0:
                cost = 0.0  # an article inside a sidebar or comment list stays there; an article's own header is its title
            push(tag, above[1] + cost, above[2] or hidden)
    close()
    return out


def terminal_costs(b: Block) -> tuple[float, float]:
    """(cost of calling it content, cost of calling it boilerplate), both at least 0: the block's score as
    a linear classifier, boilerplate above 0."""
    n = len(b.text)
    linked = min(1.0, b.linked / n)
    score = b.cost + 4.0 * max(0.0, linked - 0.3) - 0.6
    if n > 80 and linked < 0.3:
        score -= 1.0
    if b.heading:
        score -= 0.5
    return max(score, 0.0), max(-score, 0.0)


def smoothness(blocks_: list[Block]) -> list[tuple[int, int, float]]:
    """Arcs between neighbours in the page, heavier the deeper the container they share, and between
    consecutive blocks of one container that others stand between."""
    arcs = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks_):
        if i:
            arcs.append((i - 1, i, 0.2 + 0.8 * b.shared / max(blocks_[i - 1].depth, b.depth, 1)))
        parent = b.parent
        if parent in last and last[parent] < i - 1:
            arcs.append((last[parent], i, 0.5))
        last[parent] = i
    return arcs


def minimum_cut(content: list[float], boilerplate: list[float], arcs: list[tuple[int, int, float]]) -> list[bool]:
    """True for content. The source arc of a node is its cost as boilerplate, the sink arc its cost as content. The flow grows in
    phases: distances from the source by one search, then all paths along them, so that many short paths, as a long page has,
    cost one search together. Content is what the source still reaches."""
    n = len(content)
    source = [max(0.0, b - c) for b, c in zip(boilerplate, content, strict=True)]
    sink = [max(0.0, c - b) for b, c in zip(boilerplate, content, strict=True)]
    ends: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n)]  # arcs of a node; arc k ^ 1 is the way back
    for a, b, w in arcs:
        near[a].append(len(ends))
        near[b].append(len(ends) + 1)
        ends += (b, a)
        room += (w, w)
    eps = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if source[i] > eps)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or sink[i] > eps
            for k in near[i]:
                if room[k] > eps and level[ends[k]] < 0:
                    level[ends[k]] = level[i] + 1
                    queue.append(ends[k])
        if not reached:
            return [x >= 0 for x in level]
        next_arc = [0] * n
        for start in range(n):
            path: list[int] = []
            at = start
            while source[start] > eps and level[start] == 0:
                if sink[at] > eps:
                    flow = min(source[start], sink[at], min((room[k] for k in path), default=math.inf))
                    source[start] -= flow
                    sink[at] -= flow
                    for k in path:
                        room[k] -= flow
                        room[k ^ 1] += flow
                    path, at = [], start
                    continue
                while next_arc[at] < len(near[at]):
                    k = near[at][next_arc[at]]
                    if room[k] > eps and level[ends[k]] == level[at] + 1:
                        break
                    next_arc[at] += 1
                else:  # no way on from here in this phase
                    if at == start:
                        break
                    level[at] = -1
                    at = ends[path.pop() ^ 1]
                    next_arc[at] += 1
                    continue
                path.append(k)
                at = ends[k]


def main_text(html: str) -> str:
    """The page's content blocks, one per line; empty if there is none."""
    found = blocks(html)
    costs = [terminal_costs(b) for b in found]
    keep = minimum_cut([c for c, _ in costs], [b for _, b in costs], smoothness(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text`` and ``n_chars`` (its code points). A null or empty page, or one
    without content, has the empty text. Each page is cut by itself: no shuffle; repeated rows are extracted
    each; other columns are ignored."""
    def run(batches):
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["id", "url", "text", "n_chars"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
            .mapInArrow(run, f"id {id_type}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col}))
