"""Main text of web pages by minimum-cut labelling.

A page becomes text blocks in page order.  Every block has two costs: of being called boilerplate
and of being called content.  A logistic model gives them from how its text looks and where it lies
(links and length of what shares its parent, depth, place in the page); it is trained on blocks of pages
whose elements say what they are.  Elements and class names around a block that say so add to them, by
bounded amounts.  The costs are capacities to the terminals; edges between blocks that follow each other
or share a parent are smoothness capacities that fall with their distance in the tree and between
elements that say different things.  The smallest cut separates content from boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import typed

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template svg iframe canvas textarea select option datalist head title video audio map".split())
RAW = set("script style textarea title noscript iframe noframes xmp".split())
BREAKS = set(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split()
)
#: Starting one of these ends an open element of the second set, up to the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
CLOSES |= {name: ({"td", "th"}, {"tr", "table"}) for name in ("td", "th")}
CLOSES["tr"] = ({"tr"}, {"table", "tbody", "thead", "tfoot"})
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label"}
CONTENT_TAGS = {"article", "main"}
_BAD = """ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation
breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended trending
comment comments comentarios commentaires kommentare reply replies respond disqus discussion pagination pager skip legal
copyright search form""".split()
_GOOD = "article content main post entry story body text".split()
BAD_NAMES, GOOD_NAMES = frozenset(_BAD), frozenset(_GOOD)
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}

#: A class name with one of these parts says what a layout has, not what the element is.
LAYOUT_PARTS = {"has", "with", "without", "no", "and"}
#: Tags that also wrap whole pages.
WRAPPER_TAGS = {"form", "fieldset"}
#: A wrapper holds this share of a page's text.
WRAPPER_SHARE = 0.8

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|</?[a-zA-Z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^'\">])*>|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'<>]+)")

#: Names that an article may give to its own parts.
OWN_NAMES = frozenset("header legal search discussion form".split())
#: A section that begins with one of these headings holds comments of readers.
COMMENTS = re.compile(
    r"(?:\d+ )?(?:reader |user )?(?:comments?|kommentare?|commentaires?|comentarios?|repl(?:y|ies)|responses?)(?: ?\(\d+\)| ?: ?\d*)?", re.I
)
#: Elements that such a heading may speak for.
SECTIONS = {"section", "div", "aside", "details"}

#: What the model may say at most, and what elements and names add: a block in a boilerplate element,
#: under a boilerplate name, in a content element, under a content name.
LOOKS, BAD_TAG_COST, BAD_NAME_COST, GOOD_TAG_COST, GOOD_NAME_COST = 2.5, 5.0, 4.0, 3.2, 1.0
#: Smoothness of two blocks in one parent, and the share of it between elements that say different things.
SMOOTH, APART = 1.5, 0.1
#: Features of a block, see :func:`features` and :func:`place_features`.
TEXT_FEATURES, PLACE_FEATURES = 8, 5


@dataclass
class Block:
    text: str
    depth: int
    #: Block elements shared with the block before, and the number of the one above the own.
    shared: int
    parent: int
    link_chars: int
    heading: bool
    bad: float
    good: float
    marked: int | None = None
    #: The innermost mark around the block.
    mark: int = 0
    features: list[float] = field(default_factory=list)


@dataclass(slots=True)
class Mark:
    """An element that is marked as boilerplate (``cost``) or as content (``fresh``: whatever is around it)."""

    above: int
    cost: float = 0.0
    content: bool = False
    fresh: bool = False
    #: Whether it is no boilerplate if it turns out to hold most of the page.
    wrapper: bool = False
    #: Characters of text inside, and those of them under content elements and names.
    chars: int = 0
    content_chars: int = 0


@dataclass(slots=True)
class Element:
    """An open element, with what it has from the elements around it."""

    name: str = ""
    good: float = 0.0
    silent: bool = False
    mark: int = 0
    #: Block elements open here, the number of the innermost and of the one above it.
    depth: int = 0
    block: int = 0
    parent: int = 0
    link: bool = False
    heading: bool = False


def bad_name(value: str, ignored: frozenset[str]) -> bool:
    """Whether a name in a class or id says boilerplate.

    A part counts anywhere, but not in names of layouts ("has-sidebar", "post-with-comments",
    "content-sidebar-wrap": content first, and something else last).
    """
    for name in value.split():
        parts = re.findall("[a-z]+", name)
        if LAYOUT_PARTS.intersection(parts):
            continue
        for k, part in enumerate(parts):
            if part in BAD_NAMES and part not in ignored:
                if k == len(parts) - 1 or not GOOD_NAMES.intersection(parts[:k]):
                    return True
    return False


def _element(name: str, tag: str, number: int, above: Element, marks: list[Mark]) -> Element:
    good, silent = above.good, above.silent
    cost, wrapper, content, named = 0.0, True, name in CONTENT_TAGS, False
    if name in BOILERPLATE_TAGS or (name == "header" and not good):
        cost, wrapper = BAD_TAG_COST, name in WRAPPER_TAGS
    if content:
        good = max(good, GOOD_TAG_COST)
    if " " in tag or "\n" in tag or "\t" in tag:
        for m in ATTRIBUTE.finditer(tag, len(name) + 1, len(tag) - 1):
            key = (m.group(1) or m.group(5) or "").lower()
            value = next((v for v in m.groups()[1:4] if v is not None), "").lower()
            # The id of a heading is what links point at, and repeats its words.
            named_by = ("class",) if name[0] == "h" and name[1:].isdigit() else ("class", "id")
            if key in named_by and name not in ("html", "body"):
                # Inside an article, a "post-header" is its heading.
                wrong = bad_name(value, OWN_NAMES if good else frozenset())
                if wrong and name in CONTENT_TAGS:
                    named = True
                elif wrong:
                    cost = max(cost, BAD_NAME_COST)
                elif GOOD_NAMES.intersection(re.findall(r"[a-z]+", value)):
                    good = max(good, GOOD_NAME_COST)
            elif key == "role":
                if value in BAD_ROLES:
                    cost, wrapper = max(cost, BAD_TAG_COST), wrapper and value == "form"
                elif value in ("main", "article"):
                    good, content = max(good, GOOD_TAG_COST), True
    mark = above.mark
    if cost or content:
        # An article named as a comment or the like stays in what is around it.
        marks.append(Mark(mark, cost, content and not cost, content and not cost and not named, wrapper))
        mark = len(marks) - 1
    depth, block, parent, heading = above.depth, above.block, above.parent, above.heading
    if name in BREAKS:
        depth, block, parent = depth + 1, number, block
        heading = heading or (name[0] == "h" and name[1:].isdigit())
    return Element(name, good, silent or name in SILENT, mark, depth, block, parent, above.link or name == "a", heading)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; character references decoded, white space made single."""
    found: list[Block] = []
    root = Element()
    marks = [Mark(0)]
    stack = [root]
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    links = number = shared = 0
    place: Element | None = None
    last_mark = page.rfind(">")

    def flush():
        nonlocal parts, links, shared, place
        if place is not None:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                own = place
                found.append(
                    Block(text, own.depth, min(shared, own.depth), own.parent, links, own.heading, 0.0, own.good, mark=own.mark)
                )
                shared = own.depth
                if own.heading and COMMENTS.fullmatch(text):
                    comments_begin(own)
        parts, links, place = [], 0, None

    def comments_begin(heading):
        """The section that begins with this heading is marked, from the heading on."""
        for k in range(len(stack) - 1, 0, -1):
            e = stack[k]
            if e.block == heading.parent and e.name in BREAKS:
                first = len(found) == 1 or e.depth > min(found[-2].depth, found[-1].shared)
                if e.name in SECTIONS and first:
                    marks.append(Mark(e.mark, BAD_NAME_COST, wrapper=True))
                    found[-1].mark = len(marks) - 1
                    for inner in stack[k:]:
                        inner.mark = len(marks) - 1
                return

    def say(text):
        nonlocal links, place
        if not text or stack[-1].silent:
            return
        if place is None and not text.isspace():
            place = stack[-1]
        if stack[-1].link:
            links += len(text.strip())
        parts.append(text)

    def shut(first):
        nonlocal shared
        for e in stack[first:]:
            open_names[e.name] -= 1
        del stack[first:]
        shared = min(shared, stack[-1].depth)

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at) if at <= last_mark else None
        if not m:  # no tag can end here any more; an open comment has the rest
            say(page[at:].partition("<!--")[0])
            break
        say(page[at : m.start()])
        tag, at = m.group(), m.end()
        if tag == "<":
            say("<")
            continue
        if tag[1] in "!?":
            continue
        closing = tag[1] == "/"
        name = re.match(r"</?([^\s/>]+)", tag).group(1).lower()
        if name == "br":
            say(" ")
            continue
        if name in BREAKS:
            flush()
        if closing:
            if open_names[name]:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                if place is not None and stack[-1].depth > stack[k - 1].depth:
                    flush()
                shut(k)
            continue
        if name in VOID:
            continue
        if name in BREAKS and open_names["p"]:  # a paragraph ends where a block begins
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    shut(k)
                    break
                if stack[k].name in BREAKS:
                    break
        if name in CLOSES:
            ends, scope = CLOSES[name]
            if any(open_names[e] for e in ends):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in ends:
                        shut(k)
                        break
                    if stack[k].name in scope:
                        break
        if tag.endswith("/>") and name not in RAW:
            continue
        number += 1
        if name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        stack.append(_element(name, tag, number, stack[-1], marks))
        open_names[name] += 1
    flush()
    place_costs(found, marks)
    for block, around in zip(found, place_features(found)):
        block.features = features(block) + around
    return found


def place_costs(blocks: list[Block], marks: list[Mark]) -> None:
    """Sets ``bad`` and ``marked`` of the blocks from the marks around them.

    The innermost content element counts from its start on, unless it lies in what can't wrap a page
    (navigation, footers).  A form or a bad name around most of the page's text, with hardly any text
    of content elements outside, wraps the page and costs nothing.
    """
    for b in blocks:
        marks[b.mark].chars += len(b.text)
        marks[b.mark].content_chars += len(b.text) if b.good else 0
    for m in reversed(marks[1:]):
        if m.content:
            m.content_chars = m.chars
        marks[m.above].chars += m.chars
        marks[m.above].content_chars += m.content_chars
    whole, content = marks[0].chars, marks[0].content_chars
    # Of each mark: cost, label, whether all costs are those of wrappers.
    state: list[tuple[float, int | None, bool]] = [(0.0, None, True)]
    for m in marks[1:]:
        cost, label, wrapper = state[m.above]
        if m.content:
            if label is None or (m.fresh and wrapper):
                cost, label, wrapper = 0.0, 1, True
        elif m.cost and not (
            m.wrapper and m.chars >= WRAPPER_SHARE * whole and content - m.content_chars <= (1 - WRAPPER_SHARE) * content
        ):
            cost, label, wrapper = max(cost, m.cost), 0, wrapper and m.wrapper
        state.append((cost, label, wrapper))
    for b in blocks:
        b.bad, b.marked, _ = state[b.mark]


def features(block: Block) -> list[float]:
    """What the text alone says: length, links, sentence ends, commas, capitals, digits, heading."""
    text, n = block.text, max(1, len(block.text))
    words = text.count(" ") + 1
    return [
        1.0,
        math.log1p(words),
        min(1.0, block.link_chars / n),
        min(1.0, (text.count(".") + text.count("!") + text.count("?")) / words * 5),
        min(1.0, text.count(",") / words * 5),
        sum(map(str.isupper, text)) / n,
        sum(map(str.isdigit, text)) / n,
        float(block.heading),
    ]


def place_features(blocks: list[Block]) -> list[list[float]]:
    """Where blocks lie: place in the page, depth, and length, links and number of those in one parent."""
    chars: Counter[int] = Counter()
    links: Counter[int] = Counter()
    number: Counter[int] = Counter()
    for b in blocks:
        chars[b.parent] += len(b.text)
        links[b.parent] += b.link_chars
        number[b.parent] += 1
    return [
        [
            k / len(blocks),
            min(1.0, b.depth / 20),
            math.log1p(chars[b.parent]) / 10,
            min(1.0, links[b.parent] / max(1, chars[b.parent])),
            math.log1p(number[b.parent]) / 5,
        ]
        for k, b in enumerate(blocks)
    ]


def fit(rows: list[list[float]], labels: list[int], ridge: float = 1.0) -> list[float]:
    """Weights of a ridge logistic regression in which both labels weigh the same; 0 with one alone."""
    import numpy as np

    x, y = np.array(rows, float), np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        return [0.0] * (x.shape[1] if len(y) else TEXT_FEATURES + PLACE_FEATURES)
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * weights
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights -= np.linalg.solve(hessian, gradient)
    return weights.tolist()


def kinship(before: Block, block: Block) -> float:
    """1 for blocks in one parent, less with every step between them and between marked elements."""
    steps = max(0, before.depth + block.depth - 2 * block.shared - 2)
    return (1.0 if before.mark == block.mark else APART) / (1.0 + steps) ** 2


def costs(blocks: list[Block], weights: list[float]) -> list[float]:
    """Cost of boilerplate less that of content: positive wants to be content.  What is marked as
    boilerplate inside an article is judged by its own mark.  Features without a weight count nothing."""
    found = []
    for b in blocks:
        looks = sum(w * f for w, f in zip(weights, b.features))
        found.append(max(-LOOKS, min(LOOKS, looks)) + (-b.bad if b.bad else b.good))
    return found


def smoothness(blocks: list[Block]) -> list[dict[int, float]]:
    """Of each block, what it costs to part it from others: those that follow it and those before and
    after it in its parent."""
    near: list[dict[int, float]] = [{} for _ in blocks]
    last_child: dict[int, int] = {}

    def join(a: int, b: int, c: float) -> None:
        near[a][b] = near[b][a] = near[a].get(b, 0.0) + c

    for k, b in enumerate(blocks):
        if k:
            join(k - 1, k, SMOOTH * kinship(blocks[k - 1], b))
        before = last_child.get(b.parent)
        if before is not None and before != k - 1:
            join(before, k, SMOOTH / 2 * (1.0 if blocks[before].mark == b.mark else APART))
        last_child[b.parent] = k
    return near


def label(blocks: list[Block], weights: list[float], smooth: bool = True) -> list[bool]:
    """The minimum cut: True for content.  Without ``smooth``, the sign of each block's own cost."""
    cost = costs(blocks, weights)
    side = source_side(list(range(len(blocks))), cost, smoothness(blocks) if smooth else [{} for _ in blocks])
    return [k in side for k in range(len(blocks))]


def source_side(nodes: list[int], cost: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the content side of the smallest cut (of several, the one with the fewest).

    Maximum flow by levels: paths of the fewest edges first, all of one length in a sweep.  An edge's
    number differs from that of its way back in the last bit.
    """
    source, sink = len(near), len(near) + 1
    ends: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(near) + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(ends))
        out[b].append(len(ends) + 1)
        ends.extend((b, a))
        room.extend((there, back))

    for k in nodes:
        if cost[k] > 0:
            edge(source, k, cost[k], 0.0)
        else:
            edge(k, sink, -cost[k], 0.0)
        for j, c in near[k].items():
            if k < j:
                edge(k, j, c, c)
    while True:
        level = {source: 0}
        queue = [source]
        for u in queue:
            if u == sink or (sink in level and level[u] >= level[sink] - 1):
                continue
            for e in out[u]:
                if room[e] > 1e-12 and ends[e] not in level:
                    level[ends[e]] = level[u] + 1
                    queue.append(ends[e])
        if sink not in level:
            return set(level) - {source}
        tried = [0] * len(out)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # On from before the first edge that is full.
                full = next(n for n, e in enumerate(path) if room[e] <= 1e-12)
                u = ends[path[full] ^ 1]
                del path[full:]
            elif tried[u] < len(out[u]):
                e = out[u][tried[u]]
                if room[e] > 1e-12 and level.get(ends[e]) == level[u] + 1:
                    path.append(e)
                    u = ends[e]
                else:
                    tried[u] += 1
            elif path:
                u = ends[path.pop() ^ 1]
                tried[u] += 1
            else:
                break


def extract(page: str | None, weights: list[float]) -> str:
    blocks = blocks_of(page or "")
    return "\n\n".join(b.text for b, keep in zip(blocks, label(blocks, weights)) if keep)


def train(pages: DataFrame, sample: int = 400) -> list[float]:
    """Weights from the blocks of at most ``sample`` different pages, chosen by hashes of id and text.

    Blocks inside elements that say what they are (``article``, ``main``; ``nav``, ``footer``, forms,
    adverts by name and the like) are the labelled examples; the features don't see the elements.
    At most 100 blocks of each label and page are used.  Rows of one page count once, also those
    without an id, so the driver never gets more than the sample.
    """
    rows = typed(pages, page_id="long", html="string").where("html IS NOT NULL")
    keyed = rows.select("html", F.xxhash64("page_id").alias("a"), F.xxhash64("html").alias("b"))
    keys = keyed.select("a", "b").distinct().orderBy("a", "b").limit(sample)
    # At most ``sample`` keys of two numbers; copies are left out before their texts are read.
    kept = keyed.join(F.broadcast(keys), ["a", "b"], "left_semi")
    chosen = kept.groupBy("a", "b").agg(F.first("html").alias("html")).select("html")

    def examples(batches):
        for batch in batches:
            for page in batch.column(0):
                used = [0, 0]
                rows, labels = [], []
                for b in blocks_of(page.as_py()):
                    if b.marked is not None and used[b.marked] < 100:
                        used[b.marked] += 1
                        rows.append(b.features)
                        labels.append(b.marked)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())], ["x", "y"])

    got = sorted((r["x"], r["y"]) for r in chosen.mapInArrow(examples, "x array<double>, y int").collect())
    return fit([x for x, _ in got], [y for _, y in got])


def main_text(pages: DataFrame, weights: list[float]) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every row of ``pages``.

    Blocks of content in page order, parted by an empty line.  NULL, empty and textless pages give
    an empty text, repeated rows equal texts, an empty table no rows; broken markup is read as far
    as it goes.  Only ``page_id``, ``url`` and ``html`` are read.
    """

    def run(batches):
        for batch in batches:
            texts = [extract(p.as_py(), weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = typed(pages, page_id="long", url="string", html="string")
    return rows.mapInArrow(run, "page_id long, url string, text string")
