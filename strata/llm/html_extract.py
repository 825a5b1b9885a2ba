"""HTML extraction by minimum-cut labelling.

A page becomes a row of text blocks.  A logistic classifier of each block's
text and links, and fixed odds for the names of the elements around it, give
log odds of content against boilerplate; they are the capacities from source
and to sink.  The classifier is trained on blocks of a bounded sample of the
pages at hand whose surroundings leave no doubt (see `weak_label`); it matters
where the names say nothing.
Edges join neighbours in page order and neighbours under one parent, heavier
the nearer the blocks are in the element tree.  The minimum cut labels all
blocks of the page at once, so short paragraphs follow the article they stand
in and short notices the bar they stand in.

Nodes whose own capacity outweighs all their edges are settled first (no cut
can gain from them); augmenting paths decide the rest.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from bisect import bisect_right
from collections import Counter, deque

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import bounded_batches, materialize

# Element classes of HTML.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title select "
                    "textarea button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr img input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figcaption".split())
CLOSES_ITSELF = frozenset("li dt dd tr td th option".split())

# Fixed log odds of an element, and words of a class, id or role (see `_bonus`).
ELEMENT = {"article": 5.0, "main": 4.0, "nav": -7.0, "footer": -7.0, "aside": -6.0, "header": -4.0,
           "form": -7.0, "menu": -6.0, "dialog": -6.0, "fieldset": -5.0, "address": -2.0}
GOOD_WORDS = frozenset("article content main post entry story body text prose".split())
# What names a place beside the article.
BAD_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads advert "
                      "adverts advertisement advertising promo promotion sponsor sponsored cookie cookies "
                      "consent gdpr notice notices banner popup modal comment comments commentlist respond "
                      "reply replies disqus thread threads related recommended recommendations subscribe "
                      "subscription newsletter signup pagination pager toolbar copyright masthead topbar "
                      "complementary contentinfo".split())
# What names a small tool, and often only decorates the name of something else.
TOOL_WORDS = frozenset("alert overlay share sharing social login register search form legal skip widget "
                       "tags".split())
# A word that takes the next one back, beginnings that say nothing of the
# element itself (layout switches, topics of a post), an end that does so.
WITHOUT = frozenset("has no not with without hide show".split())
TOPICS = frozenset("is js tag category cat".split())
GOOD, BAD, MIXED, HEADER = 4.0, -6.0, -1.0, -4.0
# Classifier weights (bias, then the features of `describe`) before training,
# and how far the trained ones may go: a sample whose boilerplate is all of one
# kind must not outweigh the names.
UNTRAINED = (-1.0, 0.55, -6.0, 0.8, 0.5)
MOST = 6.0
TRAIN_PAGES = 2000  # pages of the training sample, on average
INNER, OUTER_BAD, OUTER_GOOD = 1.0, 0.9, 0.4
NEXT, SIBLING, DECAY = 1.2, 1.6, 0.5

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>
                      |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>""", re.S | re.X)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*.?true|display\s*:\s*none")
_START = re.compile(r"</?[A-Za-z]")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class _Node:
    __slots__ = ("name", "parent", "depth", "bonus", "good", "bad", "told")

    def __init__(self, name: str, parent: "_Node | None", own: float) -> None:
        self.name, self.parent, self.bonus = name, parent, own
        self.depth = parent.depth + 1 if parent else 0
        # the best and worst that stands around the block, nearest first
        self.good = max(own, parent.good if parent else 0.0, 0.0)
        self.bad = min(own, parent.bad if parent else 0.0, 0.0)
        # the nearest telling element counts in full, outer ones less
        self.told = parent.told if parent else 0.0
        if own:
            self.told = own * INNER + (parent.bad * OUTER_BAD + parent.good * OUTER_GOOD if parent else 0.0)

    def odds(self) -> float:
        return self.told


def _name_kind(name: str) -> str:
    """What one class, id or role says: "good", "bad", "tool", "header" or "".

    "story--no-comments" is a story, "with-sidebar" and "ad-free" say nothing,
    "post-comments" are comments, "widget-content" is content and
    "content-search" a tool: a place beside the article rules wherever it
    stands, between content and tools the last word does.
    """
    words = [w.lower() for w in _SPLIT.findall(name.split("--")[0])]
    if not words or (len(words) > 1 and (words[0] in TOPICS or words[-1] == "free")):
        return ""
    kept = [w for i, w in enumerate(words) if w not in WITHOUT and (i == 0 or words[i - 1] not in WITHOUT)]
    if any(w in BAD_WORDS for w in kept):
        return "bad"
    telling = [w for w in kept if w in GOOD_WORDS or w in TOOL_WORDS]
    if telling and telling[-1] in TOOL_WORDS:
        return "tool"
    if "header" in kept:
        return "" if telling else "header"  # "article-header" names a part of the article
    return "good" if telling else "bad" if "hidden" in kept else ""


def _bonus(name: str, attrs: str) -> float:
    """Log odds of an element by its own name and its class, id and role: all
    names are weighed together, none decides against all others."""
    own = ELEMENT.get(name, 0.0)
    if not attrs or name in ("html", "body"):
        return own
    said = {_name_kind(x) for m in _ATTR.finditer(attrs) for x in (m[2] or m[3] or m[4] or "").split()}
    if _HIDDEN.search(attrs):
        return min(own, BAD)
    good = "good" in said
    if own <= HEADER:
        return min(own, BAD) if "bad" in said else 0.0 if name == "header" and good else own
    if "bad" in said:
        return (MIXED if own >= GOOD else BAD + GOOD / 2) if good else BAD
    if "tool" in said:
        return max(own, GOOD) - 2.0 if good or own >= GOOD else BAD
    if good:
        return max(own, GOOD)
    return HEADER if "header" in said and own < GOOD else own


class _Tags:
    """Tags of a page in order, in linear time: a start that no ">" ends is
    scanned once for all starts that the same quotes leave outside."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.open = page, page.rfind(">"), []

    def search(self, at: int) -> "re.Match | None":
        page = self.page
        while (at := page.find("<", at)) >= 0:
            special = page.startswith(("<!--", "<![CDATA["), at)
            if special or (at < self.last and not any(self._outside(x, at) for x in self.open)):
                m = _TAG.match(page, at)
                if m:
                    return m
                if _START.match(page, at):
                    quoted = [q.span() for q in _QUOTED.finditer(page, at)]
                    self.open.append((at, [a for a, _ in quoted], [b for _, b in quoted]))
            at += 1
        return None

    @staticmethod
    def _outside(scan: tuple, at: int) -> bool:
        """Whether a failed scan passed this place outside its quotes."""
        first, starts, ends = scan
        k = bisect_right(starts, at) - 1
        return at > first and (k < 0 or at >= ends[k])


def blocks(page: str):
    """(text, link characters, node, is heading) of the page's text blocks."""
    root = _Node("", None, 0.0)
    stack, out = [root], []
    parts, linked, in_link, heading = [], 0, 0, False
    tags = _Tags(page)
    opened: Counter = Counter()  # names on the stack
    ahead: dict[str, re.Match | None] = {}  # the next match of a pattern, None: no more

    def following(pattern: str):
        m = ahead.get(pattern, "new")
        if m == "new" or (m is not None and m.start() < at):
            m = ahead[pattern] = re.compile(pattern, re.I).search(page, at, tags.last + 1)
        return m

    def pop_from(k: int):
        opened.subtract(x.name for x in stack[k:])
        del stack[k:]

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(htmllib.unescape("".join(parts)).split())
            if text:
                out.append((text, min(linked, len(text)), stack[-1], heading))
            parts, linked = [], 0

    at, n = 0, len(page)
    while at < n:
        m = tags.search(at)
        end = m.start() if m else n
        if end > at:
            parts.append(page[at:end])
            if in_link:
                linked += end - at
        if not m:
            break
        at = m.end()
        name = m[2]
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:-3])
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                in_link = 0
            elif name in INLINE or name == "br":
                continue
            else:
                flush()
                heading = False
                if name not in LEAF and opened[name]:
                    k = len(stack) - 1
                    while stack[k].name != name:
                        k -= 1
                    pop_from(k)
            continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = 1
        elif name in INLINE:
            continue
        elif name in SKIPPED:
            flush()
            if not m[3].endswith("/"):
                close = following(rf"</{re.escape(name)}\b[^>]*>")
                body = following(r"<body\b") if name == "head" else None
                if close and (body is None or close.end() <= body.start()):
                    at = close.end()
                elif body:
                    at = body.start()
                elif name in ("script", "style", "textarea", "title"):
                    at = n
        else:
            flush()
            in_link = 0
            heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
            if name in LEAF:
                own = _bonus(name, m[3])
                if own:
                    # a telling paragraph: its own node until the next block
                    out_len = len(out)
                    at = _leaf(page, tags, at, name, own, stack, out, heading)
                    if len(out) > out_len:
                        heading = False
                continue
            if name in VOID:
                continue
            if name in CLOSES_ITSELF and stack[-1].name == name:
                pop_from(len(stack) - 1)
            if not m[3].endswith("/"):
                own = _bonus(name, m[3])
                if name == "header" and own == ELEMENT["header"] and stack[-1].good >= ELEMENT["main"]:
                    own = 0.0  # an article's own header holds its title
                stack.append(_Node(name, stack[-1], own))
                opened[name] += 1
    flush()
    return out


def _leaf(page: str, tags: _Tags, at: int, name: str, own: float, stack: list, out: list, heading: bool) -> int:
    """Text of a paragraph that has a telling class, up to the next block tag."""
    parts = []
    while True:
        m = tags.search(at)
        parts.append(page[at:m.start() if m else len(page)])
        if not m:
            at = len(page)
            break
        tag = (m[2] or "").lower()
        if tag and tag not in INLINE and tag != "br":
            at = m.end() if m[1] and tag == name else m.start()
            break
        if tag == "br":
            parts.append(" ")
        at = m.end()
    text = " ".join(htmllib.unescape("".join(parts)).split())
    if text:
        out.append((text, 0, _Node(name, stack[-1], own), heading))
    return at


def describe(text: str, linked: int, heading: bool) -> tuple[float, float, float, float]:
    """Doublings of the word count, share of link text, whether it ends like a
    sentence, whether it is a heading."""
    words = text.count(" ") + 1
    return (min(math.log2(words + 1), 8.0), linked / len(text),
            float(words > 3 and text[-1] in ".!?…\"”»)"), float(heading))


def log_odds(text: str, linked: int, node: _Node, heading: bool, weights: tuple = UNTRAINED) -> float:
    return weights[0] + sum(w * x for w, x in zip(weights[1:], describe(text, linked, heading))) + node.odds()


def weak_label(node: _Node) -> int | None:
    """1 in an article and nothing else telling, 0 in boilerplate and nothing
    else telling, None in between."""
    if node.good >= 4 and node.bad == 0:
        return 1
    return 0 if node.bad <= -4 and node.good == 0 else None


def edges(items: list) -> list[tuple[int, int, float]]:
    """Smoothness edges: page order, and the next block under the same parent."""
    out, last = [], {}
    for i, (_, _, node, _) in enumerate(items):
        if i:
            out.append((i - 1, i, NEXT * DECAY ** _distance(items[i - 1][2], node)))
        before = last.get(id(node))
        if before is not None:
            out.append((before, i, SIBLING))
        last[id(node)] = i
    return out


def _distance(a: _Node, b: _Node) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: source side) of a minimum cut.  Positive scores are
    capacities from the source, negative ones to the sink."""
    n = len(scores)
    score = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        if i != j and w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None:
            continue
        hold = sum(near[i].values())
        if score[i] >= hold:
            label[i] = True
        elif score[i] < -hold:
            label[i] = False
        else:
            continue
        for j, w in near[i].items():
            score[j] += w if label[i] else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        source = _max_flow(open_nodes, score, near)
        for i in open_nodes:
            label[i] = i in source
    return label


def _max_flow(nodes: list[int], score: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches once no path to the sink is left."""
    s, t = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    room[s], room[t] = {}, {}
    for i in nodes:
        if score[i] > 0:
            room[s][i] = score[i]
            room[i][s] = 0.0
        elif score[i] < 0:
            room[i][t] = -score[i]
            room[t][i] = 0.0
    while True:
        # levels by breadth-first search; a page takes few rounds
        level, todo = {s: 0}, deque([s])
        while todo:
            i = todo.popleft()
            for j, r in room[i].items():
                if r > 1e-12 and j not in level:
                    level[j] = level[i] + 1
                    todo.append(j)
        if t not in level:
            return set(level) - {s}
        left = {i: iter(list(room[i])) for i in level}  # neighbours not yet given up in this round
        path = [s]
        while path:
            i = path[-1]
            if i == t:
                push = min(room[a][b] for a, b in zip(path, path[1:]))
                full = None
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    room[a][b] -= push
                    room[b][a] = room[b].get(a, 0.0) + push
                    if full is None and room[a][b] <= 1e-12:
                        full = k
                # from the first full edge's start on, its next neighbours are tried
                del path[full + 1:]
                continue
            for j in left[i]:
                if room[i][j] > 1e-12 and level.get(j) == level[i] + 1:
                    path.append(j)
                    break
            else:
                path.pop()


def main_text(page: str, weights: tuple = UNTRAINED) -> str:
    """The page's content blocks, joined by newlines."""
    items = blocks(page)
    if not items:
        return ""
    keep = min_cut([log_odds(*x, weights) for x in items], edges(items))
    return "\n".join(x[0] for x, k in zip(items, keep) if k)


def _labelled(batches):
    for batch in batches:
        found = []
        for page in batch.column(0).to_pylist():
            for text, linked, node, heading in blocks(page or ""):
                label = weak_label(node)
                if label is not None:
                    found.append((list(describe(text, linked, heading)), float(label)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.list_(pa.float64())), pa.array([y for _, y in found], pa.float64())],
            names=["x", "label"])


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
          sample: int = TRAIN_PAGES) -> tuple:
    """Classifier weights from about `sample` pages, drawn by a hash of id and
    html where they are read (nothing meets in one task); `UNTRAINED` where the
    sample lacks content or boilerplate."""
    share = min(1.0, sample / max(1, pages.count()))
    drawn = F.pmod(F.xxhash64(id_col, html_col), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = materialize(pages.filter(drawn).select(html_col).mapInArrow(
        _labelled, "x array<double>, label double"), "op5-train")
    if rows.select("label").distinct().count() < 2:
        return UNTRAINED
    model = LogisticRegression(regParam=0.01, maxIter=25, standardization=True).fit(
        rows.select(array_to_vector("x").alias("features"), "label"))
    return tuple(max(-MOST, min(MOST, float(w))) for w in (model.intercept, *model.coefficients))


def _extractor(weights: tuple):
    def extract(col: pa.Array) -> pa.Array:
        return pa.array([main_text(x, weights) if x else "" for x in col.to_pylist()], pa.string())
    return F.arrow_udf(extract, T.StringType())


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars), one row per input row.

    A null or empty html, and a page without content, give an empty text.
    Broken markup is read as browsers do where it matters here: unclosed
    paragraphs end at the next block, unknown end tags are ignored, unclosed
    comments run to the end.  Repeated rows are extracted row by row.  Other
    columns are not read.
    """
    bounded_batches(pages.sparkSession)
    extract = _extractor(train(pages, id_col, html_col))
    out = pages.select(F.col(id_col), F.col(url_col), extract(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
