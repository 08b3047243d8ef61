"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. A block's unary cost is a log-odds for content: what its elements
and their names tell, if anything, plus a logistic model of its length, link share, punctuation, tag, place in the page and
recurrence on other pages of its host. The model is fitted on blocks whose elements do tell (FIT_PAGES pages and FIT_BLOCKS
blocks at most, a documented bound of the model alone), drawn towards fixed weights where there are few. The cost is the
capacity of the block's edge to the source (content) or the sink (boilerplate). Neighbouring blocks are tied by smoothness
edges, stronger the nearer they stand in the document tree, so that an unsure block goes with its neighbours. The minimum
cut, found by maximum flow, separates content from boilerplate, and the content blocks are the page's text.

A null page counts as empty and gives an empty text. Nothing is capped: every block of the whole page takes part, however
long the page and however deep its elements. Repeated rows give the same text each. A null or unreadable URL has no host, and
nothing recurs there. An empty table gives an empty result. Extra columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.functions.url import authority
from corpusloom.llm import textbatch
from corpusloom.session import cut

#: Tags that begin and end a block; tags whose text is never shown as text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("script style title noscript template textarea iframe svg math object select option button datalist canvas audio video noembed noframes xmp head".split())
BOILERPLATE_TAG = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAG = frozenset(("article", "main"))
#: Words of class names, ids and roles that mark boilerplate.
BOILERPLATE_WORD = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist contentinfo cookie cookies copyright disclaimer disqus footer "
    "form header masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo promotion related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
CONTENT_WORD = frozenset("article body content entry main post story text".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Log-odds (nats) of a block whose elements tell: boilerplate; inside content; outside it on a page that has some.
STRONG, INSIDE, OUTSIDE = 9.0, 4.0, 2.5
#: Capacity of the tie between neighbours with one parent.
TIE = 1.6
#: What the model knows of a block, and the weights towards which it is drawn with PULL blocks' worth of trust. Fitted weights
#: stay within a factor of DRIFT of them, so that one corpus's markup does not stand for all.
FEATURES = ("bias", "link_share", "length", "text_tag", "list_tag", "sentence", "edge", "few_words", "recurs")
WEIGHTS = (-0.5, -4.0, 1.5, 0.8, -0.7, 0.8, -0.6, -0.6, -5.0)
PULL, DRIFT = 20.0, 2.0
#: Pages and labelled blocks that the fit may read.
FIT_PAGES, FIT_BLOCKS = 2_000, 50_000
#: A block recurs if this share of its host's pages, and so many of them at least, have its text.
RECURS_SHARE, RECURS_PAGES = 0.5, 4
#: Recurring blocks that may be sent to every worker (8 bytes each); beyond it they are joined to their host's pages.
BROADCAST_BLOCKS = 1_000_000
_LISTED = frozenset("li dt dd td th tr option menu".split())
_STOPS = frozenset(".!?…。！？:;\"”»)")


@dataclass
class Block:
    text: str
    node: int
    tag: str
    letters: int
    linked: int
    bad: bool
    inside: bool


@dataclass
class Page:
    """Blocks in order, and the tree of block-level elements: parent and depth by number."""

    blocks: list[Block]
    parent: list[int]
    depth: list[int]


_NAME = re.compile(r"[a-zA-Z]+")
_HAS_NAME = re.compile(r"(?i)class|id|role|hidden")


def _marks(tag: str, raw: str, in_content: bool) -> tuple[bool, bool]:
    """Whether an opening tag marks boilerplate, and whether it marks content."""
    bad, good = tag in BOILERPLATE_TAG or tag == "header" and not in_content, tag in CONTENT_TAG
    if raw and _HAS_NAME.search(raw):
        attrs = H.attributes(raw)
        words = {w.lower() for key in ("class", "id", "role") for w in _NAME.findall(attrs.get(key, ""))}
        if attrs.get("aria-hidden") == "true" or "hidden" in attrs:
            bad = True
        if words & BOILERPLATE_WORD and not (words & CONTENT_WORD and tag in CONTENT_TAG):
            bad = True
        elif words & CONTENT_WORD:
            good = True
    return bad, good


def read(page: str) -> Page:
    """The blocks of a page and the tree above them."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int, str]] = [("#root", False, False, 0, "#root")]  # tag, boilerplate, content, node and tag of the nearest block
    parent, depth = [0], [0]
    opened: Counter[str] = Counter()
    hidden = links = 0
    buffer: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                _, bad, inside, node, own = stack[-1]
                out.append(Block(text, node, own, len(text), len(" ".join(unescape(" ".join(linked)).split())), bad, inside))
            buffer.clear()
            linked.clear()

    def close(at: int) -> None:
        nonlocal hidden, links
        if any(s[0] in BLOCK for s in stack[at:]):
            flush()
        for s in stack[at:]:
            hidden -= s[0] in HIDDEN
            links -= s[0] == "a"
            opened[s[0]] -= 1
        del stack[at:]

    def close_open(names: tuple[str, ...] | frozenset, limits) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                close(i)
                return
            if stack[i][0] in limits:
                return

    for kind, name, rest in H.tokens(page):
        if kind == "text":
            if not hidden:
                buffer.append(rest)
                if links:
                    linked.append(rest)
        elif kind == "open":
            if name in BLOCK and not hidden:
                flush()
            if name in H.CLOSES_P:
                close_open(("p",), ("table", "td", "th", "button"))
            if name in H.CLOSED_BY:
                close_open(*H.CLOSED_BY[name])
            if name == "body" and opened["head"]:
                # Whatever the head left open ends here.
                close(next(i for i, s in enumerate(stack) if s[0] == "head"))
            if name in H.VOID:
                if name == "br" and not hidden:
                    buffer.append(" ")
                continue
            _, was_bad, was_inside, node, own = stack[-1]
            bad, good = _marks(name, rest, was_inside)
            if name in BLOCK:
                parent.append(node)
                depth.append(depth[node] + 1)
                node, own = len(parent) - 1, name
            stack.append((name, was_bad or bad, was_inside or good, node, own))
            opened[name] += 1
            hidden += name in HIDDEN
            links += name == "a"
        elif kind == "close":
            close_open((name,), ())
    flush()
    return Page(out, parent, depth)


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def features(page: Page, recurring: frozenset[int] = frozenset()) -> np.ndarray:
    """FEATURES of every block."""
    n = len(page.blocks)
    rows = []
    for i, b in enumerate(page.blocks):
        rows.append(
            (
                1.0,
                b.linked / max(b.letters, 1),
                min(1.5, math.log1p(b.letters / 40)),
                float(b.tag in HEADING or b.tag in ("p", "pre", "blockquote")),
                float(b.tag in _LISTED),
                float(b.text[-1] in _STOPS),
                abs(2 * (i + 0.5) / n - 1),
                float(b.text.count(" ") < 3),
                float(bool(recurring) and text_hash(b.text) in recurring),
            )
        )
    return np.array(rows).reshape(n, len(FEATURES))


def log_odds(page: Page, weights: tuple[float, ...], recurring: frozenset[int] = frozenset()) -> list[float]:
    """Nats by which each block is rather content than boilerplate."""
    has_content = any(b.inside and not b.bad for b in page.blocks)
    learned = features(page, recurring) @ np.array(weights)
    return [-STRONG if b.bad else float(x) + (0.0 if not has_content else INSIDE if b.inside else -OUTSIDE) for b, x in zip(page.blocks, learned, strict=True)]


def proximity(page: Page, a: int, b: int) -> float:
    """1 for block elements with one parent (or one in the other), less the farther their common ancestor is."""
    far = 0
    while a != b:
        if page.depth[a] >= page.depth[b]:
            a = page.parent[a]
        else:
            b = page.parent[b]
        far += 1
    return 1 / (1 + max(0, far - 2) / 2)


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stand on the source's side: positive gains are source edges, negative ones sink edges, ties go both ways.

    Augmenting by levels from the nodes with source capacity left; nodes that cannot be reached in the end are cut off."""
    n = len(gain)
    left = [max(g, 0.0) for g in gain]  # to be pushed
    room = [max(-g, 0.0) for g in gain]  # to the sink
    to: list[int] = []
    cap: list[float] = []
    edges: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in ties:
        edges[a].append(len(to))
        to.append(b)
        cap.append(c)
        edges[b].append(len(to))
        to.append(a)
        cap.append(c)
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque()
        for i in range(n):
            if left[i] > tiny:
                level[i] = 0
                queue.append(i)
        reach = False
        while queue:
            v = queue.popleft()
            reach |= room[v] > tiny
            for e in edges[v]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if not reach:
            return [x >= 0 for x in level]
        turn = [0] * n
        for s in range(n):
            while left[s] > tiny:
                # A path from s down the levels to a node with room, by depth-first search.
                path: list[int] = []
                v = s
                while True:
                    if room[v] > tiny:
                        push = min([left[s], room[v], *(cap[e] for e in path)])
                        left[s] -= push
                        room[v] -= push
                        for e in path:
                            cap[e] -= push
                            cap[e ^ 1] += push
                        break
                    step = -1
                    while turn[v] < len(edges[v]):
                        e = edges[v][turn[v]]
                        if cap[e] > tiny and level[to[e]] == level[v] + 1:
                            step = e
                            break
                        turn[v] += 1
                    if step >= 0:
                        path.append(step)
                        v = to[step]
                    elif path:
                        v = to[path.pop() ^ 1]
                        turn[v] += 1
                    else:
                        v = -1
                        break
                if v < 0:
                    break


def labelled(html: str, weights: tuple[float, ...] = WEIGHTS, recurring: frozenset[int] = frozenset()) -> tuple[list[Block], list[float], list[bool]]:
    """The blocks of a page, their log-odds, and whether the cut makes each content."""
    page = read(html)
    found = page.blocks
    gain = log_odds(page, weights, recurring)
    ties = [(i, i + 1, TIE * proximity(page, found[i].node, found[i + 1].node)) for i in range(len(found) - 1)]
    # Siblings that other blocks stand between are tied too.
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        home = page.parent[b.node]
        j = last.get(home)
        if j is not None and j < i - 1:
            ties.append((j, i, TIE / 2))
        last[home] = i
    return found, gain, minimum_cut(gain, ties)


def main_text(page: str | None, weights: tuple[float, ...] = WEIGHTS, recurring: frozenset[int] = frozenset()) -> str:
    """The content blocks of a page, one a line."""
    if not page:
        return ""
    found, _, content = labelled(page, weights, recurring)
    return "\n".join(b.text for b, yes in zip(found, content, strict=True) if yes)


def learn(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights by Newton's method, both labels counted alike, drawn towards WEIGHTS."""
    prior = np.array(WEIGHTS)
    w = prior.copy()
    if not 0 < y.sum() < len(y):
        return WEIGHTS
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + PULL * np.eye(len(w)), x.T @ (share * (y - p)) - PULL * (w - prior))
        w += step
        if np.abs(step).max() < 1e-9:
            break
    low, high = np.sort(np.stack([prior / DRIFT, prior * DRIFT]), axis=0)
    return tuple(float(v) for v in np.clip(w, low, high))


def fit(pages: DataFrame) -> tuple[float, ...]:
    """Weights from the blocks whose elements tell, of a bounded sample of pages by hash."""
    keep = min(1.0, FIT_PAGES / max(pages.count(), 1))
    chosen = pages.select("html").where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(keep * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, list[float], int]] = []
            for html in textbatch.as_strings(batch.column("html")).to_pylist():
                page = read(html)
                if not any(b.inside and not b.bad for b in page.blocks):
                    continue
                for b, x in zip(page.blocks, features(page), strict=True):
                    if b.bad or b.inside:
                        rows.append((text_hash(f"{b.tag} {b.text}"), x.tolist(), int(not b.bad)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.int32())], names=["hash", "x", "y"])

    found = chosen.mapInArrow(run, "hash long, x array<double>, y int").orderBy("hash", "x", "y").limit(FIT_BLOCKS).toArrow()
    if not found.num_rows:
        return WEIGHTS
    return learn(np.array(found["x"].to_pylist()), found["y"].to_numpy().astype(float))


def recurring_blocks(pages: DataFrame) -> DataFrame:
    """host, blocks: the hashes of the texts that recur on a host's pages. As each is on RECURS_SHARE of them at least, a list
    is no longer than 1 / RECURS_SHARE times the blocks of a page of that host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, host, number = textbatch.as_strings(batch.column("html")), batch.column("host").to_pylist(), batch.column("page").to_pylist()
            for start, stop in textbatch.slices(column):
                at, block = [], []
                for i, html in enumerate(column.slice(start, stop - start).to_pylist(), start):
                    mine = {text_hash(b.text) for b in read(html).blocks}
                    at += [i] * len(mine)
                    block += sorted(mine)
                yield pa.RecordBatch.from_arrays([pa.array([host[i] for i in at], pa.string()), pa.array([number[i] for i in at], pa.int64()), pa.array(block, pa.int64())], names=["host", "page", "block"])

    # Copies of a page are one page; hosts with too few pages are left out before anything is read.
    keyed = pages.select(_host().alias("host"), "html", F.xxhash64("html").alias("page")).where("host <> ''")
    sizes = cut(keyed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= RECURS_PAGES))
    if sizes.isEmpty():
        return sizes.select("host", F.array().cast("array<long>").alias("blocks"))
    few = F.broadcast(sizes) if sizes.count() <= BROADCAST_BLOCKS // 8 else sizes
    rows = keyed.join(few.select("host"), "host", "left_semi").mapInArrow(run, "host string, page long, block long").distinct()
    counts = rows.groupBy("host", "block").agg(F.count("*").alias("n")).join(sizes, "host")
    return counts.where((F.col("n") >= RECURS_PAGES) & (F.col("n") >= RECURS_SHARE * F.col("pages"))).groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("blocks"))


def _host():
    return F.lower(F.coalesce(authority(F.col("url")), F.lit("")))


def extract(pages: DataFrame, weights: tuple[float, ...] = WEIGHTS, recurring: DataFrame | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page, by the fitted weights and the blocks that recur (host, blocks)."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html")
    if recurring is None:
        rows = rows.withColumn("blocks", F.lit(None).cast("array<long>"))
    else:
        own = cut(recurring.withColumnRenamed("host", "own"))
        size = own.agg(F.sum(F.size("blocks") + 8)).first()[0] or 0
        rows = rows.join(F.broadcast(own) if size <= BROADCAST_BLOCKS else own, _host() == F.col("own"), "left").select("page_id", "url", "html", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, known = textbatch.as_strings(batch.column("html")), batch.column("blocks")
            for start, stop in textbatch.slices(column):
                texts = [main_text(p, weights, frozenset(r or ())) for p, r in zip(column.slice(start, stop - start).to_pylist(), known.slice(start, stop - start).to_pylist(), strict=True)]
                old = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([old.column("page_id"), old.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
