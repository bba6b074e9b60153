"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded down the tree.

Every block element is a node with features of its tag, the tokens of its attributes, the density of its subtree,
its depth, its ancestors and its siblings. Boosted trees score each node; the decoder then picks the best labelling
in which everything below a dropped node is dropped, so ancestors and descendants cannot contradict each other. The
trees are fitted on a bounded sample of pages that mark their main part themselves, with the marks hidden in some
copies, so that the other features carry pages without marks.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Pages the trees are fitted on at most, chosen by a hash of their id.
TRAINING_PAGES = 2_000
TREES = 40
DEPTH = 3
LEARNING_RATE = 0.3
BINS = 32
#: Weight of a subtree's characters, against 1 for those directly in the node, when a node is kept or dropped.
SUBTREE_WEIGHT = 0.25

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
#: Elements whose content is no text of the page. Left open, the first ones take all that follows, as in a browser; the
#: others end at the next block element, so that a mistake of the page costs no text.
RAW = set("script style title noscript template textarea iframe svg select button object audio video canvas".split())
TO_THE_END = {"script", "style", "title", "textarea", "iframe"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td"
    " tfoot th thead tr ul caption".split()
)
#: What a new element ends, if it is open and nothing of the second set lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
MAIN_TAGS = {"article", "main"}
OTHER_TAGS = set("nav aside footer header form menu dialog fieldset search".split())
TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt figcaption caption".split())
MAIN_TOKENS = set("article articlebody content main post entry story text body".split())
OTHER_TOKENS = set(
    "ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs byline comment comments consent"
    " cookie cookies copyright discussion disclaimer disqus footer form gdpr header legal login masthead menu modal nav"
    " navbar navigation newsletter notice notices overlay pager pagination popular popup promo promotion recommended register"
    " related replies reply respond reviews search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription toolbar topbar trending widget alert".split()
)
FEATURES = 18
#: Features that tell the marks of a page's main part; those that tell the marks of the rest.
MAIN_FEATURES, OTHER_FEATURES = [0, 5, 7], [1, 4, 6]


@dataclass
class Page:
    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    main_hint: list[int] = field(default_factory=list)
    other_hint: list[int] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    #: (node, text) in page order.
    blocks: list[tuple[int, str]] = field(default_factory=list)


#: Attributes whose tokens are remembered at a time; pages repeat them.
REMEMBERED = 4096


def _hints(attributes: str, known: dict[str, tuple[int, int]]) -> tuple[int, int]:
    if attributes not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        known[attributes] = _count_hints(attributes)
    return known[attributes]


def _count_hints(attributes: str) -> tuple[int, int]:
    tokens = set()
    for value in ATTRIBUTES.findall(attributes):
        tokens.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
    return len(tokens & MAIN_TOKENS), len(tokens & OTHER_TOKENS) + bool(HIDDEN.search(attributes))


BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.I)


def _behind(html: str, tag: str, at: int, empty: bool) -> int:
    """Where the page goes on behind an element of ``RAW`` whose content begins ``at``; ``empty``: its tag ended in ``/>``."""
    if tag == "svg" and empty:
        return at
    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
    if tag in TO_THE_END:
        return end.end() if end else len(html)
    if end and not re.compile(rf"<{tag}(?=[\s/>])", re.I).search(html, at, end.start()):
        return end.end()
    if end and tag in ("svg", "object", "template"):
        return _nested_end(html, tag, at) or _next_block(html, at)
    return _next_block(html, at)


def _nested_end(html: str, tag: str, at: int) -> int | None:
    """The end of an element that may hold others of its kind; None if it is left open."""
    depth = 1
    for found in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*?(/?)>", re.I).finditer(html, at):
        depth += -1 if found[1] else not found[2]
        if not depth:
            return found.end()
    return None


def _next_block(html: str, at: int) -> int:
    block = BLOCK_TAG.search(html, at)
    return block.start() if block else len(html)


def parse(html: str, known: dict[str, tuple[int, int]] | None = None) -> Page:
    """Block elements and the text directly in them. Tags that are left open end where a parser would end them.

    ``known`` remembers what attributes say from page to page.
    """
    known = {} if known is None else known
    page, stack = Page(), [0]
    pieces: list[str] = []
    linked, in_link, at = 0, False, 0

    def open_node(tag: str, attributes: str) -> None:
        main, other = _hints(attributes, known) if attributes else (0, 0)
        page.parent.append(stack[-1] if page.parent else -1)
        page.tag.append(tag)
        page.main_hint.append(main)
        page.other_hint.append(other)
        page.own.append(0)
        page.links.append(0)

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            page.blocks.append((stack[-1], text))
            page.own[stack[-1]] += len(text)
            page.links[stack[-1]] += min(linked, len(text))
        linked = 0

    def close(names: set[str], barrier: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[depth]]
            if tag in names:
                del stack[depth:]
                return
            if tag in barrier:
                return

    open_node("", "")
    while match := TOKEN.search(html, at):
        text = html[at : match.start()]
        if text:
            pieces.append(text)
            linked += len(text) if in_link else 0
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        ending = bool(match[1] or match[4])
        if not tag:
            continue
        if tag in RAW:
            if not ending:
                at = _behind(html, tag, at, match[0].endswith("/>"))
                pieces.append(" ")
        elif tag == "a":
            in_link = not ending
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCKS:
            flush()
            in_link = False
            if ending:
                close({tag}, set())
                continue
            if tag != "hr":
                close({"p"}, {"table", "td", "th"})
                if tag in ENDS:
                    close(*ENDS[tag])
                open_node(tag, match[3] or match[6] or "")
                stack.append(len(page.parent) - 1)
    if "<" not in html[at:]:
        pieces.append(html[at:])
    else:
        pieces.append(html[at:].partition("<")[0] if re.match(r"<[/a-zA-Z!?]", html[html.index("<", at) :]) else html[at:])
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each node. Parents come before their children."""
    n = len(page.parent)
    chars, links, nodes = list(page.own), list(page.links), [1] * n
    longest, paragraphs, stops = [0] * n, [t == "p" for t in page.tag], [0] * n
    for node, text in page.blocks:
        longest[node] = max(longest[node], len(text))
        stops[node] += sum(map(text.count, ".,;!?"))
    children: list[int] = [0] * n
    place = [0] * n
    for i in range(1, n):
        place[i] = children[page.parent[i]]
        children[page.parent[i]] += 1
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        nodes[p] += nodes[i]
        stops[p] += stops[i]
        paragraphs[p] += paragraphs[i]
        longest[p] = max(longest[p], longest[i])
    rows = np.zeros((n, FEATURES), np.float32)
    above_main, above_other, depth = [0] * n, [0] * n, [0] * n
    for i in range(n):
        tag, p = page.tag[i], page.parent[i]
        main, other = tag in MAIN_TAGS, tag in OTHER_TAGS
        if p >= 0:
            depth[i] = depth[p] + 1
            above_main[i] = above_main[p] + (page.tag[p] in MAIN_TAGS or page.main_hint[p] > 0)
            above_other[i] = above_other[p] + (page.tag[p] in OTHER_TAGS or page.other_hint[p] > 0)
        size = max(chars[i], 1)
        siblings = max(children[p], 1) if p >= 0 else 1
        rows[i] = (
            main,
            other,
            tag in TEXT_TAGS,
            tag[:1] == "h" and tag[1:].isdigit(),
            page.other_hint[i],
            page.main_hint[i],
            above_other[i],
            above_main[i],
            depth[i],
            np.log1p(chars[i]),
            links[i] / size,
            np.log1p(chars[i] / nodes[i]),
            chars[i] / max(chars[p] if p >= 0 else size, 1),
            np.log1p(siblings),
            place[i] / siblings,
            stops[i] / size,
            chars[i] / max(chars[0], 1),
            np.log1p(longest[i]) + np.log1p(paragraphs[i]),
        )
    return rows


def weak_labels(page: Page) -> np.ndarray | None:
    """1 where most text below a node is in the page's marked main part and in no marked other part; None without marks."""
    n = len(page.parent)
    inside, outside = [False] * n, [False] * n
    for i in range(n):
        p = page.parent[i]
        inside[i] = page.tag[i] in MAIN_TAGS or (p >= 0 and inside[p])
        outside[i] = page.tag[i] in OTHER_TAGS or page.other_hint[i] > 0 or (p >= 0 and outside[p])
    if not any(inside):
        return None
    good = [own * (i and not o) for own, i, o in zip(page.own, inside, outside)]
    total = list(page.own)
    for i in range(n - 1, 0, -1):
        good[page.parent[i]] += good[i]
        total[page.parent[i]] += total[i]
    return np.array([g * 2 >= t if t else i and not o for g, t, i, o in zip(good, total, inside, outside)], np.float32)


@dataclass
class Forest:
    """Trees of full depth: at every inner node a feature and a threshold, at every leaf a value."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        out, every = np.full(len(rows), self.base, np.float32), np.arange(len(rows))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[every, f[at]] > t[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def boost(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Newton boosting on logistic loss over binned features."""
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    margin, inner = np.full(len(rows), base), 2**DEPTH - 1
    trees: list[tuple] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - labels, p * (1 - p) + 1e-9
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        at = np.zeros(len(rows), np.int64)
        for node in range(inner):
            here = np.nonzero(at == node)[0]
            best = (1e-6, 0, None)
            for f, e in enumerate(edges):
                if len(e) and len(here) > 1:
                    sg = np.bincount(binned[here, f], g[here], len(e) + 1).cumsum()
                    sh = np.bincount(binned[here, f], h[here], len(e) + 1).cumsum()
                    lg, lh, rg, rh = sg[:-1], sh[:-1], sg[-1] - sg[:-1], sh[-1] - sh[:-1]
                    gain = lg**2 / (lh + 1) + rg**2 / (rh + 1) - sg[-1] ** 2 / (sh[-1] + 1)
                    top = int(gain.argmax())
                    if gain[top] > best[0]:
                        best = (gain[top], f, e[top])
            if best[2] is not None:
                feature[node], threshold[node] = best[1], best[2]
            at[here] = 2 * node + 1 + (rows[here, feature[node]] > threshold[node])
        leaf = at - inner
        value = -LEARNING_RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        margin = margin + value[leaf]
        trees.append((feature, threshold, value.astype(np.float32)))
    return Forest(base, *(np.stack(x) for x in zip(*trees)))


def hint_margins(rows: np.ndarray) -> np.ndarray:
    """Scores without a forest: marks, and text without links."""
    return 1 + rows[:, 0] + rows[:, 7] - 4 * (rows[:, 1] + rows[:, 4] + rows[:, 6]) - 4 * rows[:, 10]


def decode(page: Page, margins: np.ndarray) -> str:
    """The text of the blocks in the best labelling in which all below a dropped node is dropped. The root is kept."""
    n = len(page.parent)
    size = np.array(page.own, np.float64)
    below = list(page.own)
    for i in range(n - 1, 0, -1):
        below[page.parent[i]] += below[i]
    weight = size + SUBTREE_WEIGHT * np.array(below)
    best = (weight * margins).tolist()
    for i in range(n - 1, 0, -1):
        best[page.parent[i]] += max(best[i], 0.0)
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and best[i] > 0
    return "\n".join(text for node, text in page.blocks if kept[node] and (node or margins[0] > 0 or n == 1))


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, tuple[int, int]] = {}
    for batch in batches:
        for page_id, html in zip(batch["page_id"], batch["html"]):
            page = parse(html or "", known)
            labels = weak_labels(page)
            if labels is not None:
                yield pd.DataFrame(
                    {"page_id": page_id, "features": list(features(page)), "label": labels}
                )


def train(pages: DataFrame) -> Forest | None:
    """A forest from at most ``TRAINING_PAGES`` pages; None if none of them marks its main part."""
    chosen = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id")
    # Broadcast: TRAINING_PAGES ids. A repeated id counts once, with its least html.
    sample = pages.select("page_id", "html").join(F.broadcast(chosen.limit(TRAINING_PAGES)), "page_id")
    sample = sample.groupBy("page_id").agg(F.min("html").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    found = sample.mapInPandas(_training_rows, f"page_id {kind}, features array<float>, label float").toPandas()
    if not len(found):
        return None
    found = found.sort_values("page_id", kind="stable")
    rows, labels = np.stack(found["features"].to_numpy()), found["label"].to_numpy()
    unmarked, bare = rows.copy(), rows.copy()
    unmarked[:, MAIN_FEATURES] = 0
    bare[:, MAIN_FEATURES + OTHER_FEATURES] = 0
    return boost(np.concatenate((rows, rows, unmarked, unmarked, bare)), np.tile(labels, 5))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, the main ``text`` and its code points ``n_chars`` for every row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by a
    line feed. NULL and empty html give an empty text, and so do pages without any kept block. Repeated rows
    are rows of their own; other columns are ignored; an empty table gives an empty result.
    """
    fitted = train(pages)
    # Arrays, not the class: a broadcast value is pickled by reference, and workers have no copy of this package.
    parts = pages.sparkSession.sparkContext.broadcast(fitted and (fitted.base, fitted.feature, fitted.threshold, fitted.value))

    @pandas_udf(StringType())
    def extract(html: pd.Series) -> pd.Series:
        known: dict[str, tuple[int, int]] = {}
        parsed = [parse(h or "", known) for h in html]
        rows = [features(p) for p in parsed]
        every = np.concatenate(rows) if rows else np.zeros((0, FEATURES), np.float32)
        margins = Forest(*parts.value).margins(every) if parts.value else hint_margins(every)
        ends = np.cumsum([len(r) for r in rows])[:-1] if rows else []
        return pd.Series([decode(p, m) for p, m in zip(parsed, np.split(margins, ends))], dtype=object)

    found = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
