"""Main text of HTML pages by gradient-boosted trees over DOM nodes.

A forgiving parser makes a tree of block elements (inline elements only lend their text; unclosed paragraphs
and list items end where HTML ends them; scripts, styles, comments and the head are skipped). Each node has
features: kind of tag, attribute tokens, depth, subtree and own text, link and text density, siblings, place.
Boosted trees give each node the log-odds of being part of the article. Decoding goes by the tree: a node is
kept only if all its ancestors are, and of all such choices the one with the largest sum of log-odds is taken,
so no kept node lies inside a dropped one.

The trees are fitted on TRAIN_PAGES pages that this module composes (a bounded sample with known labels,
the same in every run): articles in various wrappers among menus, headers, adverts, notices, forms, sidebars,
comments and footers. Nothing of the table to be extracted is used for fitting.

Defined cases: null, empty and text-free pages give the empty string; text outside every block element counts
as text of the body, whose tags may be missing, and a byte order mark isn't text; broken markup is parsed as far as it
goes; equal rows give equal results; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, table, trimmed

TRAIN_PAGES = 400
TREES = 40
DEPTH = 4
BINS = 24
RATE = 0.3

#: Elements by their part in a page.
SKIPPED = frozenset("script style head title template iframe object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr picture source area map meta link base param track embed col".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: All others are inline, as browsers show what they don't know (formulas, drawings and elements of a page's own among them).
BLOCKS = CLOSES_P | frozenset("html body center legend li dt dd option optgroup summary caption colgroup tbody thead tfoot tr td th dir select input button label textarea dialog search".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("html body div article section main table ul ol dl nav header footer aside form td th".split())
KINDS = {
    "text": "p blockquote pre",
    "heading": "h1 h2 h3 h4 h5 h6",
    "item": "li dt dd option",
    "list": "ul ol dl menu select",
    "frame": "nav header footer aside",
    "article": "article main",
    "group": "div section figure center details",
    "table": "table tbody thead tfoot tr td th",
    "control": "form input button label textarea fieldset legend dialog",
    "root": "html body #root",
}
BAD_TOKENS = frozenset(
    "ad ads advert advertisement alert author banner bar bottom breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright cta disclaimer dialog discussion disqus feedback footer form head header legal login masthead menu meta modal nav navbar navigation newsletter notice pagination pager popup promo promoted recommend recommended related reply replies search share sharing sidebar signup site skip social sponsor sponsored subscribe tags toolbar top widget".split()
)
GOOD_TOKENS = frozenset("article articlebody blog body content entry entrycontent main mainentity maintext page post postbody posttext story storybody text prose".split())
KIND_OF = {tag: k for k, (_, tags) in enumerate(KINDS.items()) for tag in tags.split()}

_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*>)")
#: For the rest of a page from a tag on whose quotes don't close: quotes are letters like others there.
_LAX_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?][^>]*>)")
_OPENED = re.compile("<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile("[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: frozenset = frozenset()
    text: list = field(default_factory=list)  # (text, number of the block it belongs to)
    own: int = 0
    links: int = 0
    place: int = 0
    label: str = ""


def parse(page: str) -> list[Node]:
    """The block elements in page order, the root first. Text hangs on the block element around it."""
    nodes = [Node("#root", -1, 0)]
    stack, at, n, anchors, block = [0], int(page.startswith("\ufeff")), len(page), 0, 0
    seen_text = 0

    def add(raw: str) -> None:
        nonlocal seen_text
        text = unescape(raw)
        node = nodes[stack[-1]]
        if not text.isspace():
            size = len(text)
            node.own += size
            node.links += size * (anchors > 0)
            seen_text += size
        node.text.append((text, block))

    # How many elements of each tag are open, and skipped elements that have no end from here on: so that every step takes its time once.
    opened: Counter[str] = Counter()
    endless: set[str] = set()
    pattern = _TAG

    def close(k: int) -> None:
        opened.subtract(nodes[i].tag for i in stack[k:])
        del stack[k:]

    while at < n:
        begin = _OPENED.search(page, at)
        if begin is None:
            rest = page[at:].removesuffix("<")
            if rest:
                add(rest)
            break
        m = pattern.match(page, begin.start())
        if m is None and pattern is _TAG and begin[0][1] not in "!?" and page.find(">", begin.start()) >= 0 and _LAX_TAG.match(page, begin.start()):
            pattern = _LAX_TAG
            m = pattern.match(page, begin.start())
        if m is None:
            # `</` or `<!` before what is no name is dropped; a tag that never ends isn't text.
            if page.find(">", begin.start()) < 0:
                if begin.start() > at:
                    add(page[at : begin.start()])
                break
            add(page[at : begin.start() + 1])
            at = begin.start() + 1
            continue
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", m.start() + 4)
            at = n if end < 0 else end + 3
            continue
        if not m[3]:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag in SKIPPED:
            if not closing and not m[4].endswith("/") and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
                    if tag in ("script", "style"):
                        at = n
            continue
        if tag in INLINE or tag not in BLOCKS:
            if tag == "a":
                anchors = 0 if closing else 1
            elif tag == "br":
                nodes[stack[-1]].text.append((" ", block))
            continue
        block += 1
        if closing:
            if not opened[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    close(k)
                    break
                if tag not in SCOPES and nodes[stack[k]].tag in SCOPES:
                    break
            continue
        if tag in CLOSES_P and nodes[stack[-1]].tag == "p":
            close(len(stack) - 1)
        ends = SELF_CLOSING.get(tag)
        if ends and any(opened[t] for t in ends):
            for k in range(len(stack) - 1, 0, -1):
                t = nodes[stack[k]].tag
                if t in ends:
                    close(k)
                    if tag != "tr" and tag != "tbody":
                        break
                elif t in SCOPES or t in ("ul", "ol", "dl", "tr", "table"):
                    break
        words = frozenset(w.lower() for a in _ATTRIBUTE.findall(m[4]) for w in _TOKEN.findall(a[1] or a[2] or a[3])) if m[4] else frozenset()
        nodes.append(Node(tag, stack[-1], nodes[stack[-1]].depth + 1, words, place=seen_text))
        if "hidden" in m[4].lower() and re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.sub(r"[\"'][^\"']*[\"']", "", m[4]), re.I):
            nodes[-1].words |= {"notice"}
        if tag in ("body", "html"):
            anchors = 0
        if tag not in VOID and not m[4].endswith("/"):
            stack.append(len(nodes) - 1)
            opened[tag] += 1
    return nodes


FEATURES = 26


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    parent = np.fromiter((x.parent for x in nodes), np.int64, n)
    own = np.fromiter((x.own for x in nodes), np.float64, n)
    links = np.fromiter((x.links for x in nodes), np.float64, n)
    kind = np.fromiter((KIND_OF.get(x.tag, 6) for x in nodes), np.int64, n)
    bad = np.fromiter((len(x.words & BAD_TOKENS) if x.words else 0 for x in nodes), np.float64, n)
    good = np.fromiter((len(x.words & GOOD_TOKENS) if x.words else 0 for x in nodes), np.float64, n)
    depth = np.fromiter((x.depth for x in nodes), np.float64, n)
    place = np.fromiter((x.place for x in nodes), np.float64, n)
    stops = np.fromiter((sum(t.count(".") + t.count(",") for t, _ in x.text) for x in nodes), np.float64, n)
    text, link, size, stop, paragraphs, children = own.copy(), links.copy(), np.ones(n), stops.copy(), (kind == 0).astype(float), np.zeros(n)
    parts = (text, link, size, stop, paragraphs)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for x in parts:
            x[p] += x[i]
        children[p] += 1
    frame = (kind == 4).astype(float)
    control = (kind == 8).astype(float)
    above_bad, above_good, above_frame, above_article, above_control = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    rank, longest = np.zeros(n), np.zeros(n)
    count = np.zeros(n)
    for i in range(1, n):
        p = parent[i]
        above_bad[i] = above_bad[p] + bad[p]
        above_good[i] = above_good[p] + good[p]
        above_frame[i] = above_frame[p] + frame[p]
        above_article[i] = above_article[p] + (kind[p] == 5)
        above_control[i] = above_control[p] + control[p]
        rank[i] = count[p]
        count[p] += 1
        longest[p] = max(longest[p], text[i])
    whole = max(1.0, text[0])
    safe = np.maximum(text, 1)
    up = np.maximum(parent, 0)
    tag = [(kind == k).astype(float) for k in range(len(KINDS) - 1)]
    head = np.fromiter((x.tag in ("header", "h1") for x in nodes), np.float64, n)
    return np.stack(
        [*tag, head, bad, good, above_bad, above_good, above_frame, above_article, above_control, depth, np.log1p(text), link / safe, np.log1p(text / size), stop / safe * 100, paragraphs, children[up], rank / np.maximum(children[up], 1), text / whole],
        axis=1,
    )


@dataclass
class Forest:
    edges: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out


def boosted(x: np.ndarray, y: np.ndarray) -> Forest:
    """Trees of fixed depth on the logistic loss, split by histograms of quantile bins."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    trees: list[tuple] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            local = at - first
            g_all, h_all = np.bincount(local, grad, width), np.bincount(local, hess, width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                code = local * (len(e) + 1) + binned[:, f]
                g = np.bincount(code, grad, width * (len(e) + 1)).reshape(width, -1).cumsum(1)[:, :-1]
                h = np.bincount(code, hess, width * (len(e) + 1)).reshape(width, -1).cumsum(1)[:, :-1]
                gain = g**2 / (h + 1) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + 1) - (g_all**2 / (h_all + 1))[:, None]
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best[better] = gain[np.arange(width), k][better]
                feature[first : first + width][better], cut[first : first + width][better] = f, e[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        leaf = RATE * np.bincount(at - inner, grad, leaves) / (np.bincount(at - inner, hess, leaves) + 1)
        score += leaf[at - inner]
        trees.append((feature, cut, leaf))
    return Forest(edges, *(np.stack(c) for c in zip(*trees)), base)


def decoded(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the choice with the largest sum of log-odds in which kept nodes have kept parents."""
    gain = odds.astype(float).tolist()
    # The roots hold everything and say nothing.
    for i in range(len(nodes) - 1, -1, -1):
        if KIND_OF.get(nodes[i].tag) == 9:
            gain[i] -= odds[i]
        if i and gain[i] > 0:
            gain[nodes[i].parent] += gain[i]
    kept = np.zeros(len(nodes), bool)
    kept[0] = True
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and (gain[i] > 0 or KIND_OF.get(nodes[i].tag) == 9)
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """The kept text: blocks in page order, white space inside a block made one space."""
    runs: dict[int, list[str]] = {}
    for node, keep in zip(nodes, kept):
        if keep:
            for text, block in node.text:
                runs.setdefault(block, []).append(text)
    blocks = (" ".join("".join(runs[b]).split()) for b in sorted(runs))
    return "\n".join(b for b in blocks if b)


# ---- the composed training pages


def _words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(("ka", "lo", "mi", "ter", "an", "so", "re", "un", "st", "e")) for _ in range(r.randint(1, 4))) for _ in range(n))


def _sentences(r: random.Random, n: int) -> str:
    return " ".join((_words(r, r.randint(3, 16)).capitalize() + ("," if r.random() < 0.2 else ".") + r.choice(("", "", " " + _words(r, 4) + "."))) for _ in range(n))


def _clutter(r: random.Random) -> str:
    links = "".join(f'<li><a href="/{k}">{_words(r, r.randint(1, 3))}</a></li>' for k in range(r.randint(2, 9)))
    box = lambda names, inner: f'<{r.choice(("div", "section", "aside"))} {r.choice(("class", "id"))}="{r.choice(names)}">{inner}</TAG>'
    kinds = [
        lambda: f"<nav><ul>{links}</ul></nav>",
        lambda: f"<nav>{_words(r, 3)} <a href='/'>{_words(r, 2)}</a></nav>",
        lambda: f"<header><h1>{_words(r, 3)}</h1><p>{_words(r, 5)}</p></header>",
        lambda: f'<header class="site-header"><div><a href="/">{_words(r, 2)}</a></div></header>',
        lambda: f"<footer>&copy; {_words(r, 3)} &middot; {_sentences(r, r.randint(1, 3))}</footer>",
        lambda: f'<footer><p>{_sentences(r, 2)}</p><ul>{links}</ul></footer>',
        lambda: f"<aside><h3>{_words(r, 2)}</h3><p>{_sentences(r, r.randint(1, 4))}</p></aside>",
        lambda: box(("sidebar", "widget", "related-posts", "right sidebar"), f"<h3>{_words(r, 2)}</h3><ul>{links}</ul>"),
        lambda: box(("sidebar", "widget-area"), f"<p>{_sentences(r, r.randint(1, 4))}</p>"),
        lambda: box(("ad", "ads", "advert", "ad-banner", "sponsored", "promo"), r.choice((_sentences(r, r.randint(1, 3)), f"<p>{_sentences(r, r.randint(1, 4))}</p>"))),
        lambda: box(("cookie-notice", "notice", "cookie-consent", "alert", "popup"), f"<p>{_sentences(r, r.randint(1, 3))}</p><button>{_words(r, 1)}</button>"),
        lambda: box(("menu", "navbar", "breadcrumb", "breadcrumbs", "pagination"), f"<ul>{links}</ul>"),
        lambda: box(("comments", "comment-list", "discussion", "replies"), f"<h2>{_words(r, 1)}</h2>" + "".join(f'<div class="comment"><p>{_sentences(r, r.randint(1, 4))}</p></div>' for _ in range(r.randint(1, 4)))),
        lambda: f'<form action="/s"><label>{_words(r, 2)}</label><input name="q"><p>{_sentences(r, 1)}</p><button>{_words(r, 1)}</button></form>',
        lambda: box(("newsletter", "subscribe", "signup-form"), f"<h4>{_words(r, 3)}</h4><p>{_sentences(r, 2)}</p><form><input><button>{_words(r, 1)}</button></form>"),
        lambda: box(("share", "social-share", "tags", "author-byline"), f"<a href='#'>{_words(r, 1)}</a> <a href='#'>{_words(r, 1)}</a>"),
        lambda: f'<div class="{r.choice(("site-footer", "copyright", "legal"))}"><p>{_sentences(r, 2)}</p></div>',
    ]
    out = r.choice(kinds)()
    tag = re.match(r"<(\w+)", out)[1]
    return out.replace("</TAG>", f"</{tag}>")


def _article(r: random.Random) -> str:
    parts = [f"<h1>{_words(r, r.randint(2, 9))}</h1>"] * (r.random() < 0.8)
    for _ in range(r.randint(1, 12)):
        roll = r.random()
        if roll < 0.62:
            parts.append(f"<p>{_sentences(r, r.choice((1, 1, 2, 4, 8)))}</p>")
        elif roll < 0.7:
            parts.append(f"<p><b>{_sentences(r, 2)}<br>")
        elif roll < 0.75:
            parts.append(f"<p>{_words(r, r.randint(1, 3))}.</p>")
        elif roll < 0.82:
            parts.append(f"<h2>{_words(r, r.randint(1, 5))}</h2>")
        elif roll < 0.88:
            parts.append("<ul>" + "".join(f"<li>{_sentences(r, 1)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
        elif roll < 0.92:
            parts.append(f"<blockquote>{r.choice((_sentences(r, 2), '<p>' + _sentences(r, 2) + '</p>'))}</blockquote>")
        elif roll < 0.95:
            parts.append(f"<table><tr><td>{_words(r, 3)}</td><td>{_words(r, 4)}</td></tr></table>")
        elif roll < 0.97:
            parts.append(f"<p>{_sentences(r, 1)} <a href='/x'>{_words(r, 3)}</a> {_sentences(r, 1)}</p>")
        else:
            parts.append(f"<pre>{_words(r, 12)}</pre>")
    return "".join(parts)


def composed(seed: int) -> list[tuple[list[Node], np.ndarray]]:
    """Parsed pages with the label of each node: 1 on the article and what holds it."""
    r, out = random.Random(seed), []
    for _ in range(TRAIN_PAGES):
        inner = _article(r)
        if r.random() < 0.3:
            cut = inner.rfind("</p>") + 4
            if cut > 4:
                inner = inner[:cut] + f"<!--off-->{_clutter(r)}<!--on-->" + inner[cut:]
        wrap = r.choice(
            ["<article>%s</article>"] * 4
            + ["<main>%s</main>", '<div class="content">%s</div>', '<div id="post-body">%s</div>', '<main><article>%s</article></main>', '<section class="article-text">%s</section>', "<div>%s</div>", '<div class="entry-content">%s</div>', "<article><div>%s</div></article>"]
        )
        body = "".join(_clutter(r) for _ in range(r.randint(0, 4))) + "<!--on-->" + wrap % inner + "<!--off-->" + "".join(_clutter(r) for _ in range(r.randint(0, 4)))
        if r.random() < 0.3:
            body = f'<div class="{r.choice(("page", "wrapper", "container"))}">{body}</div>'
        marked = re.sub(r"<!--(on|off)-->", lambda m: f"<x-{m[1]}>", f"<html><body>{body}</body></html>")
        # Marks are parsed as void elements; what stands between them is the article.
        nodes = _marked(marked)
        label = np.array([x.label == "on" for x in nodes], bool)
        for i in range(len(nodes) - 1, 0, -1):
            if label[i]:
                label[nodes[i].parent] = True
        out.append((nodes, label.astype(float)))
    return out


def _marked(page: str) -> list[Node]:
    """parse(), with each node's label by the last mark before it; the marks themselves go."""
    pieces, on, spans, at = [], "off", [], 0
    for part in re.split(r"<x-(on|off)>", page):
        if part in ("on", "off"):
            on = part
            continue
        pieces.append(part)
        spans.append((at, on))
        at += len(re.findall(r"<[a-zA-Z]", part))
    clean = "".join(pieces)
    nodes = parse(clean)
    # Count block elements as parse() makes them, in the same order.
    order, labels = 0, []
    for part, (_, on) in zip(pieces, spans):
        made = sum(1 for m in _TAG.finditer(part) if m[3] and not m[2] and m[3].lower() not in INLINE and m[3].lower() not in SKIPPED)
        labels += [on] * made
        order += made
    for node, on in zip(nodes[1:], labels):
        node.label = on
    return nodes


@lru_cache(1)
def trained() -> Forest:
    pages = composed(17)
    x = np.concatenate([features(nodes) for nodes, _ in pages])
    y = np.concatenate([label for _, label in pages])
    return boosted(x, y)


def extract(pages: list[str | None], forest: Forest) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    found = [features(nodes) for nodes in parsed]
    odds = forest.scores(np.concatenate(found)) if found else np.zeros(0)
    out, at = [], 0
    for nodes in parsed:
        out.append(text_of(nodes, decoded(nodes, odds[at : at + len(nodes)])))
        at += len(nodes)
    return out


def extracted(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (page_id and url) and the main text of every page."""
    spark = pages.sparkSession
    arrow_batches(spark, rows=1000)
    keep = ["page_id", "url"] if keep is None else keep
    forest = spark.sparkContext.broadcast(trained())
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html).cast("string").alias("__html"))
    schema = rows.drop("__html").withColumn("text", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = extract(part.column(len(keep)).to_pylist(), forest.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    return rows.mapInArrow(trimmed(run), schema)


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
