"""Main text of HTML pages: gradient-boosted trees over DOM-node features, decoded over the tree.

A page is parsed into a tree (with the implied end tags of HTML).  Every element gets features:
its tag, tokens of its class, id and role, depth, place among its siblings, and densities of its
subtree (text, links, paragraphs, punctuation).  Boosted trees give the probability that an element
belongs to the article.  Decoding picks the likeliest labelling in which nothing outside the article
has a descendant inside it, by dynamic programming over the tree; so an advert within the article may
be dropped, but no paragraph of a sidebar is kept while the sidebar goes.

The trees are trained here, on pages generated from a seed with known labels (``examples``); no page
of the input is used.  Extraction is one narrow pass, without a shuffle; memory is bounded by a few
pages.  Defined cases: null or empty html gives the empty text; a page without markup is one block; a
repeated page gives the same text each time.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.common import small_batches

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HIDDEN = frozenset("script style textarea title noscript iframe template head select option button form input nav menu dialog".split())
INLINE = frozenset("a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow ms msqrt msub msup mtext object q ruby rb rp rt s samp small span strike strong sub sup svg time tt u var video wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("tr td th tbody thead", "table"), "tbody": ("tr td th tbody thead", "table")}
TAGS = "article main section div p h1 h2 h3 h4 ul ol li table blockquote pre figure nav header footer aside form".split()
GOOD = "article content main post entry body story text blog page hentry column".split()
BAD = {
    "ad": "ad ads advert advertisement banner sponsor sponsored promo promoted promotion outbrain taboola adsbox commercial".split(),
    "nav": "nav menu navbar breadcrumb breadcrumbs pagination pager toc skip toolbar tabs links navigation".split(),
    "foot": "footer foot copyright legal colophon bottom sitemap".split(),
    "head": "header masthead top topbar logo brand".split(),
    "side": "sidebar side aside widget related recommended popular trending more rail secondary complementary".split(),
    "talk": "comment comments reply replies respond disqus discussion feedback reactions thread".split(),
    "note": "cookie cookies consent gdpr notice popup modal overlay alert newsletter subscribe signup login share social sharing banner toast dialog".split(),
}

_token = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_attribute = re.compile(r"\b(class|id|role|hidden|style|aria-label|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I | re.S)
_words = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    up: int
    depth: int
    attributes: frozenset = frozenset()
    hidden: bool = False
    below: list = field(default_factory=list)  # node numbers, and texts


def _attributes(raw: str) -> tuple[frozenset, bool]:
    found, hidden = set(), False
    for name, a, b, c in _attribute.findall(raw):
        name, value = name.lower(), a or b or c
        if name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "hidden":
            hidden = True
        else:
            found.update(_words.findall(_camel.sub(" ", value).lower()))
    return frozenset(found), hidden


def parse(page: str) -> list[Node]:
    """Elements in document order; the first is the root."""
    nodes = [Node("#root", -1, 0)]
    stack, at, size = [0], 0, len(page)

    places: dict[str, list[int]] = {}  # where in the stack a tag is open

    def text(part: str) -> None:
        if part:
            nodes[stack[-1]].below.append(part)

    def innermost(names: Iterable[str]) -> int:
        return max((places[t][-1] for t in names if places.get(t)), default=0)

    def close(names: Iterable[str], scope: Iterable[str] = ()) -> None:
        to = innermost(names)
        if to and to >= innermost(scope):
            while len(stack) > to:
                places[nodes[stack.pop()].tag].pop()

    while at < size:
        m = _token.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        if m[1]:
            tag = m[1].lower()
            close((tag,), ("table",) if tag in INLINE or tag == "p" else ())
        elif m[2]:
            tag = m[2].lower()
            if tag in CLOSES_P:
                close(("p",), ("table", "td", "li", "button"))
            if tag in CLOSES:
                names, scope = CLOSES[tag]
                for _ in range(3 if tag in ("tr", "tbody", "thead") else 1):
                    close(names.split(), scope.split())
            attributes, hidden = _attributes(m[3]) if m[3] else (frozenset(), False)
            n = len(nodes)
            nodes.append(Node(tag, stack[-1], len(stack), attributes, hidden))
            nodes[stack[-1]].below.append(n)
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            elif tag not in VOID and not m[0].endswith("/>"):
                places.setdefault(tag, []).append(len(stack))
                stack.append(n)
    return nodes


NAMES = [f"tag_{t}" for t in TAGS] + [f"in_{t}" for t in ("nav", "header", "footer", "aside", "form", "article", "main")] + ["good", *(f"bad_{k}" for k in BAD), "in_good", *(f"in_bad_{k}" for k in BAD)] + ["depth", "place", "siblings", "same_tag", "chars", "share", "words", "link_share", "per_tag", "stops", "paragraphs", "paragraph_share", "longest", "below", "after_h1", "has_h1", "list_items"]
_BAD = {w: k for k, (_, ws) in enumerate(BAD.items()) for w in ws}
_GOOD = frozenset(GOOD)


def features(nodes: list[Node]) -> np.ndarray:
    """A row for every node."""
    n, nb = len(nodes), len(BAD)
    chars, links, words, stops, tags, paragraphs, in_p, longest, h1, items = (np.zeros(n) for _ in range(10))
    for i in range(n - 1, -1, -1):
        v = nodes[i]
        if v.tag in RAW or v.hidden:
            continue
        tags[i] += 1
        own = 0
        for x in v.below:
            if isinstance(x, str):
                k = len(x.strip())
                own += k
                words[i] += x.count(" ") + 1 if k else 0
                stops[i] += x.count(".") + x.count(",")
        chars[i] += own
        longest[i] = max(longest[i], own)
        if v.tag == "a":
            links[i] = chars[i]
        if v.tag == "p":
            paragraphs[i] += 1
            in_p[i] = chars[i]
        if v.tag == "h1":
            h1[i] = 1
        if v.tag == "li":
            items[i] += 1
        if v.up >= 0:
            for a in (chars, links, words, stops, tags, paragraphs, in_p, items):
                a[v.up] += a[i]
            longest[v.up], h1[v.up] = max(longest[v.up], longest[i]), max(h1[v.up], h1[i])
    out = np.zeros((n, len(NAMES)))
    children = np.bincount([v.up for v in nodes[1:]], minlength=n)
    around = ("nav", "header", "footer", "aside", "form", "article", "main")
    base, seen_h1 = len(TAGS), 0.0
    for i, v in enumerate(nodes):
        row = out[i]
        if v.tag in TAGS:
            row[TAGS.index(v.tag)] = 1
        good = bool(v.attributes & _GOOD)
        at = base + len(around)
        if v.up >= 0:
            row[base:at] = out[v.up, base:at]
            row[at + 1 + nb] = out[v.up, at] or out[v.up, at + 1 + nb]
            row[at + 2 + nb : at + 2 + 2 * nb] = np.maximum(out[v.up, at + 1 : at + 1 + nb], out[v.up, at + 2 + nb : at + 2 + 2 * nb])
        if v.tag in around:
            row[base + around.index(v.tag)] = 1
        row[at] = good
        for w in v.attributes:
            if w in _BAD:
                row[at + 1 + _BAD[w]] = 1
        c = max(chars[i], 1.0)
        row[at + 2 + 2 * nb :] = (v.depth, 0.0, children[v.up] if v.up >= 0 else 1, 0.0, np.log1p(chars[i]), chars[i] / max(chars[0], 1.0), np.log1p(words[i]), links[i] / c, np.log1p(chars[i] / max(tags[i], 1)), stops[i] / max(words[i], 1), paragraphs[i], in_p[i] / c, np.log1p(longest[i]), np.log1p(tags[i]), seen_h1, h1[i], items[i])
        if v.tag == "h1":
            seen_h1 = 1.0
    place, same = NAMES.index("place"), NAMES.index("same_tag")
    for v in nodes:
        family = [x for x in v.below if not isinstance(x, str)]
        kinds: dict[str, int] = {}
        for x in family:
            kinds[nodes[x].tag] = kinds.get(nodes[x].tag, 0) + 1
        for k, x in enumerate(family):
            out[x, place], out[x, same] = k / len(family), kinds[nodes[x].tag] / len(family)
    return out


class Trees:
    """Gradient-boosted regression trees of the logistic loss, on quantile bins."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)
        p0 = y.mean()
        self.start, self.trees = float(np.log(p0 / (1 - p0))), []
        f = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            size = 2**self.depth
            by, cut, leaf = np.zeros(size, int), np.full(size, np.inf), np.zeros(len(y), int) + 1
            for level in range(self.depth):
                for node in range(2**level, 2 ** (level + 1)):
                    rows = np.flatnonzero(leaf == node)
                    best = (1e-6, 0, np.inf, 0)
                    if len(rows) > 20:
                        gr, hr, br = g[rows], h[rows], b[rows]
                        gs, hs = gr.sum(), hr.sum()
                        for j, c in enumerate(self.cuts):
                            if len(c):
                                gl = np.cumsum(np.bincount(br[:, j], gr, len(c) + 1))[:-1]
                                hl = np.cumsum(np.bincount(br[:, j], hr, len(c) + 1))[:-1]
                                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                                k = int(gain.argmax())
                                if gain[k] > best[0]:
                                    best = (gain[k], j, c[k], k)
                    by[node], cut[node] = best[1], best[2]
                    leaf[rows] = 2 * node + (x[rows, best[1]] > best[2])
            value = np.array([g[leaf == k].sum() / (h[leaf == k].sum() + 1) for k in range(size, 2 * size)]) * self.rate
            self.trees.append((by, cut, value))
            f += value[leaf - size]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        f, rows = np.full(len(x), self.start), np.arange(len(x))
        for by, cut, value in self.trees:
            at = np.ones(len(x), int)
            for _ in range(self.depth):
                at = 2 * at + (x[rows, by[at]] > cut[at])
            f += value[at - len(value)]
        return f


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The likeliest labelling in which all below what is outside is outside; the root is inside."""
    odds = np.clip(odds, -8, 8)
    inside, outside = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    best_in, all_out = inside.copy(), outside.copy()
    for i in range(len(nodes) - 1, 0, -1):
        if nodes[i].tag in HIDDEN or nodes[i].hidden:
            best_in[i] = -1e9
        up = nodes[i].up
        best_in[up] += max(best_in[i], all_out[i])
        all_out[up] += all_out[i]
    keep = [True] * len(nodes)
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].up] and best_in[i] >= all_out[i]
    return keep


def scored(nodes: list[Node]) -> list[int]:
    """Numbers of the elements that are labelled: blocks; inline ones go with the block around them."""
    return [i for i, v in enumerate(nodes) if v.tag not in INLINE and v.tag not in RAW]


def blocks(nodes: list[Node], keep: list[bool]) -> list[str]:
    """Texts of the blocks that are kept, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(_html.unescape("".join(parts)).split())
        if text:
            out.append(text)
        parts.clear()

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, k = stack.pop()
        v = nodes[i]
        if k == 0 and v.tag not in INLINE:
            flush()
        while k < len(v.below):
            x = v.below[k]
            k += 1
            if isinstance(x, str):
                parts.append(x)
            elif nodes[x].tag in ("br", "img", "wbr"):
                parts.append(" " if nodes[x].tag == "br" else "")
            elif keep[x]:
                stack.append((i, k))
                stack.append((x, 0))
                break
        else:
            if v.tag not in INLINE:
                flush()
    return out


# ---- training pages -------------------------------------------------------------------------


def _sentence(r: random.Random, low: int, high: int) -> str:
    words = ["".join(r.choice("aeioulnrstdmcpbg") for _ in range(r.randint(1, 9))) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + r.choice([".", ".", ".", "?", "!", ":"])


def _example(r: random.Random) -> str:
    """A page whose article elements carry the marker attribute data-k; the marker is not a feature."""
    links = lambda n: "".join(f'<li><a href="/{k}">{_sentence(r, 1, 3)[:-1]}</a></li>' for k in range(n))
    short = lambda: _sentence(r, 2, 14)
    prose = lambda: " ".join(_sentence(r, 1, 25) for _ in range(r.randint(1, 6)))
    cls = lambda words: f' {r.choice(["class", "class", "id"])}="{r.choice(words)}{r.choice(["", "", "-box", "-1", " wide", "_inner"])}"'
    nav = lambda: r.choice([f"<nav{cls(BAD['nav']) if r.random() < 0.3 else ''}><ul>{links(r.randint(2, 9))}</ul></nav>", f"<div{cls(BAD['nav'])}><ul>{links(r.randint(2, 9))}</ul></div>"])
    header = lambda: r.choice([f"<header>{r.choice(['', nav()])}<p>{short()}</p></header>", f"<div{cls(BAD['head'])}><a href='/'>{short()}</a></div>"])
    footer = lambda: r.choice([f"<footer>&copy; {short()} {r.choice(['', short()])}</footer>", f"<footer><p>{short()}</p><ul>{links(3)}</ul></footer>", f"<div{cls(BAD['foot'])}><p>&copy; {short()}</p></div>"])
    ad = lambda: f"<{(t := r.choice(['div', 'div', 'section', 'aside']))}{cls(BAD['ad'])}>{r.choice([short(), f'<p>{prose()}</p>', f'<a href=/x>{short()}</a>'])}</{t}>"
    side = lambda: f"<{(t := r.choice(['aside', 'aside', 'div']))}{cls(BAD['side']) if t == 'div' or r.random() < 0.5 else ''}><h3>{short()}</h3>{r.choice([f'<ul>{links(4)}</ul>', f'<p>{prose()}</p>'])}</{t}>"
    note = lambda: f"<div{cls(BAD['note'])}><p>{short()}</p>{r.choice(['', '<button>OK</button>', f'<a href=/p>{short()}</a>'])}</div>"
    form = lambda: f"<form action=/s><label>{short()}</label><input name=q><p>{short()}</p><button>Go</button></form>"
    talk = lambda: f"<{(t := r.choice(['div', 'section', 'ul']))}{cls(BAD['talk'])}>" + "".join(f"<{(u := 'li' if t == 'ul' else r.choice(['div', 'article']))}{cls(BAD['talk'])}><p>{prose()}</p></{u}>" for _ in range(r.randint(1, 5))) + f"</{t}>"
    inside = lambda f, p: f() if r.random() < p else ""
    body = []
    for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14])):
        kind = r.random()
        if kind < 0.75:
            body.append(f"<p data-k>{r.choice(['', '<b>', '<em>'])}{prose()}{r.choice(['', '<br>', ''])}" + r.choice(["</p>", "</p>", ""]))
        elif kind < 0.82:
            body.append(f"<h2 data-k>{short()}</h2>")
        elif kind < 0.88:
            body.append("<ul data-k>" + "".join(f"<li data-k>{_sentence(r, 2, 20)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
        elif kind < 0.92:
            body.append(f"<blockquote data-k>{r.choice([prose(), f'<p data-k>{prose()}</p>'])}</blockquote>")
        elif kind < 0.95:
            body.append(f"<table data-k><tr data-k><td data-k>{short()}</td><td data-k>{short()}</td></tr></table>")
        else:
            body.append(f"<div data-k>{prose()}</div>")
        body.append(inside(ad, 0.08) + inside(side, 0.04) + inside(note, 0.04))
    tail = inside(talk, 0.15) + inside(note, 0.1) + inside(nav, 0.05)
    wrap, attr = r.choice([("article", ""), ("article", ""), ("article", cls(GOOD)), ("main", ""), ("div", cls(GOOD)), ("section", cls(GOOD)), ("div", "")])
    article = f"<{wrap} data-k{attr}>" + r.choice([f"<h1 data-k>{short()}</h1>", f"<h1 data-k>{short()}</h1>", f"<header data-k><h1 data-k>{short()}</h1></header>", ""]) + "".join(body) + tail + f"</{wrap}>"
    if r.random() < 0.4:
        outer, attr = r.choice([("div", cls(GOOD)), ("main", ""), ("div", ' class="wrapper"'), ("section", "")])
        article = f"<{outer} data-k{attr}>" + inside(side, 0.2) + article + inside(side, 0.3) + inside(talk, 0.2) + f"</{outer}>"
    head = f"<head><meta charset=utf-8><title>{short()}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
    page = inside(note, 0.25) + inside(header, 0.4) + inside(nav, 0.7) + inside(ad, 0.4) + article + inside(ad, 0.2) + inside(side, 0.3) + inside(talk, 0.25) + inside(form, 0.15) + inside(note, 0.15) + inside(footer, 0.8)
    return f"<!DOCTYPE html><html data-k>{head}<body data-k>{page}" + r.choice(["</body></html>", ""])


def examples(pages: int = 900, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    r, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        nodes = parse(_example(r).replace(" data-k", " role=mainmark"))
        y = np.array([1.0 if "mainmark" in v.attributes else 0.0 for v in nodes])
        for v in nodes:
            v.attributes = v.attributes - {"mainmark"}
        at = [i for i in scored(nodes) if nodes[i].tag not in HIDDEN and i]
        xs.append(features(nodes)[at])
        ys.append(y[at])
    return np.concatenate(xs), np.concatenate(ys)


def train(pages: int = 900, seed: int = 20) -> Trees:
    return Trees().fit(*examples(pages, seed))


def texts(pages: list[str | None], trees: Trees) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    xs = [features(nodes) for nodes in parsed]
    odds = trees.predict(np.concatenate(xs)) if xs else np.zeros(0)
    out, at = [], 0
    for nodes in parsed:
        own = odds[at : at + len(nodes)].copy()
        at += len(nodes)
        for i, v in enumerate(nodes):
            if v.tag in INLINE or v.tag in ("html", "body", "#root"):
                own[i] = 0.0  # not labelled by themselves
        out.append("\n".join(blocks(nodes, decode(nodes, own))))
    return out


def extract(pages: DataFrame, trees: Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)  # some 40 trees of 16 leaves

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches, 64):
            found = texts(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"page_id {dict(pages.dtypes)[id_col]}, url string, text string, n_chars long")
