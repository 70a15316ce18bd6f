"""Main text of web pages: content marginals of a tree-structured graphical model over the page's elements.

Each element that stands for a block (and each inline one with a class or id) is a node with two states, content or
not. A node's own potential comes from its tag, the words of its class and id, and its text and links; a potential
between parent and child ties their states. Sum-product messages, first upward and then downward, give the exact
marginals. The potentials are trained on labelled pages by the gradient of the log-likelihood, which needs the same
marginals. Text whose node is content with a probability of a half or more makes up the result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages read at once in a task.
PAGES = 100

# --- pages as trees ------------------------------------------------------------------------------------------

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button canvas cite code data del dfn em font i img input ins kbd label map mark math meter noscript object output"
    " picture progress q rp rt ruby s samp select slot small source span strike strong sub sup svg textarea time tt u var video audio wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: what is in the first kind is no text, that of the second is.
SILENT, PLAIN = ("script", "style", "template", "iframe", "title"), ("textarea", "xmp")
HIDDEN = frozenset((*SILENT, "head"))
#: Elements in which no element is a block.
FOREIGN = frozenset(("math", "svg"))
#: What an opening tag ends that was left open.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, set()),
}

_ATTRS = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^<>]*>"
    rf"|<(?P<raw>{'|'.join(SILENT + PLAIN)})\b{_ATTRS}>(?P<body>.*?)(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})>"
    # A quote that is never closed, or a page that stops within a tag.
    r"|<(?P<cut_end>/)?(?P<cut_tag>[a-zA-Z][^\s/>]*)(?P<cut_attrs>[^>]*)(?P<closed>>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r"\bdata-main\s*=\s*\"?([01])")
_WORD = re.compile(r"[a-z]+")


class Page:
    """The nodes of a page in order, a parent before its children, and its pieces of text."""

    def __init__(self, source: str):
        self.tags, self.names, self.parents, self.depths, self.labels, self.hidden = [""], [frozenset()], [-1], [0], [0], [False]
        self.chars, self.linked, self.stops, self.below = [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self._read(source)

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        found = _NAMES.findall(attrs) if attrs else ()
        label = _LABEL.search(attrs) if attrs else None
        self.tags.append(tag)
        self.names.append(frozenset(w for x in found for w in _WORD.findall("".join(x).lower())) if found else frozenset())
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        self.labels.append(int(label[1]) if label else self.labels[parent])
        self.hidden.append(self.hidden[parent] or tag in HIDDEN or "hidden" in attrs and re.search(r"(?:^|\s)hidden(?=[\s=/]|$)", attrs) is not None)
        for column in (self.chars, self.linked, self.stops, self.below):
            column.append(0)
        self.below[parent] += 1
        return len(self.tags) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        block, links, at = 0, 0, 0
        foreign = re.search("<(?:math|svg)", source, re.I) is not None
        for found in _TOKEN.finditer(source):
            if found.start() > at:
                self._text(source[at : found.start()], stack[-1][1], block, links)
            at = found.end()
            inside = foreign and any(t in FOREIGN for t, _ in stack)
            if found["raw"]:
                raw = found["raw"].lower()
                if raw in PLAIN or raw == "title" and inside:
                    apart = raw == "xmp"
                    block += apart
                    self._text(found["body"], self._open(raw if raw in PLAIN else "text", "", stack[-1][1]), block, links, not apart)
                    block += apart
                continue
            tag, attrs, end = (found["tag"], found["attrs"], found["end"]) if found["tag"] else (found["closed"] and found["cut_tag"], found["cut_attrs"], found["cut_end"])
            if not tag:
                continue
            tag = tag.lower()
            inline = tag in INLINE or inside
            if end:
                if any(t == tag for t, _ in stack):
                    while (closed := stack.pop()[0]) != tag:
                        links -= closed == "a"
                    links -= tag == "a"
            else:
                if not inline and any(t == "p" for t, _ in stack[-8:]):
                    # A block ends an open paragraph, with what is open in it.
                    depth = max(i for i, (t, _) in enumerate(stack) if t == "p")
                    if all(t in INLINE for t, _ in stack[depth + 1 :]):
                        links -= sum(t == "a" for t, _ in stack[depth:])
                        del stack[depth:]
                if tag in ENDS:
                    ends, within = ENDS[tag]
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] in within:
                            break
                        if stack[depth][0] in ends:
                            links -= sum(t == "a" for t, _ in stack[depth:])
                            del stack[depth:]
                            break
                node = stack[-1][1]
                if not inline or "class" in attrs or "id" in attrs or "data-main" in attrs:
                    node = self._open(tag, attrs, node)
                if tag == "br":
                    self.pieces.append((stack[-1][1], block, " "))
                if tag not in VOID and not attrs.endswith("/"):
                    stack.append((tag, node))
                    links += tag == "a"
            if not inline:
                block += 1
        if at < len(source):
            self._text(source[at:], stack[-1][1], block, links)

    def _text(self, raw: str, node: int, block: int, links: int, decode: bool = True) -> None:
        text = html.unescape(raw) if decode and "&" in raw else raw
        self.pieces.append((node, block, text))
        n = len(text)
        self.chars[node] += n
        self.stops[node] += text.count(".") + text.count(",")
        if links:
            self.linked[node] += n


# --- the model -----------------------------------------------------------------------------------------------

#: Words of a class, id or role that often tell what a block is, by kind.
KINDS = {
    "menu": "nav navbar navigation menu submenu breadcrumb breadcrumbs toc tabs pagination pager",
    "head": "header masthead topbar banner logo brand hero",
    "foot": "footer foot copyright colophon legal imprint",
    "side": "sidebar aside side widget rail related recommended recommendations trending popular tags tagcloud more complementary",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion commercial",
    "notice": "cookie cookies notice consent gdpr alert popup modal overlay toast announcement disclaimer",
    "form": "form search searchbox newsletter subscribe subscription login signup register contact",
    "comment": "comment comments commentlist reply replies respond discussion disqus reader feedback",
    "share": "share sharing social follow print toolbar",
    "main": "article main content post entry story body text maincontent articlebody",
}
_KIND = {word: kind for kind, words in KINDS.items() for word in words.split()}
TAGS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "h", "li", "ul", "table", "td", "pre", "figure", "body", "inline", "other")
FEATURES = [f"tag:{t}" for t in TAGS] + [f"kind:{k}" for k in KINDS] + ["linked", "short", "long", "stops", "one"]
_INDEX = {name: i for i, name in enumerate(FEATURES)}


@lru_cache(maxsize=4096)
def _fixed(tag: str, names: frozenset) -> tuple[int, ...]:
    if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
        tag = "h"
    tag = {"ol": "ul", "tr": "table", "tbody": "table", "th": "td", "blockquote": "p", "dd": "li", "dt": "li", "html": "body"}.get(tag, "inline" if tag in INLINE else tag)
    kinds = {_KIND[w] for w in names if w in _KIND}
    if kinds - {"main"}:
        kinds -= {"main"}
    return (_INDEX[f"tag:{tag if tag in TAGS else 'other'}"], *sorted(_INDEX[f"kind:{k}"] for k in kinds), _INDEX["one"])


def features(page: Page, node: int) -> list[int]:
    """The features that hold for a node."""
    out = list(_fixed(page.tags[node], page.names[node]))
    n = page.chars[node]
    if n:
        if 2 * page.linked[node] > n:
            out.append(_INDEX["linked"])
        out.append(_INDEX["short"] if n < 40 else _INDEX["long"])
        if page.stops[node]:
            out.append(_INDEX["stops"])
    return out


class Forest:
    """The nodes of several pages, by their depth, and the features that hold for each."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.tags) for p in pages]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        self.parents = np.concatenate([np.array(p.parents) + s for p, s in zip(pages, self.starts, strict=False)])
        depth = np.concatenate([p.depths for p in pages])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        held = [features(p, i) for p in pages for i in range(len(p.tags))]
        self.rows, self.columns = np.repeat(np.arange(len(held)), [len(h) for h in held]), np.array([f for h in held for f in h], dtype=int)

    def own(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=weight[self.columns], minlength=self.starts[-1])


def marginals(forest: Forest, own: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each node and the expected number of each pair of states of parent and child.

    ``own`` is the log-potential of content (that of the other state is 0), ``tie`` those of pairs [parent][child].
    Messages go up from the deepest nodes, then down again, a depth at a time for all pages.
    """
    up = np.stack([np.zeros(len(own)), own])
    to = np.zeros_like(up)
    for level in reversed(forest.levels[1:]):
        for state in (0, 1):
            to[state, level] = np.logaddexp(up[0, level] + tie[state, 0], up[1, level] + tie[state, 1])
            np.add.at(up[state], forest.parents[level], to[state, level])
    out = up.copy()
    pairs = np.zeros((2, 2))
    for level in forest.levels[1:]:
        rest = out[:, forest.parents[level]] - to[:, level]
        for state in (0, 1):
            out[state, level] = up[state, level] + np.logaddexp(rest[0] + tie[0, state], rest[1] + tie[1, state])
        total = np.logaddexp(out[0, level], out[1, level])
        pairs += [[np.exp(rest[a] + tie[a, b] + up[b, level] - total).sum() for b in (0, 1)] for a in (0, 1)]
    return 1 / (1 + np.exp(np.minimum(700.0, out[0] - out[1]))), pairs


def train(pages: list[str], rounds: int = 100, rate: float = 0.5, decay: float = 0.0001) -> tuple[np.ndarray, np.ndarray]:
    """Weights of FEATURES and ties, from pages whose elements carry data-main="1" or "0" (inherited)."""
    read = [Page(p) for p in pages]
    forest = Forest(read)
    labels, total = np.concatenate([p.labels for p in read]), forest.starts[-1]
    below = np.concatenate(forest.levels[1:])
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[forest.parents[below]], labels[below]), 1)
    weight, tie = np.zeros(len(FEATURES)), np.zeros((2, 2))
    speed_w, speed_t = np.full(len(FEATURES), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        share, pairs = marginals(forest, forest.own(weight), tie)
        grad = np.bincount(forest.columns, weights=(labels - share)[forest.rows], minlength=len(FEATURES)) / total - decay * weight
        grad_tie = (seen - pairs) / total - decay * tie
        speed_w, speed_t = speed_w + grad**2, speed_t + grad_tie**2
        weight, tie = weight + rate * grad / np.sqrt(speed_w), tie + rate * grad_tie / np.sqrt(speed_t)
    return weight, tie


def main_texts(sources: list[str], weight: np.ndarray, tie: np.ndarray) -> list[str]:
    if not sources:
        return []
    pages = [Page(s) for s in sources]
    forest = Forest(pages)
    share, _ = marginals(forest, forest.own(weight), tie)
    out = []
    for page, start in zip(pages, forest.starts, strict=False):
        blocks: dict[int, list[str]] = {}
        for node, block, text in page.pieces:
            if share[start + node] >= 0.5 and not page.hidden[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        out.append("\n".join(line for line in lines if line))
    return out


# --- labelled pages ------------------------------------------------------------------------------------------


MAINS = (
    '<article data-main="1">{}</article>', '<article class="post" data-main="1">{}</article>', '<main data-main="1"><article>{}</article></main>', '<div class="content" data-main="1">{}</div>',
    '<div id="main-content"><div class="post entry" data-main="1">{}</div></div>', '<section class="article-body" data-main="1">{}</section>', '<div class="wrap"><div class="story" data-main="1">{}</div></div>',
    '<div role="main" data-main="1">{}</div>', '<main id="content" data-main="1"><section>{}</section></main>', '<table><tr><td class="content" data-main="1">{}</td></tr></table>',
    '<div class="page"><section class="entry" data-main="1"><div>{}</div></section></div>', '<div id="article" data-main="1"><div class="text">{}</div></div>',
)


def labelled_pages(layouts: Sequence[int] = range(len(MAINS))) -> list[str]:
    """Pages of some layouts of MAINS with the content marked, each with long, short, odd and link-laden text."""
    fills = [
        ("A longer line of prose, with commas and stops. It goes on for a while, as text does.", "Short note"),
        ("WORDS!! IN!! CAPITALS!! THAT!! GO!! ON!! AND!! ON!! WITHOUT!! A!! STOP!!", "One word"),
        ("name | price | size | colour | weight | name | price | size | colour", "x"),
        ("no stops at all in a line that goes on and on like a list of words would", "2024"),
    ]
    links = '<ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul>'
    body = lambda long, short: f"<h1>{short}</h1><p>{long}</p><p><b>{short}<br><p>{long}</p><ul><li>{short}</li><li>{long}</li></ul><p>{long} <a href='/x'>{short}</a></p><blockquote>{long}</blockquote><table><tr><td>{short}</td><td>{long}</td></tr></table><h2>{short}</h2><p>{short}</p><pre>{long}</pre>"
    brief = [lambda long, short: f"<h1>{long}</h1><p><b>{long}<br><p>{long}</p>", lambda long, short: f"<h1>{short}</h1>", lambda long, short: f"<h2>{short}</h2><p>{short}</p>", lambda long, short: f"<p>{long}</p>"]
    rich = lambda long, short: f"<h2>{short}</h2><dl><dt>{short}</dt><dd>{long}</dd></dl><figure><p>{long}</p><figcaption>{short}</figcaption></figure><section><h3>{short}</h3><p>{long} <math><mi>{short}</mi></math></p><div>{long}</div></section>"
    bodies = [body, *brief, rich, body]
    pages = []
    for i, main in ((i, MAINS[i]) for i in layouts):
        for j, (build, (long, short)) in enumerate((b, f) for b in bodies for f in fills):
            around = [
                f"<nav>{links}</nav>", f'<div class="menu">{links}</div>', f"<header><h1>{short}</h1><p>{long}</p></header>", f'<div id="header"><a href="/">{short}</a></div>',
                f'<div class="ad">{long}</div>', f'<div class="advert-box"><p>{short}</p></div>', f'<div class="cookie-notice"><p>{long}</p></div>', f'<div class="alert notice">{short}</div>',
                f"<aside><h2>{short}</h2><p>{long}</p></aside>", f'<div class="sidebar"><h3>{short}</h3>{links}<p>{long}</p></div>', f"<form><label>{short}</label><p>{long}</p></form>", f'<div class="search"><p>{short}</p></div>', f"<form><select><option>{short}</option><option>{short}</option></select><textarea>{long}</textarea><button>{short}</button></form>",
                f'<section class="comments"><h3>{short}</h3><div class="comment"><p>{long}</p></div></section>', f'<div id="comments"><ul><li><p>{long}</p></li></ul></div>', f"<footer><p>{long}</p>{links}</footer>", f'<div class="footer">{short}</div>', f'<div class="share">{short}</div>', f'<div class="related">{links}</div>',
            ]
            mine = [a for n, a in enumerate(around) if (n * (i + 1) + j) % 5 < 2]
            half = len(mine) // 2
            inner = build(long, short)
            if (i + j) % 4 == 0:
                inner += f'<aside data-main="0"><p>{long}</p></aside><div class="ad" data-main="0">{short}</div><div class="comments" data-main="0"><p>{long}</p></div>'
            pages.append(f"<html><head><title>{short}</title></head><body>{''.join(mine[:half])}{main.format(inner)}{''.join(mine[half:])}</body></html>")
    return pages


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, np.ndarray]:
    """Weights learnt from all labelled pages, once a session."""
    return train(labelled_pages())


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html, ...).

    Scripts, styles, templates, frames, titles, the head and what is hidden are never text; the words of formulas,
    drawings and other elements are, where they stand in the article. Character references are decoded; white space
    within a block becomes one space; blocks are joined by a line feed. Null or empty html has the text "". Broken
    markup is read as far as it goes: tags left open end with what encloses them, a quote that is never closed ends with
    its tag, one that is closed further on takes in what stands between, and a tag in which the page stops is no text.
    Rows are independent of each other, so repeated rows give equal results; other columns are ignored; a table without
    rows gives none. The model is trained once a session on ``labelled_pages``.
    """
    weight, tie = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES):
                part = batch.slice(start, PAGES)
                texts = main_texts([x.as_py() or "" for x in part.column(2)], weight, tie)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    plain = pages.select(F.col("page_id").cast("long"), "url", "html")
    return plain.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
