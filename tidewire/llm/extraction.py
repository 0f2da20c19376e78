"""Main-text extraction by a tree-structured graphical model over the DOM.

A page is parsed into its block-level elements. Each is a variable, content or not, with a potential from its own
features and one with its parent: how well a child of this kind goes with a parent that is content, or not. On a tree,
sum-product message passing is exact: one sweep from the leaves up and one from the root down give every node's
marginal. The sweeps run level by level over all pages of a batch at once. Text runs of elements whose marginal is at
least one half are the blocks.

Both kinds of potentials are trained together from labelled pages: gradient ascent on the likelihood of the labels,
whose gradient is the labels' counts less those that message passing expects. The labelled pages are made by
``labelled_pages``: layouts of articles among menus, adverts, notices, forms, comments and so on, with a label for each
element; no input of a query goes into the training. An article's own header, with its title and byline, and the captions
of its figures are part of the article. Names count by their whole, or by their first or last part, unless a part such
as ``no`` or ``tags`` makes them speak of something else; how much, the training says.

Nulls and edge cases: a null or empty html gives an empty text; a null page_id or url is kept; a page cut off anywhere
is read up to there; unknown or unclosed tags are fine; a tag with an unclosed quote ends at the next ``>``; a page of
any kind takes time in proportion to its length; an unclosed svg or template ends with the element that it is in;
repeated rows are extracted each; text of any length and nesting of any depth is kept whole; the text of formulas and
the fallback of an object are text, a noscript element's, which readers don't see, isn't; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import importable, read_table
from .textkernel import batches_by_bytes

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?]|/)")
#: The rest of a sound tag: a quoted value ends at its quote, which white space, a slash or the tag's end follows.
_REST = re.compile(r"""(?:[^=>]++|=\s*+(?:"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>])|[^\s"'>][^\s>]*+|(?=>)))*+>""")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements whose content is never text of the page.
_SKIP = frozenset("script style noscript template svg annotation annotation-xml iframe select textarea button title head audio video canvas map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin a block of their own.
_BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: What a start tag of the first closes if it is open within the nearest of the last.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}

KINDS = ["root", "article", "section", "div", "paragraph", "heading", "list", "item", "table", "cell", "figure", "quote", "nav", "header", "footer", "aside", "form"]
_KIND = {
    "html": "root", "body": "root", "article": "article", "main": "article", "section": "section", "div": "div", "center": "div", "details": "div", "p": "paragraph", "pre": "paragraph", "summary": "paragraph", "address": "footer", **{f"h{i}": "heading" for i in range(1, 7)}, "hgroup": "heading",
    "ul": "list", "ol": "list", "dl": "list", "dir": "list", "li": "item", "dt": "item", "dd": "item", "table": "table", "tbody": "table", "thead": "table", "tfoot": "table", "caption": "figure", "tr": "cell", "td": "cell", "th": "cell", "figure": "figure", "figcaption": "figure",
    "blockquote": "quote", "nav": "nav", "menu": "nav", "search": "form", "header": "header", "footer": "footer", "aside": "aside", "dialog": "aside", "form": "form", "fieldset": "form",
}
#: Names of boilerplate, as they stand in classes, ids and roles; a hyphen within them doesn't count.
_BAD = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice gdpr alert popup modal overlay footer header masthead topbar toolbar login signin signup register newsletter subscribe subscription search share sharing social related recommended recommendations morestories tags taglist tagcloud pagination pager comment comments commentlist replies reply respond discussion disqus copyright legal disclaimer skiplink contentinfo complementary form toc".split()
)
_GOOD = frozenset("article content post entry story main body text articlebody prose markdown".split())
#: Parts that make a name speak of something else than the element's own role, as in no-sidebar or tags-news.
_MODIFIERS = frozenset("no not non has with without is layout template theme category cat tag tags topic status format style".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_STOP = re.compile(r"[.!?;:,](?:\s|$)")
_LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved|cookie|privacy|subscribe|sign in|log in|advertis|sponsored", re.I)

#: A pair's kind: the child's kind, with a parent that is an article, one that looks like boilerplate, or another.
PAIRS = 3 * len(KINDS)
_SIDE = frozenset(KINDS.index(k) for k in ("nav", "header", "footer", "aside", "form"))

FEATURES = ["bias", *KINDS, "bad_name", "bad_part", "good_name", "has_text", "log_chars", "link_share", "stops", "legal", "short"]


def _roles(attributes: str) -> tuple[bool, bool, bool]:
    """Of a tag's names: whether one is a name of boilerplate, begins or ends with such a part, has a part of content."""
    bad = part = good = False
    for groups in _ATTRIBUTE.findall(attributes):
        for name in _CAMEL.sub("-", "".join(groups)).lower().replace("_", "-").split():
            parts = name.split("-")
            good = good or not _GOOD.isdisjoint(parts)
            if name.replace("-", "") in _BAD:
                bad = True
            elif _MODIFIERS.isdisjoint(parts):
                part = part or parts[0] in _BAD or parts[-1] in _BAD
    return bad, part, good


def _next_tag(page: str, at: int) -> tuple[int, int, bool, str, str] | None:
    """The next tag's start and end, whether it closes, its name (empty for comments and declarations) and its attributes.

    A broken tag, one with a quote that isn't closed in it, ends at the next ``>``. Every step is linear: a quote is
    searched up to the next one of its kind, where the next broken tag begins at the earliest.
    """
    m = _TAG.search(page, at)
    if m is None:
        return None
    if m[2]:
        rest = _REST.match(page, m.end())
        end = rest.end() if rest else page.find(">", m.end()) + 1
        return (m.start(), end, bool(m[1]), m[2].lower(), page[m.end() : end - 1]) if end else None
    if m[0] == "<!--":
        end = page.find("-->", m.end())
        return m.start(), len(page) if end < 0 else end + 3, False, "", ""
    end = page.find(">", m.end()) + 1
    return (m.start(), end, False, "", "") if end else None


@dataclass
class Page:
    """Block-level elements of a page in order: parent, pair (which potential joins it to its parent), features; and the
    text runs with their elements."""

    parent: list[int]
    pair: list[int]
    rows: list[list[float]]
    runs: list[tuple[int, str]]


def _unclosed(page: str, at: int, name: str) -> int:
    """Where an svg or a template that is never closed ends: at the end of the element that it is in; an svg at any block, too."""
    inside: list[str] = []
    while (found := _next_tag(page, at)) is not None:
        start, at, closes, tag, _ = found
        if tag not in _BLOCKS:
            continue
        if name == "svg" or closes and tag not in inside:
            return start
        if closes:
            while inside.pop() != tag:
                pass
        else:
            inside.append(tag)
    return len(page)


def parse(page: str) -> Page:
    parent, kind, tags, names = [-1], [0], ["html"], [(False, False, False)]
    runs: list[tuple[int, str]] = []
    linked: dict[int, int] = {}
    open_ = [0]
    n_open: Counter[str] = Counter()
    unended: set[str] = set()  # elements without an end tag in the rest of the page
    pieces: list[str] = []
    link_chars, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal pieces, link_chars
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                runs.append((open_[-1], text))
                linked[open_[-1]] = linked.get(open_[-1], 0) + link_chars
            pieces = []
        link_chars = 0

    def close(i: int) -> None:
        n_open.subtract(tags[x] for x in open_[i:])
        del open_[i:]

    while True:
        found = _next_tag(page, at)
        if found is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!]", rest)  # a tag that never ends
            pieces.append(rest[: cut.start()] if cut else rest)
            break
        start, end, closes, name, attributes = found
        if start > at:
            pieces.append(page[at:start])
            if in_link:
                link_chars += start - at
        at = end
        if not name:
            continue
        if name in _SKIP:
            if not closes and not attributes.endswith("/"):
                skipped = None
                if name not in unended:
                    # a head may not be closed: it ends at the body, too
                    skipped = re.compile(r"</head\s*>|(?=<body\b)" if name == "head" else rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if skipped:
                    at = skipped.end()
                    continue
                unended.add(name)
                if name in ("template", "svg"):
                    at = _unclosed(page, at, name)
                elif name in ("script", "style", "textarea", "title"):
                    break  # all that follows is in it
            continue
        if name == "a":
            in_link = not closes
            continue
        if name in ("br", "wbr"):
            pieces.append(" " if name == "br" else "")
            continue
        if name not in _BLOCKS:
            continue
        flush()
        in_link = False
        if closes:
            if n_open[name]:
                for i in range(len(open_) - 1, 0, -1):
                    if tags[open_[i]] == name:
                        close(i)
                        break
                    if tags[open_[i]] in ("td", "th", "table") and name not in ("table", "tr", "tbody", "article", "body", "html"):
                        break
            continue
        if name in ("html", "body") or name in _VOID:
            continue
        if tags[open_[-1]] == "p" or (tags[open_[-1]][0] == "h" and tags[open_[-1]][1:].isdigit()):
            close(len(open_) - 1)  # a block ends a paragraph or a heading
        if name in _CLOSES and any(n_open[x] for x in _CLOSES[name][0]):
            ends, within = _CLOSES[name]
            for i in range(len(open_) - 1, 0, -1):
                if tags[open_[i]] in within:
                    break
                if tags[open_[i]] in ends:
                    close(i)
                    break
        names.append(_roles(attributes) if attributes else (False, False, False))
        parent.append(open_[-1])
        tags.append(name)
        kind.append(KINDS.index(_KIND[name]))
        open_.append(len(tags) - 1)
        n_open[name] += 1
    flush()

    own: dict[int, list[str]] = {}
    for node, text in runs:
        own.setdefault(node, []).append(text)
    rows = []
    for i, k in enumerate(kind):
        row = [0.0] * len(FEATURES)
        row[0] = row[1 + k] = 1.0
        base = 1 + len(KINDS)
        row[base : base + 3] = map(float, names[i])
        if i in own:
            text = " ".join(own[i])
            n = len(text)
            row[base + 3 :] = [1.0, np.log1p(n) / 8, min(1.0, linked.get(i, 0) / n), min(1.0, 20 * len(_STOP.findall(text)) / n), float(n < 400 and bool(_LEGAL.search(text))), float(n < 40)]
        rows.append(row)
    group = [2 if names[i][0] or k in _SIDE else 1 if k == KINDS.index("article") else 0 for i, k in enumerate(kind)]
    pair = [k + len(KINDS) * (group[p] if p >= 0 else 0) for k, p in zip(kind, parent)]
    return Page(parent, pair, rows, runs)


@dataclass
class Model:
    """Node weights, and log potentials [kind of the pair, parent's label, child's label]."""

    weights: np.ndarray
    pair: np.ndarray

    def marginals(self, x: np.ndarray, parent: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Of each node of a forest (parents stand before their children) the probability to be content."""
        return self.beliefs(x, parent, pair, _levels(parent))[0]

    def beliefs(self, x: np.ndarray, parent: np.ndarray, pair: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The marginals, and those of each node's parent and itself together (zeros for roots)."""
        n = len(parent)
        belief = np.stack([np.zeros(n), x @ self.weights], axis=1)
        up = np.zeros((n, 2))  # message of a node to its parent
        for at in levels[:0:-1]:
            m = self.pair[pair[at]] + belief[at][:, None, :]
            up[at] = np.logaddexp(m[:, :, 0], m[:, :, 1])
            np.add.at(belief, parent[at], up[at])
        both = np.zeros((n, 2, 2))
        for at in levels[1:]:
            m = self.pair[pair[at]] + (belief[parent[at]] - up[at])[:, :, None]
            both[at] = m + belief[at][:, None, :]
            belief[at] += np.logaddexp(m[:, 0, :], m[:, 1, :])
            belief[at] -= belief[at].max(axis=1, keepdims=True)
        below = np.concatenate(levels[1:]) if len(levels) > 1 else np.zeros(0, np.int64)
        both[below] = np.exp(both[below] - both[below].max(axis=(1, 2), keepdims=True))
        both[below] /= both[below].sum(axis=(1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), both


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth."""
    depth = np.zeros(len(parent), np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))


def _flatten(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(p.parent) for p in pages])]).astype(np.int64)
    parent = np.array([q + s if q >= 0 else -1 for p, s in zip(pages, starts) for q in p.parent], np.int64)
    pair = np.array([k for p in pages for k in p.pair], np.int64)
    x = np.array([r for p in pages for r in p.rows], np.float64).reshape(len(pair), len(FEATURES))
    return x, parent, pair, starts


def train(pages: list[Page], labels: list[list[int]], l2: float = 1e-3, steps: int = 300, rate: float = 0.05) -> Model:
    """Potentials from pages whose elements have labels."""
    x, parent, pair, _ = _flatten(pages)
    y = np.array([v for row in labels for v in row], np.float64)
    levels = _levels(parent)
    child = np.flatnonzero(parent >= 0)
    model = Model(np.zeros(x.shape[1]), np.zeros((PAIRS, 2, 2)))
    counted = np.zeros_like(model.pair)
    np.add.at(counted, (pair[child], y[parent[child]].astype(int), y[child].astype(int)), 1)
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (model.weights, model.pair)]
    for t in range(1, steps + 1):
        p, both = model.beliefs(x, parent, pair, levels)
        expected = np.zeros_like(model.pair)
        np.add.at(expected, pair[child], both[child])
        gradients = x.T @ (y - p) / len(pages) - l2 * model.weights, (counted - expected) / len(pages) - l2 * model.pair
        for value, g, (m, v) in zip((model.weights, model.pair), gradients, moments):  # Adam
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def labelled_pages(n: int = 600, seed: int = 5) -> Iterator[tuple[str, list[bool]]]:
    """Made pages and, for each of their text runs in order, whether it is content."""
    rng = random.Random(seed)
    sounds = ["ba", "ko", "ri", "tes", "mun", "al", "ve", "do", "sin", "pra", "lo", "chi", "ter", "an"]

    def some(lo: int, hi: int) -> str:
        return " ".join("".join(rng.choices(sounds, k=rng.randint(1, 3))) for _ in range(rng.randint(lo, hi)))

    def sentence() -> str:
        words = some(5, 18).capitalize()
        return words.replace(" ", ", ", rng.randint(0, 2)) + rng.choice("....!?")

    def prose(style: str = "") -> str:
        if style == "repeated":
            return " ".join(w for _ in range(rng.randint(1, 4)) for w in [some(1, 1)] * rng.randint(5, 40))
        if style == "scraps":
            return some(1, 4)
        if style == "unmarked":
            return some(5, 80)
        return " ".join(sentence() for _ in range(rng.randint(1, 7)))

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/x">{some(1, 3)}</a></{tag}>' for _ in range(n))

    for _ in range(n):
        marks: list[bool] = []

        def put(html: str, runs: int, good: bool, marks=marks) -> str:
            marks.extend([good] * runs)
            return html

        k = rng.randint(2, 8)
        style = rng.choice(["", "", "", "", "repeated", "repeated", "unmarked", "scraps"])  # articles needn't be good prose
        body = []
        if rng.random() < 0.3:
            body.append(put(f'<header class="site-header"><h2>{some(1, 3)}</h2></header>', 1, False))
        if rng.random() < 0.2:
            body.append(put(rng.choice(["<header><h1>{}</h1><p>{}</p></header>", '<div id="header"><h1>{}</h1><p>{}</p></div>', '<div class="banner"><div>{}</div><p>{}</p></div>']).format(some(1, 3), sentence()), 2, False))
        if rng.random() < 0.15:
            body.append(put(f'<ol class="breadcrumb">{links(3)}</ol>', 3, False))
        if rng.random() < 0.8:
            body.append(put(rng.choice(["<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="nav">{}</ul>']).format(links(k)), k, False))
        if rng.random() < 0.3:
            body.append(put(f'<div class="{rng.choice(["cookie-notice", "notice", "consent-banner", "alert"])}"><p>{prose()}</p></div>', 1, False))
        if rng.random() < 0.5:
            body.append(put(f'<div class="{rng.choice(["ad", "advert", "ads", "promo", "sponsored"])}">{prose()}</div>', 1, False))
        open_, close = rng.choice([("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main"><article class="post">', "</article></div>"), ('<div class="entry-content">', "</div>"), ("<section>", "</section>")])
        if rng.random() < 0.2:  # names that speak of boilerplate elsewhere
            name = rng.choice(["layout-no-sidebar", "content-with-sidebar", "post tags-news", "has-header", "theme-menu", "sidebar-right", "header-fixed", "single-widget"])
            open_, close = rng.choice([(f'<article class="{name}">', "</article>"), (f'<div class="{name}"><article>', "</article></div>"), (f'<div class="{name}">', "</div>")])
        if rng.random() < 0.3:
            m = rng.randint(1, 3)
            open_, close = "<div>" * m + open_, close + "</div>" * m
        body.append(open_)
        title = f"<h1>{some(2, 12)}</h1>"
        if rng.random() < 0.2:  # an article's own header is part of it
            body.append(put(rng.choice(["<header>{}<p>{}</p></header>", "<header>{}<div>{}</div></header>"]).format(title, some(2, 8)), 2, True))
        else:
            body.append(put("<header>" + title + "</header>" if rng.random() < 0.1 else title, 1, True))
        for _ in range(rng.randint(1, rng.choice([6, 14, 40]))):
            r = rng.random()
            if r < 0.7:
                body.append(put(f"<p>{prose(style)}" + rng.choice(["</p>", "</p>", ""]), 1, True))
            elif r < 0.76:
                body.append(put(f"<h2>{some(1, 6)}</h2>", 1, True))
            elif r < 0.82:
                m = rng.randint(2, 5)
                body.append(put("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(m)) + "</ul>", m, True))
            elif r < 0.86:
                body.append(put(f"<blockquote>{prose()}</blockquote>", 1, True))
            elif r < 0.9:
                body.append(put(f'<p><a href="/y">{some(2, 4)}</a> {prose()}</p>', 1, True))
            elif r < 0.93:
                body.append(put(f'<div class="ad">{sentence()}</div>', 1, False))
            elif r < 0.94:
                body.append(put(rng.choice(['<div class="notice"><p>{}</p></div>', "<form><p>{}</p><input></form>", '<div class="newsletter">{}</div>', "<aside>{}</aside>"]).format(prose()), 1, False))
            elif r < 0.95:
                body.append(put(f"<div>{prose(style)}</div>", 1, True))
            elif r < 0.96:
                body.append(put(f'<aside class="related"><p>{prose()}</p></aside>', 1, False))
            elif r < 0.97:
                body.append(put(f"<p>{some(1, 2)}.</p>", 1, True))
            elif r < 0.98:
                body.append(put(f'<figure><img src="x"><figcaption>{sentence()}</figcaption></figure>', 1, True))
            elif r < 0.99:
                body.append(put(f"<section><h2>{some(1, 6)}</h2><p>{prose(style)}</p></section>", 2, True))
            else:
                body.append(put(f"<table><tr><td>{some(1, 3)}</td><td>{some(1, 3)}</td></tr></table>", 2, True))
        if rng.random() < 0.15:
            body.append(put(f"<footer><p>{sentence()}</p></footer>", 1, False))
        if rng.random() < 0.15:
            m = rng.randint(1, 4)
            body.append(put(f'<section class="comments"><h3>{some(1, 2)}</h3>' + "".join(f'<article class="comment"><p>{prose()}</p></article>' for _ in range(m)) + "</section>", m + 1, False))
        if rng.random() < 0.25:
            body.append(put(f'<div class="share">{links(3, "span")}</div>', 1, False))
        body.append(close)
        if rng.random() < 0.4:
            m = rng.randint(1, 4)
            body.append(put(rng.choice(['<div class="comments">{}</div>', '<section id="comments">{}</section>']).format("".join(f'<div class="comment"><p>{prose()}</p></div>' for _ in range(m))), m, False))
        if rng.random() < 0.4:
            body.append(put(rng.choice(["<aside><ul>{}</ul></aside>", '<div class="sidebar"><ul>{}</ul></div>']).format(links(k)), k, False))
        if rng.random() < 0.2:
            body.append(put(f"<aside><p>{prose()}</p></aside>", 1, False))
        if rng.random() < 0.25:
            body.append(put(rng.choice(['<div class="sidebar"><h3>{}</h3><p>{}</p></div>', '<aside id="side"><h3>{}</h3><p>{}</p></aside>', '<div role="complementary"><h4>{}</h4><div>{}</div></div>', '<div class="widget"><h3>{}</h3><p>{}</p></div>']).format(some(1, 3), prose()), 2, False))
        if rng.random() < 0.3:
            body.append(put(f"<form><p>{sentence()}</p><label>{some(1, 2)}</label><input></form>", 2, False))
        if rng.random() < 0.8:
            body.append(put(rng.choice(["<footer>&copy; {}</footer>", "<footer><p>{}</p></footer>", '<div class="footer">Copyright {}</div>']).format(sentence()), 1, False))
        yield f"<html><head><title>{some(2, 5)}</title></head><body>{''.join(body)}</body></html>", marks


def label_elements(page: Page, marks: list[bool]) -> list[int]:
    """An element is content if most of the text in it is; one without text takes its parent's label."""
    good, total = [0] * len(page.parent), [0] * len(page.parent)
    for (node, text), mark in zip(page.runs, marks, strict=True):
        while node >= 0:
            good[node] += len(text) * mark
            total[node] += len(text)
            node = page.parent[node]
    out: list[int] = []
    for i, p in enumerate(page.parent):
        out.append(int(2 * good[i] > total[i]) if total[i] else out[p] if p >= 0 else 0)
    return out


@lru_cache(maxsize=1)
def default_model() -> Model:
    pages, labels = [], []
    for html, marks in labelled_pages():
        pages.append(parse(html))
        labels.append(label_elements(pages[-1], marks))
    return train(pages, labels)


def extract(htmls: list[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    out: list[str] = []
    for lo in range(0, len(htmls), 500):
        pages = [parse(h or "") for h in htmls[lo : lo + 500]]
        x, parent, pair, starts = _flatten(pages)
        content = model.marginals(x, parent, pair) >= 0.5
        out += ["\n".join(text for node, text in p.runs if content[s + node]) for p, s in zip(pages, starts)]
    return out


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of pages."""
    importable(pages.sparkSession)
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "html", 8 << 20):
            texts = extract(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))
