"""Main text of web pages: boosted trees over the nodes of a page's tree, decoded as a hierarchy.

Every element and run of text is a node. Trees score whether it belongs to the article or leads to
it, from its tag and attribute tokens, its parent's, its depth, its siblings and the density of its
subtree. The decision for a page is the best one in which nothing inside a dropped node is kept:
a node that is kept may drop children, one that is dropped drops all below.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.llm import boosting
from regispark.llm.frames import ship, small_batches

#: Pages that the trees are fitted on, at most (a classifier's sample), and pages made from each.
SAMPLE = 150
MADE = 4
#: Bytes of the largest page that may be in the sample.
SAMPLE_BYTES = 256 * 1024
#: Tag and attribute tokens that are features.
TOKENS = 96

# The element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNREAD = frozenset("head script style template title noscript svg iframe object canvas math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td textarea tfoot th thead tr ul".split()
)
#: What an opening tag closes, up to the given boundaries.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
}
KEEPS_P = frozenset("button object".split())
WORD = re.compile(r"[a-z0-9]+")


class Page:
    """Nodes of a page in document order; a parent stands before its children. Text nodes have
    tag ``#text``. Node 0 is the page."""

    def __init__(self, html: str):
        self.tag, self.parent, self.text, self.tokens = ["#page"], [-1], [""], [()]
        parser = _Builder(self)
        parser.feed(html)
        parser.close()

    def add(self, tag: str, parent: int, text: str = "", tokens: tuple[str, ...] = ()) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.text.append(text)
        self.tokens.append(tokens)
        return len(self.tag) - 1

    def joined(self, kept: Sequence[bool]) -> str:
        """Text of the kept text nodes: blocks in page order, white space in a block as one blank."""
        block, blocks = [-1] * len(self.tag), []
        current: list[str] = []
        last = None
        for k, tag in enumerate(self.tag):
            if k:
                block[k] = k if tag in BLOCK else block[self.parent[k]]
            if tag == "br":
                current.append(" ")
            elif tag in BLOCK:
                last = None
            elif tag == "#text" and kept[k]:
                if block[k] != last:
                    blocks.append("".join(current))
                    current, last = [], block[k]
                current.append(self.text[k])
        blocks.append("".join(current))
        clean = (" ".join(b.split()) for b in blocks)
        return "\n\n".join(b for b in clean if b)


class _Builder(HTMLParser):
    def __init__(self, page: Page):
        super().__init__(convert_charrefs=True)
        self.page, self.open, self.unread = page, [0], 0
        #: Where each tag stands among the open elements, so that none is searched for.
        self.places: dict[str, list[int]] = {}

    def _last(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _close(self, names: Sequence[str], until: Iterable[str]) -> None:
        depth = self._last(names)
        if depth and depth >= self._last(until):
            self._cut(depth)

    def _cut(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.page.tag[self.open.pop()]
            self.places[tag].pop()
            self.unread -= tag in UNREAD

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.places.get("head"):
            self._close(["head"], [])
        if tag in BLOCK:
            self._close(["p"], KEEPS_P | {"table", "li", "td", "th"} - {tag})
        if tag in CLOSES:
            names, until = CLOSES[tag]
            self._close(names.split(), until.split())
        words = [w for name, value in attrs if name in ("class", "id", "role") for w in WORD.findall((value or "").lower())]
        node = self.page.add(tag, self.open[-1], tokens=tuple(words))
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.unread += tag in UNREAD

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash closes void elements only

    def handle_endtag(self, tag):
        depth = self._last([tag])
        if depth:
            self._cut(depth)

    def handle_data(self, data):
        if not self.unread and self.open:
            self.page.add("#text", self.open[-1], text=data)


SHAPE = 17
#: Nodes whose features are laid out in full at once.
ROWS = 8192


class Features:
    """A page's features: the shape of each node's subtree and its places as numbers, known tokens of itself
    and of what it lies in as bits."""

    def __init__(self, page: Page, known: dict[str, int]):
        self.known = len(known)
        self.shape = _shape(page)
        n = len(page.tag)
        size = (len(known) + 7) // 8
        own = [0] * n
        for k in range(n):
            for token in ("tag:" + page.tag[k], *page.tokens[k]):
                at = known.get(token)
                if at is not None:
                    own[k] |= 1 << at
        # What any ancestor holds reaches a node through its parent: a menu's link text has the menu's tokens.
        above = [0] * n
        for k in range(1, n):
            up = page.parent[k]
            above[k] = own[up] | above[up]
        self.bits = [
            np.frombuffer(b"".join(x.to_bytes(size, "little") for x in held), np.uint8).reshape(n, size) for held in (own, above)
        ]

    def __len__(self) -> int:
        return len(self.shape)

    def rows(self, low: int = 0, high: int | None = None) -> np.ndarray:
        held = [
            np.unpackbits(b[low:high], axis=1, count=self.known, bitorder="little") if self.known else b[low:high, :0]
            for b in self.bits
        ]
        return np.column_stack([self.shape[low:high], *held])


def _shape(page: Page) -> np.ndarray:
    n = len(page.tag)
    parent = np.array(page.parent)
    above = np.maximum(parent, 0)
    text = np.array([len(t.strip()) for t in page.text], float)
    words = np.array([len(t.split()) for t in page.text], float)
    marks = np.array([sum(t.count(c) for c in ".,;:!?") for t in page.text], float)
    is_text = np.array([t == "#text" for t in page.tag])
    number = {t: k for k, t in enumerate(set(page.tag))}
    kind = np.array([number[t] for t in page.tag])
    link, paragraph = (kind == number.get("a", -1)).tolist(), (kind == number.get("p", -1)).tolist()
    ups, texts = page.parent, is_text.tolist()
    total, in_links, spoken, marked = text.tolist(), [0.0] * n, words.tolist(), marks.tolist()
    below, paragraphs, children = [0.0] * n, [0.0] * n, [0.0] * n
    for k in range(n - 1, 0, -1):
        up = ups[k]
        if link[k]:
            in_links[k] = total[k]
        total[up] += total[k]
        in_links[up] += in_links[k]
        spoken[up] += spoken[k]
        marked[up] += marked[k]
        below[up] += below[k] + (not texts[k])
        paragraphs[up] += paragraphs[k] + paragraph[k]
        children[up] += 1
    depth, place, seen, linked = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for k in range(1, n):
        up = ups[k]
        depth[k] = depth[up] + 1
        place[k] = seen[up]
        seen[up] += 1
        linked[k] = float(linked[up] or link[k])
    total, in_links, spoken, marked, below, paragraphs, children, depth, place = (
        np.array(x) for x in (total, in_links, spoken, marked, below, paragraphs, children, depth, place)
    )
    before = np.r_[0.0, 0.0, np.cumsum(text[1:])[:-1]] if n > 1 else np.zeros(n)
    # Siblings of the same kind.
    _, which, alike = np.unique((parent + 1) * len(number) + kind, return_inverse=True, return_counts=True)
    same = alike[which].astype(float)
    same[0] = 0
    whole = max(total[0], 1.0)
    return np.column_stack([
        depth, np.minimum(children, 50), place / np.maximum(children[above], 1), np.minimum(same, 50),
        np.log1p(total), total / whole, in_links / np.maximum(total, 1), np.log1p(below),
        total / (below + 1), np.minimum(paragraphs, 50), spoken / np.maximum(total, 1), marked / np.maximum(spoken, 1),
        before / whole, np.log1p(total[above]), in_links[above] / np.maximum(total[above], 1), linked, is_text,
    ])


def decoded(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The kept nodes of the best decision in which no kept node has a dropped ancestor."""
    n = len(page.tag)
    weight = np.log2(2 + np.array([len(t.strip()) for t in page.text], float))
    yes, no = -np.logaddexp(0, -log_odds) * weight, -np.logaddexp(0, log_odds) * weight
    keep, drop = yes.tolist(), no.tolist()
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        keep[up] += max(keep[k], drop[k])
        drop[up] += drop[k]
    kept = [True] * n
    for k in range(1, n):
        kept[k] = kept[page.parent[k]] and keep[k] > drop[k]
    return kept


class Extractor:
    """Fitted trees and the tokens they know."""

    def __init__(self, known: dict[str, int], trees: boosting.BoostedTrees):
        self.known, self.trees = known, trees

    def texts(self, htmls: Iterable[str]) -> list[str]:
        """Texts of pages; those of few nodes are scored together, large ones in slices."""
        out: list[str] = []
        lot: list[tuple[Page, Features]] = []
        for html in htmls:
            page = Page(html)
            lot.append((page, Features(page, self.known)))
            if sum(len(f) for _, f in lot) >= ROWS:
                out += self._lot(lot)
                lot = []
        return out + self._lot(lot)

    def _lot(self, lot: list[tuple[Page, Features]]) -> list[str]:
        if not lot:
            return []
        if len(lot) == 1:
            ((_, found),) = lot
            odds = [np.concatenate([self.trees.log_odds(found.rows(k, k + ROWS)) for k in range(0, len(found), ROWS)])]
        elif len(lot[-1][1]) >= ROWS:
            return self._lot(lot[:-1]) + self._lot(lot[-1:])
        else:
            ends = np.cumsum([len(f) for _, f in lot])[:-1]
            odds = np.split(self.trees.log_odds(np.concatenate([f.rows() for _, f in lot])), ends)
        return [page.joined(decoded(page, o)) for (page, _), o in zip(lot, odds)]


# Wrappers that sites put round their articles, and round everything else.
ARTICLE = [
    "<article>", "<main>", '<div class="post-content">', '<div id="content">', '<section class="entry">',
    '<div class="story-body">', '<div class="article-text">', '<div class="main">', '<div role="main">', '<div>',
    '<article class="post">', '<div class="post">', '<div class="blog-post">', '<div class="page"><div class="content">', '<main id="main"><article>', '<section>',
]
MENU = ["<nav>", '<div class="menu">', '<ul class="nav">', '<div role="navigation">', '<div class="breadcrumbs">',
        '<div id="navbar">', '<div class="related-links">', '<div class="tags">', '<div class="share social">',
        '<div class="pagination">', '<aside class="related">', '<div id="nav">', '<div class="toc">']
ASIDE = ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<aside class="promo">',
         '<div class="newsletter">', '<div class="author-bio">', '<section class="related">', '<div class="trending">']
NOTICE = ['<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="alert">', '<div class="notice">',
          '<div class="gdpr consent">', '<div role="alert">', '<div class="paywall">', '<dialog>', '<div class="popup modal">']
ADVERT = ['<div class="ad">', '<div class="advert">', '<div class="sponsored">', '<div id="ads">', '<ins class="adsbygoogle">',
          '<div class="banner">', '<aside class="advertisement">', '<div class="ad-slot">']
COMMENTS = ['<section id="comments">', '<div class="comments">', '<ol class="comment-list">', '<div id="disqus">',
            '<section class="replies">', '<div class="responses">', '<div class="reader-comments">']
TOP = ["<header>", '<div class="header">', '<div id="masthead">', '<header class="site-header">', '<div class="topbar">',
       '<div role="banner">']
BOTTOM = ["<footer>", '<div class="footer">', '<div id="footer">', '<footer class="site-footer">', '<div class="copyright">',
          '<div role="contentinfo">']


def _wrapped(opening: str, inner: str) -> str:
    names = re.findall(r"<(\w+)", opening)
    return opening + inner + "".join(f"</{n}>" for n in reversed(names))


def _boilerplate(draw: random.Random, phrase) -> str:
    kind = draw.choice("menu menu aside notice advert comments top bottom form".split())
    if kind == "menu":
        items = [f'<a href="/{k}">{phrase(1, 3)}</a>' for k in range(draw.randint(2, 8))]
        inner = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if draw.random() < 0.6 else " | ".join(items)
        return _wrapped(draw.choice(MENU), inner)
    if kind == "form":
        fields = "".join(f"<label>{phrase(1, 3)}</label><input name=f{k}>" for k in range(draw.randint(1, 3)))
        options = "".join(f"<option>{phrase(1, 2)}</option>" for _ in range(draw.randint(0, 3)))
        return f"<form action=/go>{fields}<select>{options}</select><p>{phrase(3, 12)}</p><button>{phrase(1, 2)}</button></form>"
    if kind == "comments":
        item = draw.choice(['<div class="comment">', "<li>", '<article class="comment">', "<div>", '<div class="reply">'])
        notes = "".join(
            _wrapped(item, f"<b>{phrase(1, 2)}</b><p>{phrase(5, 40)}</p>") for _ in range(draw.randint(1, 4))
        )
        return _wrapped(draw.choice(COMMENTS), f"<h3>{phrase(1, 3)}</h3>{notes}" if draw.random() < 0.7 else notes)
    wrappers = {"aside": ASIDE, "notice": NOTICE, "advert": ADVERT, "top": TOP, "bottom": BOTTOM}[kind]
    inner = phrase(3, 30)
    shape = draw.random()
    if shape < 0.4:
        inner = "".join(f"<p>{phrase(4, 30)}</p>" for _ in range(draw.randint(1, 3)))
    elif shape < 0.6:
        inner = f"<h3>{phrase(1, 4)}</h3><p>{inner}</p><a href=/x>{phrase(1, 3)}</a>"
    return _wrapped(draw.choice(wrappers), inner)


def _article(draw: random.Random, phrase) -> str:
    blocks = [f"<h1>{phrase(2, 9)}</h1>"] if draw.random() < 0.8 else []
    for _ in range(draw.randint(1, 8)):
        inner = phrase(3, 80)
        shape = draw.random()
        if shape < 0.1:
            blocks.append("<ul>" + "".join(f"<li>{phrase(2, 15)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
        elif shape < 0.2:
            blocks.append(f"<h2>{phrase(1, 6)}</h2>")
        elif shape < 0.28:
            blocks.append(f"<blockquote><p>{inner}</p></blockquote>")
        elif shape < 0.34:
            cells = "".join(f"<td>{phrase(1, 4)}</td>" for _ in range(3))
            blocks.append(f"<table><tr>{cells}</tr><tr>{cells}</tr></table>")
        elif shape < 0.5:
            blocks.append(f"<p>{phrase(1, 20)} <a href=/y>{phrase(1, 4)}</a> <em>{phrase(1, 3)}</em> {inner}")
        elif shape < 0.6:
            blocks.append(f"<p><b>{phrase(1, 9)}<br></b>{inner}</p>")
        else:
            blocks.append(f"<p>{inner}</p>")
    return "\x01".join(blocks)


def made_page(draw: random.Random, words: Sequence[str]) -> str:
    """A page of a page's own words whose article is marked by ``data-kept``."""

    def phrase(low: int, high: int) -> str:
        start = draw.randrange(max(1, len(words)))
        return " ".join(words[start : start + draw.randint(low, high)]) or "text"

    blocks = _article(draw, phrase).split("\x01")
    for _ in range(draw.choice((0, 0, 1, 2))):
        blocks.insert(draw.randrange(1, len(blocks) + 1), _boilerplate(draw, phrase))
    wrapper = draw.choice(ARTICLE) if draw.random() < 0.8 else f'<div class="{"".join(draw.choices("abcdefgh", k=5))}">'
    article = _wrapped(wrapper, "\x02" + "".join(blocks))
    before = "".join(_boilerplate(draw, phrase) for _ in range(draw.randint(0, 4)))
    after = "".join(_boilerplate(draw, phrase) for _ in range(draw.randint(0, 4)))
    outer = draw.choice(["", "", '<div id="wrapper">', '<div class="container"><div class="row">'])
    return "<html><body>" + _wrapped(outer, before + article + after) + "</body></html>" if outer else (
        f"<html><body>{before}{article}{after}</body></html>"
    )


def labels(page: Page, marked: bool) -> np.ndarray | None:
    """1 for the nodes of the article and those it lies in. In a made page the article starts at a
    mark and holds no other wrapper of known use; in a given page it is the ``article`` or ``main``
    element. None if there is none."""
    n = len(page.tag)
    root = -1
    for k in range(n):
        if marked and "\x02" in page.text[k]:
            page.text[k] = page.text[k].replace("\x02", "")
            root = page.parent[k]
            break
        if not marked and page.tag[k] in ("article", "main"):
            root = k
            break
    if root < 0:
        return None
    inside = np.zeros(n, bool)
    inside[root] = True
    openings = {o for group in (MENU, ASIDE, NOTICE, ADVERT, COMMENTS, TOP, BOTTOM) for o in group}
    heads = {_signature(o) for o in openings} | {("form", ())}
    for k in range(root + 1, n):
        up = page.parent[k]
        inside[k] = up >= 0 and inside[up] and (page.tag[k], page.tokens[k]) not in heads
    up = page.parent[root]
    while up >= 0:
        inside[up] = True
        up = page.parent[up]
    return inside.astype(float)


def _signature(opening: str) -> tuple[str, tuple[str, ...]]:
    values = re.findall(r'(?:class|id|role)="([^"]*)"', opening)
    return re.match(r"<(\w+)", opening)[1], tuple(w for v in values for w in WORD.findall(v))


def fit(htmls: Sequence[str]) -> Extractor:
    """Trees fitted on given pages with an ``article`` or ``main`` element, with it and with a plain ``div`` in its
    place, and on pages made of their words with the article and all else in other wrappers and places."""
    draw = random.Random(20)
    training: list[tuple[Page, np.ndarray]] = []
    for html in htmls or [""]:
        page = Page(html)
        own = labels(page, marked=False)
        if own is not None:
            training.append((page, own))
            plain = Page(html)
            root = next(k for k, t in enumerate(plain.tag) if t in ("article", "main"))
            plain.tag[root], plain.tokens[root] = "div", ()
            training.append((plain, own))
        words = [w for t in page.text for w in t.replace("<", " ").replace("&", " ").split()]
        for _ in range(MADE):
            made = Page(made_page(draw, words))
            found = labels(made, marked=True)
            if found is not None:
                training.append((made, found))
    counts = Counter(x for p, _ in training for k, t in enumerate(p.tag) for x in {"tag:" + t, *p.tokens[k]})
    known = {token: k for k, (token, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:TOKENS])}
    x = np.concatenate([Features(p, known).rows() for p, _ in training])
    return Extractor(known, boosting.fit(x, np.concatenate([y for _, y in training]), SHAPE))


def learn(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Extractor:
    """Fits on at most ``sample`` pages of up to ``SAMPLE_BYTES``, those whose text hashes smallest."""
    some = pages.where(F.octet_length(html) <= SAMPLE_BYTES).select(F.xxhash64(html).alias("h"), F.col(html).alias("html"))
    # Only hashes are sorted; whole pages come to the driver once those to take are known.
    chosen = [r["h"] for r in some.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not chosen:
        return fit([])
    taken = some.where(F.col("h") <= chosen[-1]).groupBy("h").agg(F.min("html").alias("html"))
    return fit([r["html"] for r in taken.orderBy("h").collect()])


def extracted(pages: DataFrame, extractor: Extractor, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` (empty if there is none) and ``n_chars`` (code points)
    in place of columns of those names. A null page is empty; every row comes back."""
    ship(pages.sparkSession)
    small_batches(pages.sparkSession)
    others = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = extractor.texts(h.as_py() or "" for h in batch.column(len(others)))
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "text", "n_chars"])

    schema = pages.select(others).schema.add("text", "string").add("n_chars", "long")
    return pages.select(*others, html).mapInArrow(run, schema)
