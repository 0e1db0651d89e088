"""Main text of web pages by boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements; the text that stands directly in a
block, with its inline elements, is a leaf. Elements that aren't known to be
blocks are inline, and nothing inside a silent element (head, script, style,
form controls, frames) is a node. Gradient-boosted trees score every
node from its tag, attribute tokens, depth, sibling statistics and the text,
link and tag densities of its subtree. A node counts as content if main text
stands anywhere below it, so a child can only be content if its parent is. The
choice of nodes with the highest total score under that rule is exact: bottom
up, a node is worth its own score and what its children are worth, or nothing.
Text leaves inside chosen nodes are the main text.

The trees are trained here on composed pages: paragraphs and link words of at
most ``sample_pages`` pages (lowest hash order of page_id) are set into layouts
drawn at random (containers, menus, headers, footers, sidebars, notices,
adverts, forms, comments), whose parts are known by construction.

Blocks: runs of white space become one space, trimmed, empty ones left out,
joined by a blank line. Defined results: a null or empty html gives an empty
text; pages without main text give an empty text; text outside any element is
judged as a leaf of the page; repeated rows are extracted each; null ids and
urls pass through; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import text_or_empty

SAMPLE_PAGES = 300
COMPOSED_PAGES = 700
TREES, DEPTH, RATE, BIN_COUNT, LEAST_ROWS = 80, 4, 0.2, 32, 20

# Fixed values of the HTML standard: elements by the way they are laid out and closed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template head title iframe textarea select option datalist".split())
#: Elements that stand as blocks of their own; any other, known or not, is a part of the text around it.
BLOCK = frozenset(
    "html body main article section nav aside header footer address div p h1 h2 h3 h4 h5 h6 hgroup blockquote pre listing plaintext xmp figure figcaption "
    "ul ol menu dir li dl dt dd table caption tbody thead tfoot tr td th form fieldset legend label button details summary dialog search center "
    "frameset noframes"
    .split()
)
#: What can stand in a head (and html, which adds nothing there); any other element or text ends it.
IN_HEAD = frozenset("html base basefont bgsound link meta title style script noscript noframes template".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd"
    .split()
)
#: An opening tag ends these open elements, unless one of the scopes stands between.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead")}
SCOPES = frozenset("ul ol dl table body html article section div main".split())

# Words of class, id and role that speak for main text or against it.
FOR = frozenset("article content post entry story main body text maincontent hentry prose markdown copy".split())
AGAINST = frozenset(
    "nav navbar navigation menu header masthead footer foot sidebar side aside widget widgets comment comments reply replies respond disqus ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert warning popup modal overlay newsletter subscribe signup login search form share sharing social related recommended recommend breadcrumb breadcrumbs pagination pager toolbar copyright legal meta tags skip toc hidden"
    .split()
)
KINDS = {
    "article": 0, "main": 0, "section": 1, "div": 2, "body": 3, "html": 3, "p": 4, "h1": 5, "h2": 5, "h3": 5, "h4": 5, "h5": 5, "h6": 5, "ul": 6,
    "ol": 6, "dl": 6, "menu": 6, "li": 7, "dt": 7, "dd": 7, "table": 8, "tbody": 8, "thead": 8, "tr": 8, "td": 8, "th": 8, "blockquote": 9, "pre": 9,
    "figure": 9, "figcaption": 9, "nav": 10, "header": 11, "footer": 12, "aside": 13, "form": 14, "fieldset": 14, "button": 14, "label": 14,
}
LEAF, OTHER = 15, 16


class Tree(HTMLParser):
    """Block elements and text leaves of a page, parents before children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def parsed(self, text: str) -> Tree:
        self.reset()
        self.tag, self.parent, self.attributes, self.kind = ["html"], [-1], [""], [KINDS["html"]]
        self.text: list[list[str] | None] = [None]
        self.linked = [0]
        self.open: list[tuple[str, int]] = [("html", 0)]  # element, node (an inline element keeps its block's)
        self.leaf, self.links, self.silent = -1, 0, 0
        self.feed(text)
        self.close()
        return self

    def node(self, tag: str, attributes: str = "") -> int:
        self.tag.append(tag)
        self.kind.append(LEAF if tag == "#text" else KINDS.get(tag, OTHER))
        self.parent.append(self.open[-1][1])
        self.attributes.append(attributes)
        self.text.append(None)
        self.linked.append(0)
        return len(self.tag) - 1

    def end_head(self, anywhere: bool) -> None:
        """Ends an open head whose end tag is left out: the innermost open element, or one ``anywhere``."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == "head":
                self.cut(k)
                return
            if not anywhere:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if self.silent and tag not in IN_HEAD:
            self.end_head(tag == "body")
        if tag in VOID:
            if tag == "br" and not self.silent:
                self.handle_data(" ")
            elif tag == "hr":
                self.leaf = -1
            return
        if tag in ("html", "body") and any(t == tag for t, _ in self.open[1:]):
            return
        if self.silent:  # nothing in here is laid out
            self.silent += tag in SILENT
            self.open.append((tag, self.open[-1][1]))
            return
        if tag in CLOSES_P:
            self.end_of(("p",), SCOPES)
        for_ends = ENDS.get(tag)
        if for_ends:
            self.end_of(for_ends, SCOPES)
        if tag in SILENT:
            self.silent += 1
            self.open.append((tag, self.open[-1][1]))
        elif tag not in BLOCK:
            self.links += tag == "a"
            self.open.append((tag, self.open[-1][1]))
        else:
            own = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")) if attrs else ""
            self.open.append((tag, self.node(tag, own)))
            self.leaf = -1

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def end_of(self, tags: tuple[str, ...], scopes: frozenset) -> None:
        """Closes the innermost open element of ``tags``, if none of ``scopes`` stands inside it."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k][0]
            if tag in tags:
                self.cut(k)
                return
            if tag in scopes:
                return

    def cut(self, k: int) -> None:
        if any(node != self.open[k - 1][1] for _, node in self.open[k:]):  # a block ends
            self.leaf = -1
        for tag, _ in reversed(self.open[k:]):  # what stands in a silent element was never counted
            if tag in SILENT:
                self.silent -= 1
            elif tag == "a" and not self.silent:
                self.links -= 1
        del self.open[k:]

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                self.cut(k)
                return

    def handle_data(self, data: str) -> None:
        if self.silent and not data.isspace():
            self.end_head(False)
        if self.silent:
            return
        if self.leaf < 0:
            if data.isspace():
                return
            self.leaf = self.node("#text")
            self.text[self.leaf] = []
        self.text[self.leaf].append(data)
        if self.links > 0:
            self.linked[self.leaf] += len(data.strip())


def tokens(attributes: str) -> list[str]:
    return [t.lower() for t in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", attributes)]


def token_votes(attributes: str, known: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """Attribute tokens that speak for main text and against it."""
    votes = known.get(attributes)
    if votes is None:
        words = tokens(attributes)
        votes = sum(w in FOR for w in words), sum(w in AGAINST for w in words)
        if len(known) < 10_000:
            known[attributes] = votes
    return votes


class Pages:
    """The nodes of many pages, page after page, as columns."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.blocks: list[str] = []
        self.parent: list[int] = []  # inside the page
        self.columns: list[list] = [[] for _ in range(20)]
        self.known: dict[str, tuple[int, int]] = {}

    def add(self, tree: Tree) -> None:
        parent, kind = tree.parent, tree.kind
        n = len(parent)
        blocks = [" ".join("".join(t).split()) if t else "" for t in tree.text]
        chars = [len(b) for b in blocks]
        depth, children, place, before = [0] * n, [0] * n, [0] * n, [0] * n
        good, bad, above_good, above_bad = [0] * n, [0] * n, [0] * n, [0] * n
        done = 0
        for i in range(n):
            if tree.attributes[i]:
                good[i], bad[i] = token_votes(tree.attributes[i], self.known)
            before[i] = done
            done += chars[i]
            p = parent[i]
            if p >= 0:
                depth[i] = depth[p] + 1
                place[i] = children[p]
                children[p] += 1
                k = kind[p]
                above_good[i] = max(above_good[p], good[p] + (k == 0))
                above_bad[i] = max(above_bad[p], bad[p] + (10 <= k <= 14))
        links, count, longest = list(tree.linked), [1] * n, list(chars)
        leaves = [1 if b else 0 for b in blocks]
        paragraphs = [int(t == "p") for t in tree.tag]
        items = [int(t == "li") for t in tree.tag]
        ends = [b.count(".") + b.count(",") if b else 0 for b in blocks]
        inside_good, inside_bad = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            p = parent[i]
            chars[p] += chars[i]
            count[p] += count[i]
            if links[i]:
                links[p] += links[i]
            if leaves[i]:
                leaves[p] += leaves[i]
                ends[p] += ends[i]
                if longest[i] > longest[p]:
                    longest[p] = longest[i]
            if paragraphs[i]:
                paragraphs[p] += paragraphs[i]
            if items[i]:
                items[p] += items[i]
            k = kind[i]
            g, w = good[i] + (k == 0), bad[i] + (10 <= k <= 14)
            inside_good[p] = max(inside_good[p], inside_good[i], g)
            inside_bad[p] = max(inside_bad[p], inside_bad[i], w)
        self.sizes.append(n)
        self.blocks += blocks
        self.parent += parent
        own = (
            kind, good, bad, above_good, above_bad, inside_good, inside_bad, depth, place, children, chars, links, count, leaves, paragraphs,
            items, ends, longest, before, [chars[0]] * n,
        )
        for column, values in zip(self.columns, own, strict=True):
            column += values

    def features(self) -> np.ndarray:
        (
            kind, good, bad, above_good, above_bad, inside_good, inside_bad, depth, place, children, chars, links, count, leaves, paragraphs,
            items, ends, longest, before, total,
        ) = (np.array(c, dtype=float) for c in self.columns)
        start = np.repeat(np.cumsum([0, *self.sizes[:-1]]), self.sizes) if self.sizes else np.zeros(0, dtype=np.int64)
        p = start + np.maximum(np.array(self.parent, dtype=np.int64), 0)
        size, per_leaf = np.maximum(chars, 1), np.maximum(leaves, 1)
        columns = (
            kind, kind[p], good, bad, above_good, above_bad, inside_good, inside_bad, depth, children[p], place, children[p] - 1 - place, children,
            np.log1p(chars), links / size, count / size * 100, leaves, chars / per_leaf, paragraphs, items, ends / size * 100, longest,
            chars / np.maximum(total, 1), chars / size[p], before / np.maximum(total, 1), links[p] / size[p], np.log1p(chars[p]), paragraphs[p],
            kind == 10, kind == 12, np.isin(kind, (11, 13, 14)), kind == 0,
        )
        return np.stack([np.asarray(c, dtype=float) for c in columns], axis=1)


class Boosted:
    """Gradient-boosted regression trees on binned features, logistic loss; complete trees as flat arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        quantiles = np.linspace(0, 1, BIN_COUNT + 1)[1:-1]
        edges = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])]
        bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        inner = 2**DEPTH
        self.feature = np.zeros((TREES, inner), dtype=np.int32)
        self.split = np.full((TREES, inner), np.inf)
        self.value = np.zeros((TREES, inner))
        share = float((y * weight).sum() / weight.sum())
        self.base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        z = np.full(len(y), self.base)
        for t in range(TREES):
            p = 1 / (1 + np.exp(-z))
            gradient, curvature = weight * (y - p), weight * p * (1 - p)
            node = np.ones(len(y), dtype=np.int64)
            for level in range(DEPTH):
                for k in range(2**level, 2 ** (level + 1)):
                    rows = np.flatnonzero(node == k)
                    best = self._best(bins[rows], gradient[rows], curvature[rows], edges) if len(rows) >= 2 * LEAST_ROWS else None
                    if best is not None:
                        self.feature[t, k], self.split[t, k] = best
                node = 2 * node + (x[np.arange(len(x)), self.feature[t, node]] > self.split[t, node])
            leaf = node - inner
            up, down = np.bincount(leaf, gradient, inner), np.bincount(leaf, curvature, inner)
            self.value[t] = RATE * up / (down + 1.0)
            z = z + self.value[t][leaf]

    @staticmethod
    def _best(bins, gradient, curvature, edges):
        best, found = 1e-6, None
        total_g, total_h = gradient.sum(), curvature.sum()
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            size = len(edge) + 1
            g = np.cumsum(np.bincount(bins[:, f], gradient, size))[:-1]
            h = np.cumsum(np.bincount(bins[:, f], curvature, size))[:-1]
            c = np.cumsum(np.bincount(bins[:, f], minlength=size))[:-1]
            gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            gain[(c < LEAST_ROWS) | (len(bins) - c < LEAST_ROWS)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = gain[k], (f, edge[k])
        return found

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        # Column after column, since neighbouring rows mostly ask for the same feature.
        flat, row = np.ascontiguousarray(x.T).ravel(), np.arange(len(x))
        for feature, split, value in zip(self.feature.astype(np.int64) * len(x), self.split, self.value, strict=True):
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + (flat.take(row + feature.take(node)) > split.take(node))
            z += value.take(node - 2**DEPTH)
        return z


def decoded(parent: list[int], score: np.ndarray) -> list[bool]:
    """The nodes of highest total score such that a chosen node's parent is chosen."""
    worth = score.tolist()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    chosen: list[bool] = []
    for w, p in zip(worth, parent, strict=True):
        chosen.append(w > 0 and (p < 0 or chosen[p]))
    return chosen


class Composer:
    """Pages of known parts: marks around main text tell the label of every leaf."""

    MARK = ""

    def __init__(self, paragraphs: list[str], words: list[str], seed: int = 11) -> None:
        self.rng = np.random.default_rng(seed)
        self.paragraphs = paragraphs or ["Some words stand here, in a sentence of their own."]
        self.words = words or ["home", "news", "about"]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def prose(self, most: int = 10**9) -> str:
        return html.escape(self.pick(self.paragraphs)[:most].replace(self.MARK, ""))

    def word(self) -> str:
        return html.escape(self.pick(self.words).replace(self.MARK, ""))

    def phrase(self) -> str:
        return " ".join(self.word() for _ in range(int(self.rng.integers(1, 7))))

    def link(self) -> str:
        return f'<a href="/{self.rng.integers(9999)}">{self.phrase()}</a>'

    def named(self, tag: str, names: list[str]) -> tuple[str, str]:
        """Opening and closing tag, usually with a class or id."""
        where = self.pick(["class", "class", "id"])
        extra = self.pick(["", "", " wide", " box-1", " u-mt"]) if where == "class" else ""
        return f'<{tag} {where}="{self.pick(names)}{extra}">', f"</{tag}>"

    def menu(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(int(self.rng.integers(2, 9))))
        a, b = self.pick([("<nav>", "</nav>"), self.named("div", ["menu", "navbar", "main-nav", "breadcrumbs", "pagination"]), self.named("nav", ["top", "site-nav"])])
        return self.pick([f"{a}<ul>{items}</ul>{b}", f"{a}{' | '.join(self.link() for _ in range(4))}{b}", f'<ul class="menu">{items}</ul>'])

    def header(self) -> str:
        a, b = self.pick([("<header>", "</header>"), self.named("div", ["site-header", "header", "masthead", "banner"])])
        return f"{a}<div>{self.phrase()}</div>{self.menu() if self.chance(0.5) else ''}{'<p>' + self.prose(80) + '</p>' if self.chance(0.4) else ''}{b}"

    def footer(self) -> str:
        a, b = self.pick([("<footer>", "</footer>"), ("<footer>", "</footer>"), self.named("div", ["footer", "site-footer", "copyright", "legal"])])
        inner = self.pick([f"&copy; {self.phrase()} &middot; {self.prose(200)}", f"<p>{self.prose(150)}</p>{self.menu()}", f"<p>&copy; {self.phrase()}</p>"])
        return a + inner + b

    def advert(self) -> str:
        a, b = self.named(self.pick(["div", "div", "aside", "section", "p"]), ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot"])
        return f"{a}{self.pick([self.prose(200), self.prose(), self.link() + ' ' + self.prose(60)])}{b}"

    def notice(self) -> str:
        a, b = self.named(self.pick(["div", "section", "aside", "p"]), ["cookie-notice", "notice", "alert", "consent-banner", "gdpr", "popup", "newsletter", "subscribe"])
        inner = self.prose(200)
        return f"{a}{inner if a.startswith('<p') else f'<p>{inner}</p>'}{'<button>' + self.phrase() + '</button>' if self.chance(0.5) and not a.startswith('<p') else ''}{b}"

    def sidebar(self) -> str:
        a, b = self.pick([("<aside>", "</aside>"), self.named("div", ["sidebar", "widget", "related", "recommended", "side", "social-share"]), self.named("aside", ["sidebar", "related-posts"])])
        inner = "".join(self.pick([f"<h3>{self.phrase()}</h3>", f"<p>{self.prose(160)}</p>", f"<ul><li>{self.link()}</li><li>{self.link()}</li></ul>"]) for _ in range(int(self.rng.integers(1, 4))))
        return a + inner + b

    def form(self) -> str:
        inner = f"<label>{self.phrase()}</label><input name=x><button>{self.word()}</button>"
        return self.pick([f"<form>{inner}</form>", f"<form><p>{self.prose(120)}</p>{inner}</form>", f'<div class="search-form">{inner}</div>', f'<form id="login"><fieldset>{inner}</fieldset></form>'])

    def comments(self) -> str:
        a, b = self.named(self.pick(["section", "div", "ol", "div"]), ["comments", "comment-list", "replies", "disqus-thread", "respond"])
        one = self.pick(["div", "article", "li", "div"]) if not a.startswith("<ol") else "li"
        inner = "".join(f'<{one} class="comment"><b>{self.word()}</b><p>{self.prose()}</p></{one}>' for _ in range(int(self.rng.integers(1, 6))))
        return f"{a}{'<h3>' + self.phrase() + '</h3>' if not a.startswith('<ol') else ''}{inner}{b}"

    def main(self, with_extras: bool) -> str:
        m = self.MARK
        out = [f"<h1>{m}{self.prose(60)}</h1>"] if self.chance(0.8) else []
        if out and self.chance(0.1):
            out = [f"<header>{out[0]}</header>"]
        for _ in range(int(self.rng.choice([1, 1, 2, 3, 5, 8, 13]))):
            text = m + self.prose()
            out.append(
                self.pick(
                    [f"<p>{text}</p>"] * 8
                    + [f"<p><b>{text}<br><p>{m}{self.prose()}</p>", f"<p>{text}", f"<h2>{m}{self.prose(50)}</h2><p>{text}</p>", f"<blockquote>{text}</blockquote>",
                       f"<ul><li>{text}</li><li>{m}{self.prose(80)}</li></ul>", f"<pre>{text}</pre>", f"<p>{text} {self.link()} {self.prose(40)}</p>",
                       f"<table><tr><td>{m}{self.prose(30)}</td><td>{m}{self.prose(30)}</td></tr></table>", f"<div>{text}</div>"]
                )
            )
            if with_extras and self.chance(0.12):
                out.append(self.pick([self.advert, self.notice, self.sidebar, self.form])())
        return "".join(out)

    def page(self) -> str:
        a, b = self.pick(
            [("<article>", "</article>")] * 4
            + [("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div role='main'>", "</div>"), ("<div><div>", "</div></div>"), ("", "")]
            + [self.named("div", ["content", "post-content", "entry", "article-body", "story", "main"]), self.named("section", ["content", "story", "text"])]
        )
        top = [p() for p in (self.header, self.menu, self.notice, self.advert) if self.chance(0.45)]
        end = [p() for p in (self.sidebar, self.advert, self.comments, self.form, self.notice) if self.chance(0.35)] + ([self.footer()] if self.chance(0.85) else [])
        self.rng.shuffle(top)
        body = "".join(top) + (self.sidebar() if self.chance(0.15) else "") + a + self.main(True) + (self.comments() if self.chance(0.1) else "") + b + "".join(end)
        if self.chance(0.25):
            body = f"<div id='page'>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.phrase()}</title></head><body>{body}" + self.pick(["</body></html>", ""])


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, composed_pages: int = COMPOSED_PAGES) -> Boosted:
    """Boosted trees trained on pages composed of the sample's words."""
    # The ids first, so that no task sends more than ids to the driver; then at most so many pages.
    ids = pages.select("page_id").filter("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    chosen = [r["page_id"] for r in ids.collect()]
    rows = pages.filter(F.col("page_id").isin(chosen)).groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id")
    tree, sampled = Tree(), Pages()
    for row in rows.collect():
        sampled.add(tree.parsed(row["html"] or ""))
    linked = sampled.features()[:, 14] > 0.5 if sampled.sizes else []
    paragraphs = [b for b, k in zip(sampled.blocks, linked, strict=True) if not k and len(b) > 15]
    words = [b for b, k in zip(sampled.blocks, linked, strict=True) if k and b]
    composer, composed = Composer(paragraphs, words), Pages()
    y, weight = [], []
    for _ in range(composed_pages):
        tree.parsed(composer.page())
        label = [int(any(Composer.MARK in part for part in t)) if t else 0 for t in tree.text]
        for t in tree.text:
            if t:
                t[:] = [part.replace(Composer.MARK, "") for part in t]
        composed.add(tree)
        for i in range(len(label) - 1, 0, -1):
            label[tree.parent[i]] |= label[i]
        y += label
        weight += [1.0 if t is None else 2.0 for t in tree.text]
    return Boosted(composed.features(), np.array(y, dtype=float), np.array(weight))


def html_extraction(pages: DataFrame, model: Boosted | None = None, **options) -> DataFrame:
    """page_id, url, main text and its number of code points."""
    model = model or fit(pages, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree()
        for batch in batches:
            pages = Pages()
            for text in batch.column("_html").to_pylist():
                pages.add(tree.parsed(text))
            score = model.score(pages.features()) if pages.sizes else np.zeros(0)
            texts, at = [], 0
            for size in pages.sizes:
                chosen = decoded(pages.parent[at : at + size], score[at : at + size])
                texts.append("\n\n".join(b for b, c in zip(pages.blocks[at : at + size], chosen, strict=True) if c and b))
                at += size
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    rows = pages.select("page_id", "url", text_or_empty("html").alias("_html"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
