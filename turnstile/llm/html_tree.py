"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements, and under them the runs of text that no block interrupts
(inline markup belongs to its run).  Each node has a hidden label, content or not; node potentials are
linear in features of the tag, attributes, text and place, edge potentials join parent and child.
One sum-product pass upward and one downward give exact marginals; runs whose content
marginal is a half or more are the text.  Weights are trained by gradient ascent on the likelihood of
labelled pages, which ``labelled_pages`` lays out from many page designs with known labels.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections.abc import Iterator
from functools import cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr nobr "
                   "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover "
                   "mstyle mpadded mphantom mfenced menclose mmultiscripts mprescripts mtable mtr mtd".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template textarea select option head title svg iframe object canvas audio "
                 "video button datalist annotation annotation-xml".split())
#: skipped elements that a block element ends where their end tag is missing
LOOSE = frozenset("head title select option datalist".split())
#: block elements that close an open paragraph
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: opening a key closes an open one of its values
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "thead": ("thead", "tbody"), "tbody": ("thead", "tbody")}
SCOPE = frozenset("ul ol dl table div article section body html".split())
#: an element is never closed from inside one of these
WALLS = frozenset("td th table article body".split())
_NAME = re.compile(r"[a-z]+|[0-9]+")


class Node:
    __slots__ = ("parent", "tag", "names", "text", "linked", "hidden")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...] = (), hidden: bool = False):
        self.parent, self.tag, self.names, self.hidden = parent, tag, names, hidden
        self.text: list[str] | None = None
        self.linked = 0


class TreeBuilder(HTMLParser):
    """Nodes in page order; a parent always comes before its children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "page")]
        self.open: list[tuple[str, int]] = [("page", 0)]  # blocks only
        self.places: dict[str, list[int]] = {}  # tag -> its places in ``open``, lowest first
        self.links = self.skipping = 0
        self.skip_tag = ""
        self.run: Node | None = None

    def handle_starttag(self, tag: str, attrs) -> None:
        if self.skipping and self.skip_tag in LOOSE and (tag == "body" or tag in CLOSES_P):
            self.skipping = 0  # left open: the page's body ends it
        if self.skipping:
            self.skipping += tag == self.skip_tag
            return
        if tag in SKIP:
            if tag == "head" and self.places.get("body"):
                return  # a head inside the body is no head
            self.skipping, self.skip_tag = 1, tag
            return
        if tag == "br":
            self.handle_data(" ")
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag == "body" or tag in CLOSES_P or tag in SIBLING:
            self.links = 0
        if tag in CLOSES_P:
            self._close("p")
        for other in SIBLING.get(tag, ()):
            self._close(other, SCOPE)
        self.run = None
        if tag in VOID:
            return
        got = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "style", "hidden", "aria-hidden", "itemprop")}
        names = tuple(_NAME.findall(" ".join(got.get(k, "") for k in ("class", "id", "role", "itemprop"))))
        hidden = "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "")
        self.nodes.append(Node(self.open[-1][1], tag, names, hidden))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, len(self.nodes) - 1))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def _last(self, tag: str) -> int:
        """Place of the innermost open block of a tag, 0 for none."""
        at = self.places.get(tag)
        return at[-1] if at else 0

    def _cut(self, place: int) -> None:
        """Close the block at ``place`` and all inside it; every block is closed once, so pages cost linear time."""
        while len(self.open) > place:
            self.places[self.open.pop()[0]].pop()
        self.run = None

    def _close(self, tag: str, stop: frozenset[str] = frozenset()) -> None:
        place = self._last(tag)
        if place and place > max(self._last(t) for t in (WALLS | stop) - {tag}):
            self._cut(place)

    def handle_endtag(self, tag: str) -> None:
        if self.skipping:
            self.skipping -= tag == self.skip_tag
            if tag == "body":
                self.skipping = 0
            return
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
            return
        if self._last(tag):
            self._cut(self._last(tag))
            self.links = 0
        self.run = None

    def handle_data(self, data: str) -> None:
        if self.skipping:
            return
        if self.run is None:
            if not data.strip():
                return
            self.run = Node(self.open[-1][1], "#text")
            self.run.text = []
            self.nodes.append(self.run)
        self.run.text.append(data)
        if self.links:
            self.run.linked += len(data.strip())


def page_tree(html: str | None) -> list[Node]:
    builder = TreeBuilder()
    if html:
        builder.feed(html)
        builder.close()
    return builder.nodes


def _size_bin(n: int) -> int:
    return min(9, n.bit_length())


FEATURES = 1 << 14


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % FEATURES


#: words that publishers put around articles, in text
FURNITURE = re.compile(
    r"©|\(c\) ?\d{4}|\b(copyright|all rights reserved|cookies?|privacy|subscribe|newsletter|sign ?up|log ?in|sign in|"
    r"advertisement|sponsored|share this|follow us|related (posts|articles)|read more|comments?|reply|terms of (use|service))\b", re.I)


def node_features(nodes: list[Node]) -> list[list[int]]:
    total = len(nodes)
    out = []
    for k, n in enumerate(nodes):
        names = ["bias:" + ("text" if n.tag == "#text" else "block")]
        if n.tag == "#text":
            text = " ".join("".join(n.text).split())
            words = text.count(" ") + 1
            dense = n.linked * 4 // max(1, len(text))
            above = nodes[n.parent]
            up = above.tag
            path = f"{nodes[above.parent].tag if above.parent >= 0 else ''}/{up}"
            names += [f"len:{_size_bin(len(text))}", f"link:{min(4, dense)}", f"up:{up}", f"up:{up}:link:{min(4, dense)}",
                      f"path:{path}", f"path:{path}:{'named' if above.names else 'plain'}", f"words:{_size_bin(words)}", "stop" if text[-1:] in ".!?:;\"'”»" else "open",
                      f"commas:{min(3, text.count(','))}", f"place:{5 * k // total}"]
            if len(text) < 240 and FURNITURE.search(text):
                names.append("furniture")
        else:
            up = nodes[n.parent].tag if n.parent >= 0 else ""
            names += [f"tag:{n.tag}", f"under:{up}/{n.tag}:{'named' if n.names else 'plain'}", f"first:{min(k, 3)}", f"place:{n.tag}:{3 * k // total}"]
            names += [f"name:{x}" for x in n.names]
            if n.hidden:
                names.append("hidden")
        out.append([_feature(x) for x in names])
    return out


class TreeModel:
    """theta: log odds of a feature for content; edge[kind]: log potentials by (parent, child) label."""

    def __init__(self) -> None:
        self.theta = [0.0] * FEATURES
        self.edge = {"text": [[0.0, 0.0], [0.0, 0.0]], "block": [[0.0, 0.0], [0.0, 0.0]]}

    @staticmethod
    def kind(n: Node) -> str:
        return "text" if n.tag == "#text" else "block"

    def beliefs(self, nodes: list[Node], feats: list[list[int]]):
        """Marginal of content per node, and per node the joint with its parent [p][c]."""
        theta, exp, log = self.theta, math.exp, math.log

        def add(a: float, b: float) -> float:
            return (a if a > b else b) + log(1.0 + exp(-abs(a - b)))

        odds = [sum([theta[f] for f in fs]) for fs in feats]
        up0, up1 = [0.0] * len(nodes), odds[:]  # log potential with everything below
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):
            e, p = self.edge[self.kind(nodes[k])], nodes[k].parent
            m0, m1 = add(up0[k] + e[0][0], up1[k] + e[0][1]), add(up0[k] + e[1][0], up1[k] + e[1][1])
            sent[k] = (m0, m1)
            up0[p] += m0
            up1[p] += m1
        down0, down1 = up0[:], up1[:]  # with everything above too
        joint: list = [None] * len(nodes)
        for k in range(1, len(nodes)):
            e, p = self.edge[self.kind(nodes[k])], nodes[k].parent
            a0, a1 = down0[p] - sent[k][0], down1[p] - sent[k][1]  # the parent without this child
            j = [[a0 + e[0][0] + up0[k], a0 + e[0][1] + up1[k]], [a1 + e[1][0] + up0[k], a1 + e[1][1] + up1[k]]]
            top = max(j[0] + j[1])
            z = top + log(sum(exp(x - top) for x in j[0] + j[1]))
            joint[k] = [[exp(x - z) for x in row] for row in j]
            down0[k] = add(a0 + e[0][0], a1 + e[1][0]) + up0[k]
            down1[k] = add(a0 + e[0][1], a1 + e[1][1]) + up1[k]
        content = [1.0 / (1.0 + exp(min(500.0, max(-500.0, d0 - d1)))) for d0, d1 in zip(down0, down1)]
        return content, joint

    def fit(self, pages: list[tuple[list[Node], list[int]]], epochs: int = 12, rate: float = 0.3, l2: float = 1e-4,
            seed: int = 5) -> TreeModel:
        rng = random.Random(seed)
        data = [(nodes, labels, node_features(nodes)) for nodes, labels in pages]
        grown = [1e-3] * FEATURES
        edge_grown = {k: [[1e-3, 1e-3], [1e-3, 1e-3]] for k in self.edge}
        for _ in range(epochs):
            rng.shuffle(data)
            for nodes, labels, feats in data:
                content, joint = self.beliefs(nodes, feats)
                step: dict[int, float] = {}
                for y, c, fs in zip(labels, content, feats):
                    for f in fs:
                        step[f] = step.get(f, 0.0) + y - c
                for f, g in step.items():
                    g -= l2 * self.theta[f] * 10
                    grown[f] += g * g
                    self.theta[f] += rate * g / math.sqrt(grown[f])
                edges = {k: [[0.0, 0.0], [0.0, 0.0]] for k in self.edge}
                for k in range(1, len(nodes)):
                    e = edges[self.kind(nodes[k])]
                    e[labels[nodes[k].parent]][labels[k]] += 1.0
                    for p in (0, 1):
                        for c in (0, 1):
                            e[p][c] -= joint[k][p][c]
                for kind, e in edges.items():
                    for p in (0, 1):
                        for c in (0, 1):
                            edge_grown[kind][p][c] += e[p][c] ** 2
                            self.edge[kind][p][c] += rate * e[p][c] / math.sqrt(edge_grown[kind][p][c])
        return self

    def text(self, html: str | None) -> str:
        nodes = page_tree(html)
        content, _ = self.beliefs(nodes, node_features(nodes))
        runs = (" ".join("".join(n.text).split()) for n, c in zip(nodes, content) if n.text is not None and c >= 0.5)
        return " ".join(r for r in runs if r)


# --- labelled pages ---------------------------------------------------------------------------------------------------

_SYLLABLES = "an be con der el fa gra ho in ja ker lo mi nor os pre qua re sta ti un ver wo xi yo zan é ü ñ ction ment ing".split()


class _Page:
    """Writes one page; text passed with ``keep`` is its main text."""

    def __init__(self, rng: random.Random):
        self.r, self.parts, self.main = rng, [], []

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.choice((1, 2, 2, 3))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self, sentences: int) -> str:
        out = []
        for _ in range(sentences):
            ws = self.words(1, 24).capitalize().split(" ")
            if len(ws) > 5 and self.r.random() < 0.6:
                ws[len(ws) // 2] += ","
            out.append(" ".join(ws) + self.r.choice("....?!"))
        text = " ".join(out)
        if self.r.random() < 0.04:
            text = text.replace(" ", "*** ")
        return text

    def raw(self, html: str) -> None:
        self.parts.append(html)

    def block(self, tag: str, text: str, keep: bool, attrs: str = "") -> None:
        shown = text.replace("&", "&amp;").replace("<", "&lt;")
        if keep and self.r.random() < 0.15 and " " in shown:
            first, rest = shown.split(" ", 1)
            shown = self.r.choice((f"<b>{first}</b> {rest}", f"{first} <a href='/x'>{rest[:20]}</a>{rest[20:]}", f"<b>{first} {rest}<br>",
                                   f"<em>{first}</em> {rest}")) if "&" not in rest[:24] else shown
        closed = self.r.random() < 0.9 or tag not in ("p", "li")
        mark = "␟" if keep else "␠"  # label of the run, taken off before training
        self.raw(f"<{tag}{attrs}>{mark}{shown}" + (f"</{tag}>" if closed else ""))
        if keep:
            self.main.append(text)

    def attrs(self, *names: str) -> str:
        name = self.r.choice(names)
        form = self.r.random()
        return "" if form < 0.08 else f' id="{name}"' if form < 0.3 else f' class="{name}"' if form < 0.7 else (
            f' class="{self.word()} {name}{self.r.choice(("", "-box", "-1", "_inner", " wide"))}"')

    def links(self, n: int, inline: bool = False) -> None:
        for _ in range(n):
            a = f"<a href='/{self.word()}'>␠{self.words(1, 5)}</a>"
            self.raw(a + " " if inline else f"<li>{a}</li>")

    def furniture(self, kind: str) -> None:
        r = self.r
        if kind == "nav":
            tag = r.choice(("nav", "nav", "div", "ul"))
            self.raw(f"<{tag}{self.attrs('nav', 'menu', 'main-menu', 'navbar', 'navigation', 'breadcrumb', 'topnav', 'links')}>")
            if r.random() < 0.7:
                self.raw("<ul>"), self.links(r.randint(2, 12)), self.raw("</ul>")
            else:
                self.links(r.randint(2, 12), inline=True)
            self.raw(f"</{tag}>")
        elif kind == "header":
            tag = r.choice(("header", "header", "div"))
            self.raw(f"<{tag}{self.attrs('header', 'site-header', 'masthead', 'top', 'banner', 'page-head')}>")
            self.block(r.choice(("div", "p", "h2", "span", "h1")), self.words(1, 6), False, self.attrs("logo", "brand", "site-title", "tagline"))
            if r.random() < 0.5:
                self.furniture("nav")
            self.raw(f"</{tag}>")
        elif kind == "footer":
            tag = r.choice(("footer", "footer", "div"))
            self.raw(f"<{tag}{self.attrs('footer', 'site-footer', 'bottom', 'colophon', 'legal')}>")
            for _ in range(r.randint(1, 3)):
                self.block(r.choice(("p", "div", "span")), r.choice((f"© {self.words(1, 3)} · {self.prose(1)}", "© 2021 " + self.words(1, 4), "All rights reserved. " + self.words(0, 4),
                                                                      self.prose(r.randint(1, 3)), self.words(2, 9))), False)
            self.raw(f"</{tag}>")
        elif kind == "ad":
            tag = r.choice(("div", "div", "aside", "section", "p"))
            self.block(tag, r.choice((self.prose(r.randint(1, 2)), self.words(3, 10), "Advertisement " + self.words(2, 6), "Sponsored: " + self.prose(1))), False,
                       ' class="%s"' % r.choice(("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner-ad", "adbox", "advertisement", "promotion")))
        elif kind == "sidebar":
            tag = r.choice(("aside", "aside", "div", "section"))
            self.raw(f"<{tag}{self.attrs('sidebar', 'side', 'widget', 'related', 'rail', 'aside', 'recent-posts', 'trending')}>")
            self.block(r.choice(("h2", "h3", "h4", "p")), self.words(1, 4), False)
            if r.random() < 0.6:
                self.raw("<ul>"), self.links(r.randint(2, 8)), self.raw("</ul>")
            else:
                for _ in range(r.randint(1, 3)):
                    self.block("p", self.prose(r.randint(1, 3)), False)
            self.raw(f"</{tag}>")
        elif kind == "notice":
            tag = r.choice(("div", "div", "section", "aside"))
            self.raw(f"<{tag}{self.attrs('cookie', 'cookie-notice', 'consent', 'notice', 'gdpr', 'alert', 'popup', 'modal', 'paywall', 'subscribe')}>")
            for _ in range(r.randint(1, 2)):
                self.block(r.choice(("p", "div", "span")), r.choice(("We use cookies. ", "Your privacy: ", "Subscribe to our newsletter! ", "")) + self.prose(r.randint(1, 2)), False)
            self.raw(f"<button>{self.words(1, 2)}</button></{tag}>")
        elif kind == "form":
            self.raw(f"<form{self.attrs('search', 'newsletter', 'login', 'signup', 'contact')}>")
            self.block(r.choice(("label", "p", "div", "legend")), self.words(1, 9), False)
            self.raw(f"<input type='text'><select><option>{self.word()}</option></select><button>{self.word()}</button></form>")
        elif kind == "comments":
            tag, row = r.choice((("section", "div"), ("div", "article"), ("div", "div"), ("section", "li"), ("ol", "li")))
            self.raw(f"<{tag}{self.attrs('comments', 'comment-list', 'disqus_thread', 'responses', 'replies', 'discussion', 'reader-comments')}>")
            self.block(r.choice(("h2", "h3", "p")), r.choice(("Comments", "3 comments", "Leave a reply", self.words(1, 3))), False)
            for _ in range(r.randint(1, 6)):
                self.raw(f"<{row}{self.attrs('comment', 'reply', 'comment-body', 'response', 'post-comment')}>")
                if r.random() < 0.6:
                    self.block(r.choice(("span", "div", "p", "strong")), self.words(1, 4), False, self.attrs("author", "user", "meta"))
                for _ in range(r.randint(1, 2)):
                    self.block("p", self.prose(r.randint(1, 4)), False)
                self.raw(f"</{row}>")
            self.raw(f"</{tag}>")
        elif kind == "share":
            self.raw(f"<div{self.attrs('share', 'social', 'tags', 'post-meta')}>"), self.links(r.randint(2, 5), inline=True), self.raw("</div>")

    def article(self) -> None:
        r = self.r
        tag, attrs = r.choice((("article", ""), ("article", self.attrs("post", "entry", "story", "article")), ("div", ' class="%s"' % r.choice(
            ("content", "article-body", "post-content", "entry-content", "story", "main-content", "article", "text"))),
            ("section", ' class="article"'), ("div", ' itemprop="articleBody"')))
        bare = r.random() < 0.08  # paragraphs without a container of their own
        self.raw("" if bare else f"<{tag}{attrs}>")
        title = r.choice((self.words(1, 9), self.prose(1)))
        if r.random() < 0.9:
            wrap = r.random() < 0.15
            self.raw("<header>" * wrap)
            self.block(r.choice(("h1", "h1", "h2")), title, True)
            self.raw("</header>" * wrap)
        for _ in range(r.choice((0, 1, 1, 2, 3, 5, 8, 14))):
            kind = r.random()
            if kind < 0.74:
                self.block("p", r.choice((self.prose(1), self.prose(r.randint(1, 3)), self.prose(r.randint(2, 8)), self.words(1, 4) + ".")), True)
            elif kind < 0.80:
                self.block(r.choice(("h2", "h3", "h4")), self.words(1, 7), True)
            elif kind < 0.85:
                self.raw("<ul>")
                for _ in range(r.randint(1, 5)):
                    self.block("li", r.choice((self.words(1, 8), self.prose(1))), True)
                self.raw("</ul>")
            elif kind < 0.88:
                self.raw("<blockquote>"), self.block("p", self.prose(r.randint(1, 3)), True), self.raw("</blockquote>")
            elif kind < 0.90:
                self.block("pre", self.words(3, 20), True)
            elif kind < 0.92:
                self.raw("<table><tr>"), self.block("td", self.words(1, 3), True), self.block("td", self.words(1, 3), True), self.raw("</tr></table>")
            elif kind < 0.94:
                self.raw("<div>"), self.block("p", self.prose(r.randint(1, 4)), True), self.raw("</div>")
            else:
                self.furniture(r.choice(("ad", "ad", "share", "sidebar", "form")))
        self.raw("" if bare else f"</{tag}>")

    def html(self) -> str:
        r = self.r
        self.raw(f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style></head><body><script>var a='</p>';</script>")
        before = [k for k, p in (("notice", 0.2), ("header", 0.45), ("nav", 0.6), ("form", 0.12), ("ad", 0.45), ("sidebar", 0.12)) if r.random() < p]
        after = [k for k, p in (("share", 0.2), ("comments", 0.4), ("sidebar", 0.35), ("ad", 0.25), ("form", 0.2), ("footer", 0.75), ("notice", 0.1)) if r.random() < p]
        wrapped = r.random() < 0.5
        wrap = r.choice(("main", "div")) if wrapped else ""
        for kind in before[: (wide := r.randint(0, len(before)))]:
            self.furniture(kind)
        if wrap:
            self.raw(f"<{wrap}{self.attrs('main', 'page', 'wrapper', 'container', 'content', 'site')}>")
        for kind in before[wide:]:
            self.furniture(kind)
        self.article()
        inside = r.randint(0, len(after))
        for n, kind in enumerate(after):
            if wrap and n == inside:
                self.raw(f"</{wrap}>")
                wrap = ""
            self.furniture(kind)
        if wrap:
            self.raw(f"</{wrap}>")
        self.raw("</body></html>" * (r.random() < 0.9))
        return "".join(self.parts)


def labelled_pages(n: int, seed: int) -> list[tuple[str, str, list[Node], list[int]]]:
    """``n`` pages of random design: html, main text, tree and the label of each node (a block is content
    if some run in it is)."""
    out = []
    for k in range(n):
        page = _Page(random.Random(seed * 1_000_003 + k))
        marked = page.html()
        nodes = page_tree(marked)
        labels = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            x = nodes[i]
            if x.text is not None:
                whole = "".join(x.text)
                labels[i] = int("␟" in whole)
                x.text = [whole.replace("␟", "").replace("␠", "")]
            if labels[i] and x.parent >= 0:
                labels[x.parent] = 1
        html = marked.replace("␟", "").replace("␠", "")
        out.append((html, " ".join(t for t in (" ".join(m.split()) for m in page.main) if t), nodes, labels))
    return out


@cache
def trained_model(pages: int = 1500, seed: int = 11) -> TreeModel:
    return TreeModel().fit([(nodes, labels) for _, _, nodes, labels in labelled_pages(pages, seed)])


def main_text(html: Column, model: TreeModel) -> Column:
    @F.pandas_udf("string")
    def extract(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.text(x) for x in part], dtype="object")

    return extract(html)


def extract_main_text(pages: DataFrame, html_col: str = "html", into: str = "text", training_pages: int = 1500) -> DataFrame:
    """``pages`` with the column ``into`` (a column of that name is replaced): the main text.

    The model is trained on ``training_pages`` labelled pages (the bound of the sample); every page is
    then read whole.  Null or empty html, or no content: an empty text.  Repeated rows, null ids and
    other columns pass through; an empty table gives no rows."""
    return pages.withColumn(into, main_text(F.col(html_col), trained_model(training_pages)))
