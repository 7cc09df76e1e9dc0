"""Main text of web pages by a tree-structured graphical model.

A page's block elements and their text blocks form a tree. Each node has a hidden state,
"holds article text" or not; unary potentials score a node's own features (tag, words of its
class, id and role, length, share of linked text, punctuation) and parent-child potentials
connect states along the tree's edges. Sum-product message passing, once upward and once
downward, gives exact marginals; a text block whose marginal exceeds one half is main text. All
trees of an Arrow batch are passed level by level together.

The weights are trained by maximum likelihood (the same messages give the expected counts) on
labelled pages: (html, texts of the content blocks). ``labelled_pages`` makes a fixed training set of
varied site layouts by rule; ``fit`` takes any other.

Text rules: character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined by a blank line. Scripts, styles, the head, comments and embedded objects
have no text blocks. Defined results: a null, empty or text-free page gives an empty text. Elements nested deeper than
``DEEPEST`` are kept as siblings at that depth.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import ship

DEEPEST = 120
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("script style head title noscript template svg annotation annotation-xml iframe object canvas audio video select textarea button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# a start tag of the key ends an open element of the value
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words of class, id and role attributes, by what they tell about an element.
CUES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toc sitemap",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner dfp",
    "bottom": "footer foot copyright legal colophon contentinfo",
    "top": "header masthead topbar logo branding banner site",
    "side": "sidebar aside side rail widget related recommended trending popular complementary",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall dialog",
    "comment": "comment comments reply replies respond discussion disqus responses feedback",
    "share": "share sharing social tags follow",
    "form": "form search login register contact input",
    "content": "content article main post entry story body text document blog",
    "credit": "byline author date meta caption",
}
CUE_OF = {w: cue for cue, words in CUES.items() for w in words.split()}
TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "li", "ul", "ol", "nav", "header", "footer", "aside", "form", "table", "td",
        "blockquote", "figcaption", "body", "html", "dialog", "pre", "details", "fieldset", "dl")
NAMES = ("bias", "text", *(f"tag:{t}" for t in TAGS), "tag:other", *(f"cue:{c}" for c in CUES),
         *(f"leaf:{t}" for t in ("p", "h", "li", "div", "td", "other")), "words:1", "words:4", "words:15", "words:60", "words:more",
         "linked:none", "linked:some", "linked:most", "stop", "sign")
AT = {n: i for i, n in enumerate(NAMES)}


class Tree(HTMLParser):
    """Nodes of one page in document order: parent, depth, features; and the text of those that are text blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.depth, self.features, self.texts = [], [], [], []
        self.stack: list[tuple[str, int]] = []  # open elements and the node each belongs to
        self.hidden, self.links = 0, 0
        self.run: list[str] = []
        self.linked = 0

    def add(self, features: list[str], text: str | None) -> int:
        at = self.stack[-1][1] if self.stack else -1
        self.parent.append(at)
        self.depth.append(self.depth[at] + 1 if at >= 0 else 0)
        self.features.append([AT[f] for f in features])
        self.texts.append(text)
        return len(self.parent) - 1

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        linked, self.run, self.linked = self.linked, [], 0
        if not text:
            return
        tag = next((t for t, _ in reversed(self.stack) if t in BLOCKS), "other")
        kind = "h" if re.fullmatch("h[1-6]", tag) else tag if tag in ("p", "li", "div", "td") else "other"
        words = text.count(" ") + 1
        size = next((f"words:{n}" for n in (1, 4, 15, 60) if words <= n), "words:more")
        share = linked / len(text)
        found = ["bias", "text", f"leaf:{kind}", size, "linked:none" if not linked else "linked:some" if share < 0.5 else "linked:most"]
        if text[-1] in ".!?…:;\"'”»)":
            found.append("stop")
        if "©" in text or "™" in text:
            found.append("sign")
        self.add(found, text)

    def close_to(self, i: int) -> None:
        for tag, _ in self.stack[i:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
        del self.stack[i:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag == "hr":
            self.run.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag in BLOCKS:
            self.flush()
            heads = [i for i, (t, _) in enumerate(self.stack) if t == "head"] if self.hidden else []
            if heads:  # a head that was not closed ends where the body begins
                self.close_to(heads[0])
            ends = ENDS.get(tag, set()) | {"p"}
            for i in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[i][0]
                if open_tag in ends:
                    self.close_to(i)
                elif open_tag in BLOCKS and not (tag in ("tr", "td", "th") and open_tag in ("tr", "tbody")) or open_tag in ("ul", "ol", "dl", "table"):
                    break
        elif tag in HIDDEN:
            self.run.append(" ")
        node = self.stack[-1][1] if self.stack else -1
        if tag in BLOCKS and not self.hidden and (node < 0 or self.depth[node] < DEEPEST):
            words = {w for k, v in attrs if k in ("class", "id", "role") and v for w in re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", v).lower())}
            found = ["bias", f"tag:{tag}" if tag in TAGS else "tag:other", *{f"cue:{CUE_OF[w]}" for w in words if w in CUE_OF}]
            node = self.add(found, None)
        self.stack.append((tag, node))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # in html, the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[i][0]
            if open_tag == tag:
                self.close_to(i)
                return
            if tag not in BLOCKS and open_tag in BLOCKS:
                return  # a stray inline end tag does not close blocks

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.run.append(data)
            if self.links:
                self.linked += len(data.strip())


def parse(html: str | None) -> Tree:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    tree.flush()
    return tree


class Forest:
    """Many trees as arrays; nodes of one depth are passed together."""

    def __init__(self, trees: list[Tree]):
        base = np.cumsum([0, *(len(t.parent) for t in trees)])
        self.parent = np.array([p + b if p >= 0 else -1 for t, b in zip(trees, base) for p in t.parent], np.int64)
        depth = np.array([d for t in trees for d in t.depth], np.int64)
        rows = [f for t in trees for f in t.features]
        self.n = len(rows)
        self.at = np.repeat(np.arange(self.n), [len(r) for r in rows]) if rows else np.empty(0, np.int64)
        self.of = np.array([f for r in rows for f in r], np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if self.n else []
        self.base = base

    def unary(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, w[self.of], self.n)

    def pass_messages(self, w: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of state 1 per node, and the joint (parent state, own state) per node that has a parent."""
        up = np.zeros((self.n, 2))  # potential of a node and of all below it
        up[:, 1] = self.unary(w)
        message = np.zeros((self.n, 2))
        for level in reversed(self.levels):
            level = level[self.parent[level] >= 0]
            m = np.logaddexp(pair[:, 0] + up[level, :1], pair[:, 1] + up[level, 1:])
            message[level] = m
            np.add.at(up, self.parent[level], m)
        belief, joint = np.empty((self.n, 2)), np.zeros((self.n, 2, 2))
        for level in self.levels:
            has = self.parent[level] >= 0
            roots, level = level[~has], level[has]
            belief[roots] = up[roots] - np.logaddexp(up[roots, :1], up[roots, 1:])
            rest = belief[self.parent[level]] - message[level]
            j = rest[:, :, None] + pair + up[level][:, None, :]
            j -= np.logaddexp.reduce(j.reshape(-1, 4), axis=1)[:, None, None]
            joint[level] = np.exp(j)
            belief[level] = np.logaddexp(j[:, 0], j[:, 1])
        return np.exp(belief[:, 1]), joint


def states(tree: Tree, content: list[str]) -> np.ndarray:
    """1 for the text blocks of the article and for all elements around them."""
    left, y = list(content), np.zeros(len(tree.parent), np.int64)
    for i, text in enumerate(tree.texts):
        if left and text == left[0]:
            left.pop(0)
            while i >= 0 and not y[i]:
                y[i], i = 1, tree.parent[i]
    if left:
        raise ValueError("a labelled block is not in the page")
    return y


def fit(pages: list[tuple[str, list[str]]], rounds: int = 250, shrink: float = 2e-3) -> dict:
    """Weights of maximum likelihood, with a small quadratic penalty, by Adam steps."""
    trees = [parse(h) for h, _ in pages]
    y = np.concatenate([states(t, c) for t, (_, c) in zip(trees, pages, strict=True)])
    forest = Forest(trees)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[forest.parent[child]], y[child]), 1)
    z, m, v = np.zeros(len(NAMES) + 4), np.zeros(len(NAMES) + 4), np.zeros(len(NAMES) + 4)
    for step in range(1, rounds + 1):
        p, joint = forest.pass_messages(z[:-4], z[-4:].reshape(2, 2))
        g = np.concatenate([np.bincount(forest.of, (y - p)[forest.at], len(NAMES)), (seen - joint[child].sum(0)).ravel()]) / len(trees) - shrink * z
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        z = z + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"w": z[:-4], "pair": z[-4:].reshape(2, 2)}


def main_texts(pages: list[str | None], model: dict) -> list[str]:
    trees = [parse(h) for h in pages]
    forest = Forest(trees)
    p = forest.pass_messages(model["w"], model["pair"])[0]
    return ["\n\n".join(x for x, q in zip(t.texts, p[b:], strict=False) if x is not None and q > 0.5) for t, b in zip(trees, forest.base)]


def labelled_pages(n: int = 400, seed: int = 11) -> list[tuple[str, list[str]]]:
    """A fixed set of labelled pages: layouts that differ in elements, attribute words, order and lengths."""
    rng = random.Random(seed)
    pick, chance = rng.choice, rng.random

    stops = 0.5  # share of texts that end with a full stop, anew for each page

    def words(lo: int, hi: int, stop: bool = True) -> str:
        out = ["".join(pick(("ta", "re", "on", "le", "mi", "su", "ka", "dor")) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(lo, hi))]
        if chance() < 0.1:
            out = [w + pick(("###", "%%%", "***", "$$$")) for w in out]
        if chance() < 0.05:
            out = [w for x in out for w in (x, "|")]
        return " ".join(out).capitalize() + ("." if chance() < (stops if stop else stops / 2) else "")

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, pick((1, 1, 6)), False)}</a></li>' for i in range(n))

    def attrs(cue: str, always: float = 0.9) -> str:
        if chance() > always:
            return ""
        w = pick(CUES[cue].split())
        return pick((f' class="{w}"', f' id="{w}"', f' class="{w} {pick(("box", "wide", "left"))}"', f' class="site-{w}"' if cue != "content" else f' class="page-{w}"'))

    def prose() -> str:
        return words(*pick(((1, 3), (1, 12), (5, 40), (20, 160))))

    def around() -> list[str]:
        """Parts that are not the article."""
        out = [f"<{t}{attrs(c, a)}>{inner}</{t}>" for t, c, a, inner in (
            ("nav", "menu", 0.3, f"<ul>{links(rng.randint(3, 9))}</ul>"),
            ("div", "menu", 1, f"<ul>{links(rng.randint(3, 9))}</ul>"),
            ("ul", "menu", 1, links(rng.randint(3, 6))),
            ("header", "top", 0.4, f"<div>{words(1, 4, False)}</div>" + pick(("", f"<p>{words(3, 9)}</p>", f"<h1>{words(1, 3, False)}</h1>"))),
            ("div", "top", 1, f"<a href='/'>{words(1, 3, False)}</a>"),
            ("div", "advert", 1, pick((words(4, 12), f"<p>{words(4, 30)}</p>", f"<a href='x'>{words(3, 8)}</a>"))),
            ("div", "advert", 1, words(4, 12)),
            ("aside", "side", 0.4, f"<h3>{words(1, 3, False)}</h3>" + pick((f"<ul>{links(4)}</ul>", f"<p>{prose()}</p>", f"<p>{words(10, 60)}</p><p>{prose()}</p>"))),
            ("div", "side", 1, f"<h4>{words(1, 3, False)}</h4><ul>{links(5)}</ul><p>{prose()}</p>"),
            ("div", "notice", 1, f"<p>{words(5, 30)}</p><button>ok</button>"),
            ("section", "notice", 1, words(5, 30)),
            ("form", "form", 0.5, f"<label>{words(1, 3, False)}</label><input name=q>" + pick(("", f"<p>{words(3, 20)}</p>"))),
            ("div", "share", 1, f"<a href=s>{words(1, 1, False)}</a> <a href=t>{words(1, 1, False)}</a>"),
        )]
        return rng.sample(out, rng.randint(1, 6))

    def last() -> list[str]:
        out = []
        if chance() < 0.5:
            inner = "".join(pick((f'<div{attrs("comment")}><p>{prose()}</p></div>', f"<p>{prose()}</p>", f'<article class="comment"><p>{prose()}</p><p>{prose()}</p></article>',
                                  f"<li><b>{words(1, 2, False)}</b> <p>{prose()}</p></li>")) for _ in range(rng.randint(1, 12)))
            out.append(f"<{(t := pick(('div', 'section', 'ol')))}{attrs('comment', 1)}><h3>{words(1, 2, False)}</h3>{inner}</{t}>")
        foot = pick((f"&copy; {words(1, 4, False)}", f"<p>{words(3, 20)}</p>", f"&copy; {words(1, 2, False)} &middot; {words(3, 12)}", f"<ul>{links(4)}</ul><p>&copy; {words(2, 5)}</p>"))
        out.append(pick((f"<footer{attrs('bottom', 0.4)}>{foot}</footer>", f"<div{attrs('bottom', 1)}>{foot}</div>", "")))
        return out

    pages = []
    for _ in range(n):
        stops = chance()
        content, body = [], []
        for i in range(rng.randint(1, 14)):
            kind = "h1" if i == 0 and chance() < 0.7 else pick(("p", "p", "p", "p", "p", "h2", "li", "blockquote", "div", "td"))
            t = words(1, 12, chance() < 0.5) if kind in ("h1", "h2") else prose()
            content.append(t)
            linked = t if chance() < 0.9 or " " not in t else t.replace(" ", ' <a href="/l">', 1) + "</a>"
            if kind == "li":
                body.append(f"<ul><li>{linked}</li></ul>")
            elif kind == "td":
                body.append(f"<table><tr><td>{linked}</td></tr></table>")
            elif kind == "p":
                body.append(pick((f"<p>{linked}</p>", f"<p>{linked}", f"<p><b>{linked}<br>", f"<p><b>{linked}</b></p>")))
            else:
                body.append(f"<{kind}>{linked}</{kind}>")
        for _ in range(pick((0, 0, 1, 2))):
            body.insert(rng.randint(0, len(body)), pick(around()))
        after = last()
        if chance() < 0.4 and len(after) == 2:
            body.append(after.pop(0))
        tag = pick(("article", "article", "main", "div", "section"))
        core = f"<{tag}{attrs('content', 0.3 if tag in ('article', 'main') else 1)}>{''.join(body)}</{tag}>"
        for _ in range(pick((0, 0, 1, 2))):
            core = f"<div{pick(('', attrs('content'), ' class=wrap'))}>{core}</div>"
        parts = around()
        where = rng.randint(0, len(parts))
        page = "".join([*parts[:where], core, *parts[where:], *after])
        pages.append((f"<html><head><title>{words(1, 5)}</title></head><body>{page}</body></html>", content))
    return pages


@lru_cache(maxsize=1)
def trained() -> dict:
    return fit(labelled_pages())


def extract(pages: DataFrame, html: str = "html", model: dict | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) added; columns of these names are replaced. Map-only."""
    shared = ship(pages.sparkSession).sparkContext.broadcast(model or trained())  # some hundred bytes

    @F.pandas_udf("string")
    def text_of(batch: pd.Series) -> pd.Series:
        out: list[str] = []
        for i in range(0, len(batch), 64):  # bounded memory for batches of long pages
            out += main_texts(batch.iloc[i:i + 64].tolist(), shared.value)
        return pd.Series(out, dtype=object)

    found = pages.withColumn("__main_text", text_of(F.col(html)))
    return found.withColumns({"text": F.col("__main_text"), "n_chars": F.length("__main_text").cast("long")}).drop("__main_text")

