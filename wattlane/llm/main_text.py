"""Main text of web pages: gradient-boosted trees over DOM nodes and a hierarchical decoding.

A page becomes a tree of block elements.  Features of a node are what it is, words in its attributes and in
those of its ancestors, text and link density of its subtree, depth, and how it compares with its siblings.  Trees say
how likely a node holds main text.  Choices are then made for whole subtrees: a node is opened (it holds main
text, its children decide for themselves) or dropped with all below it, whichever has the larger likelihood, so a
kept paragraph never stands in a dropped container.

The trees are fitted on pages that are generated with known main text (``example``): layouts with and without
semantic elements, menus, adverts, notices, forms, related links and comments.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.llm.boosting import Trees, train
from wattlane.llm.texts import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea)(?=[\s/>]|\Z).*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>\"'<]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(noscript|template|select|button|svg|object|iframe|title)(?=[\s/>])[^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?]")

#: Elements by kind; all others are part of the line.  Fixed values of the markup language.
KINDS = {
    "paragraph": "p blockquote pre figcaption dd dt address td th caption",
    "heading": "h1 h2 h3 h4 h5 h6",
    "item": "li",
    "list": "ul ol dl",
    "content": "article main",
    "chrome": "nav footer header aside form menu dialog fieldset",
    "generic": "div section body html center figure details summary hgroup",
    "table": "table tbody thead tfoot tr",
}
_KIND = {tag: k for k, tags in enumerate(KINDS.values()) for tag in tags.split()}
#: Elements that a start tag closes when they are open.
_CLOSES = {"li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SPACES = {"br", "hr", "img", "input", "wbr"}
#: Elements that hold no text of the page.  Without an end tag they last until the next tag of a block.
_HIDDEN = {"noscript", "template", "select", "button", "svg", "object", "iframe", "title"}

#: Words in attributes that speak against and for main text.
AGAINST = set("""ad ads advert advertisement banner sponsor sponsored promo nav navbar menu breadcrumb breadcrumbs header
masthead footer sidebar widget related recommend share social comment comments reply disqus cookie consent notice
popup modal newsletter subscribe login signup search form tags pagination pager copyright legal toolbar skip""".split())
FOR = set("article content main post entry story body text articlebody postbody prose".split())


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: list[str]
    runs: list[tuple[int, list[str]]] = field(default_factory=list)
    linked: int = 0


def _name(m: re.Match[str]) -> str:
    """Name of a tag; empty for other tokens and for drawings that end where they begin."""
    name = (m[3] or m[5] or "").lower()
    return "" if name == "svg" and not m[2] and (m[4] or "").endswith("/") else name


def _hidden_ends(tokens: list[re.Match[str]]) -> dict[int, int]:
    """The end tag of each hidden element that has one before the end of a block around it, as numbers of tokens."""
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    ends = {}
    for k, m in enumerate(tokens):
        name = _name(m)
        if name not in _HIDDEN and name not in _KIND:
            continue
        if not m[2]:
            stack.append((name, k))
            opened[name] += 1
        elif opened[name]:
            top = ""
            while top != name:
                top, start = stack.pop()
                opened[top] -= 1
            if name in _HIDDEN:
                ends[start] = k
    return ends


def parse(source: str) -> list[Node]:
    """Block elements in page order; texts are kept as runs (order in the page, pieces) of the element they are in."""
    nodes = [Node("html", -1, 0, [])]
    stack, inside_link, order, last = [0], 0, 0, 0
    fresh, hidden = True, False

    def add(text: str) -> None:
        nonlocal order, fresh
        if hidden:
            return
        node = nodes[stack[-1]]
        if fresh or not node.runs:
            if not text.strip():
                return
            node.runs.append((order, []))
            order += 1
            fresh = False
        node.runs[-1][1].append(text)
        if inside_link:
            node.linked += len(text.strip())

    tokens = list(_TOKEN.finditer(source))
    ends = _hidden_ends(tokens)
    for k, m in enumerate(tokens):
        if m.start() < last:
            continue  # inside a hidden element
        if m.start() > last:
            add(source[last:m.start()])
        last = tokens[ends.get(k, k)].end()
        name = _name(m)
        if name not in _KIND:
            if name in _HIDDEN:
                hidden = hidden or not m[2] and k not in ends
            elif name == "a":
                inside_link = max(0, inside_link + (-1 if m[2] else 1)) if m[2] else 1
            elif name in _SPACES and not fresh:
                add(" ")
            continue
        fresh, hidden, inside_link = True, False, 0
        if m[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == name:
                    del stack[depth:]
                    break
            continue
        closes = _CLOSES.get(name, {"p"}) | ({"h1", "h2", "h3", "h4", "h5", "h6"} if name[0] == "h" and name[1:].isdigit() else set())
        while len(stack) > 1 and nodes[stack[-1]].tag in closes:
            stack.pop()
        words = [w for a in _ATTRIBUTE.findall(m[4] or "") for w in _WORD.findall("".join(a).lower())]
        nodes.append(Node(name, stack[-1], len(stack), words))
        stack.append(len(nodes) - 1)
    if last < len(source):
        add(source[last:])
    return nodes


def blocks(nodes: list[Node]) -> list[list[tuple[int, str]]]:
    """Of each node its blocks: order and text, references decoded, white space as one space, empty ones left out."""
    out = []
    for node in nodes:
        made = [(at, " ".join(html.unescape("".join(pieces)).split())) for at, pieces in node.runs]
        out.append([(at, text) for at, text in made if text])
    return out


def features(nodes: list[Node], texts: list[list[tuple[int, str]]]) -> np.ndarray:
    n = len(nodes)
    parent = [x.parent for x in nodes]
    own = [sum(len(t) for _, t in b) for b in texts]
    chars, links = own[:], [x.linked for x in nodes]
    marks = [sum(len(_MARKS.findall(t)) for _, t in b) for b in texts]
    count, children = [1] * n, [0] * n
    paragraphs = [int(_KIND.get(x.tag) == 0 and o > 0) for x, o in zip(nodes, own, strict=True)]
    place, in_children = [0] * n, [0] * n
    for k in range(1, n):
        place[k] = children[parent[k]]
        children[parent[k]] += 1
    for k in range(n - 1, 0, -1):
        p = parent[k]
        for total in (chars, links, marks, count, paragraphs):
            total[p] += total[k]
        in_children[p] += chars[k]
    bad = [sum(w in AGAINST for w in x.words) for x in nodes]
    good = [sum(w in FOR for w in x.words) for x in nodes]
    above = np.zeros((n, 4))
    kinds = [_KIND.get(x.tag, 6) for x in nodes]
    rows = np.zeros((n, len(KINDS) + 17))
    for k, node in enumerate(nodes):
        p = max(parent[k], 0)
        if k:
            above[k] = above[p] + (bad[p] > 0, good[p] > 0, kinds[p] == 5, kinds[p] == 4)
        near = max(children[p], 1)
        rows[k, kinds[k]] = 1
        rows[k, len(KINDS):] = (
            bad[k], good[k], *above[k], own[k], chars[k], links[k] / (chars[k] + 1), marks[k] / (chars[k] + 1),
            chars[k] / count[k], node.depth, near, place[k] / near, in_children[p] / near, paragraphs[k],
            chars[k] / (chars[0] + 1))
    return rows


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """Which nodes are opened, by the largest likelihood of choices that agree along every path."""
    yes, no = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    drop, keep = no.copy(), yes.copy()
    for k in range(len(nodes) - 1, 0, -1):
        drop[nodes[k].parent] += drop[k]
        keep[nodes[k].parent] += max(drop[k], keep[k])
    opened = np.zeros(len(nodes), bool)
    opened[0] = True  # a page may hold main text outside of any element
    for k in range(1, len(nodes)):
        opened[k] = opened[nodes[k].parent] and keep[k] >= drop[k]
    return opened


def extract(trees: Trees, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    parsed = [parse(p or "") for p in pages]
    texts = [blocks(p) for p in parsed]
    if not parsed:
        return []
    logit = trees.logits(np.concatenate([features(p, t) for p, t in zip(parsed, texts, strict=True)]))
    out, at = [], 0
    for nodes, own in zip(parsed, texts, strict=True):
        opened = decode(nodes, logit[at:at + len(nodes)])
        # Text that stands in the page itself is judged by the page's own node.
        opened[0] &= bool(logit[at] >= 0)
        at += len(nodes)
        out.append("\n".join(t for _, t in sorted(b for k in np.flatnonzero(opened) for b in own[k])))
    return out


def example(draw: random.Random) -> tuple[str, list[bool]]:
    """A generated page, and for each block in page order whether it is main text."""
    truth: list[bool] = []

    def say(n: int, main: bool) -> str:
        truth.append(main)
        words = ["".join(draw.choice(("ta", "ler", "in", "mo", "se", "k", "an", "du", "ri", "p")) for _ in range(draw.randint(1, 4))) for _ in range(n)]
        for k in range(draw.randint(5, 12), n, draw.randint(6, 14)):
            words[k] += draw.choice((".", ",", ".", ";"))
        return " ".join(words).capitalize() + ("." if n > 6 else "")

    def links(n: int, wrap: str) -> str:
        return wrap % "".join(f'<li><a href="/{k}">{say(draw.randint(1, 4), False)}</a></li>' for k in range(n))

    def chrome(kind: str) -> str:
        if kind == "nav":
            return links(draw.randint(2, 9), draw.choice(("<nav><ul>%s</ul></nav>", '<div class="menu"><ul>%s</ul></div>', '<div id="navbar"><ul>%s</ul></div>')))
        if kind == "ad":
            return f'<div class="{draw.choice(("ad", "banner", "promo box", "sponsored"))}">{say(draw.randint(3, 40), False)}</div>'
        if kind == "aside":
            return f"<aside><h3>{say(2, False)}</h3>" + links(draw.randint(2, 6), "<ul>%s</ul>") + f"<p>{say(draw.randint(4, 40), False)}</p></aside>"
        if kind == "sidebar":
            return f'<div class="sidebar"><p>{say(draw.randint(3, 50), False)}</p>' + links(3, "<ul>%s</ul>") + "</div>"
        if kind == "notice":
            return f'<div class="{draw.choice(("cookie-notice", "consent", "notice"))}"><p>{say(draw.randint(8, 40), False)}</p></div>'
        if kind == "form":
            return f'<form action="/s"><p>{say(draw.randint(2, 12), False)}</p><input name="q"><button>ok</button></form>'
        if kind == "comments":
            inside = "".join(f'<div class="comment"><p>{say(draw.randint(4, 60), False)}</p></div>' for _ in range(draw.randint(1, 5)))
            return draw.choice(('<div id="comments">%s</div>', '<section class="comments">%s</section>')) % inside
        if kind == "header":
            return f'<header><h2>{say(3, False)}</h2><p>{say(draw.randint(3, 14), False)}</p></header>'
        return draw.choice(("<footer>%s</footer>", '<div class="footer">%s</div>', "<footer><p>%s</p></footer>")) % say(draw.randint(3, 30), False)

    def article() -> str:
        parts = [f"<h1>{say(draw.randint(3, 9), True)}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.choice((0, 1, 2, 3, 5, 8, 14))):
            kind = draw.random()
            if kind < 0.08:
                parts.append(f"<h2>{say(draw.randint(2, 6), True)}</h2>")
            elif kind < 0.15:
                parts.append("<ul>" + "".join(f"<li>{say(draw.randint(3, 15), True)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
            elif kind < 0.2:
                parts.append(f"<blockquote>{say(draw.randint(6, 30), True)}</blockquote>")
            elif kind < 0.25:
                parts.append(chrome("ad"))
            elif kind < 0.32:
                parts.append(f"<p><b>{say(draw.randint(4, 20), True)}<br>")
            else:
                parts.append(f"<p>{say(draw.choice((2, 5, 12, 30, 60, 120)), True)}</p>")
        if not parts:
            parts.append(f"<p>{say(30, True)}</p>")
        wrap = draw.choice(("<article>%s</article>", "<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>',
                            '<div id="main"><div class="post">%s</div></div>', "<div>%s</div>", "<main><article>%s</article></main>"))
        return wrap % "".join(parts)

    if draw.random() < 0.06:
        return f"<html><body>{say(draw.randint(8, 80), True)}</body></html>", truth
    page = "".join(chrome(k) for k in ("header", "nav", "notice", "ad") if draw.random() < 0.5)
    page += article() + "".join(chrome(k) for k in ("comments", "aside", "sidebar", "form", "ad", "footer") if draw.random() < 0.4)
    return f"<html><head><title>x</title></head><body>{page}</body></html>", truth


@cache
def fitted(pages: int = 600, seed: int = 11) -> Trees:
    """Trees fitted on generated pages; a container is a positive if it holds a main block."""
    draw, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        page, truth = example(draw)
        nodes = parse(page)
        texts = blocks(nodes)
        label = np.zeros(len(nodes))
        for k, own in enumerate(texts):
            label[k] = any(truth[at] for at, _ in own)
        for k in range(len(nodes) - 1, 0, -1):
            label[nodes[k].parent] = max(label[nodes[k].parent], label[k])
        label[0] = any(truth[at] for at, _ in texts[0])
        xs.append(features(nodes, texts))
        ys.append(label)
    return train(np.concatenate(xs), np.concatenate(ys))


def main_text(spark: SparkSession, pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` (empty if there is none) and ``n_chars``.

    NULL and empty pages give an empty text; broken markup is closed as far as the element rules say; an
    empty table gives an empty result.
    """
    shared = spark.sparkContext.broadcast(trees or fitted())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                texts = extract(shared.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
