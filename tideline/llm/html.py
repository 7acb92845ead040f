"""Main text of web pages by tag-path ratios.

Every text node has a path of tags from the root.  Article text comes in few paths with much text and many marks of
punctuation per node; menus and notes come in paths with little of either.  Length and punctuation are
summed per path, put back on the nodes in page order, smoothed over neighbours, fused, and cut at a threshold.  The
container that holds the nodes above it is the article; what it holds besides (headings, short
paragraphs) belongs to it, unless a tag or a class name says that it is a menu, a form, an advert and the like.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "xmp", "noembed", "noframes")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
UNWANTED_TAGS = frozenset("head nav footer aside form button select option datalist dialog menu fieldset audio video map applet frameset".split())
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
UNWANTED_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices
    alert popup modal overlay newsletter subscribe subscription signup login paywall sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs
    pagination pager footer foot header masthead topbar toolbar comment comments commentlist respond reply replies disqus discussion reviews related recommended
    recommendations share sharing social widget widgets copyright skip search searchbox form""".split()
)
NOT_NAMES = frozenset("no without has with article post entry content main story".split())
CONTAINERS = frozenset("html body main article section div td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "p": frozenset(
        "p div ul ol dl table blockquote pre h1 h2 h3 h4 h5 h6 section article aside header footer nav form hr main address figure fieldset".split()
    ),
    **{h: HEADINGS for h in HEADINGS},
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
}
MARKS = re.compile(r"[.,;:!?…。，、！？؛،।]")
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+|[^a-z]+")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
WEIGHTS = (0.25, 0.5, 0.25)
SHARE_OF_BEST = 0.25


def _unwanted(tag: str, rest: str, inside_article: bool) -> tuple[bool, str]:
    """Whether the tag opens something that is no article text, and its class names."""
    if tag in UNWANTED_TAGS:
        return True, ""
    if tag == "header" and not inside_article:
        return True, ""
    label = ""
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in UNWANTED_ROLES):
            return True, ""
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for one in value.split():
                words = {w for w in NAME.findall(one) if w.isalpha()}
                if words & UNWANTED_NAMES and not words & NOT_NAMES:
                    return True, ""
            label += "." + value
    return False, label


class _Page:
    """Text nodes in page order: path, text and block of each.

    A path is a number; ``parent`` and ``name`` of the paths lead from each to the root, number 0, and a path comes after its parent.
    """

    def __init__(self, html: str) -> None:
        self.nodes: list[tuple[int, str, int]] = []
        self.parent, self.name, self.numbers = [0], [""], {}
        self.stack: list[tuple[str, bool, int]] = []
        self.places: dict[str, list[int]] = {}
        self.outer: list[int] = []
        self.block = self.off = self.articles = 0
        at = 0
        for token in TOKEN.finditer(html):
            if token.start() > at:
                self.text(html[at : token.start()])
            at = token.end()
            if tag := token["tag"]:
                tag = tag.lower()
                if token["close"]:
                    self.close(tag)
                else:
                    self.open(tag, token["rest"])
            elif token["raw"]:
                self.block += token["raw"].lower() not in INLINE
        if at < len(html):
            self.text(html[at:])

    def text(self, text: str) -> None:
        if not self.off:
            self.nodes.append((self.stack[-1][2] if self.stack else 0, unescape(text), self.block))

    def push(self, tag: str, off: bool, label: str) -> None:
        above, name = self.stack[-1][2] if self.stack else 0, tag + label
        path = self.numbers.setdefault((above, name), len(self.name))
        if path == len(self.name):
            self.parent.append(above)
            self.name.append(name)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        self.stack.append((tag, off, path))
        self.off += off
        self.articles += tag == "article"

    def pop(self) -> None:
        tag, off, _ = self.stack.pop()
        self.places[tag].pop()
        if tag not in INLINE:
            self.outer.pop()
            self.block += 1
        self.off -= off
        self.articles -= tag == "article"

    def open(self, tag: str, rest: str) -> None:
        self.block += tag not in INLINE
        if tag in VOID:
            return
        while self.stack and tag in CLOSED_BY.get(self.stack[-1][0], ()):
            self.pop()
        if tag in CLOSED_BY["p"] and 0 < (up := self.since("p")) <= 4 and all(t in INLINE for t, *_ in self.stack[len(self.stack) - up + 1 :]):
            self.close("p")
        if rest.endswith("/") and tag not in INLINE | CONTAINERS:
            return
        off, label = _unwanted(tag, rest, self.articles > 0)
        self.push(tag, off, label)

    def since(self, tag: str) -> int:
        """How many open elements there are from the innermost ``tag`` on; 0 for none."""
        places = self.places.get(tag)
        return len(self.stack) - places[-1] if places else 0

    def close(self, tag: str) -> None:
        depth = self.since(tag)
        if not depth or (tag in INLINE and self.outer and self.outer[-1] >= len(self.stack) - depth):
            self.block += tag not in INLINE
            return
        for _ in range(depth):
            self.pop()


def main_text(html: str | None) -> str:
    """The article text of one page; empty if there is none.  Time and memory grow with the page, however deep its elements are."""
    page = _Page(html or "")
    seen = [(path, text, block, len(text.strip())) for path, text, block in page.nodes]
    parent, tags = page.parent, [name.partition(".")[0] for name in page.name]
    totals: dict[int, list[int]] = {}
    for path, text, _, size in seen:
        if size:
            total = totals.setdefault(path, [0, 0, 0])
            total[0] += size
            total[1] += len(MARKS.findall(text))
            total[2] += 1
    if not totals:
        return ""
    fused = {path: size / n * (1 + marks / n) for path, (size, marks, n) in totals.items()}
    filled = [k for k, x in enumerate(seen) if x[3]]
    raw = [fused[seen[k][0]] for k in filled]
    ends = [raw[0], *raw, raw[-1]]
    smooth = [sum(w * v for w, v in zip(WEIGHTS, ends[k : k + 3], strict=True)) for k in range(len(raw))]
    least = SHARE_OF_BEST * max(smooth)
    chosen = {k for k, value, own in zip(filled, smooth, raw, strict=True) if value >= least and own >= least / 2}
    # chosen text under each path, children before parents, and how deep the path is
    weight, depth = [0] * len(tags), [0] * len(tags)
    for k in chosen:
        weight[seen[k][0]] += seen[k][3]
    for path in range(len(tags) - 1, 0, -1):
        weight[parent[path]] += weight[path]
    for path in range(1, len(tags)):
        depth[path] = depth[parent[path]] + 1
    holders = (p for p in range(len(tags)) if weight[p] >= 0.75 * weight[0] and (not p or tags[p] in CONTAINERS))
    root = max(holders, key=depth.__getitem__)
    article, up = False, root
    while up and not article:
        article, up = tags[up] in ("article", "main"), parent[up]
    # the path one below the container that each path lies in; the container is its own, -1 is outside
    branch = [-1] * len(tags)
    branch[root] = root
    for path in range(root + 1, len(tags)):
        branch[path] = path if parent[path] == root else branch[parent[path]]
    deep = {branch[seen[k][0]] for k in chosen}

    def kept(k: int, path: int) -> bool:
        own = branch[path]
        return own >= 0 and (article or k in chosen or own in deep or (own != root and tags[own] not in CONTAINERS))

    blocks: dict[int, list[str]] = {}
    for k, (path, text, block, _) in enumerate(seen):
        if kept(k, path):
            blocks.setdefault(block, []).append(text)
    joined = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return " ".join(x for x in joined if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars): one row per row of ``pages``.

    One scan, no shuffle, each page by itself.  A null or empty page, and one without text, has an
    empty text of length zero.  Repeated rows and null ids or URLs pass through; other columns are not read.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def build(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        return {
            id_col: batch.column(0),
            url_col: batch.column(1),
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(x) for x in texts], pa.int64()),
        }

    schema = ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "text string", "n_chars bigint"])
    return map_batches(pages.select(id_col, url_col, html_col), schema, build)
