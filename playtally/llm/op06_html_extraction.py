"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its elements. Every element has a hidden label, content
or not, with evidence from its tag, the word families in its class, id and role,
its share of linked text, its amount of text and its punctuation. A parent and a
child are tied by a potential that depends on the kind of child. Sum-product
messages pass upward (leaves to root) and downward (root to leaves); together
they give each element's exact content marginal. The text that stands directly
in elements with a marginal of at least one half is the page's main text.

Both potential tables are counted, with smoothing, on labelled pages
(``labelled_pages``). Messages of all pages of an Arrow batch pass together, one
array operation per tree depth. Pages are independent: one narrow pass, no
shuffle.

Text rules: character references are decoded; scripts, styles, templates, frames'
fallbacks, comments and the head are never text; formulas, drawings, objects and
noscript are elements like others, kept or not by their label; block elements end a text block, other
tags do not; white space inside a block (a line break tag counts as white space)
becomes one space; blocks are trimmed, empty ones dropped, and joined by one
line feed in page order. Malformed pages are read leniently: unclosed elements
close with their parent, stray end tags are ignored, a page cut inside a tag
ends before it.

Defined results: a null or empty page, and a page without content, gives the
empty text. Repeated rows repeat. Only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package
from playtally.llm.labelled_pages import labelled_pages
from playtally.llm.textscan import shards

SLICE_BYTES = 4 << 20     # pages handled at once inside a task
SMOOTHING = 0.5

# Fixed values of HTML: elements without content, with raw content, that are blocks, and
# those whose start tag ends an open element of the listed names.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style iframe template xmp noframes noembed title".split())
_FOREIGN = {"svg", "math"}  # inside these any start tag may close itself
_BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
             "option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th"}, "body": {"head"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "tbody": {"table"}, "option": {"select"}, "body": {"html"}}
_ENDS_P = _BLOCK - {"body", "html", "head", "button", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot",
                    "title", "legend", "select", "textarea"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<!doctype[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(>|\Z)|([^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+\Z")
_NAME_PARTS = re.compile(r"[a-z]+")

# Families of tags and of words in class, id and role, by what they usually hold.
_TAGS = {name: i for i, names in enumerate((
    "article main", "p", "h1 h2 h3 h4 h5 h6 hgroup", "blockquote pre figure figcaption", "nav menu", "aside",
    "header", "footer address", "form label input select option textarea fieldset legend dialog", "button", "a",
    "ul ol dl", "li dt dd", "table tbody thead tfoot tr", "td th", "div section", "body html",
    "b strong i em u small span font code sub sup mark abbr cite q s")) for name in names.split()}
_OTHER_TAG = max(_TAGS.values()) + 1
_WORDS = {name: i for i, names in enumerate((
    "", "article content post entry story body text main blog page",
    "nav menu navigation navbar breadcrumb breadcrumbs topbar pagination pager tags",
    "sidebar aside complementary widget related recommended share social",
    "ad ads advert advertisement adverts banner sponsor sponsored promo",
    "cookie cookies consent notice alert popup modal overlay dialog newsletter subscribe signup gdpr",
    "comment comments reply replies respond discussion disqus reader",
    "footer copyright contentinfo legal header masthead logo tagline",
    "search form login")) for name in names.split()}
# Kinds of parent-child potentials: the child is a container block, a text block right in the body,
# another text block, or inline.
_KINDS = 4
# Tags that stand for a word family by themselves.
_TAG_WORDS = {"article": "article", "main": "main", "nav": "nav", "menu": "menu", "aside": "aside", "footer": "footer",
              "header": "header", "form": "form", "dialog": "dialog"}
_INHERIT = 2  # levels over which an element also counts as part of its ancestors' non-content families
_FEW = 6      # elements of a level that are handled one by one
_CONTAINERS = set("html body div section article main aside nav header footer form table tbody tr td ul ol dl "
                  "details fieldset dialog menu".split())


@dataclass
class Page:
    """A parsed page: one entry per element, and the text runs in order."""

    tags: list[str] = field(default_factory=list)
    names: list[int] = field(default_factory=list)     # bit set of word families
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)     # labels of labelled pages
    runs: list[tuple[int, int, str]] = field(default_factory=list)  # element, block, decoded text


def parse(source: str) -> Page:
    """Tree of the elements and text runs of one page."""
    page, stack, block, at = Page(), [], 0, 0
    # Depths of the open elements of each name, and of the open blocks other than p: no tag looks
    # through the whole stack.
    where: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []

    def close(depth: int) -> None:
        nonlocal block
        gone = [page.tags[e] for e in stack[depth:]]
        for tag in gone:
            where[tag].pop()
        while blocks and blocks[-1] >= depth:
            blocks.pop()
        if any(tag in _BLOCK for tag in gone):
            block += 1
        del stack[depth:]

    def enter(name: str, attributes: str) -> None:
        where[name].append(len(stack))
        if name in _BLOCK and name != "p":
            blocks.append(len(stack))
        _open(page, stack, name, attributes)

    def nearest(names: set[str]) -> int:
        return max((where[x][-1] for x in names if where[x]), default=-1)

    while (token := _TOKEN.match(source, at)) is not None:
        at = token.end()
        slash, name, attributes, end, text = token.groups()
        if text is not None:
            # A sibling-less run before any element still needs one to hang on.
            if not stack and not text.isspace():
                enter("body", "")
            if stack:
                page.runs.append((stack[-1], block, entities.unescape(text)))
            continue
        if name is None or not end:
            continue
        name = name.lower()
        if slash:
            if where[name]:
                close(where[name][-1])
            continue
        if attributes.endswith("/") and not _ends_unquoted(attributes) and (
                name in _RAW or name in _FOREIGN or name == "object" or any(where[x] for x in _FOREIGN)):
            continue
        in_head = name == "noscript" and stack and page.tags[stack[-1]] == "head"
        if name in _RAW or in_head:
            stop = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            if stop or not in_head:
                at = stop.end() if stop else len(source)
                continue
        if name == "br":
            if stack:
                page.runs.append((stack[-1], block, " "))
            continue
        if name in _CLOSES:
            # The open elements that this one ends, from the innermost on, up to its scope.
            while (depth := nearest(_CLOSES[name])) >= 0 and depth >= (scope := nearest(_SCOPE.get(name, set()))):
                close(depth)
                if depth == scope:
                    break
        if name in _ENDS_P and where["p"] and where["p"][-1] > (blocks[-1] if blocks else -1):
            close(where["p"][-1])
        if name in _BLOCK:
            block += 1
        if name not in _VOID:
            enter(name, attributes)
    return page


def _ends_unquoted(attributes: str) -> bool:
    """Whether the last attribute has an unquoted value (which holds a slash that ends it)."""
    stop = attributes.rfind("=")
    return stop >= 0 and _UNQUOTED_END.search(attributes, stop) is not None


def _open(page: Page, stack: list[int], name: str, attributes: str) -> None:
    families, mark = 0, ""
    if attributes:
        for found in _ATTRIBUTE.finditer(attributes):
            for word in _NAME_PARTS.findall((found[2] or found[3] or found[4] or "").lower()):
                families |= 1 << _WORDS.get(word, 0)
        mark = "c" if "[c]" in attributes else "x" if "[x]" in attributes else ""
    parent = stack[-1] if stack else -1
    page.tags.append(name)
    if name in _TAG_WORDS:
        families |= 1 << _WORDS[_TAG_WORDS[name]]
    page.names.append(families & ~1)
    page.parents.append(parent)
    page.depths.append(len(stack))
    page.marks.append(mark)
    stack.append(len(page.tags) - 1)


@dataclass
class Forest:
    """Elements of many pages as arrays; ``evidence``: a value per evidence kind."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    evidence: np.ndarray
    first: list[int]


#: Values of each evidence kind: tag, eight word families (absent, present), linked share, amount, punctuation.
_VALUES = (_OTHER_TAG + 1, *[2] * 8, 5, 7, 5)


def forest(pages: list[Page]) -> Forest:
    first, n = [], 0
    for page in pages:
        first.append(n)
        n += len(page.tags)
    parent = np.full(n, -1)
    depth, tag, kind, names, link = (np.zeros(n, np.int64) for _ in range(5))
    chars, marks = np.zeros(n), np.zeros(n)
    for page, base in zip(pages, first, strict=True):
        m = len(page.tags)
        if not m:
            continue
        own = np.array(page.parents)
        parent[base:base + m] = np.where(own < 0, -1, own + base)
        depth[base:base + m] = page.depths
        names[base:base + m] = page.names
        tag[base:base + m] = [_TAGS.get(t, _OTHER_TAG) for t in page.tags]
        kind[base:base + m] = [0 if t in _CONTAINERS else 3 if t not in _BLOCK else
                               1 if p < 0 or page.tags[p] == "body" else 2
                               for t, p in zip(page.tags, page.parents, strict=True)]
        link[base:base + m] = [t == "a" for t in page.tags]
        for element, _, text in page.runs:
            size = len(text.strip())
            if size:
                chars[base + element] += size
                marks[base + element] += sum(map(text.count, ".,;!?"))
    # A parent stands before its children: links go down in order, sums go up against it.
    above, linked_to = parent.tolist(), link.tolist()
    for i, p in enumerate(above):
        if p >= 0 and linked_to[p]:
            linked_to[i] = 1
    link = np.array(linked_to, np.int64)
    inner = np.array([t not in ("html", "body") for page in pages for t in page.tags], dtype=np.int64)
    near = names
    for _ in range(_INHERIT):
        held = near * inner & ~2  # all families but content's own
        near = names | np.where(parent >= 0, held[parent], 0)
    sums = [values.tolist() for values in (chars, marks, chars * link)]
    for i in range(n - 1, -1, -1):
        if (p := above[i]) >= 0:
            for values in sums:
                values[p] += values[i]
    chars, marks, linked = (np.array(values) for values in sums)
    share = np.digitize(linked / np.maximum(chars, 1), [0.01, 0.3, 0.7, 0.99])
    amount = np.digitize(chars, [1, 20, 60, 150, 400, 1500])
    density = np.where(chars > 0, 1 + np.digitize(marks / np.maximum(chars, 1), [0.001, 0.01, 0.03]), 0)
    families = [(near >> i) & 1 for i in range(1, 9)]
    return Forest(parent, depth, kind, np.stack([tag, *families, share, amount, density]), first)


@dataclass
class TreeModel:
    """``evidence[k][label, value]`` and ``tie[kind][parent label, child label]``: log potentials."""

    prior: np.ndarray
    evidence: list[np.ndarray]
    tie: np.ndarray

    def marginals(self, trees: Forest) -> np.ndarray:
        """P(content) of every element, by upward and downward messages."""
        local = np.zeros((len(trees.parent), 2))
        for table, values in zip(self.evidence, trees.evidence, strict=True):
            local += table[:, values].T
        roots = trees.parent < 0
        local[roots] += self.prior
        order = np.argsort(trees.depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(trees.depth))[:-1]) if len(order) else []
        up = np.zeros_like(local)
        belief = local.copy()
        # Levels of a few elements, of which a deeply nested page has very many, go without arrays.
        for some in levels[:0:-1]:
            if len(some) <= _FEW:
                self._up_few(some.tolist(), trees, belief, up)
                continue
            up[some] = np.logaddexp.reduce(belief[some][:, None, :] + self.tie[trees.kind[some]], axis=2)
            np.add.at(belief, trees.parent[some], up[some])
        for some in levels[1:]:
            if len(some) <= _FEW:
                self._down_few(some.tolist(), trees, belief, up)
                continue
            above = belief[trees.parent[some]] - up[some]
            belief[some] += np.logaddexp.reduce(above[:, :, None] + self.tie[trees.kind[some]], axis=1)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


    def _up_few(self, some: list[int], trees: Forest, belief: np.ndarray, up: np.ndarray) -> None:
        for i in some:
            (a, b), (c, d) = self.tie[trees.kind.item(i)].tolist()
            x, y, p = belief.item(i, 0), belief.item(i, 1), trees.parent.item(i)
            up[i, 0], up[i, 1] = off, on = _log_sum(x + a, y + b), _log_sum(x + c, y + d)
            belief[p, 0] += off
            belief[p, 1] += on

    def _down_few(self, some: list[int], trees: Forest, belief: np.ndarray, up: np.ndarray) -> None:
        for i in some:
            (a, b), (c, d) = self.tie[trees.kind.item(i)].tolist()
            p = trees.parent.item(i)
            x, y = belief.item(p, 0) - up.item(i, 0), belief.item(p, 1) - up.item(i, 1)
            belief[i, 0] += _log_sum(x + a, y + c)
            belief[i, 1] += _log_sum(x + b, y + d)


def _log_sum(x: float, y: float) -> float:
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


def train_model(sources: Iterator[str] | None = None, smoothing: float = SMOOTHING) -> TreeModel:
    """Count both potential tables on labelled pages."""
    pages = [parse(s) for s in (labelled_pages() if sources is None else sources)]
    trees = forest(pages)
    label = np.zeros(len(trees.parent), np.int64)
    for page, base in zip(pages, trees.first, strict=True):
        for i, (mark, parent) in enumerate(zip(page.marks, page.parents, strict=True)):
            inherited = label[base + parent] if parent >= 0 else 0
            label[base + i] = 1 if mark == "c" else 0 if mark == "x" else inherited

    def log_rows(counts: np.ndarray) -> np.ndarray:
        return np.log(counts / counts.sum(-1, keepdims=True))

    evidence = []
    for values, size in zip(trees.evidence, _VALUES, strict=True):
        counts = np.full((2, size), smoothing)
        np.add.at(counts, (label, values), 1)
        evidence.append(log_rows(counts))
    child = np.flatnonzero(trees.parent >= 0)
    tie = np.full((_KINDS, 2, 2), smoothing)
    np.add.at(tie, (trees.kind[child], label[trees.parent[child]], label[child]), 1)
    prior = np.full(2, smoothing)
    np.add.at(prior, label[trees.parent < 0], 1)
    return TreeModel(log_rows(prior), evidence, log_rows(tie))


def extract(pages: list[Page], model: TreeModel) -> list[str]:
    """Main text of each page."""
    trees = forest(pages)
    content = model.marginals(trees) >= 0.5
    out = []
    for page, base in zip(pages, trees.first, strict=True):
        blocks: dict[int, list[str]] = {}
        for element, block, text in page.runs:
            if content[base + element]:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join("".join(parts).split()) for parts in blocks.values())
        out.append("\n".join(x for x in joined if x))
    return out


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    share_package(pages.sparkSession)
    model = train_model()

    @F.arrow_udf("string")
    def main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts: list[str] = []
            for piece in shards(pc.fill_null(batch, ""), SLICE_BYTES):
                texts += extract([parse(source) for source in piece.to_pylist()], model)
            yield pa.array(texts, pa.string())

    return (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), main_text(F.col(html)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
