"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive, tags negative;
the contiguous run of highest sum, found in one linear scan, is the content
region.  Weights are log odds of being inside the content, counted on labelled
pages.  Boilerplate elements (menus, forms, adverts, comments ...) are cut out
wherever they stand.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Element names by role.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
SKIPPED = (*RAW, "head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "noscript",
           "template", "svg", "canvas", "object", "audio", "video", "menu", "dialog", "fieldset", "label", "input")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "mark", "q", "ruby", "rb", "rt", "rp", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
CONTENT = ("article", "main")
# Words of class, id, role and aria-label that name boilerplate.
NAMED = ("ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
         "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav",
         "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promoted", "related",
         "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
         "complementary", "contentinfo", "search")
#: Pages that the weights are counted on, about.
MAX_PAGES = 2000

# A tag's attributes: quotes open a value only behind an equals sign, as in browsers.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)"
                    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in RAW}
_NAME = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
# Scripts written without spaces (Thai to Khmer, kana, Han): each character counts as a word.
_BARE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_COUNTED = re.compile(rf"[{_BARE}]|[^\s{_BARE}]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SKIPPED, _VOID, _INLINE, _NAMED = map(frozenset, (SKIPPED, VOID, INLINE, NAMED))
_LEAVES = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "pre", "blockquote", "tr", "td"))
# Elements whose start closes an open paragraph.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}


@dataclass(slots=True)
class Item:
    """A tag (``name`` set) or a text of a page, in page order.

    ``node`` numbers the innermost open element (0: none) and ``depth`` counts
    the open ones; ``skip`` tells that one of them is boilerplate, ``linked``
    that one is a link."""
    name: str
    text: str
    node: int
    depth: int
    skip: bool
    linked: bool


@dataclass(slots=True)
class Element:
    """An element that can hold others: its items are ``start`` to ``end``."""
    name: str
    parent: int
    start: int
    end: int


@dataclass(slots=True)
class Page:
    """A parsed page; ``elements[0]`` stands for the page itself."""
    items: list[Item]
    elements: list[Element]


def _n_words(text: str) -> int:
    if "&#" in text:
        text = html.unescape(text)
    return len(text.split()) if text.isascii() else len(_COUNTED.findall(text))


def _boilerplate(name: str, attrs: str) -> bool:
    if name in _SKIPPED:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    if _HIDDEN.search(attrs):
        return True
    return any(w in _NAMED for m in _NAME.finditer(attrs)
               for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[1] or m[2] or m[3] or "").lower()))


class _Open:
    """The open elements, innermost last.  Every step takes constant time, or
    time that an element's opening has paid for, however deep they nest."""

    def __init__(self, page: Page):
        self.page = page
        self.stack: list[tuple[str, int, bool]] = []  # name, number, skip
        self.by_name: dict[str, list[int]] = {}  # places in the stack
        self.blocks: list[int] = []  # those that are not inline
        self.walls: list[int] = []  # content and boilerplate

    def last(self, name: str) -> int:
        return (self.by_name.get(name) or (-1,))[-1]

    def push(self, name: str, skip: bool) -> None:
        items, elements = self.page.items, self.page.elements
        at = len(self.stack)
        self.by_name.setdefault(name, []).append(at)
        if name not in _INLINE:
            self.blocks.append(at)
        if name in _SKIPPED or name in CONTENT:
            self.walls.append(at)
        elements.append(Element(name, self.stack[-1][1] if self.stack else 0, len(items), -1))
        self.stack.append((name, len(elements) - 1, skip))

    def close(self, at: int) -> None:
        """Close the element at a place, and all in it."""
        while len(self.stack) > at:
            name, number, _ = self.stack.pop()
            self.page.elements[number].end = len(self.page.items)
            self.by_name[name].pop()
        for places in (self.blocks, self.walls):
            while places and places[-1] >= at:
                places.pop()

    def item(self, name: str, text: str) -> None:
        _, node, skip = self.stack[-1] if self.stack else ("", 0, False)
        self.page.items.append(Item(name, text, node, len(self.stack), skip, bool(self.by_name.get("a"))))


def parse(page: str) -> Page:
    """The page's tags and texts; unclosed and stray tags are tolerated."""
    out = Page([], [Element("", 0, 0, -1)])
    open_, at = _Open(out), 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            open_.item("", page[at:])
            break
        if m.start() > at:
            open_.item("", page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            found = open_.last(name)
            # a block's end does not reach beyond the content or boilerplate around it
            if found >= 0 and found >= (open_.walls[-1] if open_.walls else -1):
                open_.close(found)
                open_.item(f"/{name}", "")
            continue
        if name not in _INLINE:  # a new block ends an open paragraph and its like
            while open_.blocks:
                k = open_.blocks[-1]
                other = open_.stack[k][0]
                if not (other == "p" and name not in _SKIPPED or other in _CLOSES.get(name, ())):
                    break
                open_.close(k)
        if name == "a":  # links do not nest
            while open_.last("a") > (open_.blocks[-1] if open_.blocks else -1):
                open_.close(open_.last("a"))
        skip = bool(open_.stack) and open_.stack[-1][2] or _boilerplate(name, m[3])
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name not in _VOID:
            open_.push(name, skip)
        open_.item(name, "")
    open_.close(0)
    out.elements[0].end = len(out.items)
    return out


def _label(items: list[Item]) -> list[bool] | None:
    """Which items lie in the page's marked content, if it marks any."""
    inside, depth, out = False, None, []
    for x in items:
        if x.name in CONTENT and depth is None:
            depth = x.depth
        out.append(depth is not None and x.depth >= depth and not x.skip)
        if depth is not None and x.depth < depth:
            depth, inside = None, True
        inside = inside or depth is not None
    return out if inside else None


@dataclass(frozen=True)
class RegionScorer:
    """Scores of tags and words: log odds of lying inside the content."""
    tags: dict[str, float]
    word: float
    linked: float
    unknown: float = -1.0

    def score(self, x: Item) -> float:
        if x.name:
            return self.tags.get(x.name, self.unknown)
        return (self.linked if x.linked else self.word) * _n_words(x.text)

    def region(self, items: list[Item]) -> tuple[int, int]:
        """The run of items with the highest sum (the first on ties)."""
        best, best_at, total, start = 0.0, (0, 0), 0.0, 0
        for i, x in enumerate(items):
            if x.skip:  # boilerplate inside the content costs one tag, whatever its size
                total += self.unknown if i and not items[i - 1].skip else 0.0
            else:
                total += self.score(x)
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > best:
                best, best_at = total, (start, i + 1)
        return best_at

    def extract(self, page: str) -> str:
        """The page's main text: one line per block."""
        found = parse(page)
        items = found.items
        lo, hi = self.region(items)
        if lo == hi:
            return ""
        # a region that lies in one marked content element takes all of it; one
        # that only touches some grows by them
        touched = []
        for k in CONTENT:
            for e in found.elements:
                if e.name == k and e.start < hi and not items[e.start].skip:
                    if e.start <= lo and hi <= e.end:
                        return _blocks(items[e.start:e.end])
                    if e.end > lo:
                        touched.append((e.start, e.end))
        if touched:
            return _blocks(items[min(lo, *(a for a, _ in touched)):max(hi, *(b for _, b in touched))])
        return _blocks(items[slice(*_container(found, lo, hi))])


def _container(page: Page, lo: int, hi: int) -> tuple[int, int]:
    """The region grown to the innermost element around all its texts, unless
    that is the page's body."""
    texts = [i for i in range(lo, hi) if not (x := page.items[i]).name and not x.skip and x.text.strip()]
    node = page.items[texts[0]].node if texts else 0
    while node and (page.elements[node].end <= texts[-1] or page.elements[node].name in _INLINE | _LEAVES):
        node = page.elements[node].parent
    around = page.elements[node]
    if not node or around.name in ("html", "body"):
        return lo, hi
    return min(lo, around.start), max(hi, around.end)


def _blocks(items: list[Item]) -> str:
    lines, line = [], []
    for x in items:
        if x.name and x.name.strip("/") not in _INLINE:
            lines.append(line)
            line = []
        elif x.name == "br":
            line.append(" ")
        elif not x.name and not x.skip:
            line.append(html.unescape(x.text))
    lines.append(line)
    return "\n".join(t for x in lines if (t := " ".join("".join(x).split())))


def fit_regions(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> RegionScorer:
    """Count weights on pages that mark their own content (``article`` or
    ``main``): all of them up to about ``max_pages``, else the fraction of that
    size whose page hash is smallest.  Counting runs in the tasks.

    Without such pages, words score 1 and tags -1 (linked words too)."""
    some = (pages.select(F.col(html_col).alias("html")).where(F.col("html").isNotNull())
            .where(F.lower("html").contains("<article") | F.lower("html").contains("<main"))
            .withColumn("draw", F.pmod(F.xxhash64("html"), F.lit(1 << 30))))
    n = some.count()
    some = some.where(F.col("draw") < int((1 << 30) * min(1.0, max_pages / max(n, 1)))).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch["html"].to_pylist():
                items = parse(page).items
                label = _label(items)
                for x, y in zip(items, label or ()):
                    if x.name:
                        counts[x.name, y] += 1
                    else:
                        counts["*a" if x.linked else "*", y] += _n_words(x.text)
        rows = [{"what": k, "inside": y, "n": v} for (k, y), v in counts.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("what", pa.string()), ("inside", pa.bool_()),
                                                                 ("n", pa.int64())]))

    found = (some.mapInArrow(count, "what string, inside boolean, n long").groupBy("what", "inside")
             .agg(F.sum("n").alias("n")).collect())  # tag names of a bounded sample
    n = {(r.what, r.inside): r.n for r in found}
    if not n:
        return RegionScorer({}, 1.0, -1.0)

    def odds(what: str) -> float:
        return math.log((n.get((what, True), 0) + 1) / (n.get((what, False), 0) + 1))

    # a word scores one; tags and linked words score negative, by their odds
    word = max(0.2, odds("*"))
    tags = {k: min(-0.1, max(-2.0, (odds(k) - word) / word)) for k, _ in n if not k.startswith("*")}
    return RegionScorer(tags, 1.0, min(-0.2, max(-1.0, odds("*a") / word)) if ("*a", False) in n else -0.2)


def extract_main_text(pages: DataFrame, scorer: RegionScorer, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` for every row.

    Null or empty html gives an empty text; repeated rows stay; other columns
    are ignored.  Character references are decoded, white space inside a block
    becomes one space, blocks are joined by line feeds in page order.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [scorer.extract(p) for p in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["id", "url", "text", "n_chars"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
