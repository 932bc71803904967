"""Main text of web pages: the maximum-scoring run of words and tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import chunks

#: Labelled pages that weights are learned from, at most.
SAMPLE = 4096
#: Bounds of the weight of a word, and of what a tag or a part counts against the article: less than a word, so that its words are not lost to tags between them.
MOST, TAG_LEAST, TAG_MOST = 6.0, 0.05, 1.0
#: Words inside and outside the article that each kind is taken to have been seen with before any page; tags and parts 20 of both.
SEEN = {"text": (100, 1), "heading": (100, 1), "list": (20, 1), "link": (1, 20)}
TAG_SEEN = (20, 20)

# Fixed values of the markup language: elements without an end, elements whose content is no markup, and elements that are blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag of the first kind ends an open element of the second; blocks end an open paragraph.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LIMITS = frozenset("ul ol menu dl table tbody thead tfoot select td th article main body html div section".split())
#: Elements whose words are never the article's.
HIDDEN = frozenset("script style noscript template iframe textarea title head select datalist object svg canvas math audio video noembed noframes xmp".split())
FURNITURE = {
    "nav": "menu", "menu": "menu", "footer": "footer", "aside": "aside", "form": "form", "button": "form", "fieldset": "form", "search": "form", "dialog": "notice"}
ROLES = {
    "navigation": "menu", "menu": "menu", "menubar": "menu", "toolbar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "aside",
    "search": "form", "form": "form", "alert": "notice", "alertdialog": "notice", "dialog": "notice", "status": "notice"}
# Words of class and id names that say what a part of a page is.
NAMES = {
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc skip topbar navlinks sitemap",
    "header": "header masthead topbar pageheader siteheader logo tagline",
    "footer": "footer copyright colophon legal sitefooter pagefooter",
    "aside": "sidebar aside widget widgets related recommended recommendations trending popular share sharing social tags rail sidenav",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay banner newsletter subscribe subscription signup paywall toast disclaimer",
    "advert": "ad ads advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion promoted adsense adsbygoogle adslot adbox dfp outbrain taboola",
    "form": "form login search searchbox signin register",
    "comment": "comment comments commentlist disqus replies reply respond discussion reviews",
}
KIND = {word: kind for kind, words in NAMES.items() for word in words.split()}
#: A name that begins or ends like this belongs to the page or the article, not to a part of that kind.
ABOUT = frozenset("has with no without is".split())
OWN = frozenset("article post entry story content main".split())

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]{0,65536}+\"|'[^']{0,65536}+'){0,65536}+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def furniture(name: str, attributes: str, inside: bool) -> str | None:
    """What part of a page an element is by its name, role, classes and id; None for the rest. ``inside``: within an article."""
    kind = FURNITURE.get(name)
    if kind or name in HIDDEN:
        return kind or "hidden"
    if name == "header":
        return None if inside else "header"
    if attributes and name not in ("html", "body", "article", "main"):
        for what, *values in NAMED.findall(attributes):
            value = html.unescape("".join(values))
            if what.lower() == "role":
                if value.strip().lower() in ROLES:
                    return ROLES[value.strip().lower()]
                continue
            for one in value.split():
                words = [w.lower() for w in PARTS.findall(one)]
                if not words or words[0] in ABOUT:
                    continue
                kinds = [KIND[w] for w in words if w in KIND]
                if kinds and not (kinds == ["header"] and (inside or words[0] in OWN)):
                    return kinds[0]
    return None


class Page:
    """Tokens of one page in order: runs of words between tags, tags, and parts that aren't the article's.

    ``kinds`` has the class of each for the weights: ``word:text``, ``word:heading``, ``word:list`` or ``word:link``, a tag's name, with ``/``
    before closing ones and ``inline`` for all that are no blocks, or ``part:`` and what it is for a whole part (a menu, a notice),
    whose words and tags are no tokens. ``counts`` has the words of a run and 1 for others, ``texts`` (token, block, start, end, text).
    """

    def __init__(self, source: str):
        self.kinds: list[str] = []
        self.counts: list[int] = []
        self.texts: list[tuple[int, int, int, int, str]] = []
        self.marked: dict[str, list[list[int]]] = {"article": [], "main": []}
        self.block = 0
        self.open: list[tuple[str, str | None]] = []
        self.names: Counter = Counter()
        self.parts = 0
        self._read(source)
        while self.open:
            self._close()

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size and (found := PIECE.search(source, at)):
            self._words(source, at, found.start())
            at = found.end()
            slash, name, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
            if not name:
                if found[0].startswith("<![CDATA["):
                    self._words(source, found.start() + 9, at - 3 * found[0].endswith("]]>"), plain=True)
                continue
            name = name.lower()
            if slash:
                self._end(name)
                continue
            self._start(name, attributes)
            if name in RAW and not attributes.endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = close.start() if close else size
        self._words(source, at, size)

    def _words(self, source: str, start: int, end: int, plain: bool = False) -> None:
        if start >= end or self.parts:
            return
        text, names = source[start:end], self.names
        if "&" in text and not plain:
            text = html.unescape(text)
        kind = "heading" if names["heading"] else "link" if names["a"] else "list" if names["li"] else "text"
        self.texts.append((len(self.kinds), self.block, start, end, text))
        self._token("word:" + kind, len(text.split()))

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            if self.names["p"]:
                self._until({"p"}, LIMITS)
            if name in ENDS:
                self._until(ENDS[name], LIMITS - ENDS[name])
            self.block += 1
        elif name == "br" and not self.parts:
            self.texts.append((len(self.kinds), self.block, 0, 0, " "))
        if name in VOID:
            return self._token(name if name in BLOCKS else "inline", 1)
        part = furniture(name, attributes, bool(self.names["article"] or self.names["main"]))
        self._token(f"part:{part}" if part else name if name in BLOCKS else "inline", 1)
        if name in self.marked and not self.names[name] and not self.parts and not part:
            self.marked[name].append([len(self.kinds), -1])
        self.open.append((name, part))
        self.names[name] += 1
        self.names["heading"] += name in HEADINGS
        self.parts += part is not None

    def _end(self, name: str) -> None:
        within = self.parts
        if self.names[name]:
            while self.open[-1][0] != name:
                self._close()
            self._close()
        if not within:
            self._token("/" + name if name in BLOCKS else "inline", 1)
        self.block += name in BLOCKS

    def _until(self, names: set[str], limits: frozenset) -> None:
        """Close an open element of ``names`` with what is in it, unless one of ``limits`` lies between."""
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] in names:
                while len(self.open) > depth:
                    self._close()
                return
            if self.open[depth][0] in limits:
                return

    def _close(self) -> None:
        name, part = self.open.pop()
        self.names[name] -= 1
        self.names["heading"] -= name in HEADINGS
        self.parts -= part is not None
        if name in self.marked and not self.names[name] and self.marked[name] and self.marked[name][-1][1] < 0:
            self.marked[name][-1][1] = len(self.kinds)

    def _token(self, kind: str, count: int) -> None:
        if not self.parts:
            self.kinds.append(kind)
            self.counts.append(count)

    def label(self) -> list[int] | None:
        """First and last token (exclusive) of the article, if the page marks just one, or else one main part."""
        spans = self.marked["article"] or self.marked["main"]
        return spans[0] if len(spans) == 1 else None

    def text(self, weights: Weights) -> tuple[str, int, int, float]:
        """The main text, where it starts and ends in the page, and its score.

        The best run of tokens is taken with all of the blocks it begins and ends in.
        """
        scores = np.fromiter(map(weights.of, self.kinds), np.float64, len(self.kinds)) * np.array(self.counts, np.float64)
        start, end = best_run(scores)
        inside = [block for token, block, *_ in self.texts if start <= token < end and scores[token] > 0]
        if not inside:
            return "", 0, 0, 0.0
        first, last = inside[0], inside[-1]
        kept = [t for t in self.texts if first <= t[1] <= last]
        blocks = [" ".join("".join(t[4] for t in run).split()) for _, run in groupby(kept, key=lambda t: t[1])]
        places = [t for t in kept if t[3]]
        return "\n".join(filter(None, blocks)), places[0][2], places[-1][3], float(scores[start:end].sum())


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """Start and end of the run of the highest sum by one scan, the earliest and of those the longest; empty if no score is positive."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    return (int(np.argmax(sums[: end + 1] == low[end])), end) if sums[end] > low[end] else (0, 0)


class Weights:
    """Log-odds of the kinds of words and tags to stand in the article; a tag never counts for it."""

    def __init__(self, inside: dict[str, int], outside: dict[str, int]):
        self.inside, self.outside, self.known = inside, outside, {}

    def of(self, kind: str) -> float:
        if kind not in self.known:
            words = kind.startswith("word:")
            yes, no = SEEN[kind[5:]] if words else TAG_SEEN
            odds = np.log((self.inside.get(kind, 0) + yes) / (self.outside.get(kind, 0) + no))
            self.known[kind] = float(np.clip(odds, -MOST, MOST) if words else np.clip(odds, -TAG_MOST, -TAG_LEAST))
        return self.known[kind]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in chunks(batches, "html"):
        yield batch, [h or "" for h in batch.column("html").to_pylist()]


def learned(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from the pages that mark their article, of ``sample`` pages drawn by a hash of id and address.

    A token is inside if it is in the one article element (or else the one main element).
    Pages without the mark teach nothing; if none has it, only what is taken as seen before counts. Kinds are
    fixed names, so their counts are a small table.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for _, sources in _texts(batches):
            for page in map(Page, sources):
                span = page.label()
                for token, kind in enumerate(page.kinds if span else ()):
                    side = inside if span[0] <= token < span[1] else outside
                    side[kind] += page.counts[token]
        kinds = sorted(inside | outside)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "inside": pa.array([inside[k] for k in kinds], pa.int64()), "outside": pa.array([outside[k] for k in kinds], pa.int64())})

    draw = F.xxhash64("page_id", "url")
    drawn = pages.select(draw.alias("draw")).orderBy("draw").limit(sample)
    rows = pages.select(F.col("html").cast("string").alias("html"), draw.alias("draw")).join(F.broadcast(drawn), "draw", "left_semi").select("html")
    counts = rows.mapInArrow(counted, "kind string, inside bigint, outside bigint").groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return Weights({r.kind: r.inside for r in counts}, {r.kind: r.outside for r in counts})


def extracted(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``page_id, url, text, n_chars, region_start, region_end, score`` for every row of ``pages (page_id, url, html)``.

    Words score positive and tags negative by ``learned`` (words of links that are no part of a text may be negative too); one scan
    finds the run of the highest score, which is widened to whole blocks. Menus, headers, footers, sidebars, notices, adverts, forms,
    comments and what isn't shown, known by elements, roles and names (``furniture``), are each one more negative token without words. A block is text between tags of block elements, its character references decoded and its white space
    single; a line break inside is white space. Blocks are joined by line ends. The region is where the text stands
    in the html, in code points. A null or empty html, and a page without words that score, have an empty text; repeated rows come
    again, null ids and addresses stay, other columns play no part, an empty table gives no rows. Of equal runs the earliest counts.
    """
    weights = learned(pages, sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in _texts(batches):
            texts, starts, ends, scores = zip(*(Page(source).text(weights) for source in sources))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            columns += [pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "region_start", "region_end", "score"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint, region_start bigint, region_end bigint, score double")
