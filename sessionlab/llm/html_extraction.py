"""Main text of HTML pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags.  A word scores by the elements around it,
a tag scores negative, and one linear scan finds the contiguous region of the greatest
sum.  The weights are log odds, learned from labelled pages: those that mark their content
themselves with ``article`` or ``main``; what those elements hold is content, the rest is
not.  Names that the labelled pages never use fall back on a prior (the lists below).
Inside the region, elements that are furniture by their own weight (an advert between two
paragraphs) are left out; within an element that holds content they score nothing, so that
no aside, however long, ends the article.

Defined cases: null or empty html gives the empty text; so does a page without a positive
region; unclosed elements end with their parent or with the page; stray ``<`` is text;
repeated rows give equal texts; an empty table gives an empty result; pages of any length are
scanned whole, in one pass; of regions with equal sums the first is taken; extra columns pass
through, clashing ones are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import guarded, small_batches, unguarded

#: pages the weights are learned from (about; the rest only gets scored)
SAMPLE_PAGES = 4000
#: score of a word inside furniture that stands outside content; inside an element that holds
#: content, furniture is left out and crossing it costs nothing, however long it is
FURNITURE_WORD = -0.3
#: weight from which an element counts as one that holds content, besides CONTENT_TAGS
HOLDS_CONTENT = 1.0
#: pages of the sample a name must stand in to get a weight of its own
MIN_PAGES = 5

# ---- fixed values: HTML vocabulary
RAW = "script style noscript template textarea svg math iframe object canvas video audio select option title xmp noembed noframes".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
 footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table
 tbody tfoot thead tr ul""".split())
SPACE = BLOCK | {"br", "td", "th", "img", "wbr"}
CONTENT_TAGS = {"article", "main"}
# ---- fixed values: names that mark furniture or content where the labelled pages are silent
FURNITURE_TAGS = set("nav header footer aside form menu dialog button label legend head search".split())
FURNITURE_NAMES = set("""ad ads advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion
 nav navbar navigation navi menu breadcrumb breadcrumbs pagination pager sidebar side rail aside widget widgets footer foot
 header masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay paywall newsletter
 subscribe subscription signup login register search share sharing social follow related recommended recommendations more
 trending popular tags comment comments commentlist disqus replies reply respond discussion copyright legal disclaimer
 skip hidden contentinfo complementary navigation""".split())
CONTENT_NAMES = set("article articlebody content entry post story body main maincontent text prose".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^'\">]|\"[^\"<]*\"|'[^'<]*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?:(?P<attrs>(?:[^'\">]|\"[^\"<]*\"|'[^'<]*')*+)>|(?P<loose>[^>]*)>)",
    re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNSEEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def names(tag: str, attrs: str) -> list[str]:
    """The names of an element: its tag, the parts of its class, id and role."""
    if tag in ("html", "body"):     # around everything, whatever their classes say
        return []
    out = ["<" + tag]
    if attrs:
        for m in _NAMED.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            out += {p.lower() for p in _PART.findall(value)} | {"".join(re.findall("[a-z]+", value.lower()))} - {""}
        if _UNSEEN.search(attrs):
            out.append("hidden")
    return out


def _prior(name: str) -> tuple[float, float]:
    """Prior share of content and the bound of the weight: names that say what they hold may
    weigh much, mere layout little."""
    if name[0] == "<":
        t = name[1:]
        return (0.98, 4.0) if t in CONTENT_TAGS else (0.02, 4.0) if t in FURNITURE_TAGS else (0.7, 1.0) if t in ("p", "h1") else (0.5, 1.0)
    return (0.02, 4.0) if name in FURNITURE_NAMES else (0.95, 2.0) if name in CONTENT_NAMES else (0.5, 2.0)


class Weights:
    """Log odds of content by element name, and the (positive) cost of a tag."""

    PRIOR_WORDS, BASE = 200.0, 0.5

    def __init__(self, counts: dict[str, tuple[float, float]]):
        """counts: name -> words inside and outside content; ``~name`` for words that stand in
        furniture anyway."""
        self.counts = counts
        self.known: dict[str, float] = {}
        self.costs: dict[str, float] = {}

    def of(self, name: str) -> float:
        w = self.known.get(name)
        if w is None:
            share, most = _prior(name)
            inside, outside = self.counts.get(name, (0.0, 0.0)) if name[1:] not in CONTENT_TAGS else (0.0, 0.0)
            odds = math.log((inside + self.PRIOR_WORDS * share) / (outside + self.PRIOR_WORDS * (1 - share)))
            w = self.known[name] = max(-most, min(most, odds))
        return w

    def cost(self, tag: str) -> float:
        """What an opening or closing tag takes off: more for tags that stand outside content."""
        c = self.costs.get(tag)
        if c is None:
            a, b = self.counts.get("<" + tag, (0.0, 0.0))
            c, d = self.counts.get("~<" + tag, (0.0, 0.0))
            odds = math.log((b + d + self.PRIOR_WORDS / 2) / (a + c + self.PRIOR_WORDS / 2))
            c = self.costs[tag] = 0.3 + max(0.0, min(1.0, odds)) / 2
        return c

    def element(self, tag: str, attrs: str) -> float:
        return max(-4.0, min(4.0, sum(self.of(n) for n in names(tag, attrs))))


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, '') | ('open' | 'close', tag, attributes) in page order."""
    last = 0
    for m in _TOKEN.finditer(html):
        if m.start() > last:
            yield "text", html[last:m.start()], ""
        last = m.end()
        if m["tag"]:
            yield ("close" if m["close"] else "open"), m["tag"].lower(), m["attrs"] or m["loose"] or ""
        else:
            yield "gap", "", ""
    if last < len(html):
        yield "text", html[last:], ""


class Elements:
    """Open elements with what the caller holds for each (``value``)."""

    def __init__(self):
        self.open: list[tuple[str, object]] = []

    def push(self, tag: str, value) -> None:
        if tag in BLOCK:      # a block ends an open paragraph, an item the item before it
            self._end({"p"}, BLOCK - {"p"})
        if tag == "li":
            self._end({"li"}, {"ul", "ol", "menu"})
        elif tag in ("dt", "dd"):
            self._end({"dt", "dd"}, {"dl"})
        elif tag in ("tr", "td", "th"):
            self._end({"td", "th"} | ({"tr"} if tag == "tr" else set()), {"table"} if tag == "tr" else {"tr", "table"})
        elif tag == "body":
            self._end({"head"}, set())
        if tag not in VOID:
            self.open.append((tag, value))

    def _end(self, tags: set, within: set) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                del self.open[k:]
                return
            if self.open[k][0] in within:
                return

    def pop(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return


def label_counts(html: str) -> tuple[Counter, Counter] | None:
    """Words by element name inside and outside the marked content; None for unmarked pages."""
    inside, outside, stack, marked = Counter(), Counter(), Elements(), False
    for kind, x, attrs in tokens(html):
        if kind == "open":
            marked = marked or x in CONTENT_TAGS
            stack.push(x, names(x, attrs))
        elif kind == "close":
            stack.pop(x)
        elif kind == "text" and (n := len(x.split())):
            content = any(t in CONTENT_TAGS for t, _ in stack.open) and not any(t in FURNITURE_TAGS for t, _ in stack.open)
            own = {y for _, at in stack.open for y in at}
            furniture = {y for y in own if _prior(y)[0] < 0.1}
            # a menu explains why its words are no content; that its list is a list tells nothing more
            for name in furniture | (own if not furniture else {"~" + y for y in own - furniture}):
                (inside if content else outside)[name] += n
    return (inside, outside) if marked else None


def best_region(steps: list[tuple[float, int | None]]) -> tuple[int, int]:
    """(first, last + 1) segment of the contiguous run of ``steps`` with the greatest positive sum,
    the first of equals; (0, 0) if there is none.  A step is (score, segment), a tag has no
    segment; a run begins and ends with a segment."""
    best, at, run, start = 0.0, (0, 0), 0.0, 0
    for score, segment in steps:
        if segment is None:
            run += score
            continue
        if run <= 0:
            run, start = 0.0, segment
        run += score
        if run > best:
            best, at = run, (start, segment + 1)
    return at


def scored(html: str, weights: Weights) -> tuple[list[tuple[int, str, bool]], list[tuple[float, int | None]]]:
    """Segments (block number, text, furniture) of a page, and the steps of the scan over them."""
    stack = Elements()
    segments: list[tuple[int, str, bool]] = []
    steps: list[tuple[float, int | None]] = []
    block, score, furniture, free = 0, weights.BASE, False, False

    def state():
        # free: furniture within an element that holds content; crossing it costs nothing
        s, f, holds, inside = weights.BASE, False, False, False
        for tag, w in stack.open:
            if tag in CONTENT_TAGS:
                s, f, inside = weights.BASE, False, False    # content inside an unclosed menu is content
            s += w
            holds = holds or tag in CONTENT_TAGS or w >= HOLDS_CONTENT
            if w <= -2:
                f, inside = True, inside or holds
        return max(-5.0, min(3.0, s)), f, f and inside
    for kind, x, attrs in tokens(html):
        if kind == "text":
            if n := len(x.split()):
                steps.append((0.0 if free else n * (FURNITURE_WORD if furniture else score), len(segments)))
                segments.append((block, x, furniture))
            elif segments and x:
                segments.append((block, " ", furniture))
            continue
        if kind == "gap":
            continue
        if x in BLOCK:
            block += 1
        elif x in SPACE:
            segments.append((block, " ", furniture))
        was_free = free
        if kind == "open":
            w = weights.element(x, attrs)
            if x == "header" and any(t in CONTENT_TAGS for t, _ in stack.open):
                w = 0.0            # the head of an article, not of the page
            stack.push(x, w)
        else:
            stack.pop(x)
        score, furniture, free = state()
        if not (free or was_free):
            steps.append((-weights.cost(x), None))
    return segments, steps


def main_text(html: str | None, weights: Weights) -> str:
    if not html:
        return ""
    segments, steps = scored(html, weights)
    lo, hi = best_region(steps)
    if lo == hi:
        return ""
    while lo and segments[lo - 1][0] == segments[lo][0]:       # whole blocks
        lo -= 1
    while hi < len(segments) and segments[hi][0] == segments[hi - 1][0]:
        hi += 1
    blocks: dict[int, list[str]] = {}
    for b, text, f in segments[lo:hi]:
        if not f:
            blocks.setdefault(b, []).append(text)
    lines = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


def _count_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pages, inside, outside = Counter(), Counter(), Counter()
        for html in pdf["html"]:
            found = label_counts(html or "")
            if found:
                inside.update(found[0])
                outside.update(found[1])
                pages.update(set(found[0]) | set(found[1]))
        yield pd.DataFrame([(n, pages[n], inside[n], outside[n]) for n in pages], columns=["name", "pages", "inside", "outside"])


def learn_weights(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample`` pages spread by content hash over the whole table; what
    returns to the driver is one row for each name that ``MIN_PAGES`` of them use."""
    small_batches(pages.sparkSession)
    step = max(1, pages.count() // sample)
    drawn = pages.select(F.col(html).alias("html")).filter(F.pmod(F.xxhash64("html"), F.lit(step)) == 0)
    rows = (drawn.mapInPandas(_count_pages, "name string, pages long, inside long, outside long")
            .groupBy("name").agg(F.sum("pages").alias("pages"), F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
            .filter(F.col("pages") >= MIN_PAGES).collect())
    total = {r["name"]: (r["inside"], r["outside"]) for r in rows}
    return Weights({n: (float(a), float(b)) for n, (a, b) in total.items()})


def extract(pages: DataFrame, html: str = "html", weights: Weights | None = None) -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars`` (code points)."""
    weights = weights or learn_weights(pages, html)
    counts = weights.counts

    @F.pandas_udf(T.StringType())
    def run(column: pd.Series) -> pd.Series:
        own = Weights(counts)
        return pd.Series([main_text(x, own) for x in column], dtype=object)
    small_batches(pages.sparkSession)
    out = ["text", "n_chars"]
    done = guarded(pages, [html], out).withColumn("text", run(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))
    return unguarded(done, pages.columns, [html], out)
