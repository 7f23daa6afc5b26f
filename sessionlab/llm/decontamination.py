"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items make one automaton (of bounded size; a larger
benchmark becomes several, used in turn).  Documents stream through it word by word; the
length of the longest match that ends at a word tells which windows end there.  Words no
item holds end every match, so only runs of known words are walked.

Defined cases: null text has no words; a document without words is clean; an item without
words never occurs; a null item_id counts as the string "null"; items of equal text all
count; repeated rows are judged alike; an empty benchmark leaves all clean; an empty
documents table gives an empty result; extra columns pass through, clashing ones are
replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import guarded, small_batches, unguarded, written

#: words of an item piece, and of all pieces in one automaton (about 150 bytes of memory a word)
PIECE_WORDS = 20_000
AUTOMATON_WORDS = 200_000

# bytes that make words: 0-9, a-z (A-Z lowered) and everything outside ASCII
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word ids with the items of each window."""

    def __init__(self, pieces: list[tuple[str, str]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        texts = [(item, [self.ids.setdefault(w, len(self.ids)) for w in text.encode().split()]) for item, text in pieces]
        for _, seq in texts:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.shortest = min([window, *(len(seq) for _, seq in texts if seq)])
        # the state that holds the window ending here: first on the suffix path as short as it
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.at: list[int] = [-1] * len(self.len)
        for v in order[1:]:
            if self.len[v] >= window:
                up = self.link[v]
                self.at[v] = v if self.len[up] < window else self.at[up]
        self.items: dict[int, set[str]] = {}            # window state -> items
        short: dict[int, dict[int, set[str]]] = {}      # state of whole short items -> length -> items
        for item, seq in texts:
            if not seq:
                continue
            v = 0
            for k, c in enumerate(seq):
                v = self.next[v][c]
                if k + 1 >= window:
                    self.items.setdefault(self.at[v], set()).add(item)
            if len(seq) < window:
                short.setdefault(v, {}).setdefault(len(seq), set()).add(item)
        # all short items on the suffix path, nearest first, as a linked list
        self.short: list[tuple | None] = [None] * len(self.len)
        for v in order:
            up = self.short[self.link[v]] if v else None
            for n, own in short.get(v, {}).items():
                up = (n, own, up)
            self.short[v] = up

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        copy = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) word spans of window occurrences, and the items of those windows."""
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        edge = np.diff(np.concatenate([[0], (ids >= 0).astype(np.int8), [0]]))
        begin, stop = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        long = stop - begin >= self.shortest
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        found: set[str] = set()
        nxt, link, length, window = self.next, self.link, self.len, self.window
        for b, e in zip(begin[long].tolist(), stop[long].tolist()):
            v = n = 0
            for k, c in enumerate(ids[b:e].tolist(), b):
                while v and c not in nxt[v]:
                    v = link[v]
                    n = length[v]
                if c in nxt[v]:
                    v = nxt[v][c]
                    n += 1
                if n >= window:
                    states.add(self.at[v])
                    spans.append((k + 1 - window, k + 1))
                s = self.short[v]
                while s:
                    if s[0] <= n:
                        found |= s[1]
                        spans.append((k + 1 - s[0], k + 1))
                    s = s[2]
        for v in states:
            found |= self.items[v]
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_CACHE: dict = {}   # one automaton a worker


def _automaton(shared, window: int) -> Automaton:
    if _CACHE.get("of") is not shared.value:
        _CACHE.update(of=shared.value, automaton=Automaton(shared.value, window))
    return _CACHE["automaton"]


def _scan_udf(shared, window: int):
    @F.pandas_udf("n_words long, spans array<array<int>>, items array<string>")
    def f(text: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        auto = _automaton(shared, window)
        rows = []
        for t, s, i in zip(text, spans, items):
            w = item_words(t)
            now, found = auto.scan(w)
            rows.append((len(w), merged([*map(tuple, s), *now]), sorted(found | set(i))))
        return pd.DataFrame({"n_words": [r[0] for r in rows], "spans": [[list(x) for x in r[1]] for r in rows],
                             "items": [r[2] for r in rows]})
    return f


def _piece_udf(window: int):
    @F.pandas_udf("array<string>")
    def f(text: pd.Series) -> pd.Series:
        def cut(t):
            w = [x.decode("utf-8", "replace") for x in item_words(t)]
            step = max(PIECE_WORDS - window + 1, 1)
            return [" ".join(w[k:k + PIECE_WORDS]) for k in range(0, max(len(w) - window + 1, min(len(w), 1)), step)]
        return text.map(cut)
    return f


def item_pieces(benchmark: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """(item, piece) of at most PIECE_WORDS words; pieces of an item overlap so that each window
    lies whole in one.  Items without words give none."""
    return benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                            F.explode(_piece_udf(window)(F.col(text))).alias("piece"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, min_percent: float = 5.0) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, n_items, items, spans (word spans of hits),
    items_sha256 and contaminated (some word hit, and ``min_percent`` of the words or more)."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = written(item_pieces(benchmark, item_text, item_id, window), "bench-pieces")
    total = pieces.agg(F.sum(F.length("piece") - F.length(F.replace("piece", F.lit(" "), F.lit(""))) + 1)).first()[0] or 0
    shards = -(-total // AUTOMATON_WORDS)
    out = ["n_words", "spans", "items", "n_hit", "n_items", "items_sha256", "contaminated"]
    base = guarded(docs, [text], out).withColumn("_c", F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("spans"),
                                          F.array().cast("array<string>").alias("items")))
    for k in range(max(shards, 1)):
        # one automaton's words (bounded above) at a time pass the driver
        own = pieces.filter(F.pmod(F.xxhash64("item", "piece"), F.lit(max(shards, 1))) == k)
        shared = spark.sparkContext.broadcast([tuple(r) for r in own.select("item", "piece").distinct().collect()])
        base = base.withColumn("_c", _scan_udf(shared, window)(F.col(text), F.col("_c.spans"), F.col("_c.items")))
        if k + 1 < shards:
            base = written(base, "contamination")
    n_hit = F.aggregate("_c.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    done = (base.withColumns({"n_words": F.col("_c.n_words"), "spans": F.col("_c.spans"), "items": F.col("_c.items")})
            .withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= F.lit(float(min_percent)) * F.col("n_words")))
            .drop("_c"))
    return unguarded(done, docs.columns, [text], out)


@F.pandas_udf(T.StringType())
def _without_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    import regex
    word = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def cut(t, s):
        if t is None:
            return None
        at = [m.span() for m in word.finditer(t.translate({c: c + 32 for c in range(65, 91)}))]
        keep, last = [], 0
        for b, e in s:
            keep.append(t[last:at[b][0]])
            last = at[e - 1][1]
        return "".join([*keep, t[last:]])
    return pd.Series([cut(t, s) for t, s in zip(text, spans)], dtype=object)


def without_spans(judged: DataFrame, text: str = "text") -> DataFrame:
    """Clean documents whole, lightly hit ones without the hit spans, contaminated ones gone."""
    hit = F.size("spans") > 0
    cut: Column = _without_spans(F.when(hit, F.col(text)), F.col("spans"))
    return (judged.filter(~F.col("contaminated")).withColumn("_cut", cut)
            .withColumn(text, F.when(hit, F.col("_cut")).otherwise(F.col(text))).drop("_cut"))


def digest(items: list[str]) -> str:
    """items_sha256 of a list of items (for tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
