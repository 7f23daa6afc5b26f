"""Substring dedup: near-duplicate passages by compact windows.

The elements of a text are its word shingles.  A hash function gives every element a number;
the element of least number in a subsequence is its min-hash.  For each element c that is
least around it, [l, r] is the reach of its subtree in the Cartesian tree of the numbers: all
subsequences that hold c and lie within share one signature, a compact window.  Two texts
with near-equal passages have windows of equal signatures there.

Signatures of two hash functions whose windows overlap by a shortest passage are joined into
one key, four such keys for each place.  Places that share a key meet in shards by key and
are linked to the first and to the previous one, in the chunk first, so that a passage that a
third of all texts share costs one place for each chunk.  Every pair of documents linked is
then verified: the shingles they share are laid out along both, segments that agree are cut
out, and a pair of segments counts if both are long enough and the Jaccard similarity of
their shingles is high enough.  Overlapping segments of a document are one passage, and the
connected passages are a class.

Places without a verified link, and the first places of their keys, stay open.  Their ranges are
cut out of the chunks once a round and meet again by rare shingles and whole windows; what stays
open then lies within what was open before, so later rounds read the cut-out ranges alone.

Defined cases: very long texts are whole, in one chunk, and worked through in blocks; of equal
numbers in a window the leftmost is least, equal ranks go by hash; null text is empty; a text shorter than a shortest passage has none; a passage
repeated only within one document is none; repeated rows are documents of their own, and
their passages repeat; null doc_ids stay null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.chunks import MESSAGE, cut, messages, pack, rows_of, text_chunks, unpack, words_of
from sessionlab.llm.common import release, written
from sessionlab.llm.components import component_roots
from sessionlab.llm.tokens import mix

SHINGLE = 5
HASHES = 4
KEYS = [(0, 1), (1, 2), (2, 3), (3, 0)]
#: shingles to each side of a window's place that are laid out; longer passages are found in
#: pieces that overlap and are joined
REACH = 255
SHARD_WORDS = 2_000_000
#: shingles that must agree, by round over the places left open
ROUNDS = (1, 2, 3)
#: starts of passages worked on at once, and windows laid out in full at once
BLOCK, LAID_OUT = 1 << 17, 1 << 13
#: share of shared shingles in a segment: of n in each of two segments, m shared, the
#: similarity m / (2n - m) is s at m / n = 2s / (1 + s)
_LOW = np.uint64((1 << 21) - 1)
NO_ID = np.iinfo(np.int64).min


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the SHINGLE-word shingles that start at each word (the last few are partial)."""
    h = words.copy()
    for k in range(1, SHINGLE):
        h = h * np.uint64(0x9FB21C651E98DF25)
        h[:-k or None] += words[k:]
    return mix(h)


class Text:
    """One chunk: shingles and documents by word position."""

    def __init__(self, blob: bytes, ids: list[int | None] = ()):
        self.vocab, self.numbers, sizes = words_of(blob)
        self.end = np.cumsum(sizes.astype(np.int64)) - 1          # the end token of each document
        self.start = self.end + 1 - sizes
        self.ids = _numbers(ids)

    @cached_property
    def shingle(self) -> np.ndarray:
        return shingles(self.vocab[self.numbers])

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, at)

    def begin(self, doc):
        return self.start[doc]

    def id(self, doc):
        return self.ids[doc]

    def run(self, lo: int, hi: int) -> np.ndarray:
        return self.shingle[lo:hi + 1]

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Shingles of inclusive ranges, one after another; only these are hashed."""
        size = hi - lo + 1
        wide = np.minimum(hi + SHINGLE - 1, len(self.numbers) - 1)
        words = self.vocab[self.numbers[_laid(lo, wide)]]
        # shingles that begin within a range see its own words alone
        return shingles(words)[_laid(np.cumsum(wide - lo + 1) - (wide - lo + 1), np.cumsum(wide - lo + 1) - (wide - lo + 1) + size - 1)]


class Part:
    """The open ranges of a chunk: what ``Text`` tells, at their positions only.  A range lies
    within a document."""

    def __init__(self, blob: bytes):
        self.lo, self.hi, self.docs, self.starts, self.ids, self.shingle = unpack(blob)
        self.offset = np.cumsum(self.hi - self.lo + 1) - (self.hi - self.lo + 1)

    def _range(self, at):
        return np.searchsorted(self.lo, at, side="right") - 1

    def doc(self, at: np.ndarray) -> np.ndarray:
        return self.docs[self._range(at)]

    def begin(self, doc):
        return self.starts[np.searchsorted(self.docs, doc)]

    def id(self, doc):
        return self.ids[np.searchsorted(self.docs, doc)]

    def run(self, lo: int, hi: int) -> np.ndarray:
        k = self._range(lo)
        at = self.offset[k] + lo - self.lo[k]
        return self.shingle[at:at + hi - lo + 1]

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Shingles of inclusive ranges within the open ones, one after another."""
        k = self._range(lo)
        at = self.offset[k] + lo - self.lo[k]
        return self.shingle[_laid(at, at + hi - lo)]


def _text(table: pa.Table) -> Text | Part:
    """The chunk of a group: whole, or its open ranges."""
    own = table.filter(pc.is_in(table.column("kind"), pa.array(["text", "part"]))).select(["kind", "blob", "ids"]).to_pylist()[0]
    return Text(own["blob"], own["ids"]) if own["kind"] == "text" else Part(own["blob"])


def _content(text: Text | Part, lo: np.ndarray, hi: np.ndarray) -> bytes:
    """Ranges with their documents and shingles, as ``Part`` reads them."""
    doc = text.doc(lo)
    return pack(lo, hi, doc, text.begin(doc), text.id(doc), text.spans(lo, hi))


def _reach(level: list[np.ndarray], at: np.ndarray, step: int) -> np.ndarray:
    """How far beyond ``at`` (step -1 or 1) the numbers stay above its own, up to REACH."""
    own, gone = level[0][at], np.zeros(len(at), np.int64)
    n = len(level[0])
    for j in range(len(level) - 1, -1, -1):
        width = 1 << j
        first = at - gone - width if step < 0 else at + gone + 1
        inside = (first >= 0) & (first + width <= n) & (gone + width <= REACH)
        more = np.zeros(len(at), bool)
        more[inside] = level[j][first[inside]] > own[inside]
        gone += more * width
    return gone


def windows(text: Text, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, reach left, reach right) of the joined compact windows of a chunk.

    ``shortest``: shingles of a shortest passage.  The number of an element is the high part of
    its hash and its position, so the leftmost of equals is least.  The chunk is worked through
    in blocks that see REACH elements beyond their ends, which is as far as any window counts.
    """
    n = len(text.shingle)
    # shingles across the end of a document are smaller than all: no window reaches over them
    across = np.zeros(n, bool)
    for k in range(SHINGLE):
        across[np.maximum(text.end - k, text.start)] = True
    parts = [_block(text, across, at, min(at + BLOCK, n), shortest) for at in range(0, n, BLOCK)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _block(text: Text, across: np.ndarray, begin: int, stop: int, shortest: int):
    """``windows`` of the passages that start in [begin, stop)."""
    first, last = max(0, begin - REACH - 1), min(len(across), stop + shortest + REACH + 1)
    starts = np.arange(begin, min(stop, len(across) - shortest + 1))
    # a passage lies within a document: its last shingle ends before the end token
    starts = starts[starts + shortest + SHINGLE - 2 < text.end[text.doc(starts)]] if len(starts) else starts
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.uint8)
    starts = starts - first
    position = np.arange(last - first, dtype=np.uint64)
    least, reach = [], []
    for f in range(HASHES):
        x = (mix(text.shingle[first:last] ^ np.uint64(0xD6E8FEB86659FD93 * (f + 1) & (1 << 64) - 1)) & ~_LOW) | position
        x[across[first:last]] = 0
        level = [x]
        while (2 << len(level) - 1) <= REACH:
            half = 1 << len(level) - 1
            level.append(np.minimum(level[-1][:-half], level[-1][half:]) if len(level[-1]) > half else level[-1][:0])
        j = shortest.bit_length() - 1
        m = np.minimum(level[j][starts], level[j][starts + shortest - (1 << j)])
        at = (m & _LOW).astype(np.int64)
        own = np.unique(at)
        l, r = _reach(level, own, -1), _reach(level, own, 1)
        k = np.searchsorted(own, at)
        least.append((m >> np.uint64(21), at))
        reach.append((at - l[k], at + r[k]))
    keys, places, lefts, rights = [], [], [], []
    for band, (f, g) in enumerate(KEYS):
        (mf, pf), (mg, pg) = least[f], least[g]
        new = np.ones(len(starts), bool)
        new[1:] = (pf[1:] != pf[:-1]) | (pg[1:] != pg[:-1])
        place = np.minimum(pf, pg)[new]
        keys.append(mix(mf[new] * np.uint64(0x9E3779B97F4A7C15) + mix(mg[new] + np.uint64(band))))
        places.append(place + first)
        lefts.append(np.minimum(place - np.maximum(reach[f][0], reach[g][0])[new], REACH).astype(np.uint8))
        rights.append(np.minimum(np.minimum(reach[f][1], reach[g][1])[new] - place, REACH).astype(np.uint8))
    return np.concatenate(keys), np.concatenate(places), np.concatenate(lefts), np.concatenate(rights)


def _links(group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of sorted ``group`` numbers linked to the first and to the previous of their group, and
    whether it is the first."""
    first = np.concatenate([[True], group[1:] != group[:-1]])
    head = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    rest = np.flatnonzero(~first)
    back = rest[rest - 1 != head[rest]]
    return (np.concatenate([rest, back]), np.concatenate([head[rest], back - 1]),
            np.repeat(np.array([1, 0], np.uint8), [len(rest), len(back)]))


def _sent(number: int, text: Text | Part, found: tuple[np.ndarray, ...], shards: int) -> list[tuple[str, int, int, bytes]]:
    """A chunk's places to the shards of their keys; places that share a key within the chunk are
    linked here and one of them goes.  Those that share it within their document stay open."""
    key, place, left, right = found
    if not len(key):
        return []
    order = np.lexsort((place, key))
    key, place, left, right = key[order], place[order], left[order], right[order]
    a, b, to_first = _links(key)
    other = text.doc(place[a]) != text.doc(place[b])
    out = []
    if not other.all():
        own = a[~other]
        out.append(("open", number, 0, pack(*_spans(place[own] - left[own], place[own] + right[own]))))
    a, b, to_first = a[other], b[other], to_first[other]
    if len(a):
        out.append(("link", number, 0, pack(place[a].astype(np.uint32), left[a], right[a], np.full(len(a), number),
                                            place[b].astype(np.uint32), left[b], right[b], to_first)))
    first = np.concatenate([[True], key[1:] != key[:-1]])
    key, place, left, right = key[first], place[first], left[first], right[first]
    return out + [("place", -1 - s, number, pack(short, *x)) for s, short, x in _sharded(key, shards, place.astype(np.uint32), left, right)]


def _sharded(key: np.ndarray, shards: int, *columns: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(shard, high six bytes of the keys, columns) of rows dealt out by key."""
    shard = (key >> np.uint64(20)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    short = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, 2:])
    for s, k in cut(shard[order].astype(np.int64)):
        yield s, short[order[k]], [c[order[k]] for c in columns]


def _wide(short: list[np.ndarray]) -> np.ndarray:
    """Keys of six bytes as numbers."""
    wide = np.zeros((sum(map(len, short)), 8), np.uint8)
    if short:
        wide[:, 2:] = np.concatenate(short)
    return wide.view(np.uint64).reshape(-1)


def _send(shards: int, shortest: int):
    """The joined compact windows of every chunk, linked and sent on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist()):
                text = Text(blob)
                yield from messages(_sent(number, text, windows(text, shortest), shards)).to_batches()
    return run


def _meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A shard of keys (numbered from -1 down): links between chunks, told to the chunk of the later
    place, and the places it will ask the chunk of the earlier one for.  Links that chunks found
    within themselves pass through."""
    if key[0].as_py() >= 0:
        return table
    got = [(p, *unpack(b)) for p, b in rows_of(table, "place")]
    number = _wide([x[1] for x in got])
    chunk = np.repeat(np.arange(len(got)), [len(x[1]) for x in got])
    place, left, right = (np.concatenate([x[k] for x in got]) for k in (2, 3, 4))
    order = np.lexsort((chunk, number))
    a, b, to_first = _links(number[order])
    a, b = order[a], order[b]
    if not len(a):
        return messages([])
    number, out = np.array([x[0] for x in got]), []
    order = np.lexsort((chunk[b], chunk[a]))
    for c, k in cut(chunk[a][order]):
        i, j = a[order[k]], b[order[k]]
        out.append(("link", int(number[c]), 0, pack(place[i], left[i], right[i], number[chunk[j]], place[j], left[j], right[j],
                                                    to_first[order[k]])))
    order = np.lexsort((place[b], chunk[a], chunk[b]))
    for c, k in cut(chunk[b][order]):
        i, j = a[order[k]], b[order[k]]
        out.append(("need", int(number[c]), 0, pack(number[chunk[i]], place[j], left[j], right[j])))
    return messages(out)


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inclusive ranges merged where they overlap or touch."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    last = np.concatenate([np.flatnonzero(first)[1:] - 1, [len(lo) - 1]])
    return lo[first], hi[last]


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A chunk: the shingles of the spans that other chunks need."""
    me, needs = key[0].as_py(), [unpack(b) for _, b in rows_of(table, "need")]
    if not needs:
        return messages([])
    asker, place, left, right = (np.concatenate(x).astype(np.int64) for x in zip(*needs))
    order = np.argsort(asker, kind="stable")
    text = _text(table)
    return messages([("content", p, me, _content(text, *_spans((place - left)[order[k]], (place + right)[order[k]])))
                     for p, k in cut(asker[order])])


def _laid(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All positions of inclusive ranges."""
    n = hi - lo + 1
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _ask(shards: int):
    """A chunk: its open ranges, cut out of it, their shingles, and whether two documents hold them."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.filter(pc.equal(table.column("kind"), "open"))
        blob = _content(_text(table), *_spans(rows.column("lo").to_numpy(), rows.column("hi").to_numpy()))
        part = Part(blob)
        doc, h = np.repeat(part.docs, part.hi - part.lo + 1), part.shingle
        order = np.lexsort((doc, h))
        doc, h = doc[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        last = np.concatenate([first[1:], [len(h)]]) - 1
        rows = _sharded(h[first], shards, (doc[first] != doc[last]).astype(np.uint8))
        return messages([("part", key[0].as_py(), 0, blob)]
                        + [("shingle", -1 - s, key[0].as_py(), pack(short, *x)) for s, short, x in rows])
    return run


def _tally(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A shard of shingles: how often those that two or more documents hold are held (by chunk, and
    twice in a chunk of several), told to the chunks that asked.  Open ranges pass through."""
    if key[0].as_py() >= 0:
        return table
    got = [(p, *unpack(b)) for p, b in rows_of(table, "shingle")]
    number = _wide([x[1] for x in got])
    _, which = np.unique(number, return_inverse=True)
    n = np.bincount(which, np.concatenate([x[2] for x in got]) + 1.0)[which]
    out, at = [], 0
    for p, short, _ in got:
        own = n[at:at + len(short)]
        at += len(short)
        if (own > 1).any():
            out.append(("count", p, 0, pack(short[own > 1], own[own > 1].astype(np.uint32))))
    return messages(out)


def rare_keys(h: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, shortest: int, share: float, agree: int):
    """(key, place, reach left, reach right) of the windows that may have a partner.

    ``h``: shingles of the open ranges [lo, hi], one range after another, ``n``: how often each
    is held.  A window is ``shortest`` shingles; with ``need`` of them shared, near-equal windows
    agree in ``agree`` of the shortest - need + agree rarest of each.
    """
    need = math.ceil(shortest * share - 1e-9)
    size = hi - lo + 1
    at, begin = _laid(lo, hi), np.cumsum(size) - size
    held = np.concatenate([[0], np.cumsum(n > 1)])
    start = np.arange(max(0, len(h) - shortest + 1))
    range_of = np.searchsorted(begin, start, side="right") - 1
    start = start[(start + shortest <= (begin + size)[range_of]) & (held[start + shortest] - held[start] >= need)]
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.uint8)
    # rank by rarity, equal shingles alike
    order = np.lexsort((h, n))
    rank = np.empty(len(h), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], h[order][1:] != h[order][:-1]]))
    power = np.cumprod(np.full(shortest, 0x9FB21C651E98DF25, np.uint64))
    keys, places = [], []
    for k in range(0, len(start), LAID_OUT):
        s = start[k:k + LAID_OUT]
        grid = s[:, None] + np.arange(shortest)
        keys.append(mix((h[grid] * power).sum(axis=1, dtype=np.uint64)))
        places.append(s + shortest // 2)
        # the rarest distinct shingles of each window, at their first position there
        by = np.argsort(rank[grid], axis=1, kind="stable")
        ranked = np.take_along_axis(rank[grid], by, 1)
        again = np.zeros(ranked.shape, bool)
        again[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
        front = np.argsort(again, axis=1, kind="stable")[:, :shortest - need + agree]
        fit = ~np.take_along_axis(again, front, 1)
        where = s[:, None] + np.take_along_axis(by, front, 1)
        fit &= n[where] > 1
        for some in combinations(range(where.shape[1]), agree):
            rows = fit[:, some].all(axis=1)
            key = np.full(int(rows.sum()), agree, np.uint64)
            for c in some:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + h[where[rows, c]])
            keys.append(key)
            places.append(where[rows, some[0]])
    key, place = np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])
    key, place = key[new], place[new]
    first, last = _spans(at[start], at[start] + shortest - 1)
    region, place = np.searchsorted(first, at[place], side="right") - 1, at[place]
    return (key, place, np.minimum(place - first[region], REACH).astype(np.uint8), np.minimum(last[region] - place, REACH).astype(np.uint8))


def _rekey(shards: int, shortest: int, share: float, agree: int):
    """A chunk: places by the rare keys of its open ranges, linked and sent on."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        told = [unpack(b) for _, b in rows_of(table, "count")]
        if not told:
            return messages([])
        part = Part(rows_of(table, "part")[0][1])
        known, count = _wide([x[0] for x in told]), np.concatenate([x[1] for x in told]).astype(np.int64)
        order = np.argsort(known)
        known, count = known[order], count[order]
        h = part.shingle
        short = h & ~np.uint64(0xFFFF)
        k = np.minimum(np.searchsorted(known, short), len(known) - 1)
        n = np.where(known[k] == short, count[k], 1)
        return messages(_sent(key[0].as_py(), part, rare_keys(h, n, part.lo, part.hi, shortest, share, agree), shards))
    return run


def _numbers(ids: list[int | None]) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def segments(shared: np.ndarray, share: float) -> list[tuple[int, int]]:
    """Ranges [a, b) that begin and end with a shared element and hold ``share`` of them."""
    edge = np.diff(np.concatenate([[0], shared.astype(np.int8), [0]]))
    stack: list[tuple[int, int, int]] = []
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        n = b - a
        while stack and (stack[-1][2] + n) >= share * (b - stack[-1][0]):
            a, _, m = stack.pop()
            n += m
        stack.append((a, b, n))
    return [(a, b) for a, b, _ in stack]


def compare(a: np.ndarray, b: np.ndarray, shortest: int, similarity: float) -> Iterator[tuple[int, int, int, int, float]]:
    """Near-equal segments (a_lo, a_hi, b_lo, b_hi, similarity) of two shingle sequences."""
    order, mine = np.argsort(b, kind="stable"), np.argsort(a, kind="stable")
    at, upto = np.searchsorted(b, a, sorter=order), np.searchsorted(b, a, side="right", sorter=order)
    shared = upto > at
    # the n-th of equal shingles faces the n-th there, or the last
    ranked = a[mine]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(len(a), np.int64)
    rank[mine] = np.arange(len(a)) - np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
    place = order[np.where(shared, at + np.minimum(rank, upto - at - 1), 0)]
    share = 2 * similarity / (1 + similarity)

    def verified(lo, hi, mine):
        shift = place[mine] - mine
        ranked, half = np.sort(shift), len(shift) // 2
        median = ranked[half] if len(shift) % 2 else (ranked[half - 1] + ranked[half]) / 2
        theirs = place[mine][np.abs(shift - median) <= (hi - lo) / 4 + SHINGLE]
        if hi - lo < shortest or not len(theirs) or theirs.max() + 1 - theirs.min() < shortest:
            return None
        c, d = int(theirs.min()), int(theirs.max()) + 1
        x, y = np.unique(a[lo:hi]), np.unique(b[c:d])
        both = len(np.intersect1d(x, y, assume_unique=True))
        j = both / (len(x) + len(y) - both)
        return (lo, hi, c, d, j) if j >= similarity else None

    def refined(mine):
        """Verified parts of shared elements ``mine``: where a segment fails, its elements are told
        apart by jumps of the shift to the other side, those of one shift at the widest gap."""
        left = [mine]
        while left:
            mine = left.pop()
            if len(mine) < share * shortest:
                continue
            begin, mask = int(mine[0]), np.zeros(mine[-1] + 1 - mine[0], bool)
            mask[mine - begin] = True
            for x, y in segments(mask, share):
                lo, hi = begin + x, begin + y
                inside = mine[np.searchsorted(mine, lo):np.searchsorted(mine, hi)]
                part = verified(lo, hi, inside)
                if part:
                    yield part
                elif hi - lo >= shortest:
                    shift = place[inside] - inside
                    ranked, wide = np.sort(shift), np.diff(inside)
                    jump = np.diff(ranked)
                    if jump.max() > SHINGLE:
                        at = ranked[1:][jump > max(SHINGLE, jump.max() / 2)]
                        group = np.searchsorted(at, shift, side="right")
                        order = np.argsort(group, kind="stable")
                        left += [inside[order[k]] for _, k in cut(group[order])]
                    elif wide.max() > 1:
                        k = int(wide.argmax()) + 1
                        left += [inside[:k], inside[k:]]
    for lo, hi in segments(shared, share):
        mine = np.flatnonzero(shared[lo:hi]) + lo
        whole = verified(lo, hi, mine)
        if whole:
            yield whole
            continue
        # parts of a segment may agree where the whole does not: the other side skips, repeats or
        # has them in another order; unbroken runs that lie in no such part are tried last
        parts = list(refined(mine))
        yield from parts
        for x, y in segments(shared[lo:hi], 1.0):
            if not any(p[0] <= lo + x and lo + y <= p[1] for p in parts):
                run = verified(lo + x, lo + y, np.arange(lo + x, lo + y))
                if run:
                    yield run


_PAIRS = ("a_chunk long, a_doc long, a_id long, a_start long, a_end long, b_chunk long, b_doc long, b_id long, b_start long, "
          "b_end long, similarity double")


def _verify(shortest: int, similarity: float):
    """A chunk: compare its documents with those they are linked to.  Rows without a similarity
    are the open ranges [a_start, a_end] of a chunk: those of places without a verified link, and of
    the first places of their keys.  A place with a verified link is spoken for by its partner,
    which came before it: in the end by an open place or by the first."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        me, rows, names = key[0].as_py(), [], [x.split()[0] for x in _PAIRS.split(", ")]
        opened = {me: [unpack(b) for _, b in rows_of(table, "open")]}
        links = [unpack(b) for _, b in rows_of(table, "link")]
        if links:
            text = _text(table)
            content = {p: b for p, b in rows_of(table, "content")}
            links = [np.concatenate(x).astype(np.int64) for x in zip(*links)]
            held = np.zeros(len(links[0]), bool)
            by_partner = np.argsort(links[3], kind="stable")
            for p, part in cut(links[3][by_partner]):
                place, left, right, _, p_place, p_left, p_right, _ = (x[by_partner[part]] for x in links)
                doc = text.doc(place)
                if p == me:
                    p_lo, p_hi, p_doc = p_place - p_left, p_place + p_right, text.doc(p_place)
                else:
                    s_lo, s_hi, s_doc, s_start, s_ids, shingle = unpack(content[p])
                    offset = np.cumsum(s_hi - s_lo + 1) - (s_hi - s_lo + 1)
                    span = np.searchsorted(s_lo, p_place, side="right") - 1
                    p_doc = s_doc[span]
                order = np.lexsort((p_doc, doc))
                width = int(p_doc.max()) + 1
                for pair, k in cut((doc * width + p_doc)[order]):
                    i = order[k]
                    d, e = pair // width, pair % width
                    inside = np.zeros(len(i), bool)
                    for lo, hi in zip(*_spans(place[i] - left[i], place[i] + right[i])):
                        mine = i[(place[i] >= lo) & (place[i] <= hi)]
                        if p == me:
                            pieces = [(x, text.run(x, y)) for x, y in zip(*_spans(p_lo[mine], p_hi[mine]))]
                            b_first, b_id = text.begin(e), text.id(e)
                        else:
                            which = np.unique(span[mine])
                            pieces = [(s_lo[q], shingle[offset[q]:offset[q] + s_hi[q] - s_lo[q] + 1]) for q in which]
                            b_first, b_id = s_start[which[0]], s_ids[which[0]]
                        for first, other in pieces:
                            for a0, a1, b0, b1, j in compare(text.run(lo, hi), other, shortest, similarity):
                                inside |= ((place[i] >= lo + a0) & (place[i] < lo + a1)
                                           & (p_place[i] >= first + b0) & (p_place[i] < first + b1))
                                a0, b0 = a0 + lo - text.begin(d), b0 + first - b_first
                                rows.append((me, d, int(text.id(d)), int(a0), int(a1 + lo - text.begin(d)) + SHINGLE - 1, p, e, int(b_id), int(b0),
                                             int(b1 + first - b_first) + SHINGLE - 1, j))
                    held[by_partner[part][i]] = inside
            place, left, right, peer, p_place, p_left, p_right, to_first = links
            own = (place << 16) | (left << 8) | right
            alone = ~np.isin(own, own[held])
            opened[me].append(((place - left)[alone], (place + right)[alone]))
            alone = np.flatnonzero(alone & (to_first > 0))
            alone = alone[np.argsort(peer[alone], kind="stable")]
            for p, k in cut(peer[alone]):
                i = alone[k]
                opened.setdefault(p, []).append((p_place[i] - p_left[i], p_place[i] + p_right[i]))
        for p, parts in opened.items():
            if sum(len(x[0]) for x in parts):
                lo, hi = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
                # ranges of other chunks stay as they are: the same from every chunk that meets them
                lo, hi = _spans(lo, hi) if p == me else np.unique(np.stack([lo, hi]), axis=1)
                rows += [(p, None, None, x, y, None, None, None, None, None, None) for x, y in zip(lo.tolist(), hi.tolist())]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.table({n: pa.array([None if n in ("a_id", "b_id") and x == NO_ID else x for x in c],
                                     pa.float64() if n == "similarity" else pa.int64()) for n, c in zip(names, columns)})
    return run


def similar_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 51,
                     similarity: float = 0.8) -> DataFrame:
    """Verified pairs of passages: chunk and number of the document, doc_id, first word and end
    (exclusive) of either side, and similarity."""
    shortest = min_words - SHINGLE + 1
    chunks = text_chunks(docs, doc_id, text)
    spark = docs.sparkSession
    shards = max(4, math.ceil((chunks.agg(F.sum("n")).first()[0] or 0) / SHARD_WORDS))
    texts = chunks.select(F.lit("text").alias("kind"), F.col("chunk").alias("key"), F.lit(0).cast("long").alias("peer"), "blob", "ids")

    def verified(met: DataFrame, texts: DataFrame) -> DataFrame:
        def with_text(rows: DataFrame):
            return texts.unionByName(rows, allowMissingColumns=True).groupBy("key")
        answers = written(with_text(met.filter("kind = 'need'")).applyInArrow(_answer, MESSAGE), "contents")
        release(spark)
        links = met.filter("kind in ('link', 'open')").unionByName(answers)
        found = written(with_text(links).applyInArrow(_verify(shortest, similarity), _PAIRS), "passage-pairs")
        release(spark, met, answers)
        return found
    met = written(chunks.select("chunk", "blob").mapInArrow(_send(shards, shortest), MESSAGE)
                  .groupBy("key").applyInArrow(_meet, MESSAGE), "links")
    release(spark)
    found, held = [verified(met, texts)], chunks
    for agree in ROUNDS:
        still = (found[-1].filter("similarity is null").distinct()
                 .select(F.lit("open").alias("kind"), F.col("a_chunk").alias("key"), F.col("a_start").alias("lo"), F.col("a_end").alias("hi")))
        still = written(still, "open")
        if still.isEmpty():
            break
        # chunks that hold open ranges, with them; what is open later lies within what is open now,
        # so the ranges are cut out here and stand for the chunks from now on
        of = texts.join(still.select("key").distinct(), "key", "left_semi").unionByName(still, allowMissingColumns=True)
        asked = written(of.groupBy("key").applyInArrow(_ask(shards), MESSAGE).groupBy("key").applyInArrow(_tally, MESSAGE), "open-parts")
        release(spark, held, still)
        met = written(asked.groupBy("key")
                      .applyInArrow(_rekey(shards, shortest, 2 * similarity / (1 + similarity), agree), MESSAGE)
                      .groupBy("key").applyInArrow(_meet, MESSAGE), "links")
        release(spark)
        held, texts = asked, asked.filter("kind = 'part'").withColumn("ids", F.lit(None).cast("array<long>"))
        found.append(verified(met, texts))
    release(spark, held)
    return reduce(DataFrame.unionByName, found).filter("similarity is not null")


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 51,
                    similarity: float = 0.8) -> DataFrame:
    """One row for each repeated passage of each document: doc_id, start_word, end_word (exclusive),
    n_words, passage_class (a key), class_doc_id (least doc_id of the class), n_docs (documents
    of the class) and repeats (false for the class's one passage to keep)."""
    pairs = similar_passages(docs, doc_id, text, min_words, similarity)
    side = [F.struct(*[F.col(f"{s}_{c}").alias(c) for c in ("chunk", "doc", "id", "start", "end")]) for s in "ab"]
    found = pairs.select(F.explode(F.array(*side)).alias("s")).select("s.*").distinct()
    in_doc = Window.partitionBy("chunk", "doc").orderBy("start", "end")
    reach = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    nodes = (found.withColumn("new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
             .withColumn("number", F.sum("new").over(in_doc))
             .withColumn("node", F.xxhash64("chunk", "doc", "number")))
    nodes = written(nodes.drop("new", "number"), "passages")

    def named(s):
        return nodes.select(*[F.col(c).alias(f"{s}_{c}") for c in ("chunk", "doc", "start", "end")], F.col("node").alias(s))
    edges = (pairs.join(named("a"), ["a_chunk", "a_doc", "a_start", "a_end"]).join(named("b"), ["b_chunk", "b_doc", "b_start", "b_end"])
             .select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = component_roots(edges)
    passages = (nodes.groupBy("chunk", "doc", "id", "node").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
                .join(roots, nodes["node"] == roots["node"], "left")
                .select("chunk", "doc", "id", "start_word", "end_word", F.coalesce("root", nodes["node"]).alias("passage_class")))
    passages = written(passages, "passage-classes")
    classes = (passages.select("passage_class", "chunk", "doc", "id").distinct().groupBy("passage_class")
               .agg(F.min("id").alias("class_doc_id"), F.count("*").alias("n_docs"),
                    F.min(F.struct(F.col("id").isNull(), "id", "chunk", "doc")).alias("kept")))
    at = F.struct(F.col("id").isNull(), "id", "chunk", "doc")
    return (passages.join(classes, "passage_class").withColumn("repeats", ~at.eqNullSafe(F.col("kept")))
            .select(F.col("id").alias(doc_id), "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                    "passage_class", "class_doc_id", "n_docs", "repeats"))
