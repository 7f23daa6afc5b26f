"""Byte-level BPE: texts to token ids and back, by the ranks of a public vocabulary.

A text is cut by the tokenizer's pattern; each piece is merged on its own.  The bytes of a piece
are the leaves of a segment tree whose nodes hold the least ``rank << 32 | position`` below them,
so its root is the leftmost pair of minimum rank.  A merge writes three leaves (the merged pair,
the pair of its live left neighbour, and the swallowed one) and their ancestors: a piece of n
bytes costs O(n log n), a run of a million equal letters too.

Nothing is shuffled: documents are encoded where they are read.  The rank file (its size is that
of the vocabulary, not of the data) is broadcast as bytes and parsed once a worker.  Pieces repeat
as words do, so a worker keeps the ids of pieces of at most ``CACHE_BYTES`` bytes, in two
generations of ``CACHE_PIECES``: memory is bounded and results never depend on what is kept.

Defined results: a null text is the empty text (no ids, empty bytes); a row comes out for every
row that comes in, repeated ones too; texts of any length are encoded whole, those above
``LONG_CHARS`` in slices of pieces; ties between pairs of one rank fall to the leftmost; columns
named like the output are replaced, all others pass through; an empty table gives an empty one.
A piece that is a token as a whole is that token, as in the tiktoken library.  Letters that came
with Unicode 17 or later may be cut as the installed ``regex`` knows them.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import islice
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import guarded, small_batches, text_or_empty, unguarded

CACHE_PIECES = 1 << 18   # about 50 MB a generation
CACHE_BYTES = 64
SHORT = 64   # bytes of a piece up to which a search through all pairs is quicker than the tree
#: texts beyond are cut into pieces step by step, so that their pieces never lie in memory at once
LONG_CHARS = 1 << 20
SLICE_PIECES = 1 << 16
_NONE = 1 << 62
_AT = (1 << 32) - 1


def ranks_of(file: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines()) if token}


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` of a few bytes: the ranks of all pairs in a list that is searched after each merge."""
    rank = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    low = [rank(piece[i:i + 2], _NONE) for i in range(len(piece) - 1)]
    while low and (least := min(low)) != _NONE:
        i = low.index(least)
        parts[i] += parts.pop(i + 1)
        del low[i]
        if i < len(low):
            low[i] = rank(parts[i] + parts[i + 1], _NONE)
        if i:
            low[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the tokens of one piece: the leftmost pair of least rank is merged until none is left."""
    n = len(piece)
    if n <= SHORT:
        return _merge_short(piece, ranks)
    rank = ranks.get
    size = 1 << (n - 2).bit_length()          # leaves: the n - 1 neighbouring pairs
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        r = rank(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after = list(range(1, n + 1))             # start of the token that follows the one at i
    before = list(range(-1, n))               # start of the token that goes before it
    while (top := tree[1]) != _NONE:
        i = top & _AT
        j = after[i]
        k = after[i] = after[j]
        points = [(i, _NONE)]
        if k < n:
            before[k] = i
            points = [(j, _NONE), (i, _NONE if (r := rank(piece[i:after[k]])) is None else r << 32 | i)]
        if (h := before[i]) >= 0:
            points.append((h, _NONE if (r := rank(piece[h:k])) is None else r << 32 | h))
        for at, low in points:
            at += size
            tree[at] = low
            while at > 1:
                other = tree[at ^ 1]
                at >>= 1
                if other < low:
                    low = other
                if tree[at] == low:
                    break
                tree[at] = low
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class _Pieces(dict):
    """Text piece to its ids as little-endian int32 bytes; a missing piece is merged."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.old: dict[str, bytes] = {}       # the generation before: what is used again moves up

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            found = [whole] if whole is not None else merge(raw, self.ranks)
            ids = pack(f"<{len(found)}i", *found)
            if len(raw) > CACHE_BYTES:
                return ids
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Texts to ids by one rank file and one pattern."""

    def __init__(self, file: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(ranks_of(file))

    def encode(self, text: str) -> np.ndarray:
        ids = self.pieces.__getitem__
        if len(text) <= LONG_CHARS:
            return np.frombuffer(b"".join(map(ids, self.pattern.findall(text))), "<i4")
        found, out = self.pattern.finditer(text), []
        while part := b"".join(ids(m.group()) for m in islice(found, SLICE_PIECES)):
            out.append(part)
        return np.frombuffer(b"".join(out), "<i4")


class Decoder:
    """Ids to bytes: one gather over the bytes of all tokens laid end to end."""

    def __init__(self, file: bytes):
        tokens = {rank: token for token, rank in ranks_of(file).items()}
        self.size = np.zeros(max(tokens, default=-1) + 1, np.int64)
        for rank, token in tokens.items():
            self.size[rank] = len(token)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.data = np.frombuffer(b"".join(tokens.get(r, b"") for r in range(len(self.size))), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all():
            raise ValueError("an id is not in the vocabulary")
        out = []
        for at in range(0, len(ids), SLICE_PIECES):
            part = ids[at:at + SLICE_PIECES]
            size = self.size[part]
            ends = np.cumsum(size)
            out.append(self.data[np.arange(ends[-1]) + np.repeat(self.start[part] - ends + size, size)].tobytes())
        return b"".join(out)


_CACHE: dict = {}   # one encoder and one decoder a worker


def _own(kind: str, shared, make: Callable):
    if _CACHE.get(kind, (None,))[0] is not shared.value:
        _CACHE[kind] = (shared.value, make())
    return _CACHE[kind][1]


def _rank_file(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Every row with ``ids`` (array of ints), the tokens of its whole ``text`` by the rank file at
    ``path`` (on the driver) and the ``pattern`` that cuts texts into pieces."""
    shared = _rank_file(docs, path)
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _own("encoder", shared, lambda: Encoder(shared.value, pattern))
        for part in parts:
            yield pd.Series([own.encode(t) for t in part], dtype=object)

    out = guarded(docs, [text], ["ids"]).withColumn("ids", ids_of(text_or_empty(F.col(text))))
    return unguarded(out, docs.columns, [text], ["ids"])


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded`` (binary), the bytes of its ``ids``; null ids have none.  An id
    outside the vocabulary is an error."""
    shared = _rank_file(tokens, path)
    small_batches(tokens.sparkSession)

    @F.pandas_udf("binary")
    def bytes_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _own("decoder", shared, lambda: Decoder(shared.value))
        for part in parts:
            yield pd.Series([own.decode(np.asarray([] if x is None else x, np.int64)) for x in part], dtype=object)

    out = guarded(tokens, [ids], ["decoded"]).withColumn("decoded", bytes_of(F.col(f"`{ids}`")))
    return unguarded(out, tokens.columns, [ids], ["decoded"])
