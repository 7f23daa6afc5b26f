"""Texts as rows of hashed words, and arrays as messages between groups.

A chunk row holds whole documents of about CHUNK_WORDS words: vocabulary (sorted hashes),
word numbers (an end token closes each text) and words by document.  Messages are rows (kind,
key, peer, blob); a group receives those of its key and sends others on.
"""

from __future__ import annotations

import pickle
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import small_batches, text_or_empty, written
from sessionlab.llm.tokens import word_hashes

CHUNK_WORDS = 1_000_000
END = np.uint64(0x5E2D_58D8_B3BC_DF11)
MESSAGE = "kind string, key long, peer long, blob binary"
_ARROW = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("peer", pa.int64()), ("blob", pa.binary())])


def pack(*values) -> bytes:
    """Arrays (of one or two dimensions) with a few bytes of header each; anything else is pickled."""
    if not all(isinstance(v, np.ndarray) for v in values):
        return b"p" + zstandard.compress(pickle.dumps(values, 5), 1)
    head, body = [], []
    for v in values:
        v = np.ascontiguousarray(v)
        head.append(struct.pack("<2sBqq", v.dtype.str[1:].encode(), v.ndim, v.shape[0], v.shape[-1]))
        body.append(v.tobytes())
    return b"a" + bytes([len(values)]) + zstandard.compress(b"".join(head + body), 1)


def unpack(blob: bytes) -> tuple:
    if blob[:1] == b"p":
        return pickle.loads(zstandard.decompress(blob[1:]))
    n, raw, step = blob[1], zstandard.decompress(blob[2:]), struct.calcsize("<2sBqq")
    out, at = [], n * step
    for k in range(n):
        kind, dims, rows, columns = struct.unpack_from("<2sBqq", raw, k * step)
        kind, size = np.dtype(kind.decode()), rows * (columns if dims == 2 else 1)
        v = np.frombuffer(raw, kind, size, at)
        out.append(v.reshape(rows, columns) if dims == 2 else v)
        at += size * kind.itemsize
    return tuple(out)


def messages(rows: list[tuple[str, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)


def rows_of(table: pa.Table, kind: str) -> list[tuple[int, bytes]]:
    """(peer, blob) of one kind, ordered by peer."""
    t = table.select(["kind", "peer", "blob"])
    own = [(p, b) for k, p, b in zip(*(t.column(c).to_pylist() for c in ("kind", "peer", "blob"))) if k == kind]
    return sorted(own)


def cut(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal sorted keys."""
    at = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b > a:
            yield int(keys[a]), slice(a, b)


def _planes(ids: np.ndarray) -> np.ndarray:
    """Byte planes: the high bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to rows (chunk, ids, held, blob): vocabulary and word numbers of whole documents."""
    part, number = TaskContext.get().partitionId(), 0
    words, sizes, ids, held, total = [], [], [], [], 0

    def row():
        nonlocal number
        h, n = np.concatenate(words), np.concatenate(sizes)
        vocab, inverse = np.unique(h, return_inverse=True)
        blob = pack(vocab, _planes(inverse), n.astype(np.uint32))
        out = pa.record_batch([pa.array([(part << 20) + number]), pa.array([sum(ids, [])], pa.list_(pa.int64())),
                               pa.array([sum(held, [])], pa.list_(pa.bool_())), pa.array([len(h)]), pa.array([blob], pa.binary())],
                              names=["chunk", "ids", "held", "n", "blob"])
        number += 1
        for x in (words, sizes, ids, held):
            x.clear()
        return out
    for batch in batches:
        h, n = word_hashes(batch.column("text").to_pylist())
        ends = np.cumsum(n)
        words.append(np.insert(h, ends, END))   # the end token after each text
        sizes.append(n + 1)
        ids.append(batch.column("id").to_pylist())
        held.append(batch.column("held").to_pylist())
        total += len(words[-1])
        if total >= CHUNK_WORDS:
            yield row()
            total = 0
    if words:
        yield row()


def words_of(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, word numbers, words by document) of a chunk."""
    vocab, planes, sizes = unpack(blob)
    return vocab, np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64), sizes


def text_chunks(docs: DataFrame, doc_id: str, text: str, held: Column | None = None) -> DataFrame:
    """(chunk, ids, held, n, blob) of the texts, written to the shared folder."""
    held = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    small_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), held.alias("held"), text_or_empty(F.col(text)).alias("text"))
    chunks = written(source.mapInArrow(_chunks, "chunk long, ids array<long>, held array<boolean>, n long, blob binary"), "chunks")
    small_batches(docs.sparkSession, 4)     # a chunk is a row of megabytes
    return chunks
