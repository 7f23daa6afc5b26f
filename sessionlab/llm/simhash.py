"""SimHash near-dedup by exact tiled comparison.

Texts get a 64-bit fingerprint of their word shingles.  Distinct fingerprints are dealt into
tiles by the population counts of their four 16-bit quarters.  Two fingerprints within the
radius cannot differ by more than the radius in the sum of those counts, so all other tile
pairs are skipped; the pairs left are compared exactly with numpy exclusive-or and bit
counts.  A tile pair returns no list of pairs but a spanning star of each of its local
groups, so a large group of near copies costs links in proportion to its size.

Defined cases: null text is the empty text; a text without words has fingerprint zero and
links like any other; texts of fewer words than a shingle are one shingle, of any length are
read whole; a bit set by exactly half the hashes is 0; repeated rows and
repeated doc_ids share a component; a component_id is the least non-null doc_id reachable
(null if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.llm.common import guarded, small_batches, unguarded, written
from sessionlab.llm.components import component_roots

SEED = 42
QUARTERS = 4
#: fingerprints in a tile (about); a pair of tiles compares at most its square at once
TILE = 1024
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text: a bit is set if more than half the shingle hashes set it."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(w))
    start = (end - size)[:len(w) - k + 1].tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[i:j], SEED) for i, j in zip(start, end[k - 1:].tolist())], np.uint64)
    by_byte = h.view(np.uint8).reshape(-1, 8)   # little-endian
    counts = np.concatenate([np.bincount(by_byte[:, b], minlength=256) @ _BITS for b in range(8)])
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def _fingerprint_udf(shingle: int):
    @F.pandas_udf(T.LongType())
    def f(text: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint(x, shingle) for x in text), np.uint64, len(text))
        return pd.Series(out.view(np.int64))
    return f


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the long column ``_fp``."""
    small_batches(docs.sparkSession)
    return docs.withColumn("_fp", _fingerprint_udf(shingle)(F.col(text)))


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that links can have, one of each opposite pair."""
    r = range(-radius, radius + 1)
    zero = (0,) * QUARTERS
    return [d for d in product(r, repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= zero]


def _stars(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Links between tiles ``a`` and ``b`` reduced to (fingerprint, least of its local group)."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if same:
        np.fill_diagonal(near, False)
    i, j = np.nonzero(near)
    if not len(i):
        return None
    by_j = np.argsort(j, kind="stable")
    rows, i_at = np.unique(i, return_index=True)
    cols, j_at = np.unique(j[by_j], return_index=True)
    la, lb = a.copy(), b.copy()
    while True:
        na = np.minimum(la[rows], np.minimum.reduceat(lb[j], i_at))
        moved = not np.array_equal(na, la[rows])
        la[rows] = na
        if same:
            lb = la
        nb = np.minimum(lb[cols], np.minimum.reduceat(la[i[by_j]], j_at))
        moved = moved or not np.array_equal(nb, lb[cols])
        lb[cols] = nb
        if same:
            la = lb
        if not moved:
            break
    u, v = np.concatenate([a[rows], b[cols]]), np.concatenate([la[rows], lb[cols]])
    return u[u != v], v[u != v]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a"), batch.column("b")
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = left.values.to_numpy().view(np.uint64), right.values.to_numpy().view(np.uint64)
            same = batch.column("same").to_pylist()
            us, vs = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for k in range(batch.num_rows):
                found = _stars(lv[lo[k]:lo[k + 1]], rv[ro[k]:ro[k + 1]], same[k], radius)
                if found:
                    us.append(found[0])
                    vs.append(found[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us).view(np.int64)),
                                              pa.array(np.concatenate(vs).view(np.int64))], names=["u", "v"])
    return run


def fingerprint_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Spanning links (u, v) between the distinct fingerprints ``fps`` (column ``_fp``)."""
    cell = None
    for q in range(QUARTERS):
        count = F.bit_count(F.shiftrightunsigned("_fp", 16 * q).bitwiseAND(F.lit(0xFFFF)))
        cell = count if cell is None else cell * 17 + count
    cells = fps.select("_fp", cell.alias("cell"))
    # at most 17^4 rows: broadcasting the number of tiles of each cell is safe
    chunks = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiles = written(cells.join(F.broadcast(chunks), "cell")
                    .withColumn("tile", F.pmod(F.xxhash64("_fp"), F.col("tiles")))
                    .groupBy("cell", "tile").agg(F.collect_list("_fp").alias("fps")), "simhash-tiles")
    # quarter counts lie in 0..16, so a neighbour outside that range is no cell
    steps = F.explode(F.array(*[F.array(*[F.lit(x) for x in d]) for d in _offsets(radius)]))
    left = tiles.select(F.col("cell").alias("c"), F.col("tile").alias("t"), F.col("fps").alias("a"), steps.alias("d"))
    at = [F.floor(F.col("c") / 17 ** (QUARTERS - 1 - q)) % 17 + F.col("d")[q] for q in range(QUARTERS)]
    inside, key = F.lit(True), F.lit(0).cast("long")
    for x in at:
        inside, key = inside & x.between(0, 16), key * 17 + x
    pairs = (left.filter(inside).withColumn("n", key)
             .join(tiles.select(F.col("cell").cast("long").alias("n"), F.col("tile").alias("t2"), F.col("fps").alias("b")), "n")
             .filter((F.col("c") != F.col("n")) | (F.col("t") <= F.col("t2")))
             .select("a", "b", ((F.col("c") == F.col("n")) & (F.col("t") == F.col("t2"))).alias("same")))
    return pairs.mapInArrow(_compare(radius), "u long, v long").distinct()


def linked(docs: DataFrame, doc_id: str = "doc_id", radius: int = 3) -> DataFrame:
    """``docs`` (with ``_fp``) with ``fingerprint`` (16 hex digits), ``component`` (least
    fingerprint of the component, a key) and ``component_id``."""
    fps = written(docs.groupBy("_fp").agg(F.min(doc_id).alias("_least")), "simhash-fps")
    roots = component_roots(fingerprint_links(fps.select("_fp"), radius))
    joined = written(fps.join(roots, fps["_fp"] == roots["node"], "left")
                     .select("_fp", "_least", F.coalesce("root", "_fp").alias("component")), "simhash-roots")
    ids = joined.groupBy("component").agg(F.min("_least").alias("component_id"))
    by_fp = joined.join(ids, "component").select("_fp", "component", "component_id")
    out = ["fingerprint", "component", "component_id"]
    return (docs.drop(*[c for c in docs.columns if c.lower() in out])
            .join(by_fp, "_fp", "left")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("_fp"), 16, "0"))).drop("_fp"))


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   radius: int = 3) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and component."""
    out = ["fingerprint", "component", "component_id"]
    own = fingerprints(guarded(docs, [doc_id, text], out), text, shingle)
    return unguarded(linked(written(own, "simhash-docs"), doc_id, radius), docs.columns, [doc_id, text], out)


def one_per_component(groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: the least doc_id, of several such rows the least text."""
    first = groups.filter(F.col(doc_id).eqNullSafe(F.col("component_id")))
    rest = [c for c in groups.columns if c not in (doc_id, text, "component")]
    least = F.min_by(F.struct(doc_id, text, *rest), F.struct(doc_id, text)).alias("s")
    return first.groupBy("component").agg(least).select("component", "s.*").select(*groups.columns)
