"""Centroid clustering of vectors by scalar lookup tables (Lloyd rounds in integers).

Every component becomes the integer ``floor(scale * x)``.  Vectors are laid out once as blocks of
at most ``BLOCK`` vectors: for each dimension the integer values that occur in the block, sorted,
and for each vector the number of its value.  A round tabulates for each block the squared
difference of every dimension, occurring value and centroid; the distance of a vector is then a
sum of table entries gathered by its value numbers, with no arithmetic on the vectors themselves.

A round is one pass over the written blocks.  Each task sums the components of its clusters in
64-bit integers, Spark adds them up by (cluster, dimension), and only those sums (``k`` times the
dimensions, whatever the input) reach the driver, which floors the exact quotients.  Vectors are
never shuffled, so repeated vectors and clusters that hold most rows cost nothing extra; a lost
executor costs a re-read of its blocks.  A task holds one block and its table (at most ``BLOCK``
values a dimension).

Defined results: vectors that are null, of another length, or hold a null or non-finite component
take no part; ties go to the smaller centroid number; starting vectors with equal hashes (repeated
ids) go by their components; a null id counts as the empty text in its hash and stays null in the
result; fewer vectors than ``k`` start as many centroids; empty tables give empty results; other
columns are not read, so their names cannot clash.  Components whose squares would leave 64 bits
(beyond ``2**27`` after scaling) are an error, never a wrong distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import written

BLOCK = 1 << 14
LARGEST = 1 << 27


def _blocks(dims: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("v")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            scaled = np.floor(flat.reshape(-1, dims) * scale)
            if len(scaled) and np.abs(scaled).max() > LARGEST:
                raise ArithmeticError(f"a component is beyond {LARGEST} after scaling")
            x = scaled.astype(np.int64)
            for at in range(0, len(x), BLOCK):
                values, codes, first = [], [], [0]
                for d in range(dims):
                    seen, code = np.unique(x[at:at + BLOCK, d], return_inverse=True)
                    values.append(seen)
                    codes.append(code.astype("<u2"))
                    first.append(first[-1] + len(seen))
                yield pa.record_batch([
                    pa.array([ids.slice(at, BLOCK).to_pylist()], pa.list_(ids.type)),
                    pa.array([np.concatenate(values).astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.array(first, "<i8").tobytes()], pa.binary()),
                    pa.array([np.concatenate(codes).tobytes()], pa.binary())], names=["ids", "vals", "first", "codes"])
    return run


def _usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def value_blocks(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64,
                 scale: float = 1024.0) -> DataFrame:
    """(ids, vals, first, codes): blocks of whole vectors as numbers of their occurring values,
    written to the shared folder."""
    kept = (vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
            .filter(_usable(F.col("v"), dims)))
    id_type = kept.schema["id"].dataType.simpleString()
    return written(kept.mapInArrow(_blocks(dims, scale), f"ids array<{id_type}>, vals binary, first binary, codes binary"), "blocks")


def _starts(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: float, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of least sha256 of ``seed:vec_id``, as integers, in that order."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    kept = vectors.filter(_usable(v, dims))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{vec_id}`").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name, 256).alias("h"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("c"))
    return np.array([r["c"] for r in first.orderBy("h", "c").limit(k).collect()], np.int64).reshape(-1, dims)


def _nearest(vals: bytes, first: bytes, codes: bytes, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components by dimension, cluster, squared distance) of a block's vectors."""
    values, first = np.frombuffer(vals, "<i8"), np.frombuffer(first, "<i8")
    dims = len(first) - 1
    # entry of the table for each dimension and vector
    at = np.frombuffer(codes, "<u2").reshape(dims, -1) + first[:-1, None]
    dim = np.repeat(np.arange(dims), np.diff(first))
    best = cluster = None
    for c, centroid in enumerate(centroids):
        table = (values - centroid[dim]) ** 2
        total = np.zeros(at.shape[1], np.int64)
        for d in range(dims):
            total += table[at[d]]
        if best is None:
            best, cluster = total, np.zeros(len(total), np.int32)
        else:
            closer = total < best
            best[closer], cluster[closer] = total[closer], c
    return values[at], cluster, best


def _sums(centroids: np.ndarray):
    """A block's share of a round: rows (cluster, dimension, vectors, sum of components); dimension
    -1 carries the sum of distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, cluster, distance = _nearest(row["vals"], row["first"], row["codes"], centroids)
                out = []
                for c in range(len(centroids)):
                    own = cluster == c
                    if n := int(own.sum()):
                        out += [(c, d, n, int(s)) for d, s in enumerate(x[:, own].sum(axis=1))]
                        out.append((c, -1, n, int(distance[own].sum())))
                yield pa.record_batch([pa.array(col, t) for col, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                      names=["cluster", "dim", "n", "s"])
    return run


def _round(blocks: DataFrame, centroids: np.ndarray) -> dict[int, dict[int, tuple[int, int]]]:
    """cluster -> dimension -> (vectors, exact sum); bounded by clusters and dimensions."""
    sums = blocks.select("vals", "first", "codes").mapInArrow(_sums(centroids), "cluster int, dim int, n long, s long")
    got: dict[int, dict[int, tuple[int, int]]] = {}
    for r in sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        got.setdefault(r["cluster"], {})[r["dim"]] = (r["n"], int(r["s"]))
    return got


def _assign(centroids: np.ndarray, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, cluster, distance = _nearest(row["vals"], row["first"], row["codes"], centroids)
                yield pa.record_batch([pa.array(row["ids"], id_type), pa.array(cluster), pa.array(distance)],
                                      names=["id", "cluster", "distance"])
    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64, k: int = 8,
            rounds: int = 10, scale: float = 1024.0, seed: str = "3") -> DataFrame:
    """One row per usable vector: ``vec_id``, cluster, distance (squared, to its final centroid),
    cluster_size, cluster_inertia, inertia, centroid (array of longs) and centroid_sha256."""
    from pyspark.sql.pandas.types import to_arrow_type

    blocks = value_blocks(vectors, vec_id, embedding, dims, scale)
    centroids = _starts(vectors, vec_id, embedding, dims, scale, k, seed)
    for _ in range(rounds):
        for c, by_dim in _round(blocks, centroids).items():
            centroids[c] = [by_dim[d][1] // by_dim[d][0] for d in range(dims)]
    last = {c: by_dim[-1] for c, by_dim in _round(blocks, centroids).items()}
    total = sum(s for _, s in last.values())
    id_type = blocks.schema["ids"].dataType.elementType
    out = (blocks.mapInArrow(_assign(centroids, to_arrow_type(id_type)), f"id {id_type.simpleString()}, cluster int, distance long")
           .withColumn("_of", F.element_at(_facts(centroids, last), F.col("cluster") + 1)))
    return out.select(F.col("id").alias(vec_id), "cluster", "distance", F.col("_of.n").alias("cluster_size"),
                      F.col("_of.s").alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"),
                      F.col("_of.c").alias("centroid"), F.col("_of.h").alias("centroid_sha256"))


def _facts(centroids: np.ndarray, last: dict[int, tuple[int, int]]) -> Column:
    """What is the same for all vectors of a cluster, as an array constant by cluster number."""
    rows = [F.struct(F.lit(last.get(c, (0, 0))[0]).cast("long").alias("n"), F.lit(last.get(c, (0, 0))[1]).cast("long").alias("s"),
                     F.array(*[F.lit(int(v)).cast("long") for v in x]).alias("c"), F.lit(digest(x)).alias("h"))
            for c, x in enumerate(centroids)]
    return F.array(*rows) if rows else F.lit(None).cast("array<struct<n:bigint,s:bigint,c:array<bigint>,h:string>>")
