"""Centroid clustering against a plain loop over Python integers, and its edge cases."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from sessionlab.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, dims, k, rounds, scale=1024):
    """(vec_id, cluster, distance) and final centroids, vector by vector."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cs = [v for _, v in sorted((name(i), v) for i, v in kept)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))[::-1]
    for _ in range(rounds):
        at = [near(v)[0] for _, v in kept]
        for n in range(len(cs)):
            own = [v for a, (_, v) in zip(at, kept) if a == n]
            if own:
                cs[n] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, *near(v)) for i, v in kept], cs


def rows_of(n, dims):
    # float32 values of a fixed rule, negative ones included, with exact ties
    return [(i, [((i * 37 + d * 11) % 23 - 11) / 32 + ((i % 5) - 2) / 8 for d in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("k,dims,block", [(8, 4, 1 << 14), (3, 5, 7), (5, 3, 1)])
def test_equals_plain_loop(spark, monkeypatch, k, dims, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = rows_of(60, dims) + [(3, None), (100, [0.5] * (dims - 1)), (101, [float("nan")] * dims), (102, [float("inf")] * dims),
                                (103, [None] * dims), (None, [0.25] * dims), (7, rows_of(8, dims)[7][1])]
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA).repartition(5), dims=dims, k=k, rounds=4).collect()
    want, cs = brute(rows, dims, k, 4)
    assert sorted(((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in got)) == sorted((i is None, i or 0, c, d) for i, c, d in want)
    for r in got:
        own = [d for _, c, d in want if c == r.cluster]
        assert (r.cluster_size, r.cluster_inertia, r.inertia) == (len(own), sum(own), sum(d for *_, d in want))
        assert r.centroid == cs[r.cluster]
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster(empty).collect() == []
    # fewer vectors than centroids, all equal: the tie goes to centroid 0, the others stay empty
    same = spark.createDataFrame([(i, [0.5] * 64) for i in range(3)], SCHEMA)
    assert {(r.cluster, r.distance) for r in centroids.cluster(same).collect()} == {(0, 0)}
    # other columns, whatever their names, are not read; a text id works
    named = same.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("vec_id"), "embedding", F.lit(9).alias("cluster"),
                        F.lit("x").alias("ids"), F.lit(None).alias("distance"))
    assert sorted(r.vec_id for r in centroids.cluster(named, k=2).collect()) == ["v0", "v1", "v2"]
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)).collect()
