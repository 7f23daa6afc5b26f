"""Connected components of an edge table by alternating large and small stars.

Every round is two grouped minima and two joins over the remaining edges and is written to
the shared folder; no link, component or node is collected.  The number of rounds grows
with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller end
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    near = e.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def component_roots(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node of the component
    and has a row of its own only as a root of others.  Rounds grow with the logarithm of the
    longest chain; if ``max_rounds`` were ever not enough, that is an error, not a result."""
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .filter(F.col("u") != F.col("v")).distinct())
    e = written(e, "edges")
    seen = None
    for _ in range(max_rounds):
        e = written(_small_star(_large_star(e)), "edges")
        state = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
