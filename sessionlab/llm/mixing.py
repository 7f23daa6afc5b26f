"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words.  Among all document rates r in [0, max_copies]
that meet the targets the mix takes those of least relative entropy to one copy each,

    sum r log(r) + (m - r) log((m - r) / (m - 1)),     m = max_copies,

whose solution is an exponential tilt of the document size x (in units of the source's
mean): odds r / (m - r) = exp(lambda x) / (m - 1).  One multiplier per source solves the
convex dual; Newton steps are aggregates over the (source, size) histogram, kept inside a
bracket that shrinks every step.  Rates become copies source by source from the largest
size down, each size passing its rounding error on to the next smaller one; within a size
the extra copies go to the documents of smallest hash.  Nothing is drawn at random, so
reruns agree.

Defined cases: null text has size 0; a null source is a source of its own, last in order;
documents of size 0 take the rate their source gives them and no words; texts of any length are
counted whole; repeated rows share their hash order and count one by one; an empty table gives an empty result; input columns
that clash with output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import guarded, unguarded, words, written

#: documents ranked in one task at most (about)
RANK_ROWS = 20_000
#: (source, size) rows of a few numbers that are broadcast after counting them
BROADCAST_SIZES = 100_000
#: Newton steps after which a source that misses its target is an error; a bracket halves at least
MAX_STEPS = 200


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Targets are min(cap * size, level * weight): sharing the excess of capped sources by
    weight until none is above its cap ends at exactly this water level.  One row per
    source goes through the windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    k = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), k.cast("int") + 1)
    levels = (sizes.withColumn("weight", weight)
              .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
              .withColumn("fill", F.col("limit") / F.col("weight"))
              .withColumn("_t", F.sum("source_size").over(everything) * F.lit(float(share)))
              # if all sources that fill up earlier are capped, the rest stand at this level
              .withColumn("_capped", F.coalesce(F.sum("limit").over(by_level), F.lit(0.0)))
              .withColumn("_w", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)))
              .withColumn("_level", (F.col("_t") - F.col("_capped")) / F.col("_w"))
              .withColumn("_free", F.col("_level") < F.col("fill"))
              .withColumn("_at", F.min(F.when(F.col("_free"), F.struct("fill", "_level"))).over(everything)))
    return levels.select("source", "source_size",
                         F.when(F.col("_at").isNull() | (F.col("fill") < F.col("_at.fill")), F.col("limit"))
                         .otherwise(F.least("limit", F.col("weight") * F.col("_at._level"))).alias("target"))


def _rate(lam, x, cap: float):
    """r with odds r / (cap - r) = exp(lam x) / (cap - 1)."""
    return F.lit(cap) / (1 + F.lit(cap - 1) * F.exp(F.greatest(F.least(-lam * x, F.lit(700.0)), F.lit(-700.0))))


def solve_tilts(hist: DataFrame, targets: DataFrame, cap: float = 2.0, tolerance: float = 1e-6) -> DataFrame:
    """(source, source_size, target, unit, lam): lam null where the source stands at its cap.

    ``hist``: (source, size, n).  Each Newton step is one aggregate by source, pre-combined
    on every task; only the worst relative miss reaches the driver.
    """
    unit = hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("unit"))
    t, u = targets.alias("t"), unit.alias("u")
    state = (t.join(u, F.expr("t.source <=> u.source")).select("t.*", "u.unit")
             .withColumn("capped", (F.col("source_size") == 0) | (F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))))
             .withColumn("lam", F.when(~F.col("capped"), F.lit(0.0)))
             .withColumns({"lo": F.lit(float("-inf")), "hi": F.lit(float("inf")), "miss": F.lit(1.0)}))
    state = written(state, "mix-state")
    for _ in range(MAX_STEPS):
        h, s = hist.alias("h"), state.filter("NOT capped").select("source", "unit", "lam").alias("s")
        x = F.col("size") / F.col("unit")
        r = _rate(F.col("lam"), x, cap)
        moments = (h.join(s, F.expr("h.source <=> s.source")).select("h.source", "n", x.alias("x"), r.alias("r"))
                   .groupBy("source").agg(F.sum(F.col("n") * F.col("x") * F.col("r")).alias("got"),
                                          F.sum(F.col("n") * F.col("x") * F.col("x") * F.col("r")
                                                * (F.lit(cap) - F.col("r")) / F.lit(cap)).alias("slope")))
        s, m = state.alias("s"), moments.alias("m")
        want = F.col("target") / F.col("unit")
        over = F.col("got") > want
        lo = F.when(over, F.col("lo")).otherwise(F.col("lam"))
        hi = F.when(over, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.col("got") - want) / F.greatest(F.col("slope"), F.lit(1e-300))
        inside = (newton > F.col("lo2")) & (newton < F.col("hi2")) & (F.abs(newton - F.col("lam")) <= 2 + F.abs(F.col("lam")))
        half = (F.when(F.col("lo2") == float("-inf"), 2 * F.col("hi2") - 1 - F.abs(F.col("hi2")))
                .when(F.col("hi2") == float("inf"), 2 * F.col("lo2") + 1 + F.abs(F.col("lo2")))
                .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        stepped = (s.join(m, F.expr("s.source <=> m.source"), "left").select("s.*", "m.got", "m.slope")
                   .withColumns({"lo2": lo, "hi2": hi, "miss": F.when(F.col("capped"), 0.0).otherwise(F.abs(F.col("got") - want) / want)})
                   .withColumn("lam2", F.when(F.col("capped"), F.lit(None).cast("double"))
                               .when(F.col("miss") <= tolerance, F.col("lam")).when(inside, newton).otherwise(half))
                   .select("source", "source_size", "target", "unit", "capped", F.col("lam2").alias("lam"),
                           F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "miss"))
        state = written(stepped, "mix-state")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= tolerance:
            break
    else:
        raise RuntimeError(f"the dual did not settle in {MAX_STEPS} Newton steps")
    return state.select("source", "source_size", "target", "unit", "lam")


def _round_sizes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of one source (at most as many rows as the longest text has
    words), largest first, the error in words handed down."""
    pdf = pdf.sort_values("size", ascending=False, kind="mergesort")
    carry, total = 0.0, np.zeros(len(pdf), np.int64)
    for i, (size, n, rate, most) in enumerate(zip(pdf["size"], pdf["n"], pdf["rate"], pdf["most"])):
        want = n * rate + (carry / size if size else 0.0)
        total[i] = min(max(int(np.floor(want + 0.5)), 0), int(most) * int(n))
        carry += (n * rate - total[i]) * size
    return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "n": pdf["n"], "rate": pdf["rate"], "copies_all": total,
                         "source_size": pdf["source_size"], "target": pdf["target"]})


def mix(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[float, ...] = (5.0, 2.0, 1.0),
        share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, rate, copies and taken (words the
    mix takes of it: copies * size)."""
    cap = float(max_copies)
    out = ["size", "source_size", "target", "rate", "copies", "taken"]
    ident = F.xxhash64(*[F.to_json(f"`{f.name}`") if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                         for f in docs.schema.fields])
    base = (guarded(docs.withColumn("_row_hash", ident), [text, source, "_row_hash"], out).withColumnRenamed("_row_hash", "_h")
            .withColumn("size", F.size(words(F.col(text))).cast("long")))
    counts = written(base.groupBy(F.col(source).alias("source"), "size").agg(F.count("*").alias("n")), "mix-sizes")
    sizes = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    tilts = solve_tilts(counts, source_targets(sizes, weights, share, cap), cap)
    c, t = counts.alias("c"), tilts.alias("t")
    rated = (c.join(t, F.expr("c.source <=> t.source"))
             .select("c.source", "size", "n", "source_size", "target", F.lit(max_copies).alias("most"),
                     F.when(F.col("lam").isNull(), F.lit(cap)).otherwise(
                         _rate(F.col("lam"), F.col("size") / F.col("unit"), cap)).alias("rate")))
    schema = "source string, size long, n long, rate double, copies_all long, source_size long, target double"
    plan = written(rated.groupBy("source").applyInPandas(_round_sizes, schema), "mix-plan")
    plan = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "rate", "copies_all",
                       "source_size", "target")
    if plan.count() <= BROADCAST_SIZES:
        plan = F.broadcast(plan)
    # ranks inside a size: large groups are ranked in hash slices, each with its exact share
    slices = F.ceil(F.col("n") / RANK_ROWS)
    joined = (base.join(plan, F.expr(f"`{source}` <=> p_source AND size = p_size"))
              .withColumn("_slice", F.pmod(F.col("_h"), slices)))
    in_slice = (joined.filter(F.col("n") > RANK_ROWS).groupBy("p_source", "p_size", "n", "copies_all", "_slice")
                .agg(F.count("*").alias("m"))
                .withColumn("upto", F.sum("m").over(Window.partitionBy("p_source", "p_size").orderBy("_slice"))))
    extra_all = F.pmod(F.col("copies_all"), F.col("n"))
    quota = (in_slice.withColumn("quota", F.floor(extra_all * F.col("upto") / F.col("n"))
                                 - F.floor(extra_all * (F.col("upto") - F.col("m")) / F.col("n")))
             .select(F.col("p_source").alias("q_source"), F.col("p_size").alias("q_size"), F.col("_slice").alias("q_slice"), "quota"))
    rank = F.row_number().over(Window.partitionBy("p_source", "p_size", "_slice").orderBy("_h"))
    ranked = (joined.withColumn("_rank", rank)
              .join(quota, F.expr("p_source <=> q_source AND p_size = q_size AND _slice = q_slice"), "left"))
    done = (ranked.withColumn("copies", (F.floor(F.col("copies_all") / F.col("n"))
                                         + (F.col("_rank") <= F.coalesce(F.col("quota"), extra_all)).cast("long")).cast("int"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_h", "_slice", "_rank", "n", "copies_all", "p_source", "p_size", "q_source", "q_size", "q_slice", "quota"))
    return unguarded(done, docs.columns, [text, source], out)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as its copies."""
    return (mixed.filter(F.col("copies") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
