"""Deterministic splits (D5-D8) and per-class quotas.

Rows are ordered inside their class by ``md5(key:seed)``, then by key, so a
split never depends on partitioning or task order.  The rank inside a class
is a two-level prefix count: the leading 16 hash bits form buckets; bucket
sizes (a small table) give offsets; a window partitioned by (class, bucket)
numbers rows inside a bucket.  No window ever spans a whole class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.constants import N_FOLDS, RANDOM_STATE, TEST_SIZE
from sessionlab.functions.exprs import hash_bucket, split_hash
from sessionlab.operators.joins import lookup_join


def class_rank(df: DataFrame, label: str | None, key: str = "user_session", seed: int = RANDOM_STATE,
               bits: int = 16, out: str = "rank") -> DataFrame:
    """1-based rank of each row inside its class in (md5(key:seed), key) order."""
    groups = [label] if label else []
    d = df.withColumn("_h", split_hash(key, seed)).withColumn("_hb", hash_bucket("_h", bits))
    sizes = d.groupBy(*groups, "_hb").agg(F.count(F.lit(1)).alias("_n"))
    wo = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy("_hb")
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(wo.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0))).drop("_n")
    # (#classes x 2**bits) rows: the class count comes from the data, so the
    # side is measured before it is broadcast
    d = lookup_join(d, sizes, [*groups, "_hb"], "inner", cache=True)
    wr = Window.partitionBy(*groups, "_hb").orderBy("_h", key)
    return d.withColumn(out, F.col("_off") + F.row_number().over(wr)).drop("_h", "_hb", "_off")


def split_quotas(df: DataFrame, label: str, test_size: float = TEST_SIZE) -> DataFrame:
    """Per-class test counts of a stratified shuffle split: n_test =
    ceil(test_size*n); the train share n - n_test is spread by largest
    remainder (ties to the smaller class label); test takes the rest."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    allw = Window.partitionBy()  # one row per class
    n = F.sum("n_c").over(allw)
    c = c.withColumn("_n", n).withColumn("_ntest", F.ceil(F.lit(test_size) * F.col("_n")))
    c = c.withColumn("_ntrain", F.col("_n") - F.col("_ntest"))
    c = c.withColumn("_fl", F.floor(F.col("_ntrain") * F.col("n_c") / F.col("_n")))
    c = c.withColumn("_rem", (F.col("_ntrain") * F.col("n_c")) % F.col("_n"))
    c = c.withColumn("_need", F.col("_ntrain") - F.sum("_fl").over(allw))
    c = c.withColumn("_ord", F.row_number().over(allw.orderBy(F.col("_rem").desc(), F.col(label))))
    train = F.col("_fl") + F.when(F.col("_ord") <= F.col("_need"), 1).otherwise(0)
    return c.select(label, "n_c", (F.col("n_c") - train).alias("n_test"))


def stratified_split(df: DataFrame, label: str, key: str = "user_session", test_size: float = TEST_SIZE,
                     seed: int = RANDOM_STATE) -> DataFrame:
    """Adds ``split`` = 'train' / 'test', class shares preserved."""
    q = split_quotas(df, label, test_size).select(label, "n_test")
    r = class_rank(df, label, key, seed, out="_r")
    r = lookup_join(r, q, label, "inner", cache=True)  # one row per class, measured
    return r.withColumn("split", F.when(F.col("_r") <= F.col("n_test"), "test").otherwise("train")) \
            .drop("_r", "n_test")


def stratified_kfold(df: DataFrame, label: str, key: str = "user_session", k: int = N_FOLDS,
                     seed: int = RANDOM_STATE) -> DataFrame:
    """``fold`` in 0..k-1: rows dealt round-robin in (class, hash) order,
    so every class is spread evenly and fold sizes differ by at most one."""
    r = class_rank(df, label, key, seed, out="_r")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)  # one row per class
    sizes = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    r = lookup_join(r, sizes, label, "inner", cache=True)  # one row per class, measured
    return r.withColumn("fold", ((F.col("_o") + F.col("_r") - 1) % k).cast("int")).drop("_r", "_o")


def temporal_split(df: DataFrame, period: str = "period", test_periods=(3,)) -> DataFrame:
    """train = earlier periods, test = ``test_periods``; rows without a
    period are left out (counted by J4)."""
    return df.filter(F.col(period).isNotNull()).withColumn(
        "split", F.when(F.col(period).isin(list(test_periods)), "test").otherwise("train"))


def session_sample(sessions: DataFrame, n_pos: int = 2, n_neg: int = 2, seed: int = RANDOM_STATE,
                   key: str = "user_session", label: str = "purchased") -> DataFrame:
    """n_pos purchased + n_neg not purchased + 1 edge session (n_events = 0
    if any exist, else any session), each the first in hash order."""
    def first(rows: DataFrame, n: int, s: int, *before) -> DataFrame:
        # planned as a top-n: every task keeps n rows, no table is ranked
        return rows.orderBy(*before, split_hash(key, s), key).limit(n)
    pos = first(sessions.filter(F.col(label) == 1), n_pos, seed).withColumn("stratum", F.lit("purchased"))
    neg = first(sessions.filter(F.col(label) == 0), n_neg, seed).withColumn("stratum", F.lit("not_purchased"))
    edge = first(sessions, 1, seed + 1, F.col("n_events") != 0).withColumn("stratum", F.lit("edge"))
    return pos.unionByName(neg).unionByName(edge)
