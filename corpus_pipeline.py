"""Training-corpus pipeline: each stage is one operator, written as Parquet before the next.

``run(spark, sf_dir)`` applies the stages to ``documents``.  All stages but the last return
the columns of ``documents``; the last adds ``copy``, the number of the copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.llm import decontamination, line_dedup, mixing, quality_rules, simhash
from sessionlab.llm.common import written
from sessionlab.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted of their own lines go; the others lose
    the lines that are frequent on their host."""
    n_chars = F.when(F.col("n_frequent_words") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return quality_rules.quality_rules(docs).filter("kept").withColumn("n_chars", n_chars).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share leave the texts; a text left without a word goes."""
    cleaned = line_dedup.line_dedup(docs)
    empty = (F.col("n_removed") > 0) & F.col("text").rlike(r"^[\x20\x09-\x0D]*$")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.filter(~F.coalesce(empty, F.lit(False))).withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_per_component(simhash.simhash_groups(docs)).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others lose the few words that items share with them."""
    judged = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return decontamination.without_spans(judged).withColumn("n_chars", n_chars).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the copies of the mix."""
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns, "copy")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", benchmark), ("mixing", mixture)]

#: SimHash components, the suffix automaton and the Newton steps have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
