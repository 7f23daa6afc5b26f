"""Line dedup by distinct-site spread (native: DataFrame expressions only).

Every line is hashed after normalisation.  A HyperLogLog sketch of the sites of each line
hash is built per task and merged by the aggregation, so a line that stands on every page
of a crawl costs one small sketch per task.  Lines whose estimate is clearly above the
threshold are boilerplate; lines within the sketch's error of the threshold get an exact
distinct count; the rest stay.  Boilerplate lines leave every document.

Defined cases: null text stays null and has no lines; a null site is a site of its own;
blank lines are kept as they stand and never counted; a document whose every line is
boilerplate keeps the empty text; a line on exactly ``min_sites`` sites is boilerplate; texts of
any length are cut whole; repeated rows are treated alike; an empty table gives an empty result;
clashing extra columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import content_key, guarded, let, text_or_empty, unguarded, written

#: relative standard error of the sketch is about 1.04 / sqrt(2^LG_K)
LG_K = 10
#: standard errors of the sketch around the threshold within which a line is counted exactly; below, one
#: line in three million at the threshold would be missed (up to about 2**LG_K / 8 sites sketches are exact)
NEAR = 5
#: boilerplate hashes (rows of one long) that are broadcast after counting them
BROADCAST_LINES = 200_000


def line_hashes(text: Column) -> Column:
    """Hash of each line of a text (null for a blank line), in order."""
    return F.transform(F.split(text_or_empty(text), "\n"), lambda x: let(
        F.btrim(F.regexp_replace(F.lower(x), r"[\x20\x09-\x0D]+", " "), F.lit(" ")),
        lambda n: F.when(n != "", F.xxhash64(n))))


def site_spread(docs: DataFrame, text: str, site: str, min_sites: int) -> DataFrame:
    """(h, n_sites) of the lines on ``min_sites`` sites or more."""
    # a line of one document counts its site once, however often it repeats there
    rows = (docs.select(F.coalesce(F.col(site).cast("string"), F.lit("\0null")).alias("site"),
                        F.explode(F.array_distinct(line_hashes(F.col(text)))).alias("h"))
            .filter(F.col("h").isNotNull()))
    err = NEAR * 1.04 / (2 ** LG_K) ** 0.5
    est = (rows.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
           .select("h", F.hll_sketch_estimate("sketch").alias("n_sites")))
    likely = est.filter(F.col("n_sites") >= F.lit(min_sites * (1 - err)))
    return likely.withColumn("near", F.col("n_sites") <= F.lit(min_sites * (1 + err)))


def boilerplate_lines(docs: DataFrame, text: str, site: str, min_sites: int) -> DataFrame:
    likely = written(site_spread(docs, text, site, min_sites), "line-sites")
    near = likely.filter("near").select("h")
    near = F.broadcast(near) if near.count() <= BROADCAST_LINES else near
    rows = (docs.select(F.coalesce(F.col(site).cast("string"), F.lit("\0null")).alias("site"),
                        F.explode(F.array_distinct(line_hashes(F.col(text)))).alias("h")))
    exact = (rows.join(near, "h", "left_semi").groupBy("h", "site").count()
             .groupBy("h").agg(F.count("*").alias("n_sites")).filter(F.col("n_sites") >= min_sites))
    return likely.filter("NOT near").select("h").unionByName(exact.select("h"))


def line_dedup(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = 10) -> DataFrame:
    """Every row of ``docs`` with boilerplate lines taken out of ``text``, ``n_lines`` (lines
    before) and ``n_removed``.

    A line is boilerplate when it stands on ``min_sites`` distinct sites or more.
    """
    out = ["n_lines", "n_removed"]
    columns, docs = docs.columns, guarded(docs, [text, site], out)
    bad = written(boilerplate_lines(docs, text, site, min_sites), "line-boilerplate")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_LINES else bad
    k1, k2 = content_key(F.col(text))
    rows = docs.select(k1, k2, F.posexplode(line_hashes(F.col(text))).alias("pos", "h")).filter(F.col("h").isNotNull())
    gone = (rows.join(bad, "h", "left_semi").groupBy("k1", "k2").agg(F.collect_set("pos").alias("_gone"))
            .withColumnsRenamed({"k1": "g_k1", "k2": "g_k2"}))
    gone = written(gone, "line-positions")     # so that the join below can split the copies of one text
    base = docs.withColumns({"_k1": k1, "_k2": k2})
    kept = let(F.split(F.col(text), "\n"), lambda x: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_gone")), lambda i: F.get(x, i)), "\n"))
    done = (base.join(gone, F.expr("_k1 = g_k1 AND _k2 = g_k2"), "left")
            .withColumn("n_lines", F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
            .withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept))
            .drop("_k1", "_k2", "g_k1", "g_k2", "_gone"))
    return unguarded(done, columns, [text, site], out)
