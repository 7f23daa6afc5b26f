"""Quality rules with cross-document line frequency (native: DataFrame expressions only).

``quality_rules`` measures every text, hashes its normalised lines, counts for each
(host, line) the distinct documents that carry it, takes the lines above the limit out
and rejects documents of which too little is left.

Documents are distinct texts of a host, so exact copies count once, and nothing else about a
text decides whether it counts.

Defined cases: null text is the empty text (no words, ``base_failed``); null host is a
host of its own; an empty table gives an empty result; repeated rows get equal verdicts;
texts of any length are measured whole; lines that are equal after lower-casing and folding of
white space are one line, and a line in exactly ``min_docs`` documents stays; columns of the
input that share a name with an output column are not carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import WS_CHARS, content_key, guarded, let, text_or_empty, unguarded, words, written

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the sorted ``positions``."""
    return let(positions, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x))


def _repeat_words(w: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text.

    Windows are compared by 64-bit hash.  Most texts repeat none (one hash set decides);
    the others sort (hash, position), keep the runs and measure what they cover.
    """
    def of_grams(g):
        def of_sorted(s):
            again = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["g"] == e["g"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["g"] == e["g"], F.lit(False)))
            return _covered(F.array_sort(F.transform(again, lambda e: e["i"])))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), of_sorted))
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    return F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(let(grams, of_grams))


def _lines(text: Column) -> Column:
    """Lines of a text that hold a word, as they stand."""
    return F.filter(F.split(text_or_empty(text), "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    measured = let(words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    dup = let(_lines(F.col(text)), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return (docs
            .withColumn("_m", measured)
            .withColumns({"n_words": F.col("_m.n_words"), "word_chars": F.col("_m.word_chars"),
                          "n_symbols": F.regexp_count(text_or_empty(F.col(text)), F.lit(SYMBOLS)).cast("long"),
                          "n_dup_lines": dup, "n_repeat_words": F.col("_m.n_repeat_words")})
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .drop("_m"))


def line_rows(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row for each (host, distinct text, position of a line that holds a word): hash and words
    of the line."""
    hashed = F.filter(F.transform(F.split(text_or_empty(F.col(text)), "\n"), lambda x, i: let(
        F.btrim(F.regexp_replace(F.lower(x), r"[\x20\x09-\x0D]+", " "), F.lit(" ")),
        lambda n: F.when(n != "", F.struct(
            i.alias("pos"), F.xxhash64(n).alias("h"),
            (F.length(n) - F.length(F.replace(n, F.lit(" "), F.lit(""))) + 1).alias("w"))))),
        lambda e: e.isNotNull())
    k1, k2 = content_key(F.col(text))
    return (docs.select(F.col(host).alias("host"), k1, k2, F.inline(hashed))
            .groupBy("host", "k1", "k2", "pos")   # exact copies on a host count once
            .agg(F.min("h").alias("h"), F.min("w").alias("w")))


def frequent_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """(host, h) of the lines in more than ``min_docs`` distinct documents of their host."""
    return (rows.select("host", "h", "k1", "k2").distinct().groupBy("host", "h").agg(F.count("*").alias("docs"))
            .filter(F.col("docs") > min_docs).select("host", "h"))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = 20,
                  min_left: float = 0.2) -> DataFrame:
    """Every row of ``docs`` with the lines above the limit taken out of ``text``, the base
    measures of the text as it came, ``n_frequent_words`` (words taken out) and ``kept``.

    A line is above the limit when it stands in more than ``min_docs`` distinct documents of
    its host, whatever the host's size.  A document is depleted, and rejected, when less than
    ``min_left`` of its words stand outside such lines.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_frequent_words", "kept"]
    columns, docs = docs.columns, guarded(docs, [text, host], out)
    rows = written(line_rows(docs, text, host), "line-rows")
    bad = written(frequent_lines(rows, min_docs).select(F.col("host").alias("b_host"), F.col("h").alias("b_h")), "common-lines")
    taken = (rows.join(bad, F.expr("host <=> b_host AND h = b_h"))
             .groupBy("host", "k1", "k2").agg(F.sum("w").alias("n_frequent_words"), F.collect_list("pos").alias("_gone"))
             .withColumnsRenamed({"host": "t_host", "k1": "t_k1", "k2": "t_k2"}))
    taken = written(taken, "frequent-lines")   # so that the join below can split the copies of one text
    k1, k2 = content_key(F.col(text))
    base = base_rules(docs, text).withColumns({"_k1": k1, "_k2": k2})
    cleaned = let(F.split(F.col(text), "\n"), lambda x: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_gone")), lambda i: F.get(x, i)), "\n"))
    done = (base.join(taken, F.expr(f"`{host}` <=> t_host AND _k1 = t_k1 AND _k2 = t_k2"), "left")
            .withColumn("n_frequent_words", F.coalesce("n_frequent_words", F.lit(0).cast("long")))
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("n_words") - F.col("n_frequent_words") >= min_left * F.col("n_words")))
            .withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(cleaned))
            .drop("_k1", "_k2", "t_host", "t_k1", "t_k2", "_gone"))
    return unguarded(done, columns, [text, host], out)
