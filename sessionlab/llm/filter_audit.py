"""Interaction audit of five document filters, by a stream that takes back earlier answers.

Four filters judge a text by itself; the fifth (E) fails a document whose text a smaller id holds
anywhere in the table, so an answer given for one file can turn out wrong when a later file
arrives.  The files of the table come as available-now micro-batches (``BATCHES`` of them):

1. the batch is reduced to narrow rows (text hash, id, part, mask of failed filters, labels) and
   written; this is the only pass over its texts;
2. all its rows are counted by (part, mask, labels) as if they failed E;
3. the least id of each text in the batch meets the keyed state of earlier batches, a table of
   text hash -> least id.  Where the batch's id is smaller or new, its rows are counted as
   passing E and put into the state; if an earlier id held the place, its mask is *retracted*: its
   row leaves the counter of documents that pass E and enters that of documents that fail it.

Counters are signed and written by batch, so a batch that is replayed after a lost driver
overwrites what it wrote (batches only read the state of earlier ones), and the sum over batches
is the same for any number or order of files.  Removal counts of all 120 orders follow from the
counters alone: 32 masks a part, exploded by a constant plan of 600 (order, step) pairs.

Scale: texts are never shuffled or sent to Python; the state moves 32 bytes a document.  A text
that a third of all rows hold is reduced to its least id on each mapper; the rows that carry that
id are found by a join on (hash, id), so no task receives all copies.  State read in one run is at
most ``BATCHES / 2`` times its size.

Defined results: a null text is the empty text, a null source the part ''; a null id is neither
smaller nor larger than any, so such a row passes E and fails nobody; repeated rows (same id, same
text) pass or fail E together; a document of which any label row says 1 counts as labelled; texts
of any length are judged whole; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlab.config import fresh_path
from sessionlab.llm.common import content_key, let, text_or_empty, words
from sessionlab.sources.tables import path_exists

FILTERS = "ABCDE"
BATCHES = 4
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 50, 65, 5, "#$%&*|"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_E = 1 << FILTERS.index("E")
_KEY = ["k1", "k2"]
_CELL = ["part", "mask", "good", "toxic"]
_ROW = "k1 long, k2 long, doc_id long, part string, mask int, good boolean, toxic boolean"
_COUNT = "part string, mask int, good boolean, toxic boolean, n long, batch int"


def text_mask(text: Column) -> Column:
    """Bits of the failed filters A to D of a text that is not null."""
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    symbol = F.lit(False)
    for s in SYMBOLS:
        symbol = symbol | F.contains(text, F.lit(s))
    of_words = let(words(text), lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
                   + F.when(F.lit(100) * F.size(F.array_distinct(w)) < F.lit(DISTINCT_PERCENT) * F.size(w), 2).otherwise(0))
    return (of_words + F.when(F.lit(100) * capitals > F.lit(CAPITAL_PERCENT) * F.length(text), 4).otherwise(0)
            + F.when(symbol, 8).otherwise(0)).cast("int")


def narrow(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, part, mask) of documents, texts left behind."""
    t = text_or_empty(F.col("text"))
    return docs.select(*content_key(F.col("text")), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text_mask(t).alias("mask"))


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) of the documents that some label row marks."""
    good, toxic = F.coalesce(F.col("quality") == 1, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))
    return (labels.filter((good | toxic) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(good).alias("good"), F.max(toxic).alias("toxic")))


def _counted(rows: DataFrame, sign: int, fails_e: bool) -> DataFrame:
    mask = F.col("mask").bitwiseOR(F.lit(_E)) if fails_e else F.col("mask")
    return rows.select("part", mask.alias("mask"), "good", "toxic", F.lit(sign).cast("long").alias("n"))


class Audit:
    """Tables of one audit in the shared folder, by batch: ``rows`` (narrow documents), ``state``
    (text -> rows of its least id so far) and ``counts`` (signed counters)."""

    def __init__(self, spark: SparkSession, root: str, labels: DataFrame):
        self.spark, self.root = spark, root
        self.flags = label_flags(labels)

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch}")

    def _read(self, table: str, schema: str, batches: range) -> DataFrame:
        there = [f"{self.root}/{table}/batch={b}" for b in batches]
        read = self.spark.read.schema(schema)
        return read.option("basePath", f"{self.root}/{table}").parquet(*there) if there else self.spark.createDataFrame([], schema)

    def take(self, docs: DataFrame, batch: int) -> None:
        """Body of ``foreachBatch``: count the batch, move the state, retract what it overturns."""
        self._write(narrow(docs), "rows", batch)
        rows = (self.spark.read.parquet(f"{self.root}/rows/batch={batch}").join(self.flags, "doc_id", "left")
                .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}))
        # every (text, least id of the batch); a hot text is one row a mapper
        least = rows.filter(F.col("doc_id").isNotNull()).groupBy(*_KEY).agg(F.min("doc_id").alias("least"))
        first = rows.join(least.withColumnRenamed("least", "doc_id"), [*_KEY, "doc_id"], "left_semi")
        state = self._read("state", _ROW, range(batch))
        held = state.groupBy(*_KEY).agg(F.min("doc_id").alias("held"))
        # what moves: texts whose least id is new, or as small as the one held (repeated rows)
        moves = least.join(held, _KEY, "left").filter(F.col("held").isNull() | (F.col("least") <= F.col("held")))
        entering = first.join(moves.select(*_KEY), _KEY, "left_semi")
        self._write(entering.select(*[c.split()[0] for c in _ROW.split(", ")]), "state", batch)
        entered = self._read("state", _ROW, range(batch, batch + 1))
        beaten = moves.filter(F.col("least") < F.col("held")).select(*_KEY, F.col("held").alias("doc_id"))
        retracted = state.join(beaten, [*_KEY, "doc_id"], "left_semi")
        no_id = F.col("doc_id").isNull()
        counts = (_counted(rows.filter(~no_id), 1, True).unionByName(_counted(rows.filter(no_id), 1, False))
                  .unionByName(_counted(entered, 1, False)).unionByName(_counted(entered, -1, True))
                  .unionByName(_counted(retracted, -1, False)).unionByName(_counted(retracted, 1, True)))
        self._write(counts.groupBy(*_CELL).agg(F.sum("n").alias("n")), "counts", batch)

    def counts(self, batches: int) -> DataFrame:
        """(part, mask, good, toxic, n): documents by failed filters, retractions applied."""
        signed = self._read("counts", _COUNT, range(batches))
        return signed.groupBy(*_CELL).agg(F.sum("n").alias("n")).filter("n > 0")


def _stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files of a table (a folder, or one file) as a stream of about ``batches`` micro-batches."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(-(-files // batches), 1))
    if not fs.getFileStatus(hadoop).isDirectory():     # a stream reads folders: pick the file in its own
        folder, _, name = path.rpartition("/")
        path, source = folder, source.option("pathGlobFilter", name)
    return source.parquet(path)


def mask_counts(spark: SparkSession, documents: str, labels: DataFrame, batches: int = BATCHES, root: str | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) of the documents table at path ``documents``; bit k of ``mask``
    is set if filter ``FILTERS[k]`` fails.  A run that is started again with its ``root`` goes on
    after the last micro-batch that ended."""
    root = root or fresh_path(spark, "llm-audit")
    audit = Audit(spark, root, labels)
    docs = _stream(spark, documents, batches).select("doc_id", "text", "source")
    query = (docs.writeStream.foreachBatch(audit.take).option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    done = 0
    while path_exists(spark, f"{root}/counts/batch={done}"):
        done += 1
    return audit.counts(done)


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, filter_order (all 120) and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley, from documents counted by mask."""
    plan = [(at, "".join(order), step, sum(1 << f for f in chosen[:step - 1]), 1 << chosen[step - 1])
            for at, order in enumerate(permutations(FILTERS)) for chosen in [[FILTERS.index(x) for x in order]] for step in range(1, 6)]
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(before).alias("before"), F.lit(own).alias("own"))
                      for _, o, s, before, own in plan])
    fails = F.col("mask").bitwiseAND(F.col("p.own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("p.before")) != 0
    here = fails & ~gone

    def total(when: Column, name: str) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long"))).alias(name)

    by_step = (counts.select("*", F.explode(steps).alias("p")).groupBy("part", "p.filter_order", "p.step", "p.own")
               .agg(total(~fails & ~gone, "kept"), total(here, "removed"), total(fails & gone, "redundant"),
                    total(F.col("mask") == F.col("p.own"), "unique_fails"), total(here & F.col("good"), "good_lost"),
                    total(here & F.col("toxic"), "toxic_lost")))
    # 120 rows a window
    return (by_step.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def filter_audit(spark: SparkSession, documents: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The whole audit of the documents table at path ``documents``."""
    return interactions(mask_counts(spark, documents, labels, batches))
