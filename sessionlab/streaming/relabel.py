"""Session labels (B1/B4) kept up to date batch by batch, without a second look at the sessions
that a batch does not concern.

A later code may re-label sessions of earlier batches: the category map says which main category
an id has, and a later period (inside a period, an earlier row) wins.  Four tables hold the state,
each with one folder a batch, which a replayed batch overwrites whole:

* ``label_map``: the changelog of the map, one row for each category whose winning row changed,
  with the main category before and after;
* ``label_items``: (session, category, n) of the batch, in folders by category bucket, so that a
  batch reads only the buckets that hold a changed category;
* ``label_counts``: signed counts (session, main category, n): rows of the batch count up, rows of
  earlier batches that touch a changed category count down at the old name and up at the new one;
* ``labels``: the label of each session that the batch's counts concern; the latest batch holds.

The winner of a category is a maximum over (period, time, event id), so the labels after all
batches do not depend on their order.  Everything a batch writes follows from earlier batches and
its own rows: a batch that is replayed after a failure gives the same rows.  A hot session or
category is counted in hash aggregates that are combined on the mappers; no list is kept by
either.  ``label_log`` says per batch what changed and how many rows were read for it.

Null session keys have no label; a session without a known category has none either, and one whose
counts tie takes the smallest name.  Empty batches change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.config import written
from sessionlab.functions.exprs import main_cat_of
from sessionlab.operators.joins import keys_join, lookup_join
from sessionlab.operators.sessions import KEY
from sessionlab.sources.tables import path_exists
from sessionlab.streaming.incremental import batch_partials, read_partials, write_partials

#: folders by category of ``label_items``
BUCKETS = 32

STATE = {
    "label_map": "category_id bigint, period int, k struct<b: bigint, c: bigint>, old_main string, main_cat string, batch int",
    "label_items": "user_session string, category_id bigint, n bigint, batch int, bucket int",
    "label_counts": "user_session string, main_cat string, n bigint, batch int",
    "labels": "user_session string, main_cat string, batch int",
    "label_log": "n_changed bigint, n_earlier_items bigint, n_read_items bigint, n_moved_items bigint, "
                 "n_moved_sessions bigint, n_labelled bigint, batch int",
}


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A state table by its declared schema; one that no batch has written yet is empty."""
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE[table])
    return spark.read.schema(STATE[table]).parquet(path)


def _store(df: DataFrame, root: str, table: str, batch: int, by: tuple[str, ...] = ()) -> None:
    declared = [f for f in T.StructType.fromDDL(STATE[table]) if f.name != "batch"]
    (df.select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.mode("overwrite")
     .partitionBy(*by).parquet(f"{root.rstrip('/')}/{table}/batch={batch}"))


def _wins() -> Column:
    """Larger wins: the later period, inside it the earlier row."""
    return F.struct(F.col("period").alias("p"), (-F.col("k.b")).alias("b"), (-F.col("k.c")).alias("c"))


def _bucket() -> Column:
    return F.pmod(F.hash("category_id"), F.lit(BUCKETS))


def map_before(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The category map of all batches before ``batch``: category, winning key, main category."""
    return (read_state(spark, root, "label_map").filter(F.col("batch") < batch).groupBy("category_id")
            .agg(F.max(F.struct(_wins().alias("key"), F.col("main_cat"))).alias("w"))
            .select("category_id", F.col("w.key").alias("key"), F.col("w.main_cat").alias("old_main")))


def map_changes(spark: SparkSession, root: str, codes: DataFrame, batch: int) -> DataFrame:
    """Categories whose winning row is in this batch (``codes``: its ``category_partials``)."""
    first = codes.groupBy("category_id").agg(F.max(F.struct(_wins().alias("key"), "category_code", "period", "k")).alias("w"))
    new = first.select("category_id", "w.key", "w.period", "w.k", main_cat_of(F.col("w.category_code")).alias("main_cat"))
    old = map_before(spark, root, batch).withColumnRenamed("key", "old_key")
    return new.join(old, "category_id", "left").filter(F.col("old_key").isNull() | (F.col("key") > F.col("old_key")))


def _label(counts: DataFrame) -> DataFrame:
    """Most frequent main category by session from signed counts, ties to the smallest name."""
    total = counts.groupBy(KEY, "main_cat").agg(F.sum("n").alias("n"))
    alive = F.col("n") > 0
    return total.groupBy(KEY).agg(F.min_by(F.when(alive, F.col("main_cat")),
                                           F.when(alive, F.struct(-F.col("n"), F.col("main_cat")))).alias("main_cat"))


def update_labels(spark: SparkSession, root: str, codes: DataFrame, items: DataFrame, batch: int) -> None:
    """Add one batch: ``codes`` and ``items`` are the ``category_partials`` and
    ``session_categories`` of ``batch_partials``.  Batches are numbered in the order of arrival."""
    _store(map_changes(spark, root, codes, batch), root, "label_map", batch)
    _store(items.withColumn("bucket", _bucket()), root, "label_items", batch, by=("bucket",))
    changed = (read_state(spark, root, "label_map")
               .filter((F.col("batch") == batch) & ~F.col("old_main").eqNullSafe(F.col("main_cat")))
               .select("category_id", "old_main", "main_cat"))

    # rows of earlier batches: only the folders that hold a changed category (at most BUCKETS numbers)
    hit = [r[0] for r in changed.select(_bucket()).distinct().collect()]
    earlier = read_state(spark, root, "label_items").filter(F.col("batch") < batch)
    near = earlier.filter(F.col("bucket").isin(hit))
    moved = written(lookup_join(near, changed, "category_id", "inner").select(KEY, "old_main", "main_cat", "n"), "label-moves")

    own = read_state(spark, root, "label_items").filter(F.col("batch") == batch)
    known = map_before(spark, root, batch + 1).select("category_id", F.col("old_main").alias("main_cat"))
    fresh = lookup_join(own, known, "category_id", "inner", cache=True).select(KEY, "main_cat", "n")
    signed = (fresh.unionByName(moved.select(KEY, "main_cat", "n"))
              .unionByName(moved.select(KEY, F.col("old_main").alias("main_cat"), (-F.col("n")).alias("n"))))
    deltas = (signed.filter(F.col("main_cat").isNotNull()).groupBy(KEY, "main_cat").agg(F.sum("n").alias("n"))
              .filter(F.col("n") != 0))
    _store(deltas, root, "label_counts", batch)

    counts = read_state(spark, root, "label_counts").filter(F.col("batch") <= batch)
    concerned = counts.filter(F.col("batch") == batch)
    _store(_label(keys_join(counts, concerned, KEY, "left_semi")), root, "labels", batch)

    log = spark.range(1).select(
        F.lit(changed.count()).alias("n_changed"), F.lit(earlier.count()).alias("n_earlier_items"),
        F.lit(near.count()).alias("n_read_items"), F.lit(moved.count()).alias("n_moved_items"),
        F.lit(moved.select(KEY).distinct().count()).alias("n_moved_sessions"),
        F.lit(read_state(spark, root, "labels").filter(F.col("batch") == batch).count()).alias("n_labelled"))
    _store(log, root, "label_log", batch)


def current_labels(spark: SparkSession, root: str) -> DataFrame:
    """(session, main_cat) after all batches, sessions with a known category only."""
    latest = read_state(spark, root, "labels").groupBy(KEY).agg(F.max(F.struct("batch", "main_cat")).alias("l"))
    return latest.select(KEY, F.col("l.main_cat").alias("main_cat")).filter(F.col("main_cat").isNotNull())


def add_batch(spark: SparkSession, events: DataFrame, root: str, batch: int) -> None:
    """Partials and labels of one batch of events.  The items lie in ``label_items``, not in
    ``session_categories``; ``merge_partials_exact`` takes the labels instead."""
    parts = batch_partials(events, batch)
    items = parts.pop("session_categories")
    write_partials(parts, root)
    codes = read_partials(spark, root, "category_partials").filter(F.col("batch") == batch)
    update_labels(spark, root, codes, items, batch)


def run_labelled(spark: SparkSession, source_dir: str, schema, root: str, checkpoint: str, files_per_batch: int = 1) -> None:
    """Structured Streaming driver: new files under ``source_dir`` become micro-batches; a restart
    goes on from ``checkpoint`` and replays at most the last batch."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir))
    q = (stream.writeStream.foreachBatch(lambda df, epoch: add_batch(df.sparkSession, df, root, epoch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
