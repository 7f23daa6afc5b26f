"""Incremental sessions (re-aimed from month-at-a-time processing).

Each micro-batch (a period file, a day of events, ...) writes *partials* into
three tables partitioned by the batch id, overwriting only its own partition,
so a replayed batch is idempotent and no upsert is needed:

* ``session_partials``: per session: counts, price (n, sum, M2, min, max),
  non-purchase time range, brand flag, purchase flag, first-row key for the
  user id;
* ``session_items``: distinct (session, product_id, category_id) of
  non-purchase rows, and (session, category_id, n) of all rows, because the
  category map may change later (a later period wins) and re-label old
  sessions;
* ``category_partials``: first code per (category, period) in the batch.

Every partial table has a declared schema (``PARTIALS``), so batches without codes, without
non-purchase rows, or without any row at all read as what they are: empty.

Reading merges partials by session with exact formulas (Chan's merge for the
variance) and equals the batch table: integers exactly, floats to rounding.
The ``foreachBatch`` body is exactly the batch code.  A second form,
``windowed_sessions``, sessionises a stream without session ids with
``session_window`` and a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.constants import DEFAULT_DROP_CATEGORIES
from sessionlab.functions.exprs import is_type, main_cat_of, micros, non_purchase, price_of
from sessionlab.operators.joins import lookup_join
from sessionlab.operators.sessions import KEY, drop_categories, fill_missing
from sessionlab.sources.tables import path_exists


#: schemas of the partial tables; ``batch`` is the partition column
_FIRST = "first struct<k: struct<a: int, b: bigint, c: bigint>, u: bigint>"
PARTIALS = {
    "session_partials": f"user_session string, {_FIRST}, n_view bigint, n_cart bigint, n_remove bigint, n_events bigint, p_n bigint, "
                        "p_sum double, p_m2 double, p_min double, p_max double, t_min bigint, t_max bigint, has_brand int, "
                        "purchased int, batch int",
    "session_items": "user_session string, product_id bigint, category_id bigint, batch int",
    "session_categories": "user_session string, category_id bigint, n bigint, batch int",
    "category_partials": "category_id bigint, period int, category_code string, k struct<b: bigint, c: bigint>, batch int",
}


def read_partials(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A partial table by its declared schema; one that no batch has written yet is empty."""
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARTIALS[table])
    return spark.read.schema(PARTIALS[table]).parquet(path)


def batch_partials(events: DataFrame, batch: int) -> dict[str, DataFrame]:
    """Partials of one batch of events (raw schema + event_id + period)."""
    ev = events.filter(F.col(KEY).isNotNull())
    np_ = non_purchase()
    price = F.when(np_, price_of())
    us = micros("event_time")
    first_key = F.struct((np_.cast("int") * -1).alias("a"), us.alias("b"), F.col("event_id").alias("c"))
    sess = ev.groupBy(KEY).agg(
        F.min(F.struct(first_key.alias("k"), F.col("user_id").alias("u"))).alias("first"),
        F.sum(F.when(np_, is_type("view"))).alias("n_view"),
        F.sum(F.when(np_, is_type("cart"))).alias("n_cart"),
        F.sum(F.when(np_, is_type("remove_from_cart"))).alias("n_remove"),
        F.count(F.when(np_, F.lit(1))).alias("n_events"),
        F.count(price).alias("p_n"), F.sum(price).alias("p_sum"),
        (F.coalesce(F.var_pop(price), F.lit(0.0)) * F.count(price)).alias("p_m2"),
        F.min(price).alias("p_min"), F.max(price).alias("p_max"),
        F.min(F.when(np_, us)).alias("t_min"), F.max(F.when(np_, us)).alias("t_max"),
        F.max(F.when(np_, F.col("brand").isNotNull().cast("int"))).alias("has_brand"),
        F.max(is_type("purchase")).alias("purchased"),
    ).withColumn("batch", F.lit(batch))
    items = ev.filter(np_).select(KEY, "product_id", "category_id").distinct().withColumn("batch", F.lit(batch))
    cats = ev.groupBy(KEY, "category_id").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(batch))
    cmap = (events.filter(F.col("category_code").isNotNull()).groupBy("category_id", "period")
            .agg(F.min_by("category_code", F.struct(us, F.col("event_id"))).alias("category_code"),
                 F.min(F.struct(us.alias("b"), F.col("event_id").alias("c"))).alias("k"))
            .withColumn("batch", F.lit(batch)))
    return {"session_partials": sess, "session_items": items, "session_categories": cats,
            "category_partials": cmap}


def write_partials(parts: dict[str, DataFrame], root: str) -> None:
    """Overwrite this batch's partition of each partial table."""
    for name, df in parts.items():
        declared = T.StructType.fromDDL(PARTIALS[name])
        (df.select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{root.rstrip('/')}/{name}"))


def partial_labels(spark: SparkSession, root: str) -> DataFrame:
    """Main category by session from all partials.  Category map: latest period wins; inside a
    period the earliest row."""
    cmap = read_partials(spark, root, "category_partials").groupBy("category_id").agg(
        F.max_by("category_code", F.struct(F.col("period"), -F.col("k.b"), -F.col("k.c"))).alias("category_code"))
    cats = read_partials(spark, root, "session_categories").groupBy(KEY, "category_id").agg(F.sum("n").alias("n"))
    names = cmap.select("category_id", main_cat_of("category_code").alias("main_cat"))
    labelled = lookup_join(cats, names, "category_id", "inner", cache=True).groupBy(KEY, "main_cat").agg(F.sum("n").alias("n"))
    return labelled.groupBy(KEY).agg(F.min_by("main_cat", F.struct(-F.col("n"), F.col("main_cat"))).alias("main_cat"))


def merge_partials_exact(spark: SparkSession, root: str, drop=DEFAULT_DROP_CATEGORIES, labels: DataFrame | None = None) -> DataFrame:
    """Merge every batch's partials into the session table (same schema and
    values as the exact batch rollup).  ``labels`` are those of
    ``relabel.current_labels`` where they are kept up to date by batch."""
    sp = read_partials(spark, root, "session_partials")
    # the session's mean first, then what each part lies off it: nothing cancels
    mean = sp.groupBy(KEY).agg(F.sum("p_n").alias("n"), F.try_divide(F.sum("p_sum"), F.sum("p_n")).alias("mean"))
    off = F.col("p_sum") / F.nullif(F.col("p_n"), F.lit(0)) - F.col("mean")
    spread = (sp.join(mean, KEY).groupBy(KEY)
              .agg(F.first("n").alias("n"), F.first("mean").alias("avg_price"),
                   F.sum(F.when(F.col("p_n") > 0, F.col("p_m2") + F.col("p_n") * off * off)).alias("m2"))
              .select(KEY, "avg_price", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("price_std")))
    merged = sp.groupBy(KEY).agg(
        F.min("first").alias("first"),
        *[F.sum(c).alias(c) for c in ("n_view", "n_cart", "n_remove", "n_events")],
        F.min("p_min").alias("min_price"), F.max("p_max").alias("max_price"),
        ((F.max("t_max") - F.min("t_min")) / 1e6).alias("session_duration_sec"),
        F.max("has_brand").alias("has_brand"), F.max("purchased").alias("purchased"),
    ).join(spread, KEY)
    items = read_partials(spark, root, "session_items")
    uniq = items.groupBy(KEY).agg(F.count_distinct("product_id").alias("unique_products"),
                                  F.count_distinct("category_id").alias("unique_categories"))
    mode = partial_labels(spark, root) if labels is None else labels
    out = merged.join(uniq, KEY, "left").join(mode, KEY, "left").withColumn("user_id", F.col("first.u"))
    out = fill_missing(out.withColumn("purchased", (F.col("purchased") > 0).cast("tinyint")))
    out = out.select(KEY, "user_id", "n_view", "n_cart", "n_remove", "n_events", "avg_price", "max_price",
                     "min_price", "price_std", "unique_products", "unique_categories", "has_brand",
                     "session_duration_sec", "purchased", "main_cat")
    return drop_categories(out, drop)


def run_incremental(spark: SparkSession, source_dir: str, schema, root: str, checkpoint: str,
                    files_per_batch: int = 1) -> None:
    """Structured Streaming driver: new files under ``source_dir`` become
    micro-batches whose partials are written by ``foreachBatch``."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))

    def body(df: DataFrame, epoch: int) -> None:
        write_partials(batch_partials(df, epoch), root)

    q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _window_totals(events: DataFrame, gap: str) -> DataFrame:
    np_ = non_purchase()
    price = F.when(np_, price_of())
    return (events.groupBy("user_id", F.session_window("event_time", gap).alias("session"))
            .agg(F.count(F.when(np_, F.lit(1))).alias("n_events"),
                 F.avg(price).alias("avg_price"),
                 F.max(is_type("purchase")).alias("purchased"))
            .select("user_id", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                    "n_events", "avg_price", "purchased"))


def windowed_sessions(events: DataFrame, gap: str = "12 hours", watermark: str = "1 day") -> DataFrame:
    """Streaming sessions without a session id: ``session_window`` per user.

    A session is emitted once the watermark has passed its end; those still
    open when a stream ends are left to ``open_sessions``.  A row is lost only
    if it arrives in a later micro-batch than one that moved the watermark past
    it, that is more than ``watermark`` late.  ``count(DISTINCT)`` is not
    allowed on streams and a per-session set would grow with a hot session, so
    distinct counts are left to the partials path (exact, set-free)."""
    ev = events.withColumn("event_time", F.col("event_time").cast("timestamp"))  # watermarks need TIMESTAMP
    return _window_totals(ev.withWatermark("event_time", watermark), gap)


def open_sessions(events: DataFrame, closed: DataFrame, gap: str = "12 hours") -> DataFrame:
    """Sessions of ``events`` that a finished stream has not emitted: those that
    begin at or after the end of the user's last ``closed`` one."""
    ends = closed.groupBy("user_id").agg(F.max("session_end").alias("_end"))
    ev = events.withColumn("event_time", F.col("event_time").cast("timestamp")).join(ends, "user_id", "left")
    return _window_totals(ev.filter(F.col("_end").isNull() | (F.col("event_time") >= F.col("_end"))), gap)


def run_windowed(spark: SparkSession, source_dir: str, schema, out: str, checkpoint: str, gap: str = "12 hours",
                 watermark: str = "1 day") -> DataFrame:
    """All sessions of the files under ``source_dir``: the stream takes every
    file there in one micro-batch, so no watermark is set before all rows are
    in and neither number nor order of the files matters; closed sessions go to
    the file sink under ``out``, open ones are added from the source."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (windowed_sessions(stream, gap, watermark).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    closed = spark.read.parquet(out)
    return closed.unionByName(open_sessions(spark.read.schema(schema).parquet(source_dir), closed, gap))
