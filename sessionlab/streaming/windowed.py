"""Sessions without a session id from a stream that runs on: many triggers, late rows, restarts.

Each micro-batch writes one folder in each of four tables, which a replayed batch overwrites:

* ``open``: sessions that later rows may still prolong, as mergeable parts;
* ``closed``: sessions whose end the watermark has passed;
* ``late``: rows older than the watermark the batch began with, whole, for ``all_sessions``;
* ``progress``: rows, late rows, rows without a time, sessions closed and left open, watermark.

The watermark of a batch is the latest time of earlier batches less ``delay``.  A row on time is
at or past it, a closed session ends at or before it, so no row on time can belong to a closed
one.  ``all_sessions`` merges late rows into the sessions of their users, so that every row counts
and the result is that of one batch over all rows, whatever their order of arrival.

Rows are aggregated by (user, stretch of time no longer than the gap) first: no session break lies
within a stretch, so a hot user costs one part for each stretch, combined on the mappers, and the
window that joins parts to sessions never sees rows.  A pause of exactly the gap is a break.  Rows
without a time have no session and are counted in ``progress``; rows without a user are one user's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.config import written
from sessionlab.functions.exprs import is_type, micros, non_purchase, price_of
from sessionlab.sources.tables import path_exists

HOUR = 3_600_000_000
GAP, DELAY = 12 * HOUR, 24 * HOUR

_PART = "user_id bigint, t_min bigint, t_max bigint, n_events bigint, p_n bigint, p_sum double, purchased int"
STATE = {
    "open": f"{_PART}, batch int",
    "closed": f"{_PART}, batch int",
    "late": "user_id bigint, t bigint, event_type string, price double, batch int",
    "progress": "n_rows bigint, n_late bigint, n_timeless bigint, n_closed bigint, n_open bigint, latest bigint, watermark bigint, batch int",
}


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A state table by its declared schema; one that no batch has written yet is empty."""
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE[table])
    return spark.read.schema(STATE[table]).parquet(path)


def _store(df: DataFrame, root: str, table: str, batch: int) -> None:
    declared = [f for f in T.StructType.fromDDL(STATE[table]) if f.name != "batch"]
    (df.select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.mode("overwrite")
     .parquet(f"{root.rstrip('/')}/{table}/batch={batch}"))


def _rows(events: DataFrame) -> DataFrame:
    return events.select("user_id", micros("event_time").alias("t"), "event_type", price_of().alias("price"))


def _totals() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in ("n_events", "p_n", "p_sum")], F.max("purchased").alias("purchased")]


def _parts(rows: DataFrame, gap: int) -> DataFrame:
    """Parts of sessions: one for each user and stretch of time that holds rows."""
    price = F.when(non_purchase(), F.col("price"))
    return (rows.groupBy("user_id", F.floor(F.col("t") / F.lit(gap)).alias("_stretch"))
            .agg(F.min("t").alias("t_min"), F.max("t").alias("t_max"), F.count_if(non_purchase()).alias("n_events"),
                 F.count(price).alias("p_n"), F.sum(price).alias("p_sum"), F.max(is_type("purchase")).alias("purchased"))
            .drop("_stretch"))


def _joined(parts: DataFrame, gap: int) -> DataFrame:
    """Parts that lie less than a gap apart are one."""
    by_user = Window.partitionBy("user_id").orderBy("t_min", "t_max")
    before = F.max("t_max").over(by_user.rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce((F.col("t_min") - before >= gap).cast("int"), F.lit(1))
    return (parts.withColumn("_first", first).withColumn("_no", F.sum("_first").over(by_user)).groupBy("user_id", "_no")
            .agg(F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"), *_totals()).drop("_no"))


def add_batch(spark: SparkSession, events: DataFrame, root: str, batch: int, gap: int = GAP, delay: int = DELAY) -> None:
    """One micro-batch.  Batches are numbered from 0 in the order of arrival."""
    rows = written(_rows(events), "arrived")
    seen = read_state(spark, root, "progress").filter(F.col("batch") < batch).agg(F.max("latest")).first()[0]
    n, timeless, newest = rows.agg(F.count("*"), F.count_if(F.col("t").isNull()), F.max("t")).first()
    latest = max((x for x in (seen, newest) if x is not None), default=None)
    is_late = F.lit(False) if seen is None else F.col("t") < F.lit(seen - delay)
    timed = rows.filter(F.col("t").isNotNull())
    _store(timed.filter(is_late), root, "late", batch)
    still = read_state(spark, root, "open").filter(F.col("batch") == batch - 1).drop("batch")
    now = written(_joined(still.unionByName(_parts(timed.filter(~is_late), gap)), gap), "sessions-now")
    done = F.lit(False) if latest is None else F.col("t_max") + F.lit(gap) <= F.lit(latest - delay)
    _store(now.filter(done), root, "closed", batch)
    _store(now.filter(~done), root, "open", batch)
    n_closed, n_all = now.agg(F.count_if(done), F.count("*")).first()
    n_late = read_state(spark, root, "late").filter(F.col("batch") == batch).count()
    row = [(n, n_late, timeless, n_closed, n_all - n_closed, latest, None if latest is None else latest - delay)]
    _store(spark.createDataFrame(row, STATE["progress"].rsplit(",", 1)[0]), root, "progress", batch)


def _shown(parts: DataFrame, gap: int) -> DataFrame:
    return parts.select("user_id", F.timestamp_micros("t_min").alias("session_start"),
                        F.timestamp_micros(F.col("t_max") + F.lit(gap)).alias("session_end"), "n_events",
                        F.try_divide("p_sum", "p_n").alias("avg_price"), "purchased")


def all_sessions(spark: SparkSession, root: str, gap: int = GAP) -> DataFrame:
    """All sessions so far: closed and open ones as they are for users without late rows; for the
    others their late rows are merged in."""
    last = read_state(spark, root, "progress").agg(F.max("batch")).first()[0]
    told = (read_state(spark, root, "closed")
            .unionByName(read_state(spark, root, "open").filter(F.col("batch") == F.lit(-1 if last is None else last))).drop("batch"))
    late = _parts(read_state(spark, root, "late"), gap)
    users = late.select(F.col("user_id").alias("_user")).distinct()
    same = F.col("user_id").eqNullSafe(F.col("_user"))
    mended = _joined(told.join(users, same, "left_semi").unionByName(late), gap)
    return _shown(told.join(users, same, "left_anti").unionByName(mended), gap)


def run_sessions(spark: SparkSession, source_dir: str, schema, root: str, checkpoint: str, files_per_batch: int = 1,
                 gap: int = GAP, delay: int = DELAY) -> None:
    """Structured Streaming driver: files under ``source_dir`` that are new since ``checkpoint``
    become micro-batches; a restart replays at most the last one."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(lambda df, epoch: add_batch(df.sparkSession, df, root, epoch, gap, delay))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
