"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.config import scratch_path

# ASCII white space of the contracts: \x20 and \x09-\x0D
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
#: rows handed to a Python worker at once; long texts make a batch of documents large
ARROW_ROWS = 500


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda body that names an outer expression would evaluate it again for
    every element; binding it as the one element of an array avoids that.
    """
    return F.transform(F.array(value), body)[0]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the ``[^\\x20\\x09-\\x0D]+`` words of a text (null: none)."""
    return let(F.btrim(text_or_empty(text), F.lit(WS_CHARS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_CLASS + "+")))


def content_key(text: Column) -> list[Column]:
    """128 hash bits of a text as two longs: equal texts share them (null: the empty text)."""
    t = text_or_empty(text)
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a derived table to the shared folder (one folder for each value of ``by``) and read it
    back: lineage ends at files that every executor sees, so a lost executor costs a re-read, not
    a re-run."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return (spark.read.schema(df.schema) if by else spark.read).parquet(path)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch for the operators that read whole texts in Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def guarded(df: DataFrame, needed: list[str], out: list[str]) -> DataFrame:
    """``needed`` columns as they are and all others packed away in ``_rest``, so that their names
    meet none of an operator's own; those named like an output column are left out."""
    rest = [c for c in df.columns if c not in needed and c.lower() not in out]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(needed)], packed.alias("_rest"))


def unguarded(df: DataFrame, columns: list[str], needed: list[str], out: list[str]) -> DataFrame:
    """The ``columns`` a guarded frame came from, in their order, and the output columns."""
    kept = [c for c in columns if c in needed or c.lower() not in out]
    return df.select(*[F.col(f"`{c}`") if c in needed else F.col("_rest").getField(c).alias(c) for c in kept],
                     *[c for c in out if c not in needed])


def release(spark: SparkSession, *tables: DataFrame, parts: tuple[str, ...] = ()) -> None:
    """Free what finished steps left on disk: written tables (of partitioned ones only the
    ``parts`` named) that no later step reads, and the shuffle files of finished jobs, which Spark
    removes once the driver has collected the objects that stand for them."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        if parts and not folder.endswith(parts):
            continue
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()
