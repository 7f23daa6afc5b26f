"""Sinks: session tables, side tables, the long metrics table and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.operators.sessions import categorized_sessions
from sessionlab.sources.tables import path_exists

METRICS_SCHEMA = "run string, task string, model string, metric string, label string, value double"


def write_sessions(sessions: DataFrame, out_dir: str, all_name: str = "sessions_all",
                   cat_name: str = "sessions_cat") -> tuple[DataFrame, DataFrame]:
    """Write sessions_all and sessions_cat (main_cat not NULL) as parquet.

    The table is written once; sessions_cat is derived from the written
    files, so the event pipeline runs a single time.  Returns the re-read
    tables."""
    spark = sessions.sparkSession
    all_path, cat_path = f"{out_dir.rstrip('/')}/{all_name}", f"{out_dir.rstrip('/')}/{cat_name}"
    sessions.write.mode("overwrite").parquet(all_path)
    written = spark.read.parquet(all_path)
    categorized_sessions(written).write.mode("overwrite").parquet(cat_path)
    return written, spark.read.parquet(cat_path)


def write_session_months(months: DataFrame, path: str) -> DataFrame:
    """Persist the session -> first month side table."""
    months.select("user_session", "month").write.mode("overwrite").parquet(path)
    return months.sparkSession.read.parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics table, or an empty one while there is none; any other fault is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS_SCHEMA)
    return spark.read.schema(METRICS_SCHEMA).parquet(path)


def metrics_upsert(metrics: DataFrame, path: str) -> None:
    """A10: replace only the (run, task) partitions present in ``metrics``,
    keep all others (dynamic partition overwrite)."""
    (metrics.select("run", "task", "model", "metric", "label", F.col("value").cast("double"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "task").parquet(path))
