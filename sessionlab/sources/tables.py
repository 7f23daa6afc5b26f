"""Readers for the parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)
