"""Derived features (P6-P10, P13) and the long (unpivoted) feature form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.constants import FEATURE_COLS
from sessionlab.functions.exprs import cart_to_view_ratio, remove_to_cart_ratio
from sessionlab.operators.sessions import fill_missing


def add_features(sessions: DataFrame) -> DataFrame:
    """The two ratio features (float) plus NULL guards; other columns kept."""
    out = sessions.withColumn("cart_to_view_ratio", cart_to_view_ratio().cast("float")) \
                  .withColumn("remove_to_cart_ratio", remove_to_cart_ratio().cast("float"))
    return fill_missing(out)


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail before execution when a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing feature columns: {missing}")
    return df


def column_presence(df: DataFrame, cols: list[str]) -> DataFrame:
    """P13 as rows: (column, present), from the schema alone."""
    rows = [(c, c in df.columns) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean")


def select_features(sessions: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P10: the 14 features in canonical order (plus ``keep`` columns first)."""
    require_columns(sessions, FEATURE_COLS)
    return sessions.select(*(keep or []), *FEATURE_COLS)


def to_long(df: DataFrame, features: list[str] = FEATURE_COLS, keep: list[str] | None = None,
            name: str = "feature", value: str = "x") -> DataFrame:
    """Unpivot features to (keep..., feature, x double): one scan, no join."""
    keep = keep or []
    ids = [F.col(c) for c in keep]
    packed = F.explode(F.array(*[F.struct(F.lit(f).alias(name), F.col(f).cast("double").alias(value))
                                 for f in features])).alias("_kv")
    return df.select(*ids, packed).select(*keep, f"_kv.{name}", f"_kv.{value}")
