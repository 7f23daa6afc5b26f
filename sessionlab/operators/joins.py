"""Join helpers and the reference's join operators.

Only sides whose size in bytes has been measured below a bound are broadcast;
beyond the bound the plain join is left to Catalyst/AQE (sort-merge with skew
splitting), so nothing that grows with the data is ever broadcast blindly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab import config


def side_bytes(df: DataFrame) -> int:
    """Bytes of the values of a (small, derived or dimension) frame, measured by one aggregate over
    it: fixed-width columns by their type, the others by what each row holds."""
    fixed, wide = 0, []
    for f in df.schema.fields:
        kind = f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(F.col(f"`{f.name}`")))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            wide.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
        else:
            fixed += 16 if isinstance(kind, T.DecimalType) else 8
    row = F.lit(fixed).cast("long")
    for w in wide:
        row = row + F.coalesce(w, F.lit(0))
    return df.agg(F.sum(row)).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a frame is small enough to send to every executor, by measuring it now."""
    return side_bytes(df) <= (config.BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left", max_bytes: int | None = None,
                cache: bool = False) -> DataFrame:
    """Join a dimension onto a fact table; broadcast only after a size check in bytes.

    ``cache=True`` is for derived dimensions (e.g. the category map): the side
    is written to the shared folder first, so measuring it and joining it
    compute it once.  A side over the bound is joined by shuffle (AQE splits
    skew)."""
    if cache:
        small = config.written(small, "lookup")
    return big.join(F.broadcast(small) if fits_broadcast(small, max_bytes) else small.hint("shuffle_merge"), on, how)


def bounded_join(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Broadcast join for sides whose size is bounded by construction, not by
    the data: one row per feature (a list fixed in code), or a subset of a side
    that was already measured.  Callers state the bound where they call it;
    anything keyed by data values (classes, buckets) goes through
    ``lookup_join``."""
    return big.join(F.broadcast(small), on, how)


def keys_join(big: DataFrame, keys: DataFrame, on, how: str) -> DataFrame:
    """Semi/anti join against a key set that grows with the data (session ids):
    distinct keys, plain join; AQE turns it into a broadcast only when the
    measured shuffle output is small, and splits skewed partitions."""
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(keys.select(*cols).distinct(), cols, how)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as a scalar
    subquery (evaluated once, inlined into the plan): no join at all."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in cols])


# --- J operators -----------------------------------------------------------

def fill_main_cat(events: DataFrame, cat_map: DataFrame) -> DataFrame:
    """Attach ``category_filled`` and ``main_cat`` by ``category_id``;
    ids missing from the map give NULL."""
    from sessionlab.functions.exprs import main_cat_of
    m = cat_map.select("category_id", F.col("category_code").alias("category_filled"))
    out = lookup_join(events, m, "category_id", "left", cache=True)
    return out.withColumn("main_cat", main_cat_of("category_filled"))


def features_targets_join(features: DataFrame, targets: DataFrame, key: str = "user_session") -> DataFrame:
    """Features (non-purchase rows) full-outer targets (all rows)."""
    return features.join(targets, key, "full_outer")


def attach_month(sessions: DataFrame, months: DataFrame, key: str = "user_session") -> DataFrame:
    """Sessions left-join their first month."""
    return sessions.join(months, key, "left")


def missing_months(sessions: DataFrame, months: DataFrame, key: str = "user_session") -> DataFrame:
    """How many sessions the side table does not know."""
    return attach_month(sessions, months, key).agg(F.count_if(F.col("month").isNull()).alias("n_missing"),
                                                   F.count(F.lit(1)).alias("n_sessions"))


def not_in(left: DataFrame, right: DataFrame, key: str = "user_session") -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (left anti)."""
    return keys_join(left, right, key, "left_anti")


def only_in(left: DataFrame, right: DataFrame, key: str = "user_session") -> DataFrame:
    """Rows of ``left`` whose key is present in ``right`` (left semi)."""
    return keys_join(left, right, key, "left_semi")
