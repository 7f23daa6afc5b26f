"""Exact running sums over a global order without a single-task window.

``Window.orderBy`` with no partition runs in one task, and a window per group
puts a whole group (a feature, a class) in one task.  Instead, rows are first
collapsed to one row per distinct sort value, then dealt out by range over
(group, value).  The boundaries come from the data (Spark samples them), so a
narrow band of values is cut as finely as a wide one.  The dealt rows are
written once with the number of their range, because boundaries sampled anew
could differ.  Totals per range are tiny and get a window of their own
(offsets); exact running sums inside a range use a window partitioned by
(group, range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.operators.joins import lookup_join


def in_ranges(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """``df`` with ``_b``: the range of its row, increasing with (groups, value)."""
    dealt = df.repartitionByRange(*groups, value).withColumn("_b", F.spark_partition_id())
    return written(dealt, "ranges")


def running_sums(df: DataFrame, value: str, sums: list[str], groups: list[str] | None = None) -> DataFrame:
    """For each (groups..., distinct ``value``) give the per-value totals of
    ``sums`` and, for each, ``<c>_le`` = running total over values <= this one
    (ascending) and ``<c>_tot`` = group total.  ``df`` must already hold one
    row per (groups, value) (pre-aggregated)."""
    groups = groups or []
    bucketed = in_ranges(df, value, groups)
    tot = bucketed.groupBy(*groups, "_b").agg(*[F.sum(c).alias(f"_bt_{c}") for c in sums])
    # one row per (group, value range): small
    wg = Window.partitionBy(*groups).orderBy("_b") if groups else Window.orderBy("_b")
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy()
    for c in sums:
        tot = tot.withColumn(f"_off_{c}", F.coalesce(
            F.sum(f"_bt_{c}").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        tot = tot.withColumn(f"{c}_tot", F.sum(f"_bt_{c}").over(whole))
    tot = tot.select(*groups, "_b", *[f"_off_{c}" for c in sums], *[f"{c}_tot" for c in sums])
    # (#groups x value ranges) rows: measured before it is broadcast
    out = lookup_join(bucketed, tot, [*groups, "_b"], "inner", cache=True)
    wb = Window.partitionBy(*groups, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    for c in sums:
        out = out.withColumn(f"{c}_le", F.col(f"_off_{c}") + F.sum(c).over(wb))
    return out.drop("_b", *[f"_off_{c}" for c in sums])


def with_previous(df: DataFrame, value: str, cols: list[str], groups: list[str] | None = None) -> DataFrame:
    """Attach ``prev_<c>``: the columns of the row with the next smaller
    ``value`` (one row per distinct value and group), without a global window:
    a lag inside each value range plus, for a range's first row, the last row
    of the previous non-empty range (a small per-range table)."""
    groups = groups or []
    b = in_ranges(df, value, groups)
    w = Window.partitionBy(*groups, "_b").orderBy(value)
    for c in cols:
        b = b.withColumn(f"_lag_{c}", F.lag(c).over(w))
    last = b.groupBy(*groups, "_b").agg(
        *[F.max_by(c, F.col(value)).alias(f"_last_{c}") for c in cols])
    wb = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy("_b")  # one row per range
    last = last.select(*groups, "_b", *[F.lag(f"_last_{c}").over(wb).alias(f"_pb_{c}") for c in cols])
    out = lookup_join(b, last, [*groups, "_b"], "inner", cache=True)
    first_in_range = F.row_number().over(w) == 1
    for c in cols:
        out = out.withColumn(f"prev_{c}", F.when(first_in_range, F.col(f"_pb_{c}")).otherwise(F.col(f"_lag_{c}")))
    return out.drop("_b", *[f"_lag_{c}" for c in cols], *[f"_pb_{c}" for c in cols])
