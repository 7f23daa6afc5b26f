"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlab.constants import CART, PURCHASE, REMOVE, VIEW

__all__ = [
    "micros", "price_of", "is_type", "non_purchase", "main_cat_of", "duration_seconds",
    "cart_to_view_ratio", "remove_to_cart_ratio", "split_hash", "hash_bucket", "r6",
    "safe_div", "VIEW", "CART", "REMOVE", "PURCHASE",
]


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ columns."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def is_type(event_type: str, col: str = "event_type") -> Column:
    """1/0 flag for one event type; a NULL type gives 0 (pandas ``==``)."""
    return F.coalesce((F.col(col) == F.lit(event_type)).cast("int"), F.lit(0))


def non_purchase(col: str = "event_type") -> Column:
    """pandas ``!= 'purchase'`` keeps NULL types, so use null-safe equality."""
    return ~F.col(col).eqNullSafe(F.lit(PURCHASE))


def price_of(col: str = "price") -> Column:
    """Price as double; NaN is a missing price, not a number."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def main_cat_of(code: str | Column = "category_code") -> Column:
    """Top-level category: text before the first dot (whole text if none)."""
    c = F.col(code) if isinstance(code, str) else code
    return F.split_part(c, F.lit("."), F.lit(1))


def duration_seconds(t_min: str, t_max: str) -> Column:
    """Seconds between two timestamps (NTZ-safe)."""
    return (micros(t_max) - micros(t_min)) / F.lit(1_000_000.0)


def cart_to_view_ratio(n_view: str = "n_view", n_cart: str = "n_cart") -> Column:
    return F.when(F.col(n_view) > 0, F.col(n_cart) / F.col(n_view)).otherwise(F.lit(0.0))


def remove_to_cart_ratio(n_remove: str = "n_remove", n_cart: str = "n_cart") -> Column:
    return F.col(n_remove) / F.greatest(F.col(n_cart), F.lit(1))


def split_hash(key: str | Column, seed: int) -> Column:
    """Deterministic per-row sort key: md5 of ``key:seed`` (hex text).

    DuckDB spells it ``md5(key || ':' || seed)``; the same hex string orders
    identically in both engines, so splits never depend on partitioning.
    """
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def hash_bucket(hex_hash: str | Column, bits: int = 16) -> Column:
    """Leading ``bits`` of a hex hash as an integer: an order-preserving bucket."""
    c = F.col(hex_hash) if isinstance(hex_hash, str) else hex_hash
    n_hex = max(1, bits // 4)
    return F.conv(F.substring(c, 1, n_hex), 16, 10).cast("int")


def r6(c: Column | str, digits: int = 6) -> Column:
    """Round a double for engine-independent comparison."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den, ``default`` where den is 0 or NULL (never raises in ANSI mode)."""
    out = F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))
    return out if default is None else F.coalesce(out, F.lit(default))
