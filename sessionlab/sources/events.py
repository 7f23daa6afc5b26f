"""Event sources.

* ``read_events_csv`` / ``scan_periods_csv``: the raw monthly CSV layout with a
  declared schema (no inference), one ``period`` ordinal per file.
* ``shop_events``: a deterministic event view over the driver tables
  (``events`` + ``part``) with the raw event schema, including sessions
  (a new session after a gap of more than 12 h for the same user).
* ``wide_events``: lineitem x orders x part as an event table (large sessions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.functions.exprs import micros
from sessionlab.operators.joins import lookup_join
from sessionlab.sources.tables import path_exists, read_table

RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.FloatType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

# --- fixed values: event view over the driver tables (FIXTURES.md) --------
SESSION_GAP_SECONDS = 12 * 3600
TYPE_MAP = {"click": "cart", "error": "remove_from_cart", "purchase": "purchase",
            "view": "view", "signup": "view"}
NULL_SESSION_MODULUS = 997
CODE_EVENT_MODULUS = 10
CODE_CATEGORY_MODULUS = 4
CODE_CATEGORY_SKIP = 3
BRAND_EVENT_MODULUS = 3
PRODUCTS_PER_CATEGORY = 5
DAYS_PER_PERIOD = 8
N_PERIODS = 4
# the rare class of the test tables, dropped where the original drops its own
RARE_CATEGORIES = ("promo",)
# ---------------------------------------------------------------------------


def read_events_csv(spark: SparkSession, path: str, nrows: int | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """One raw CSV file (or folder of part files of one layout), by header name (A1).

    ``columns`` are selected by name, in whatever order the header has them,
    and cast to the declared types; a missing column, a row of the wrong width
    or a value that does not cast raises, as the original loader does.
    ``nrows`` keeps the first rows of the input.
    """
    df = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    wanted = [f for f in RAW_EVENT_SCHEMA.fields if columns is None or f.name in columns]
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise KeyError(f"{path}: missing columns {missing}")
    typed = [F.to_timestamp(f.name, "yyyy-MM-dd HH:mm:ss[ z][XXX]").alias(f.name) if f.dataType == T.TimestampType()
             else F.col(f.name).cast(f.dataType) for f in wanted]
    out = df.select(*typed)
    return out.limit(nrows) if nrows is not None else out


def scan_periods_csv(spark: SparkSession, paths: list[str], nrows: int | None = None) -> DataFrame:
    """Ordered file set -> one frame with a ``period`` ordinal (A3/A4).

    Missing files fail before any job is planned.  Each path is a read of its
    own, so its rows get its ordinal whatever the path looks like, and each
    file's own header counts.
    """
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"Missing raw file: {p}")
    parts = [read_events_csv(spark, p, nrows).withColumn("period", F.lit(i)) for i, p in enumerate(paths)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_events_csv(events: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Raw CSV layout: header, the 9 raw columns, times as 'yyyy-MM-dd HH:mm:ss UTC';
    with ``partition_by`` one folder for each of its values, in one pass."""
    out = events.select(
        F.date_format(F.col("event_time").cast("timestamp"), "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        *[c.name for c in RAW_EVENT_SCHEMA.fields if c.name != "event_time"], *([partition_by] if partition_by else []))
    w = out.write.mode("overwrite").option("header", True)
    (w.partitionBy(partition_by) if partition_by else w).csv(path)


def shop_events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event view without sessions: raw schema columns + ``event_id`` and ``period``.

    ``part`` is joined twice (brand by product, code by category) through a
    size-checked lookup join.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")
    type_map = F.create_map(*[F.lit(x) for kv in TYPE_MAP.items() for x in kv])
    ev = ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        type_map[F.col("event_type")].alias("event_type"),
        k.alias("product_id"),
        F.floor(k / PRODUCTS_PER_CATEGORY).cast("bigint").alias("category_id"),
        F.col("value").cast("float").alias("price"),
        "user_id",
        F.least(F.lit(N_PERIODS - 1), F.floor((F.dayofmonth("ts") - 1) / DAYS_PER_PERIOD)).cast("int").alias("period"),
    )
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    brands = part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("_brand"))
    codes = part.select(
        F.col("p_partkey").alias("category_id"),
        F.concat(F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", ".")).alias("_code"))
    ev = lookup_join(ev, brands, "product_id")
    ev = lookup_join(ev, codes, "category_id")
    has_code = ((F.col("event_id") % CODE_EVENT_MODULUS == 0)
                & (F.col("category_id") % CODE_CATEGORY_MODULUS != CODE_CATEGORY_SKIP))
    return ev.select(
        "event_id", "event_time", "event_type", "product_id", "category_id",
        F.when(has_code, F.col("_code")).alias("category_code"),
        F.when(F.col("event_id") % BRAND_EVENT_MODULUS != 0, F.col("_brand")).alias("brand"),
        "price", "user_id", "period",
    )


def sessionize(df: DataFrame, user: str = "user_id", ts: str = "event_time", tiebreak: str = "event_id",
               gap_seconds: int = SESSION_GAP_SECONDS, bucket_seconds: int = 3600,
               out: str = "session_no") -> DataFrame:
    """Number each user's sessions: ``out`` = count of gaps > ``gap_seconds``
    before the row in (ts, tiebreak) order.

    A window over one user would put a hot user in one task.  Instead time is
    cut into buckets no longer than the gap, so two events of one bucket are
    never more than a gap apart and every row of a bucket shares its session
    number.  A partial/final aggregate gives each (user, bucket) its first and
    last time; a window over the user's buckets (at most one row per active
    hour) flags a new session where a bucket starts more than a gap after the
    previous one ends, and sums the flags; one join brings the number back to
    the rows (AQE splits a hot (user, bucket) partition).  No row-level sort.
    """
    if bucket_seconds > gap_seconds:
        raise ValueError("bucket_seconds must not exceed gap_seconds")
    gap_us = gap_seconds * 1_000_000
    d = df.withColumn("_tb", F.floor(micros(ts) / (bucket_seconds * 1_000_000)))
    buckets = d.groupBy(user, "_tb").agg(F.min(micros(ts)).alias("_first"), F.max(micros(ts)).alias("_last"))
    wb = Window.partitionBy(user).orderBy("_tb")
    prev_last = F.lag("_last").over(wb)
    buckets = buckets.withColumn(
        "_fg", F.when(prev_last.isNotNull() & (F.col("_first") - prev_last > gap_us), 1).otherwise(0))
    buckets = buckets.select(user, "_tb", F.sum("_fg").over(wb.rowsBetween(Window.unboundedPreceding, 0))
                             .cast("bigint").alias(out))
    # every (user, bucket) of d is in the bucket table: the left join keeps rows
    # and lets Catalyst drop the numbering when no caller uses it
    return d.join(buckets, [user, "_tb"], "left").drop("_tb")


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full event view: raw schema + ``event_id`` and ``period``.

    ``user_session`` is ``<user_id>-<n>``; it is NULL for every 997th event id
    (after numbering), to exercise NULL session keys.
    """
    base = shop_events_base(spark, sf_dir)
    s = sessionize(base)
    sess = F.when(F.col("event_id") % NULL_SESSION_MODULUS != 0,
                  F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("session_no").cast("string")))
    return s.select("event_id", "event_time", "event_type", "product_id", "category_id", "category_code",
                    "brand", "price", "user_id", sess.alias("user_session"), "period")


def wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part as shop events: one session per order.

    session = l_orderkey, user = o_custkey, product = l_partkey, price =
    l_extendedprice, brand = p_brand, category id = l_partkey div 5 with the
    code of that part key (lower(p_type) + '.' + name), time = l_shipdate, type from (returnflag, linestatus):
    N -> view, A -> cart, R/O -> remove_from_cart, R/F -> purchase.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                                                "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    ev = li.join(orders, li.l_orderkey == orders.o_orderkey)
    ev = ev.withColumn("category_id", F.floor(F.col("l_partkey") / PRODUCTS_PER_CATEGORY).cast("bigint"))
    ev = lookup_join(ev, part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    codes = part.select(F.col("p_partkey").alias("category_id"),
                        F.concat(F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", ".")).alias("_code"))
    ev = lookup_join(ev, codes, "category_id")
    etype = (F.when(F.col("l_returnflag") == "N", "view")
             .when(F.col("l_returnflag") == "A", "cart")
             .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "remove_from_cart")
             .when(F.col("l_returnflag") == "R", "purchase"))
    return ev.select(
        (F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_suppkey")).alias("event_id"),
        F.col("l_shipdate").alias("event_time"),
        etype.alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        "category_id",
        F.col("_code").alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.col("l_extendedprice").cast("float").alias("price"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("user_session"),
        F.least(F.lit(N_PERIODS - 1), F.floor((F.month("l_shipdate") - 1) / 3)).cast("int").alias("period"),
    )
