"""URL filters by a temporal list join.

A block list is a log of dated edits: at some time a pattern was added or removed.  Edits
become validity intervals [valid_from, valid_to) of each pattern.  A capture has a few
candidate patterns (its host, the domains above it, its path prefixes); an as-of join finds
for each the interval that holds at fetch time.

Both steps work in time slices: edits and captures meet by (pattern, slice), with the state
at the start of a slice carried over from earlier slices.  A pattern that a third of all
captures share is thus spread over its slices, and within one the capture side can be split
freely because the list side has one row.

Patterns: ``h:host``, ``d:domain`` (the host itself or any host below it), ``p:host/path``
(that path and everything below it, by whole segments).

Defined cases: user info, a port and one final dot are no part of a host; a url without a host,
or a null url, matches nothing, nor does one whose authority is no host and port; urls of any
length are matched whole; of entries that match, the least pattern is named; a null fetch time
matches nothing; edits without pattern, time or known action are ignored; of edits of one
pattern at one time, a removal wins; an edit counts from its own instant on; repeated rows
are judged alike; an empty list lets everything pass; clashing extra columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import guarded, let, unguarded

#: seconds of a time slice
SLICE = 86_400


def host_of(url: Column) -> Column:
    """Lower-case host of a url without user, password, port and the dot of a rooted name; an IPv6
    address keeps its brackets."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?(\[[^\]]*\]|[^:@]*?)\.?(?::[^@]*)?$", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def candidates(url: Column) -> Column:
    """The patterns that would match a url."""
    def of(host):
        labels = F.split(host, r"\.")
        domains = let(labels, lambda a: F.transform(
            F.sequence(F.lit(1), F.size(a)), lambda k: F.concat(F.lit("d:"), F.array_join(F.slice(a, k, F.size(a)), "."))))
        parts = let(F.filter(F.split(path_of(url), "/"), lambda x: x != ""), lambda a: F.when(
            F.size(a) > 0, F.transform(F.sequence(F.lit(1), F.size(a)),
                                       lambda k: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(a, F.lit(1), k), "/"))))
                    .otherwise(F.array().cast("array<string>")))
        return F.when(host == "", F.array().cast("array<string>")).otherwise(
            F.concat(F.array(F.concat(F.lit("h:"), host)), domains, parts))
    return let(host_of(url), of)


def _slice(time: Column, width: int) -> Column:
    return F.floor(F.unix_micros(time) / F.lit(width * 1_000_000))


def validity(edits: DataFrame, width: int = SLICE) -> DataFrame:
    """(pattern, slice, at, active): the edits that change a pattern's state, from
    (pattern, at, action) with action ``add`` or ``remove``."""
    clean = (edits.filter(F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
             .groupBy("pattern", "at").agg(F.min(F.col("action") == "add").alias("active"))
             .withColumn("slice", _slice(F.col("at"), width)))
    ends = clean.groupBy("pattern", "slice").agg(F.max_by("active", "at").alias("end"))
    before = Window.partitionBy("pattern").orderBy("slice").rowsBetween(-1, -1)
    start = ends.select("pattern", "slice", F.coalesce(F.max("end").over(before), F.lit(False)).alias("start"))
    inside = Window.partitionBy("pattern", "slice").orderBy("at")
    return (clean.join(start, ["pattern", "slice"])
            .withColumn("was", F.coalesce(F.lag("active").over(inside), F.col("start")))
            .filter(F.col("active") != F.col("was")).select("pattern", "slice", "at", "active"))


def intervals(edits: DataFrame, width: int = SLICE) -> DataFrame:
    """(pattern, valid_from, valid_to) of the list; valid_to is null while an entry stands."""
    changes = validity(edits, width)
    heads = changes.groupBy("pattern", "slice").agg(F.min("at").alias("head"))
    after = Window.partitionBy("pattern").orderBy("slice").rowsBetween(1, 1)
    nexts = heads.select("pattern", "slice", F.max("head").over(after).alias("later"))
    inside = Window.partitionBy("pattern", "slice").orderBy("at")
    return (changes.join(nexts, ["pattern", "slice"])
            .withColumn("valid_to", F.coalesce(F.lead("at").over(inside), F.col("later")))
            .filter("active").select("pattern", F.col("at").alias("valid_from"), "valid_to"))


def filter_urls(captures: DataFrame, edits: DataFrame, url: str = "url", fetched_at: str = "fetched_at",
                width: int = SLICE) -> DataFrame:
    """Every row of ``captures`` with blocked, n_entries (entries active at fetch time that match),
    entry (the least of them) and valid_from (since when it stands)."""
    out = ["blocked", "n_entries", "entry", "valid_from"]
    base = guarded(captures, [url, fetched_at], out)
    # a judgement depends on url and time alone
    asked = base.select(F.col(url).alias("_url"), F.col(fetched_at).alias("_at")).filter("_url IS NOT NULL AND _at IS NOT NULL").distinct()
    asked = (asked.select("_url", "_at", F.explode(F.array_distinct(candidates(F.col("_url")))).alias("pattern"))
             .withColumn("slice", _slice(F.col("_at"), width)))
    changes = validity(edits, width)
    listed = changes.groupBy("pattern", "slice").agg(
        F.array_sort(F.collect_list(F.struct("at", "active"))).alias("log"), F.max(F.struct("at", "active")).alias("last"))
    need = asked.select("pattern", "slice").distinct().join(changes.select("pattern").distinct(), "pattern")
    before = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (need.join(listed, ["pattern", "slice"], "full")
              .withColumn("carried", F.last("last", ignorenulls=True).over(before)).drop("last"))
    past = F.filter("log", lambda e: e["at"] <= F.col("_at"))
    state = F.coalesce(F.get(past, F.size(past) - 1), F.col("carried"))
    hits = (asked.join(slices, ["pattern", "slice"])
            .withColumn("state", state)
            .filter(F.col("state.active"))
            .groupBy("_url", "_at").agg(F.count("*").alias("n_entries"), F.min(F.struct("pattern", "state.at")).alias("least")))
    done = (base.join(hits, (F.col(url) == F.col("_url")) & (F.col(fetched_at) == F.col("_at")), "left")
            .withColumn("blocked", F.col("n_entries").isNotNull())
            .withColumn("n_entries", F.coalesce("n_entries", F.lit(0).cast("long")))
            .withColumn("entry", F.col("least.pattern")).withColumn("valid_from", F.col("least.at"))
            .drop("_url", "_at", "least"))
    return unguarded(done, captures.columns, [url, fetched_at], out)
