"""The operators as registered queries (``opN_<name>``) over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.llm import (byte_bpe, centroids, chat_quotes, decontamination, filter_audit, html_extraction, line_dedup, lm_scoring, mixing,
                            quality_rules, simhash, substring_dedup, url_filter)
from sessionlab.llm.common import written
from sessionlab.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op5_benchmark_decontamination(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    out = decontamination.contamination(docs, read_table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register
def op6_line_dedup(spark, d):
    return line_dedup.line_dedup(read_table(spark, d, "documents", ["doc_id", "source", "text"]))


@register
def op8_quality_rules(spark, d):
    out = quality_rules.quality_rules(read_table(spark, d, "documents", ["doc_id", "source", "text"]))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "n_frequent_words", "text")


@register
def op9_simhash_near_dedup(spark, d):
    fps = simhash.fingerprints(read_table(spark, d, "documents", ["doc_id", "text"])).drop("text")
    return simhash.linked(written(fps, "simhash-docs")).select("doc_id", "fingerprint", "component_id")


@register
def op10_mixing(spark, d):
    out = mixing.mix(read_table(spark, d, "documents", ["doc_id", "source", "text"]))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "rate", "copies")


@register
def op2_html_extraction(spark, d):
    pages = read_table(spark, d, "pages", ["page_id", "url", "html"])
    return html_extraction.extract(pages).select("page_id", "url", "text", "n_chars")


# ---- op4: the chat has no quotes, so each turn quotes the two before it as mail does
_TRIM = r"regexp_replace({0}, '^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$', '', 'g')"
ORACLES["op4_chat_quotes"] = rf"""
WITH c AS (
  SELECT conv_id, turn, role, text,
         lag(turn) OVER w AS p_turn, lag(text) OVER w AS p_text, lag(turn, 2) OVER w AS pp_turn, lag(text, 2) OVER w AS pp_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
l AS (
  SELECT *, coalesce(p_turn = turn - 1 AND {_TRIM.format("coalesce(p_text, '')")} <> '', false) AS linked FROM c),
r AS (
  SELECT *, max(CASE WHEN NOT linked THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS thread_root FROM l)
SELECT conv_id, turn, role, {_TRIM.format("coalesce(text, '')")} AS text,
       CASE WHEN linked THEN turn - 1 END AS reply_to, thread_root, turn - thread_root AS depth,
       CAST(coalesce(CASE WHEN p_turn = turn - 1 THEN len(string_split(p_text, chr(10))) END, 0)
            + coalesce(CASE WHEN p_turn = turn - 2 THEN len(string_split(p_text, chr(10)))
                            WHEN pp_turn = turn - 2 THEN len(string_split(pp_text, chr(10))) END, 0) AS BIGINT) AS n_quoted_lines,
       row_number() OVER (PARTITION BY conv_id ORDER BY thread_root, turn - thread_root, turn) - 1 AS position
FROM r"""


@register
def op4_chat_quotes(spark, d):
    mail = chat_quotes.mail_view(read_table(spark, d, "conversations", ["conv_id", "turn", "role", "text"]))
    return chat_quotes.conversations(mail).select("conv_id", "turn", "role", "text", "reply_to", "thread_root", "depth",
                                                  "n_quoted_lines", "position")


# ---- op7: pages are the captures, fetched when the event of their number happened; the other
# events of a page's number (user_id) are the edits that listed or delisted its host, domain or path
ORACLES["op7_url_filter"] = r"""
WITH r AS (   -- what follows the scheme, read piece by piece
  SELECT page_id, url, CASE WHEN regexp_full_match(split_part(url, '://', 1), '[A-Za-z][A-Za-z0-9+.-]*') AND contains(url, '://')
                            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
a AS (SELECT *, split_part(split_part(split_part(rest, '/', 1), '?', 1), '#', 1) AS authority FROM r),
b AS (SELECT *, list_extract(string_split(authority, '@'), -1) AS place, split_part(split_part(substr(rest, length(authority) + 1), '?', 1), '#', 1) AS path FROM a),
n AS (SELECT *, lower(CASE WHEN starts_with(place, '[') THEN split_part(place, ']', 1) || ']' ELSE split_part(place, ':', 1) END) AS name FROM b),
u AS (SELECT page_id, url, CASE WHEN ends_with(name, '.') THEN left(name, length(name) - 1) ELSE name END AS host,
             list_filter(string_split(coalesce(path, ''), '/'), lambda x: x <> '') AS parts FROM n),
e AS (
  SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'h:' || host
              WHEN event_type IN ('click', 'view') THEN 'p:' || host || '/' || parts[1]
              WHEN event_type = 'purchase' AND len(string_split(host, '.')) > 2
                   THEN 'd:' || array_to_string(string_split(host, '.')[2:], '.') END AS pattern,
         ts AS t_at, (event_type IN ('error', 'click') OR (event_type = 'purchase' AND event_id % 2 = 0)) AS adds
  FROM events JOIN u ON u.page_id = events.user_id),
s AS (SELECT pattern, t_at, bool_and(adds) AS active FROM e WHERE pattern IS NOT NULL AND t_at IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, lag(active) OVER (PARTITION BY pattern ORDER BY t_at) AS was FROM s),
x AS (SELECT pattern, t_at, active FROM g WHERE active <> coalesce(was, false)),
c AS (SELECT u.*, events.ts AS fetched_at FROM u LEFT JOIN events ON events.event_id = u.page_id),
k AS (
  SELECT page_id, fetched_at, unnest(list_distinct(list_concat(['h:' || host],
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'd:' || array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(parts) + 1), lambda i: 'p:' || host || '/' || array_to_string(parts[1:i], '/'))))) AS pattern
  FROM c WHERE coalesce(host, '') <> '' AND fetched_at IS NOT NULL),
h AS (
  SELECT k.page_id, count(*) AS n_entries, min({'p': x.pattern, 'a': x.t_at}) AS least
  FROM k ASOF JOIN x ON k.pattern = x.pattern AND k.fetched_at >= x.t_at WHERE x.active GROUP BY 1)
SELECT c.page_id, c.url, epoch_us(c.fetched_at) AS fetched_us, h.page_id IS NOT NULL AS blocked, coalesce(n_entries, 0) AS n_entries,
       least.p AS entry, epoch_us(least.a) AS valid_from_us
FROM c LEFT JOIN h ON h.page_id = c.page_id"""


@register
def op7_url_filter(spark, d):
    pages = read_table(spark, d, "pages", ["page_id", "url"])
    events = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type"]).withColumn("ts", F.col("ts").cast("timestamp"))
    captures = pages.join(events.select(F.col("event_id").alias("page_id"), F.col("ts").alias("fetched_at")), "page_id", "left")
    host, kind = url_filter.host_of(F.col("url")), F.col("event_type")
    part = F.get(F.filter(F.split(url_filter.path_of(F.col("url")), "/"), lambda x: x != ""), F.lit(0))
    labels = F.split(host, r"\.")
    pattern = (F.when(kind.isin("error", "signup"), F.concat(F.lit("h:"), host))
               .when(kind.isin("click", "view"), F.concat(F.lit("p:"), host, F.lit("/"), part))
               .when((kind == "purchase") & (F.size(labels) > 2), F.concat(F.lit("d:"), F.array_join(F.slice(labels, F.lit(2), F.size(labels)), "."))))
    adds = kind.isin("error", "click") | ((kind == "purchase") & (F.col("event_id") % 2 == 0))
    edits = (events.join(pages, events["user_id"] == pages["page_id"])
             .select(pattern.alias("pattern"), F.col("ts").alias("at"), F.when(adds, "add").otherwise("remove").alias("action")))
    return url_filter.filter_urls(captures, edits).select(
        "page_id", "url", F.unix_micros("fetched_at").alias("fetched_us"), "blocked", "n_entries", "entry",
        F.unix_micros("valid_from").alias("valid_from_us"))


@register
def op3_lm_scoring(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lm_scoring.score_documents(docs, held_out=held_out)


@register
def op1_substring_dedup(spark, d):
    return substring_dedup.substring_dedup(read_table(spark, d, "documents", ["doc_id", "text"]))


# ---- op11: ten rounds written out one after another
def _rounds_sql(rounds: int = 10, k: int = 8) -> str:
    def assigned(r):
        return f"""a{r} AS MATERIALIZED (SELECT vec_id, v, d, list_position(d, list_min(d)) - 1 AS c FROM (
  SELECT vec_id, v, list_transform((SELECT list(v ORDER BY c) FROM c{r}), lambda q:
         list_sum(list_transform(list_zip(v, q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM kept))"""
    parts = ["""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
  SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds):
        parts += [assigned(r), f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) AS t(i) GROUP BY c, i) GROUP BY c) m ON m.c = c{r}.c)"""]
    parts.append(assigned(rounds))
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, CAST(list_min(d) AS BIGINT) AS distance,
       CAST(sum(list_min(d)) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(list_min(d)) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} q ON q.c = a{rounds}.c"""


ORACLES["op11_centroid_clustering"] = _rounds_sql()


@register
def op11_centroid_clustering(spark, d):
    return centroids.cluster(read_table(spark, d, "embeddings", ["vec_id", "embedding"])).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@register
def op12_byte_bpe(spark, d):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode(read_table(spark, d, "documents", ["doc_id", "text"]), ranks, public_tokenizers.PATTERN)
    out = byte_bpe.decode(tokens.drop("text"), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


ORACLES["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+') AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         MAP {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
              'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
              'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)} AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, string_split(filter_order[1:step - 1], '') AS before FROM o, range(1, 6) AS t(step)),
g AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
j AS (SELECT g.*, s.*, fails[own] AS bad, len(list_filter(before, lambda y: y <> '' AND fails[y])) > 0 AS gone,
             len(list_filter(map_values(fails), lambda y: y)) = 1 AS once FROM g, s),
r AS (
  SELECT part, filter_order, step, own,
         CAST(sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN bad AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN bad AND once THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN bad AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN bad AND NOT gone AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


@register
def op13_filter_audit(spark, d):
    return filter_audit.filter_audit(spark, f"{d.rstrip('/')}/documents.parquet", read_table(spark, d, "labels"))
