"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables for every operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from sessionlab.llm import (chat_quotes, decontamination, html_extraction, line_dedup, lm_scoring, mixing, quality_rules, simhash,
                            substring_dedup, url_filter)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
ROWS = [
    (0, "one two three four five six seven eight nine ten eleven twelve", "a"), (1, None, "a"), (2, "", None), (3, " \t\n ", "b"),
    (None, "null id with some words in it and more words to come here", None),
    (5, "Straße é ÀÉ ☃ naïve\nsame line of text here\nsame line of text here", "b"),
    (6, LONG, "a"), (6, LONG, "a"), (7, "head words " + PASSAGE + " tail", "c"), (8, PASSAGE + " other tail here", "a"), (9, PASSAGE, "b"),
    (9, PASSAGE, "b"), (10, "a a a a a a a a a a a a a a a", "a"), (11, "x", "")]
SCHEMA = "doc_id long, text string, source string"
CLASH = ["k1", "h", "t_host", "_fp", "size", "Copies", "kept", "n_removed", "spans", "component", "fingerprint", "n", "_rest", "copy2", "node", "pos",
         "_c", "rate", "source_size", "b_h", "p_source", "g_k1", "_k1", "_size", "_rank"]
ITEMS = [(1, PASSAGE), (2, "ten eleven twelve"), (3, None), (4, ""), (None, "Words to COME here")]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return d.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def values(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_quality_rules(docs, none):
    out = quality_rules.quality_rules(docs)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert values(out, *cols) == sorted([(d, *brute.base_rules(t)) for d, t, _ in ROWS], key=repr)
    assert set(CLASH) - {"kept"} <= set(out.columns)
    assert quality_rules.quality_rules(none).count() == 0


def test_line_dedup(docs, none):
    out = line_dedup.line_dedup(docs, min_sites=2)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] is None and got[2] == "" and got[9] == PASSAGE
    assert out.count() == len(ROWS) and line_dedup.line_dedup(none).count() == 0


def test_simhash(docs, none):
    out = simhash.simhash_groups(docs)
    assert values(out, "doc_id", "fingerprint", "component_id") == sorted(brute.components([(d, t) for d, t, _ in ROWS]), key=repr)
    one = simhash.one_per_component(out)
    assert one.count() == one.select("component").distinct().count() == out.select("component").distinct().count()
    assert simhash.simhash_groups(none).count() == 0


def test_contamination(docs, none, items, spark):
    out = decontamination.contamination(docs, items)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert values(out, *cols) == sorted(brute.contamination([(d, t) for d, t, _ in ROWS], ITEMS), key=repr)
    assert decontamination.without_spans(out).filter("contaminated").count() == 0
    empty = decontamination.contamination(docs, items.limit(0))
    assert empty.filter("n_hit > 0 OR contaminated").count() == 0 and empty.count() == len(ROWS)
    assert decontamination.contamination(none, items).count() == 0


def test_mixing(docs, none, spark):
    out = mixing.mix(docs)
    rows = out.collect()
    sizes = {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    want = brute.targets(sizes)
    got = {}
    for r in rows:
        assert r.taken <= 2 * r["size"] and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        got[r.source] = got.get(r.source, 0) + r.taken
    for s in sizes:   # few documents: within one of the largest
        assert abs(got[s] - want[s]) <= max(len(brute.WORD.findall(t or "")) for _, t, x in ROWS if x == s)
    assert values(out, "doc_id", "text", "taken") == values(mixing.mix(docs.repartition(5)), "doc_id", "text", "taken")
    assert mixing.mix(none).count() == 0 and mixing.repeated(mixing.mix(none)).count() == 0
    assert mixing.mix(docs.filter("doc_id IN (1, 2)")).agg(F.sum("taken")).first()[0] == 0


def test_substring_dedup(docs, none):
    got = {(r.doc_id, r.start_word, r.end_word): r for r in substring_dedup.substring_dedup(docs).collect()}
    assert {d for d, *_ in got} == {6, 7, 8, 9}
    assert (7, 2, 62) in got and (8, 0, 60) in got and (9, 0, 60) in got
    assert got[(9, 0, 60)].class_doc_id == 7 and got[(9, 0, 60)].n_docs == 4
    assert substring_dedup.substring_dedup(none).count() == 0


def test_lm_scoring(docs, none):
    out = {r.doc_id: r for r in lm_scoring.score_documents(docs, held_out=F.col("doc_id") == 9).collect()}
    assert out[1].n_tokens == 1 and out[9].held_out and not out[None].held_out and out[9].n_known == 61
    assert all(r.score < 0 for r in out.values()) and out[9].score > out[9].base_score
    assert lm_scoring.score_documents(none).count() == 0
    untrained = lm_scoring.score_documents(docs, held_out=F.lit(True)).collect()
    assert len(untrained) == len(ROWS) and all(r.score == r.base_score == 0 and r.train_tokens == 0 for r in untrained)


def test_html(spark):
    rows = [(1, None), (2, ""), (3, "no tags &amp; all"), (4, "<p>only"), (5, "<article><h1>T</h1><p>a\n b<p>c &lt; d</article>"), (5, "<p"),
            (6, "<div>" * 3000 + "deep words here" + "</div>" * 3000), (7, "<p>" + LONG)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, html string, Text int")
    got = {}
    for r in html_extraction.extract(pages).collect():
        got.setdefault(r.page_id, set()).add(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == got[2] == {""} and got[3] == {"no tags & all"} and "T\na b\nc < d" in got[5] and got[7] == {LONG}
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_chat(spark):
    rows = [("c", 0, "first words\nand a second line"), ("c", 1, "> first words\n> and a second line\nmy reply"),
            ("c", 2, "> > first words\n> > and a second line\n> my reply\nanswer to the reply"), ("c", 3, "> AND a   second line\nto the first again"),
            ("c", 4, "> quoted from nowhere\nlost"), ("d", 0, None), ("d", 1, ""), ("d", None, "x"), (None, 0, "> x\ny"), ("c", 0, "first words\nand a second line")]
    m = spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id string, turn long, text string, depth int, h int")
    out = chat_quotes.conversations(m)
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert out.count() == len(rows)
    assert [got["c", t].reply_to for t in range(5)] == [None, 0, 1, 0, None]
    assert [got["c", t].depth for t in range(5)] == [0, 1, 2, 1, 0]
    assert got["c", 2].text == "answer to the reply" and got["c", 4].text == "lost" and got["c", 4].n_quoted_lines == 1
    assert sorted(r.position for r in out.filter("conv_id = 'c'").collect()) == list(range(6))
    assert chat_quotes.conversations(m.limit(0)).count() == 0


def test_urls(spark):
    day = lambda n, h=0: dt.datetime(2024, 1, n, h)
    edits = [("h:a.com", day(2), "add"), ("h:a.com", day(4), "remove"), ("d:b.org", day(3), "add"), ("p:c.net/x/y", day(1), "add"),
             ("h:a.com", day(9, 5), "add"), ("h:a.com", day(9, 5), "remove"), (None, day(1), "add"), ("h:q", None, "add"), ("h:q", day(1), "?"),
             ("d:b.org", day(5), "add")]
    caps = [(1, "http://a.com/", day(1), False), (2, "http://A.com/z", day(2), True), (3, "http://a.com", day(3, 23), True),
            (4, "http://a.com", day(4), False), (5, "http://www.b.org/q?x", day(20), True), (6, "http://xb.org", day(20), False),
            (7, "https://c.net/x/y/z", day(30), True), (8, "https://c.net/x/yz", day(30), False), (9, None, day(3), False),
            (10, "http://b.org", None, False), (11, "nonsense", day(9), False), (12, "http://a.com", day(9, 6), False),
            (2, "http://A.com/z", day(2), True)]
    c = spark.createDataFrame([(*r, 1) for r in caps], "id long, url string, fetched_at timestamp, expected boolean, entry int")
    e = spark.createDataFrame(edits, "pattern string, at timestamp, action string")
    out = url_filter.filter_urls(c, e)
    assert out.count() == len(caps) and out.filter("blocked <> expected").count() == 0
    assert out.filter("id = 5").first().valid_from == day(3)
    assert url_filter.filter_urls(c.limit(0), e).count() == 0
    assert url_filter.filter_urls(c, e.limit(0)).filter("blocked").count() == 0
    spans = {(r.pattern, r.valid_from, r.valid_to) for r in url_filter.intervals(e).collect()}
    assert spans == {("h:a.com", day(2), day(4)), ("d:b.org", day(3), None), ("p:c.net/x/y", day(1), None)}


def test_hosts(spark):
    """User info, ports, rooted names, IPv6 addresses and very long urls."""
    at = dt.datetime(2024, 1, 2)
    hosts = [("http://user@evil.com/", "evil.com"), ("http://user:pw@evil.com/", "evil.com"), ("http://evil.com./x", "evil.com"),
             ("HTTPS://a:b@EVIL.com.:8080?x", "evil.com"), ("http://u@v@evil.com#f", "evil.com"), ("http://[2001:DB8::1]:80/x", "[2001:db8::1]"),
             ("ftp://[::1]", "[::1]"), ("http://ok.org/user@evil.com", "ok.org"), ("http://ok.org?to=http://evil.com/", "ok.org"),
             ("http://:80/", ""), ("//evil.com", ""), ("1http://evil.com", ""), (None, ""), ("http://" + "a." * 5000 + "evil.com/" + "p/" * 3000, "a." * 5000 + "evil.com")]
    df = spark.createDataFrame([(*h, at) for h in hosts], "url string, host string, fetched_at timestamp")
    assert [r for r in df.withColumn("got", url_filter.host_of(F.col("url"))).collect() if r.got != r.host] == []
    edits = spark.createDataFrame([("d:evil.com", dt.datetime(2024, 1, 1), "add")], "pattern string, at timestamp, action string")
    judged = url_filter.filter_urls(df, edits).collect()
    assert all(r.blocked == (r.host.endswith("evil.com")) for r in judged) and sum(r.blocked for r in judged) == 6


def test_pipeline_stages_on_edges(spark, tmp_path, items):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(*r, "en", len(r[1] or "")) for r in ROWS], SCHEMA + ", lang string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.mixture(spark, docs.limit(0), str(tmp_path)).count() == 0
