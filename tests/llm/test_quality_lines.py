"""Frequent lines of a host leave the texts, whatever stands beside them and however large the host is."""

import brute
import corpus_pipeline
from sessionlab.llm import quality_rules

SCHEMA = "doc_id long, text string, source string"


def line(tag, n):
    return " ".join(f"{tag}{j}" for j in range(n))


def as_brute(spark, data):
    out = quality_rules.quality_rules(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    got = sorted((r.doc_id, r.text, r.n_frequent_words) for r in out)
    assert got == sorted((x[0], *y) for x, y in zip(data, brute.without_host_lines(data)))
    return {r.doc_id: r for r in out}


def test_lines_are_taken_out(spark):
    """Share bars of 40 % leave texts that stay; the same line on another host, blank lines and nulls stand."""
    data = [(i, f"{line(f'a{i}x', 9)}\n\n  Share  THIS page now \n{line(f'b{i}x', 3)}\nshare this page now", "s") for i in range(30)]
    data += [(100 + i, f"{line(f'c{i}x', 12)}\nshare this page now", "t") for i in range(20)] + [(200, None, "s"), (201, "", None)]
    got = as_brute(spark, data + data[:5])
    assert all(got[i].kept and got[i].n_frequent_words == 8 and "share" not in got[i].text.lower() for i in range(30))
    table = spark.createDataFrame([(*x, len(x[1] or "")) for x in data], SCHEMA + ", n_chars long")
    kept = corpus_pipeline.quality(spark, table, "").collect()
    assert len(kept) == 50 and all(r.text == got[r.doc_id].text and r.n_chars == len(r.text) for r in kept)


def test_long_furniture(spark):
    """Two shared lines longer than the own ones, each the longest other line of the rest, and two short ones."""
    shared = [line("notice", 60), line("menu", 50), "cookie line here", "share this"]
    data = [(i, "\n".join([*shared[:i % 4], line(f"own{i}x", 24), *shared[i % 4:]]), "s") for i in range(60)]
    got = as_brute(spark, data)
    assert not any(r.kept for r in got.values()) and all(got[i].text == line(f"own{i}x", 24) for i in range(60))


def test_mass_copies(spark):
    """Exact copies count once; a page with another line edited in each of 300 texts is 300 documents."""
    body = [line(f"p{k}w", 8 + k) for k in range(40)]
    data = [(i, "\n".join(body), "s") for i in range(300)] + [(1000 + i, f"{line(f'own{i}x', 30)}\n{body[3]}", "s") for i in range(19)]
    got = as_brute(spark, data)
    assert all(r.kept and not r.n_frequent_words for r in got.values())
    data = [(i, "\n".join([*body[:i % 40], f"edit {i}", *body[i % 40 + 1:]]), "s") for i in range(300)]
    got = as_brute(spark, data)
    assert not any(r.kept for r in got.values()) and got[7].text == "edit 7"


def test_pages_of_furniture(spark):
    """1,000 distinct pages with 25 menu lines (300 words) and 12, 17 or 80 words of their own; all of the first two go."""
    menu = [line(f"m{k}x", 12) for k in range(25)]
    for own, kept in ((12, 0), (17, 0), (80, 1000)):
        data = [(i, "\n".join([*menu, line(f"own{i}x", own)]), "s") for i in range(1000)]
        assert sum(r.kept for r in as_brute(spark, data).values()) == kept


def test_stage_takes_lines_out(spark):
    """The pipeline's stage on a table that loses lines and documents."""
    data = [(i, f"{line(f'a{i}x', 12)}\nshare this page now", "s", 5) for i in range(25)]
    data += [(50 + i, f"{line(f'b{i}x', 2)}\nshare this page now\n{line('t', 8)}", "s", 5) for i in range(25)]
    rows = [x[:3] for x in data]
    want = [(d, left, s) for (d, _, s), (left, _), k in zip(rows, brute.without_host_lines(rows), brute.quality_kept(rows)) if k]
    out = corpus_pipeline.quality(spark, spark.createDataFrame(data, SCHEMA + ", n_chars long"), "").collect()
    assert sorted((r.doc_id, r.text, r.source) for r in out) == sorted(want) and len(want) == 25
    assert all(r.n_chars == len(r.text) for r in out)


def test_large_host(spark):
    """A line of 21 documents is frequent on a host of 30 texts and on one of 21,500."""
    for n in (30, 21_500):
        data = [(i, f"own{i} {line('w', 11)} {i}" + "\nshare this" * (i < 21), "s") for i in range(n)]
        got = as_brute(spark, data)
        assert sum(r.n_frequent_words for r in got.values()) == 42
