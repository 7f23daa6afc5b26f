"""Filter audit: the stream over many files in any order against plain counting."""

import itertools
import re

import pytest

from sessionlab.llm import filter_audit

DOCS = "doc_id long, text string, source string, n int"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(docs, labels):
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x, *_ in labels if x == 1 and i is not None}
    judged = []
    for i, t, s, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        judged.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                stay, go = [j for j in left if not j[1][f]], [j for j in left if j[1][f]]
                out[part, order, step] = [len(stay), len(go), sum(j[1][f] for j in own) - len(go),
                                          sum(j[1][f] and sum(j[1].values()) == 1 for j in own), sum(j[2] for j in go), sum(j[3] for j in go)]
                total[f] += len(go)
                left = stay
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(total[f])
    return out


def as_dict(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def corpus():
    long = " ".join(f"w{k}" for k in range(60))
    texts = [long, long + " #", "a b c", "", None, long.upper(), " ".join(["same"] * 70), long + " É x", "A" * 5000 + " " + long]
    # ids fall from file to file, so that every copy is overturned by the next one
    docs = [(1000 - 7 * i, texts[i % len(texts)], ["s0", "s1", None, ""][i % 4], 0) for i in range(54)]
    docs += [(None, long, "s0", 0), (None, "a b c", "s1", 0), (5, long, "s0", 0), (5, long, "s0", 0), (5, long, "s9", 0), (5, "other", "s0", 0)]
    labels = [(d[0], i % 2, int(i % 3 == 0), "x") for i, d in enumerate(docs[:50:2])] + [(5, None, 1, None), (5, 1, None, ""), (None, 1, 1, "")]
    return docs, labels


@pytest.mark.parametrize("files", [1, 5])
def test_stream_equals_plain_counts(spark, tmp_path, files):
    docs, labels = corpus()
    want = brute(docs, labels)
    for turn, rows in enumerate((docs, docs[::-1])):
        path = str(tmp_path / f"docs{turn}")
        step = -(-len(rows) // files)
        for k in range(0, len(rows), step):
            spark.createDataFrame(rows[k:k + step], DOCS).coalesce(1).write.mode("append").parquet(path)
        got = as_dict(filter_audit.filter_audit(spark, path, spark.createDataFrame(labels, LABELS), batches=files))
        assert got == want


def test_retraction_by_batch(spark, tmp_path):
    """The counters after each batch are right for the files seen so far; a replayed batch changes nothing."""
    audit = filter_audit.Audit(spark, str(tmp_path), spark.createDataFrame([], LABELS))
    seen = []
    for batch, rows in enumerate([[(9, "t", "p", 0)], [(7, "t", "q", 0), (8, "t", "p", 0)], [(7, "t", "r", 0), (3, "u", "p", 0)], [(1, "t", "p", 0)]]):
        for _ in range(2):
            audit.take(spark.createDataFrame(rows, DOCS), batch)
        seen.append({(r.part, bool(r["mask"] & 16)): r.n for r in audit.counts(batch + 1).collect()})
    assert seen == [{("p", False): 1}, {("p", True): 2, ("q", False): 1}, {("p", True): 2, ("q", False): 1, ("r", False): 1, ("p", False): 1},
                    {("p", True): 2, ("q", True): 1, ("r", True): 1, ("p", False): 2}]


def test_empty_and_single_file(spark, tmp_path):
    labels = spark.createDataFrame([], LABELS)
    path = str(tmp_path / "none")
    spark.createDataFrame([], DOCS).write.parquet(path)
    assert filter_audit.filter_audit(spark, path, labels).collect() == []
    # a table that is one file, beside another in its folder
    spark.createDataFrame([(1, "a", "p", 0)], DOCS).coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next((tmp_path / "one").glob("part-*.parquet"))
    (tmp_path / "flat").mkdir()
    for name in ("docs.parquet", "other.parquet"):
        (tmp_path / "flat" / name).write_bytes(part.read_bytes())
    got = as_dict(filter_audit.filter_audit(spark, str(tmp_path / "flat" / "docs.parquet"), labels))
    assert len(got) == 600 and got["p", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]
