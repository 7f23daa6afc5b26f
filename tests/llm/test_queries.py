"""Registered queries and pipeline stages against brute force, and oracles, on the smallest tables."""

import html as entities
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as ent
import brute
import corpus_pipeline
from sessionlab.llm import lm_scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in "documents pages benchmark conversations events".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, source FROM documents").fetchall()


@pytest.fixture(scope="module")
def items(con):
    return con.execute("SELECT item_id, text FROM benchmark").fetchall()


def rows(spark, name):
    return ent.queries()[name](spark, SF).collect()


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_op1(spark, docs):
    got = defaultdict(set)
    for r in rows(spark, "op1_substring_dedup"):
        assert r.n_words >= 51 and r.n_docs > 1
        got[r.doc_id].update(range(r.start_word, r.end_word))
    for i, words in brute.shared_passages([(d, t) for d, t, _ in docs]).items():
        assert words <= got[docs[i][0]]


def test_op2(spark, con):
    def truth(h):
        inside = re.search(r"<article>(.*?)(</article>|\Z)", h, re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        return "\n".join(b for b in blocks if b)
    want = [(i, u, truth(h), len(truth(h))) for i, u, h in con.execute("SELECT page_id, url, html FROM pages").fetchall()]
    same([tuple(r) for r in rows(spark, "op2_html_extraction")], want)


def test_op3(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op3_lm_scoring")}
    words = {d: [*(t or "").encode().lower().split(), None] for d, t, _ in docs}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, *_ in docs}
    c = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in words.items():
        r, base = got[d], sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    # what the model adds to single words shows on texts it has not seen
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_op3_is_a_distribution(spark):
    """After any known word, and after an unknown one, the probabilities of all words sum to one."""
    train = ["a b a c", "b a b", "c c a d", "a b"] * 3
    known = ["a", "b", "c", "d", "zz"]      # zz: the unknown word
    texts = train + known + [f"{u} {w}" for u in known for w in known] + [""]
    d = spark.createDataFrame([(i, t, i >= len(train)) for i, t in enumerate(texts)], "doc_id long, text string, held boolean")
    s = {texts[r.doc_id]: r.score for r in lm_scoring.score_documents(d, held_out=d["held"]).collect() if r.held_out}
    p = lambda t: 10 ** s[t]
    # texts give P(u|start) e(u) and P(u|start) P(w|u) e(w), where e(w) = P(end|w); the rows
    # sum_w P(w|u) + e(u) = 1 determine e, and then P(.|start) must sum to one as well
    e = np.full(len(known), 0.3)
    for _ in range(5000):
        miss = np.array([sum(p(f"{u} {w}") * e[i] / (p(u) * e[j]) for j, w in enumerate(known)) + e[i] - 1 for i, u in enumerate(known)])
        e = e * (1 - 0.2 * miss)
    assert np.abs(miss).max() < 1e-9
    assert sum(p(u) / e[i] for i, u in enumerate(known)) + p("") == pytest.approx(1, abs=1e-6)


def test_op3_repeats_itself(spark):
    a, b = (sorted((r.doc_id, r.score) for r in rows(spark, "op3_lm_scoring")) for _ in range(2))
    assert a == b


@pytest.mark.parametrize("name", ["op4_chat_quotes", "op7_url_filter"])
def test_oracles(spark, con, name):
    r = con.execute(ent.oracle_sql()[name])
    names, want = [d[0] for d in r.description], r.fetchall()
    df = ent.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    same([tuple(x) for x in df.select(*names).collect()], want)


def test_op5(spark, docs, items):
    same([tuple(r) for r in rows(spark, "op5_benchmark_decontamination")], brute.contamination([(d, t) for d, t, _ in docs], items))


def test_op6(spark, docs):
    want = brute.line_dedup(docs)
    same([(r.doc_id, r.text) for r in rows(spark, "op6_line_dedup")], [(d, w) for (d, *_), w in zip(docs, want)])


def test_op6_near_threshold(spark):
    """Lines of 9, 10 and 11 sites around a threshold of 10; a hot line of all sites."""
    from sessionlab.llm import line_dedup
    data = [(i, f"shared by {n}\nhot line\nown {i}", f"s{i}") for n in (9, 10, 11) for i in range(100 * n, 101 * n)]
    d = spark.createDataFrame(data * 2, "doc_id long, text string, source string")
    got = [(r.doc_id, r.text) for r in line_dedup.line_dedup(d).collect()]
    same(got, [(x[0], t) for x, t in zip(data * 2, brute.line_dedup(data * 2))])


def test_op8(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op8_quality_rules")}
    for (d, t, _), kept in zip(docs, brute.quality_kept(docs)):
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(t)
        assert r.kept == kept


def test_op8_frequent_lines(spark):
    """Furniture goes, and with it pages that hold little else, be they distinct or one page with small edits."""
    from sessionlab.llm import quality_rules
    menu = "home news sport weather travel shop help contact about imprint terms privacy"
    data = [(i, f"{menu}\nunique line {i} {i * 7} about something else", "s") for i in range(60)]
    data += [(100 + i, f"{menu}\n{menu} x\nunique text number {i} of this page has many more words than the menu has so it stays whatever {i}", "s")
             for i in range(40)]
    body = [" ".join(f"p{k}w{j}" for j in range(12 + k)) for k in range(8)]
    data += [(200 + i, "\n".join([*body[:i % 8], f"edited {i}", *body[i % 8:]]), "s") for i in range(80)]
    d = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(d, min_left=0.5).collect()}
    assert not any(got[i] for i in range(60)) and not any(got[i] for i in range(200, 280))
    assert [got[x[0]] for x in data] == brute.quality_kept(data, min_left=0.5)


def test_op9(spark, docs):
    same([tuple(r) for r in rows(spark, "op9_simhash_near_dedup")], brute.components([(d, t) for d, t, _ in docs]))


def test_op9_chains(spark):
    """Random fingerprints with planted neighbours and a long chain: the tiles lose no link."""
    import random
    from sessionlab.llm import simhash
    rnd = random.Random(3)
    fps = [rnd.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:
        for _ in range(3):
            fps.append(f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))))
    x = rnd.getrandbits(64)
    for _ in range(25):
        x ^= sum(1 << b for b in rnd.sample(range(64), 3))
        fps.append(x)
    d = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, _fp long")
    got = {r.doc_id: r.component_id for r in simhash.linked(d).collect()}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert got == {i: find(i) for i in range(len(fps))}


def test_op10(spark, docs):
    size = {d: len(brute.WORD.findall(t or "")) for d, t, _ in docs}
    total = Counter()
    for d, _, s in docs:
        total[s] += size[d]
    want, got = brute.targets(dict(total)), Counter()
    out = rows(spark, "op10_mixing")
    for r in out:
        assert r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size) and r.target == pytest.approx(want[r.source])
        got[r.source] += r.taken
    for s in want:
        assert abs(got[s] - want[s]) <= 0.02 * want[s] + 20
    assert sorted(map(tuple, out)) == sorted(map(tuple, rows(spark, "op10_mixing")))


def test_pipeline(spark, docs, items, tmp_path):
    """Every stage on what its predecessor kept, against the brute-force version of each."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    now = [(d, t, s) for d, t, s in docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, table, SF).write.parquet(path)
        table = spark.read.parquet(path)
        if name == "quality_rules":
            now = [(d, left, s) for (d, _, s), (left, _), k in zip(now, brute.without_host_lines(now), brute.quality_kept(now)) if k]
        elif name == "line_dedup":
            now = [(d, n, s) for (d, t, s), n in zip(now, brute.line_dedup(now)) if n == t or brute.WORD.search(n)]
        elif name == "simhash_near_dedup":
            own = {d: c for d, _, c in brute.components([(d, t) for d, t, _ in now])}
            now = [r for r in now if own[r[0]] == r[0]]
        else:
            left = dict(brute.without_spans([(d, t) for d, t, _ in now], items))
            now = [(d, left[d], s) for d, _, s in now if d in left]
        same([(r.doc_id, r.text, r.source) for r in table.collect()], now)
    got, total = Counter(), Counter()
    for _, t, s in now:
        total[s] += len(brute.WORD.findall(t))
    out = corpus_pipeline.mixture(spark, table, SF).collect()
    texts = {d: t for d, t, _ in now}
    assert all(texts[r.doc_id] == r.text and r.copy in (1, 2) for r in out)
    for r in out:
        got[r.source] += len(brute.WORD.findall(r.text))
    for s, want in brute.targets(dict(total)).items():
        assert abs(got[s] - want) <= 0.02 * want + 20
