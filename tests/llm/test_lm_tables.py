"""Tables of the language model against sums over Stirling numbers and against seating one customer at a time."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sessionlab.llm import lm_scoring


def log_weights(count, d):
    """Log weight of all seatings of ``count`` customers at 1 .. count tables."""
    row = [0.0]
    for c in range(1, count):
        nxt = [-math.inf] * (c + 1)
        for t, x in enumerate(row, 1):
            nxt[t - 1] = np.logaddexp(nxt[t - 1], x + math.log(c - d * t))
            nxt[t] = np.logaddexp(nxt[t], x)
        row = nxt
    return np.array(row)


def exact_mean(count, new, d):
    """Mean number of tables of ``count`` customers of one dish when a new table weighs ``new``."""
    w = log_weights(count, d) + np.arange(1, count + 1) * math.log(new)
    w = np.exp(w - w.max())
    return float((w * np.arange(1, count + 1)).sum() / w.sum())


@pytest.mark.parametrize("d", [0.8, 0.5])
@pytest.mark.parametrize("count", [2, 5, 20, 50, 128, 129, 300, 600])
def test_mean_tables(count, d):
    for new in (0.05, 1.62, 12.0, 90.0):
        n = 6000
        s = lm_scoring.Seating(np.zeros(n, np.int64), np.full(n, count), np.ones(n), np.array([0]), np.ones(1), d, 1.0, np.random.default_rng(1))
        got = s._draw(s.count, np.full(n, new), np.zeros(n))
        assert got.min() >= 1 and got.max() <= count
        assert got.mean() == pytest.approx(exact_mean(count, new, d), rel=0.05)


def test_mean_tables_of_the_largest():
    """2,000 customers: sums over Stirling numbers give 3.03 and 6.01 (new tables of 1.62 and 4)."""
    for new, want in ((1.62, 3.03), (4.0, 6.01)):
        n = 20_000
        s = lm_scoring.Seating(np.zeros(n, np.int64), np.full(n, 2000), np.ones(n), np.array([0]), np.ones(1), 0.8, 1.0, np.random.default_rng(2))
        assert s._draw(s.count, np.full(n, new), np.zeros(n)).mean() == pytest.approx(want, rel=0.05)


def exact_restaurant(counts, p0, d, s):
    """Mean tables of each dish of one restaurant, summed over all numbers of tables."""
    top = sum(counts) + 1
    gain = np.array([math.lgamma(s / d + t) for t in range(top)])

    def weights(k):
        w = np.concatenate([[-np.inf], log_weights(counts[k], d) + np.arange(1, counts[k] + 1) * math.log(d * p0[k])])
        return np.exp(w - w.max())
    out = []
    for k in range(len(counts)):
        others = np.ones(1)
        for j in range(len(counts)):
            if j != k:
                others = np.convolve(others, weights(j))
        own = weights(k)
        with np.errstate(divide="ignore"):
            joint = np.log(np.outer(own, others)) + gain[np.add.outer(np.arange(len(own)), np.arange(len(others)))]
        joint = np.exp(joint - joint.max())
        out.append(float((joint.sum(axis=1) * np.arange(len(own))).sum() / joint.sum()))
    return out


@pytest.mark.parametrize("counts,p0", [([2, 3, 8, 40, 90, 200], [0.01, 0.05, 0.1, 0.2, 0.02, 0.3]), ([400, 5, 300], [0.3, 0.1, 0.05]),
                                       ([2] * 30, [0.03] * 30)])
def test_sweeps_reach_the_posterior(counts, p0):
    """Dishes of many sizes in one restaurant: mean tables within 5 % of the sums over all seatings."""
    copies, got, n = 1500, np.zeros(len(counts)), 12
    seat = lm_scoring.Seating(np.repeat(np.arange(copies), len(counts)), np.tile(counts, copies), np.tile(p0, copies), np.zeros(copies),
                              np.ones(copies), 0.8, 1.0, np.random.default_rng(5))
    seat.sweep(8)
    for _ in range(n):
        seat.sweep(2)
        got += seat.tables.reshape(copies, -1).mean(axis=0) / n
    assert got == pytest.approx(exact_restaurant(counts, p0, 0.8, 1.0), rel=0.05)
    assert (seat.total == seat.tables.reshape(copies, -1).sum(axis=1)).all()


def brute_scores(train, texts, settings, sweeps=400, skip=100, seed=1):
    """log10 probability of ``texts`` under the two-level model, customers seated one by one, tables
    of restaurants as customers of the parent, predictive probabilities averaged over sweeps."""
    draw, words = random.Random(seed), {w for t in train for w in [*t.split(), None]}
    base = 1 / (len(words) + 1)
    d, s, rd, rs = settings.discount, settings.strength, settings.root_discount, settings.root_strength
    root = defaultdict(list)
    rooms = defaultdict(lambda: defaultdict(list))

    def p_root(w):
        c, t = sum(root[w]), len(root[w])
        n, k = sum(sum(x) for x in root.values()), sum(len(x) for x in root.values())
        return (c - rd * t + (rs + rd * k) * base) / (rs + n)

    def sit(tables, new, discount):
        at = draw.choices(range(len(tables) + 1), [*(x - discount for x in tables), new])[0]
        tables.append(1) if at == len(tables) else tables.__setitem__(at, tables[at] + 1)
        return at == len(tables) - 1 and tables[at] == 1

    def leave(tables):
        at = draw.choices(range(len(tables)), tables)[0]
        tables[at] -= 1
        if not tables[at]:
            del tables[at]
            return True
        return False

    def sit_root(w):
        sit(root[w], (rs + rd * sum(len(x) for x in root.values())) * base, rd)

    def p(u, w):
        room = rooms[u]
        c, t, n, k = sum(room[w]), len(room[w]), sum(sum(x) for x in room.values()), sum(len(x) for x in room.values())
        return (c - d * t + (s + d * k) * p_root(w)) / (s + n)

    def put(u, w):
        if sit(rooms[u][w], (s + d * sum(len(x) for x in rooms[u].values())) * p_root(w), d):
            sit_root(w)
    pairs = [(a, b) for t in train for a, b in zip([None, *t.split()], [*t.split(), None])]
    for u, w in pairs:
        put(u, w)
    asked = {(a, b) for t in texts for a, b in zip([None, *t.split()], [*t.split(), None])}
    known, mean = set(words), Counter()
    for turn in range(sweeps):
        for u, w in pairs:
            if leave(rooms[u][w]):
                leave(root[w])
            put(u, w)
        if turn >= skip:
            for u, w in asked:
                v = w if w in known else "\0"
                mean[u, w] += (p(u, v) if u in known else p_root(v)) / (sweeps - skip)
    return [sum(math.log10(mean[a, b]) for a, b in zip([None, *t.split()], [*t.split(), None])) for t in texts]


def test_scores_of_a_tiny_corpus(spark):
    """Against the model sampled customer by customer: 0.02 (log10) a token on average, 0.12 for any text (the
    worst is the empty one, a single token whose mass is nearly all the parent's, which one run of sweeps holds still)."""
    draw = random.Random(9)
    vocabulary = [f"w{k}" for k in range(14)]
    chain = {w: draw.sample(vocabulary, 4) for w in vocabulary}

    def text():
        out = [draw.choice(vocabulary[:5])]
        while draw.random() < 0.85:
            out.append(draw.choices(chain[out[-1]], [8, 4, 2, 1])[0])
        return " ".join(out)
    train, held = [text() for _ in range(60)], [text() for _ in range(25)] + ["zz w1 zz", "", "w3 w3 w3 w3"]
    rows = [(i, t, i >= len(train)) for i, t in enumerate(train + held)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    settings = lm_scoring.Settings(samples=20, burn_in=20)
    got = {r.doc_id: r for r in lm_scoring.score_documents(df, held_out=df["held"], settings=settings).collect()}
    want = brute_scores(train, train + held, settings)
    off = [(got[i].score - want[i]) / got[i].n_tokens for i in range(len(rows))]
    assert max(map(abs, off)) < 0.12 and sum(map(abs, off)) / len(off) < 0.02
