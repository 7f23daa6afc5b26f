"""Near-equal passages that the other text has in another order are found one by one."""

import numpy as np

from sessionlab.llm.substring_dedup import SHINGLE, compare, shingles


def sequence(words):
    return shingles(np.array(words, np.uint64))[:len(words) - SHINGLE + 1]


def edited(words):
    return [*words[:len(words) // 2], 7, *words[len(words) // 2 + 1:]]


def test_swapped_passages():
    rnd = np.random.default_rng(5)
    for n, m in ((60, 90), (75, 75), (90, 64)):
        p, q, r = (rnd.integers(1 << 40, 1 << 60, k).tolist() for k in (n, m, 80))
        for mine, theirs in (((p, q), (q, p)), ((p, q, r), (r, q, p)), ((p, q, r), (q, r, p))):
            a, b = sequence(sum(mine, [])), sequence(sum(map(edited, theirs), []))
            found = list(compare(a, b, 51 - SHINGLE + 1, 0.8))
            at = 0
            for x in mine:
                assert any(lo <= at + SHINGLE and hi >= at + len(x) - 2 * SHINGLE and j >= 0.8 for lo, hi, _, _, j in found)
                at += len(x)


def test_nothing_of_before_is_lost():
    """A long run whose ends the other side has elsewhere, and text without any likeness."""
    rnd = np.random.default_rng(6)
    p, q, r = (rnd.integers(1 << 40, 1 << 60, k).tolist() for k in (120, 20, 20))
    a, b = sequence(q + p + r), sequence(r + [3] * 300 + p + [4] * 300 + q)
    assert any(lo <= 20 + SHINGLE and hi >= 120 for lo, hi, *_ in compare(a, b, 47, 0.8))
    assert not list(compare(sequence(p), sequence(rnd.integers(1 << 40, 1 << 60, 200).tolist()), 47, 0.8))
