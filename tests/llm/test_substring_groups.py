"""Passages around a sentence that many texts share: copies are found though their keys lie in it."""

import numpy as np
import pytest

from sessionlab.llm.substring_dedup import SHINGLE, rare_keys, similar_passages

LENGTH = 51 - SHINGLE + 1
SHARE = 1.6 / 1.8


def word_list(rnd, n):
    return [f"w{x:x}" for x in rnd.integers(1 << 40, 1 << 60, n)]


def grouped(template, passage, edit, pairs=200, seed=3):
    """Two documents for each pair: the template within a passage of their own, and other text around."""
    rnd = np.random.default_rng(seed)
    common, docs = word_list(rnd, template), []
    for k in range(pairs):
        before = int(rnd.integers(0, passage - template + 1))
        whole = word_list(rnd, before) + common + word_list(rnd, passage - template - before)
        for copy in (0, 1):
            words = list(whole)
            if copy and edit:
                own = [i for i in range(passage) if not before <= i < before + template]
                words[own[int(rnd.integers(0, len(own)))]] = "changed"
            docs.append((2 * k + copy, " ".join(word_list(rnd, int(rnd.integers(5, 40))) + words + word_list(rnd, int(rnd.integers(5, 40))))))
    return docs


def found_pairs(spark, docs):
    rows = similar_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    return {(min(r.a_id, r.b_id), max(r.a_id, r.b_id)) for r in rows}


@pytest.mark.parametrize("template,passage", [(45, 55), (30, 60)])
def test_exact_copies_around_a_template(spark, template, passage):
    found = found_pairs(spark, grouped(template, passage, False))
    assert {(2 * k, 2 * k + 1) for k in range(200)} <= found


def test_near_copies_around_a_template(spark):
    """One word of the own part is another: 61 shingles, at least 56 of them shared."""
    found = found_pairs(spark, grouped(40, 65, True))
    assert sum((2 * k, 2 * k + 1) in found for k in range(200)) >= 180


def test_rare_keys_miss_no_near_equal_windows():
    """Every two windows of two ranges that share enough shingles share a key, in each round."""
    rnd = np.random.default_rng(8)
    base = rnd.integers(1, 1 << 60, 80).astype(np.uint64)
    for agree in (1, 2, 3):
        for trial in range(20):
            other = base.copy()
            other[rnd.integers(0, 80, int(rnd.integers(0, 6)))] = rnd.integers(1 << 60, 1 << 61, 1).astype(np.uint64)
            far = rnd.integers(1 << 61, 1 << 62, 60).astype(np.uint64)
            h = np.concatenate([base, other, far])
            kinds, which, n = np.unique(h, return_inverse=True, return_counts=True)
            n = np.maximum(n, rnd.integers(1, 9, len(kinds)) * (n > 1))[which]
            lo, hi = np.array([0, 100, 300]), np.array([79, 179, 359])
            key, place, left, right = rare_keys(h, n, lo, hi, LENGTH, SHARE, agree)
            assert not (place >= 300).any() and (left <= place).all()
            need = int(np.ceil(LENGTH * SHARE))
            alike = [s for s in range(80 - LENGTH + 1)
                     if len(np.intersect1d(base[s:s + LENGTH], other[s:s + LENGTH])) >= need]
            mine, theirs = set(key[place < 80].tolist()), set(key[(place >= 100) & (place < 180)].tolist())
            assert bool(mine & theirs) >= bool(alike)


def test_template_alone_is_no_passage(spark):
    rnd = np.random.default_rng(4)
    common = word_list(rnd, 45)
    docs = [(k, " ".join(word_list(rnd, 60) + common + word_list(rnd, 60))) for k in range(60)]
    assert found_pairs(spark, docs) == set()
