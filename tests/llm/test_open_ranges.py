"""Open ranges cut out of a chunk tell what the whole chunk tells at their positions."""

import numpy as np

from sessionlab.llm.chunks import _planes, pack
from sessionlab.llm.substring_dedup import Part, SHINGLE, Text, _content, _laid


def test_parts_tell_what_texts_tell():
    rnd = np.random.default_rng(5)
    words, sizes = rnd.integers(0, 40, 900), np.array([400, 1, 7, 300, 192])
    vocab, numbers = np.unique(words.astype(np.uint64) * np.uint64(977), return_inverse=True)
    text = Text(pack(vocab, _planes(numbers), sizes.astype(np.uint32)), [11, None, 13, 14, 15])
    lo = np.array([0, 60, 408, 650, 708, 800])
    hi = np.array([10, 394, 600, 702, 708, 899 - SHINGLE])
    whole = Text(pack(vocab, _planes(numbers), sizes.astype(np.uint32)), [11, None, 13, 14, 15])
    assert (text.spans(lo, hi) == whole.shingle[_laid(lo, hi)]).all() and "shingle" not in text.__dict__
    part = Part(_content(text, lo, hi))
    at = _laid(lo, hi)
    assert (part.doc(at) == whole.doc(at)).all()
    assert all(part.begin(d) == whole.begin(d) and part.id(d) == whole.id(d) for d in np.unique(whole.doc(lo)))
    for x, y in [(0, 0), (3, 10), (60, 394), (100, 146), (708, 708), (850, 894)]:
        assert (part.run(x, y) == whole.run(x, y)).all()
    # parts of parts
    small = Part(_content(part, np.array([5, 70, 660]), np.array([9, 90, 702])))
    again = _laid(np.array([5, 70, 660]), np.array([9, 90, 702]))
    assert (small.shingle == whole.shingle[again]).all() and (small.doc(again) == whole.doc(again)).all()
