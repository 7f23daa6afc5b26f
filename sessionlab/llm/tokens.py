"""Word hashes of whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

PIECE = 1 << 19
_P = 0x9E3779B97F4A7C15
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# a random number for each byte, the same for A-Z and a-z
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([c]).lower(), 7) for c in range(256)], np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE, 1 << (n - 1).bit_length())
    if size not in _powers:
        out = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x))
        _powers.clear()
        _powers[size] = (out[0], out[1])
    return _powers[size]


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """uint64 hash of every word ``[^\\x20\\x09-\\x0D]+`` (A-Z lowered) of the texts in order, and
    the number of words of each text.

    A word's hash is a polynomial of its bytes, taken from running sums, so there is no
    Python step per word.  Texts are worked through in pieces cut at white space.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends_of_texts = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    hashes, starts = [], []
    at = 0
    while at < len(data):
        size = PIECE
        while True:
            piece = data[at:at + size]
            space = _IS_SPACE[piece]
            gaps = np.flatnonzero(space[-4096:]) if at + size < len(data) else None
            if gaps is None:
                break
            if len(gaps):
                cut = len(piece) - min(4096, len(piece)) + int(gaps[-1]) + 1
                piece, space = piece[:cut], space[:cut]
                break
            every = np.flatnonzero(space)
            if len(every):
                piece, space = piece[:every[-1] + 1], space[:every[-1] + 1]
                break
            size *= 2            # one word longer than the piece
        word = ~space
        first = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
        last = np.flatnonzero(word & np.concatenate([space[1:], [True]]))
        if len(first):
            power, inverse = _power_tables(len(piece))
            value = _BYTE[piece] * power[:len(piece)]
            total = np.cumsum(value)
            h = (total[last] - total[first] + value[first]) * inverse[first]
            hashes.append(mix(h ^ ((last - first + 1).astype(np.uint64) * np.uint64(_P))))
            starts.append(first + at)
        at += len(piece)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(raw), np.int64)
    where = np.searchsorted(np.concatenate(starts), np.concatenate([[0], ends_of_texts]))
    return np.concatenate(hashes), np.diff(where)
