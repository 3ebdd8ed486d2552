"""Word shingles of many texts at once, as sorted arrays of 64-bit hashes.

Words are runs of ``[^\\x20\\x09-\\x0D]``. A text with fewer words than a shingle has one
shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from functools import cache

import numpy as np

WORDS = 5
PORTION_CHARS = 1 << 19

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _A
        h = (h ^ (h >> np.uint64(27))) * _B
        return h ^ (h >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_P), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _P, np.uint64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
    return up, down


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and the number of words of each text."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join([b"", *coded, b""]), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = (p[:len(data)] for p in _powers(1 << max(1, (len(data) - 1)).bit_length()))
    with np.errstate(over="ignore"):
        summed = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)
        hashes = mix((summed[ends - 1] - summed[begins - 1]) * down[begins])
    stops = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1) + 1
    counts = np.diff(np.searchsorted(begins, stops), prepend=0)
    return hashes, counts


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The set of shingles of each text, sorted."""
    hashes, counts = word_hashes(texts)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for k in range(words):
            rolled = rolled * _Q + hashes[k:k + len(rolled)]
        rolled = mix(rolled)
        at = 0
        for n in counts.tolist():
            if n >= words:
                out.append(np.unique(rolled[at:at + n - words + 1]))
            else:
                one = np.uint64(n)
                for h in hashes[at:at + n]:
                    one = one * _Q + h
                out.append(mix(np.array([one])) if n else np.zeros(0, np.uint64))
            at += n
    return out


def set_keys(sets: list[np.ndarray]) -> list[bytes]:
    """16 bytes that equal sets share."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    out = np.zeros((len(sets), 2), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        begins = (np.cumsum(sizes) - sizes)[full]
        with np.errstate(over="ignore"):
            out[full, 0] = np.add.reduceat(mix(flat + _P), begins)
            out[full, 1] = np.add.reduceat(mix(flat ^ _Q), begins)
    return [row.tobytes() for row in out]


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per text and band, from ``rows`` MinHash values each; sets must not be empty."""
    if not sets:
        return np.zeros((0, bands), np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, begins = np.concatenate(sets), np.cumsum(sizes) - sizes
    rng = np.random.default_rng(20240101)
    factors = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    out = np.zeros((len(sets), bands), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(bands * rows):
            least = np.minimum.reduceat((flat ^ masks[k]) * factors[k], begins)
            out[:, k // rows] = out[:, k // rows] * _Q + mix(least)
        return mix(out + np.arange(bands, dtype=np.uint64) * _P)
