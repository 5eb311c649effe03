"""Word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 62, size=256, dtype=np.uint64)
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                  0xE7037ED1A0B428DB], dtype=np.uint64)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word: a run of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased."""
    data = np.frombuffer(raw.lower(), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    up, down = _power_tables(len(data))
    # hash of a word: its part of a polynomial over the text, shifted back to power 0
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    return mix((total[end] - total[start]) * down[start])


def shingles(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Hash of every run of ``width`` words in text order; a text with fewer words is one shingle."""
    w = word_hashes(raw)
    if not len(w):
        return w
    width_here = min(width, len(w))
    n = len(w) - width_here + 1
    out = np.full(n, width_here, dtype=np.uint64)
    for j in range(width_here):
        out = mix(out * _STEP[j % len(_STEP)] + w[j:j + n])
    return out
