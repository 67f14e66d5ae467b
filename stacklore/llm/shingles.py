"""Hashed word-shingle sets of whole texts, vectorised over bytes."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_U = np.uint64
_POWER = _U(0x9E3779B97F4A7C13)  # 3 mod 8: powers differ in high bits
_INVERSE = _U(pow(int(_POWER), -1, 1 << 64))


def _byte_values() -> np.ndarray:
    """A random number per byte; A-Z have those of a-z."""
    values = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_IS_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_FACTORS = np.random.default_rng(6).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the base and its inverse, grown as longer texts come."""

    def __init__(self):
        self.up = np.ones(1, _U)
        self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, base)])) for base in (_POWER, _INVERSE)
            )
        return self.up[:n], self.down[:n]


def word_hashes(text: str | None, powers: Powers) -> np.ndarray:
    """A hash per word `[^\\x20\\x09-\\x0D]+`, with A-Z lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, _U)
    up, down = powers.upto(len(data))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_VALUES[data] * up)])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def shingle_set(text: str | None, powers: Powers) -> np.ndarray:
    """Sorted distinct hashes of 5-word shingles; of the whole sequence for fewer words; else empty."""
    words = word_hashes(text, powers)
    if not len(words):
        return words
    if len(words) < SHINGLE:
        whole = np.array([len(words)], _U)
        for i in range(len(words)):
            whole = mixed(whole * _FACTORS[i] + words[i:i + 1])
        return whole
    n = len(words) - SHINGLE + 1
    total = words[:n] * _FACTORS[0]
    for k in range(1, SHINGLE):
        total += words[k:n + k] * _FACTORS[k]
    return np.unique(mixed(total))
