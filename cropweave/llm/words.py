"""Words of many texts at once, as places and 64-bit hashes in numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
FACTOR = 0x9E3779B97F4A7C15
_UNIT = np.uint64(1)


@lru_cache(1)
def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte belongs to a word, and a random number for each byte, equal for both cases."""
    byte = np.arange(256)
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    inside = (byte >= 128) | ((lower >= 97) & (lower <= 122)) | ((byte >= 48) & (byte <= 57))
    return inside, np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)[lower]


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR and its inverse modulo 2^64, to the powers 0 to n."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 22)
        for k, base in enumerate((FACTOR, pow(FACTOR, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the words of all rows in order: row, first byte, end byte and hash."""
    inside, numbers = byte_classes()
    word = inside[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    fresh = offsets[:-1][offsets[:-1] < len(data)]
    begin[fresh] |= word[fresh]
    starts = np.flatnonzero(begin)
    last = word.copy()
    last[:-1] &= ~word[1:]
    closing = offsets[1:][offsets[1:] > 0] - 1
    last[closing] |= word[closing]
    ends = np.flatnonzero(last) + 1
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[data] * up[: len(data)], dtype=np.uint64)])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends, hashes


def windows_hashed(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes; len - size + 1 of them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(FACTOR) + hashes[k : k + n]
    return mixed(out)
