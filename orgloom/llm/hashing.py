"""64-bit hashes of word sequences in numpy, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
FACTOR = _U(0x9E3779B97F4A7C15)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_S30, _S27, _S31 = _U(30), _U(27), _U(31)
#: Entries that a task's table of word hashes may hold before it is started anew, and the longest word in it.
WORDS = 400_000
LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x + FACTOR
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


class WordHashes:
    """Hashes of words, remembered while there are not too many."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen, of = self.seen, xxhash.xxh3_64_intdigest
        if len(seen) > WORDS:
            seen.clear()
        out = []
        for word in words:
            h = seen.get(word)
            if h is None:
                h = of(word)
                if len(word) <= LONG:
                    seen[word] = h
            out.append(h)
        return np.array(out, np.uint64)


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` consecutive words, in order."""
    n = len(hashes) - length + 1
    if n <= 0:
        return hashes[:0]
    out = hashes[:n].copy()
    for i in range(1, length):
        out = out * _M1 + hashes[i : i + n]
    return mix(out + _U(length))


def rolling_hashes(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Like ``sequence_hashes`` in time that doesn't depend on the length.

    A polynomial over the integers modulo 2**64 with an odd base, from prefix sums.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return hashes[:0]
    base = _U(mix_int(seed) | 1)
    inverse = _U(pow(int(base), -1, 1 << 64))
    steps = np.full(len(hashes), base, np.uint64)
    steps[0] = 1
    powers = np.multiply.accumulate(steps)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ _U(mix_int(seed + 1))) * powers, dtype=np.uint64)])
    steps[1:] = inverse
    back = np.multiply.accumulate(steps[:n])
    return (sums[length:] - sums[:-length]) * back


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
