"""The perfect binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit words.

Every word lies within 3 bits of exactly one codeword.  A word at exactly 3 bits also has five
codewords at 4 bits.  From that follows:

* of two words that differ in one bit, each one's nearest codeword is among the six of the other;
* two words that differ in two bits have one of their six codewords in common.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, CHECKS = 23, 11
GENERATOR = 0b101011100011
"""x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, which divides x^23 + 1."""


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each word by the generator: zero for codewords."""
    rest = words.astype(np.uint32)
    for bit in range(BITS - 1, CHECKS - 1, -1):
        rest = rest ^ (((rest >> np.uint32(bit)) & np.uint32(1)) * np.uint32(GENERATOR << (bit - CHECKS)))
    return rest


@cache
def flips() -> np.ndarray:
    """For each syndrome, six patterns that lead to codewords; the first to the nearest.

    Where there are no codewords at 4 bits, the first pattern is repeated.
    """
    near = np.zeros(1 << CHECKS, dtype=np.uint32)
    beyond: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(BITS), weight)], dtype=np.uint32)
        found = syndrome(patterns)
        if weight <= 3:
            near[found] = patterns
        else:
            for s, p in zip(found.tolist(), patterns.tolist(), strict=True):
                beyond[s].append(p)
    return np.array([[n, *(b if len(b) == 5 else [n] * 5)] for n, b in zip(near.tolist(), beyond, strict=True)], dtype=np.uint32)


def indices(words: np.ndarray) -> np.ndarray:
    """The 12-bit indices of six codewords of each word, the nearest first."""
    words = words.astype(np.uint32)
    return (words[:, None] ^ flips()[syndrome(words)]) >> np.uint32(CHECKS)
