"""The perfect binary Golay code of length 23, for whole arrays of words.

Every 23-bit word is within three bits of exactly one of 4096 codewords. The
keys of a word are the codewords of the word itself and of its 23 neighbours at
one bit; there are one or six of them. Words two bits apart have a neighbour in
common, so words at most two bits apart share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from .shipping import ship

ship(__name__)

#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the code.
GENERATOR = 0b110001110101
CHECK_BITS = 11
LENGTH = 23


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


#: Check bits of each 12-bit message, and the error of up to three bits behind each syndrome.
CHECKS = np.array([_remainder(m << CHECK_BITS) for m in range(1 << 12)], dtype=np.int64)
ERRORS = np.zeros(1 << CHECK_BITS, dtype=np.int64)
for _weight in (1, 2, 3):
    for _bits in combinations(range(LENGTH), _weight):
        _error = sum(1 << b for b in _bits)
        ERRORS[_remainder(_error)] = _error
NEAR = np.array([0] + [1 << b for b in range(LENGTH)], dtype=np.int64)


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of each word's codeword."""
    syndrome = CHECKS[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))
    return (words ^ ERRORS[syndrome]) >> CHECK_BITS


def keys(words: np.ndarray) -> list[np.ndarray]:
    """The keys of each word, ascending."""
    found = np.sort(decode(words[:, None] ^ NEAR[None, :]), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return [row[new] for row, new in zip(found, first, strict=True)]
