"""The perfect binary Golay code of 23 bits as a hash that tolerates a flipped bit.

Every 23-bit word lies within three bits of exactly one of the 4,096 codewords.
The index of that codeword is the word's key. A word next to it, one bit away,
may decode to another codeword, so a probe takes the keys of the word and of all
its one-bit neighbours: one key when the word lies within two bits of its
codeword, up to six when it lies three bits away.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
# Generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each single bit, and the nearest error pattern of each remainder."""
    bits = [_remainder(1 << b) for b in range(LENGTH)]
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in (1, 2, 3):
        for chosen in combinations(range(LENGTH), weight):
            remainder, pattern = 0, 0
            for b in chosen:
                remainder ^= bits[b]
                pattern |= 1 << b
            errors[remainder] = pattern
    return np.array(bits, dtype=np.int64), errors


def remainders(words: np.ndarray) -> np.ndarray:
    bits, _ = _tables()
    out = np.zeros(len(words), dtype=np.int64)
    for b in range(LENGTH):
        out ^= np.where(words >> b & 1, bits[b], 0)
    return out


def nearest_key(words: np.ndarray) -> np.ndarray:
    """Index of the codeword next to each word: its twelve information bits."""
    _, errors = _tables()
    return (words ^ errors[remainders(words)]) >> CHECK_BITS


def probe_keys(words: np.ndarray, width: int) -> np.ndarray:
    """Keys of each word and of its neighbours in the lowest ``width`` bits, one row a word.

    A key that a row has already is replaced by -1.
    """
    bits, errors = _tables()
    own = remainders(words)
    keys = np.empty((len(words), width + 1), dtype=np.int64)
    keys[:, 0] = (words ^ errors[own]) >> CHECK_BITS
    for b in range(width):
        keys[:, b + 1] = (words ^ (1 << b) ^ errors[own ^ bits[b]]) >> CHECK_BITS
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys
