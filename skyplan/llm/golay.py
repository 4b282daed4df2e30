"""Keys from the perfect binary Golay code [23, 12, 7].

Every 23-bit word is within 3 bits of exactly one codeword. `fuzzy` names all
codewords within 4 bits of a word: 1 of them if the word is within 2 bits of
its own codeword, else 6. Two words that differ in at most 2 bits share one
of these names, and the name of a word's own codeword is among the names of
each word that differs from it in at most 1 bit. Both facts are checked over
all cosets in the tests (the code is linear, so that covers all words).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, which generates the code.
GENERATOR = 0b101011100011
LENGTH, CHECKS = 23, 11
#: Most names of one word.
NAMES = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Syndromes of each byte of a word; per syndrome the error patterns that
    lead to codewords within 4 bits (the nearest first), and their number."""
    unit = [_remainder(1 << bit) for bit in range(LENGTH)]
    by_byte = []
    for low in (0, 8, 16):
        part = np.zeros(256, np.uint32)
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and low + bit < LENGTH:
                    part[value] ^= unit[low + bit]
        by_byte.append(part)
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            s = 0
            for bit in bits:
                s ^= unit[bit]
            found[s].append(sum(1 << bit for bit in bits))
    patterns = np.zeros((1 << CHECKS, NAMES), np.uint32)
    for s, errors in enumerate(found):
        patterns[s, : len(errors)] = errors
        patterns[s, len(errors) :] = errors[0]  # repeats of the nearest
    return by_byte, patterns, np.array([len(x) for x in found], np.uint8)


def fuzzy(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) twelve-bit codeword indices, and how many of them count; the
    first is that of the word's own codeword."""
    by_byte, patterns, number = _tables()
    w = words.astype(np.uint32)
    s = by_byte[0][w & 255] ^ by_byte[1][w >> 8 & 255] ^ by_byte[2][w >> 16]
    return (w[:, None] ^ patterns[s]) >> CHECKS, number[s]
