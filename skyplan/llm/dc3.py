"""Suffix arrays by the difference cover modulo 3, in numpy.

Positions not divisible by 3 are the sample: their triples are sorted and
named, and if two names are equal, the string of names is sorted by recursion.
The remaining suffixes are sorted by their first symbol and the rank of the
sampled suffix behind it, and the two orders are merged by ranks alone.
"""

from __future__ import annotations

import numpy as np

#: Names and ranks of three must fit one 64-bit key.
MAX_SYMBOLS = 1 << 20


def suffix_array(text: np.ndarray) -> np.ndarray:
    """text: positive integers, at most MAX_SYMBOLS of them and none above
    MAX_SYMBOLS. A suffix that is a prefix of another comes first."""
    n = len(text)
    if n > MAX_SYMBOLS or n and int(text.max()) > MAX_SYMBOLS:
        raise ValueError(f"at most {MAX_SYMBOLS} symbols and values")
    return _sort(text.astype(np.int64))


def _sort(text: np.ndarray) -> np.ndarray:
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.zeros(n + 5, np.int64)
    t[:n] = text
    extra = n % 3 == 1  # the place behind the end ends the first half of the names
    n_zeros, n_ones, n_twos = (n + 2) // 3, (n + 1) // 3 + extra, n // 3
    base = int(text.max()) + 1

    def symbols(first: int, number: int) -> np.ndarray:
        return t[first::3][:number]

    def pairs(first: int, number: int) -> np.ndarray:
        return symbols(first, number) * base + symbols(first + 1, number)

    order = _named(np.concatenate((pairs(1, n_ones) * base + symbols(3, n_ones), pairs(2, n_twos) * base + symbols(4, n_twos))))
    wide = len(order) + 1
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, wide)
    ones, twos = np.zeros(n_zeros + 1, np.int64), np.zeros(n_zeros + 1, np.int64)  # ranks; 0 behind the end
    ones[:n_ones], twos[:n_twos] = rank[:n_ones], rank[n_ones:]
    order = order[int(extra) :]  # that place is the least
    second = order >= n_ones
    is_one, is_two = order[~second], order[second] - n_ones

    key = symbols(0, n_zeros) * wide + ones[:n_zeros]  # all different
    by_key = np.argsort(key)
    before = np.arange(n_zeros)
    before += np.searchsorted((symbols(1, n_ones) * wide + twos[:n_ones]).take(is_one), key.take(by_key))
    before += np.searchsorted((pairs(2, n_twos) * wide + ones[1:][:n_twos]).take(is_two), (pairs(0, n_zeros) * wide + twos[:n_zeros]).take(by_key))
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[before] = False
    out[before] = 3 * by_key
    out[free] = 3 * order + 1 - second * (3 * n_ones - 1)
    return out


def _named(triples: np.ndarray) -> np.ndarray:
    """The order of the sampled suffixes, by the names of their triples."""
    order = np.argsort(triples)
    sorted_ = triples.take(order)
    new = sorted_[1:] != sorted_[:-1]
    if new.all():
        return order
    names = np.empty(len(triples), np.int64)
    names[order] = np.concatenate(([1], np.cumsum(new) + 1))
    return _sort(names)
