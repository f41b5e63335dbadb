"""Words and shingles of many texts at once, as NumPy arrays over the texts' UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: True for bytes of words: all but space and the control characters 9 to 13.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False

_R = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_C = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = -(-n >> 18) << 18
        inverse = pow(_R, -1, 1 << 64)
        steps = np.full(size, _R, np.uint64)
        steps[0] = 1
        back = np.full(size, inverse, np.uint64)
        back[0] = 1
        _powers, _inverses = np.cumprod(steps), np.cumprod(back)
    return _powers[:n], _inverses[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTES):
    """(starts, ends, rows) of all words of the texts ``data[offsets[i]:offsets[i+1]]``."""
    base = int(offsets[0])
    data, offsets = data[base : int(offsets[-1])], offsets - base
    member = inside[data]
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = member[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = member[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts + base, ends + base, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base, stop = int(starts[0]), int(ends[-1])
    power, inverse = _tables(stop - base + 1)
    prefix = np.zeros(stop - base + 1, np.uint64)
    np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * power[:-1], out=prefix[1:])
    return mix((prefix[ends - base] - prefix[starts - base]) * inverse[starts - base])


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, short: bool = True):
    """(hash, row) of every run of ``n`` words of one text.

    With ``short`` a text of 1 to n - 1 words has one shingle: all its words.
    """
    found, at = [], []
    total = len(hashes)
    if total >= n:
        value = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            value = value * _C + hashes[k : total - n + 1 + k]
        same = rows[n - 1 :] == rows[: total - n + 1]
        found.append(mix(value[same]))
        at.append(rows[: total - n + 1][same])
    if short and total:
        ids, firsts, counts = np.unique(rows, return_index=True, return_counts=True)
        for k in range(1, n):
            few = counts == k
            if few.any():
                value = np.full(int(few.sum()), k, np.uint64)
                for j in range(k):
                    value = value * _C + hashes[firsts[few] + j]
                found.append(mix(value))
                at.append(ids[few])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(at)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of every text."""
    starts, ends, rows = word_spans(data, offsets)
    values, at = shingles(word_hashes(data, starts, ends), rows, n)
    order = np.argsort(at, kind="stable")
    values, at = values[order], at[order]
    bounds = np.searchsorted(at, np.arange(len(offsets)))
    return [np.unique(values[a:b]) if b > a else values[:0] for a, b in zip(bounds[:-1], bounds[1:])]
