"""Vectorised word and word-window hashes of whole columns of texts.

A word of up to LONG bytes is the sum of its eight-byte lanes, each mixed with its place,
mixed again with its length; a longer one is a BLAKE2b digest. Windows are hashed as trees of
words whose joins multiply and shift. Neither is linear modulo a power of two, so no pattern
of bytes or of words cancels out; two keys (``which``) give two hashes without relation.
"""

from __future__ import annotations

import hashlib

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd keys of the two hashes, for words and for joins.
KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
JOINS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Bytes of words that are hashed in lanes; longer ones take a digest.
LONG = 64
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of text that word hashes are computed over at once.
SPAN = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words of rows data[offsets[i]:offsets[i+1]], and the first word of each row (n + 1)."""
    a, b = int(offsets[0]), int(offsets[-1])
    blank = _SPACE[data[a:b]]
    edge = np.empty(len(blank), bool)
    if len(blank):
        edge[0] = True
        np.not_equal(blank[1:], blank[:-1], out=edge[1:])
        inner = offsets[1:-1] - a
        edge[inner[inner < len(blank)]] = True
    at = np.flatnonzero(edge)
    to = np.append(at[1:], len(blank))
    full = ~blank[at] if len(at) else np.zeros(0, bool)
    begin, end = at[full] + a, to[full] + a
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, fold: bool = False, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z folded if asked)."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    a, b = int(begin[0]), int(end[-1])
    cuts = np.unique(np.append(np.searchsorted(begin, np.arange(a, b, SPAN)), len(begin))).tolist()
    if len(cuts) > 2:  # in stretches, so that work arrays stay small
        return np.concatenate([word_hashes(data, begin[i:j], end[i:j], fold, which) for i, j in zip(cuts, cuts[1:], strict=False)])
    body = np.zeros(b - a + 8, np.uint8)
    body[:-8] = _LOWER[data[a:b]] if fold else data[a:b]
    lanes = np.ndarray((b - a + 1,), "<u8", body, strides=(1,))  # the eight bytes from each place on
    at, size, key = begin - a, end - begin, np.uint64(KEYS[which])
    out = mix((lanes[at] & _MASK[np.minimum(size, 8)]) ^ key)
    more = np.flatnonzero((size > 8) & (size <= LONG))
    if len(more):
        n = (size[more] + 7) // 8 - 1
        first = np.cumsum(n) - n
        lane = np.arange(int(n.sum())) - np.repeat(first, n) + 1
        left = np.repeat(size[more], n) - 8 * lane
        part = lanes[np.repeat(at[more], n) + 8 * lane] & _MASK[np.minimum(left, 8)]
        part = mix(part ^ (key * (2 * lane + 1).astype(np.uint64)))
        out[more] += np.add.reduceat(part, first)
    out += size.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    out = mix(out)
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(body[at[i] : at[i] + size[i]], digest_size=16).digest()[8 * which : 8 * which + 8], "little")
    return out


def _join(left: np.ndarray, right: np.ndarray, which: int) -> np.ndarray:
    out = left * np.uint64(JOINS[which])
    out += right
    out ^= out >> np.uint64(32)
    return out


def window_hashes(words_: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` words: out[i] covers words i to i + length - 1. By
    doubling: halves join pair by pair, so that log2(length) passes are enough."""
    n = len(words_) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done = None, 0  # hashes of runs of ``done`` words
    part, size, k = words_, 1, length  # hashes of runs of ``size`` words, a power of two
    while k:
        if k & 1:
            out = part if out is None else _join(out[:n], part[done : done + n], which)
            done += size
        k >>= 1
        if k:
            part = _join(part[:-size], part[size:], which)
            size *= 2
    return mix(out[:n])
