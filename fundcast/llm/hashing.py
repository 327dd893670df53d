"""Vectorised word and word-run hashes over Arrow string columns.

A text column's UTF-8 buffer is hashed as a whole: prefix sums of a polynomial
hash give every word's 64-bit hash without a Python loop over words. Equal
words have equal hashes everywhere; different words collide with probability
about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_TWO = np.uint64(2 * int(_P) % (1 << 64))
_CHUNK = 1 << 20

SPACE = np.ones(256, bool)  # what belongs to a word: all but space and \t..\r
SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)  # letters, digits and everything beyond ASCII
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = (_LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)  # of a byte, lower-cased


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_FORWARD, _BACKWARD = _powers(_P, _CHUNK + 1), _powers(_INVERSE, _CHUNK + 1)


def _utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if n else raw[:0], offsets - offsets[0]


def words(column: pa.Array, kind: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the hash of every word of every text in order, A-Z
    lower-cased, and the n + 1 positions at which the texts' words begin."""
    raw, offsets = _utf8(column)
    starts, ends, hashes = [], [], []
    # words never cross texts; chunks end at text boundaries where they can
    at = 0
    n = len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, "right")) - 1)
        s, e, h = _chunk(raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], kind)
        starts.append(s + offsets[at])
        ends.append(e)
        hashes.append(h)
        at = to
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    out = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return out, np.searchsorted(start, offsets, "left")


def _chunk(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = kind[raw]
    edge = inside[1:] & ~inside[:-1]  # a word begins at byte i
    stop = inside[:-1] & ~inside[1:]  # a word ends before byte i
    cut = offsets[1:-1]  # texts that touch without a break
    cut = cut[(cut > 0) & (cut < len(raw))]
    cut = cut[inside[cut] & inside[cut + 1]]
    edge[cut] = True
    stop[cut] = True
    s, e = np.flatnonzero(edge), np.flatnonzero(stop)
    value = _VALUE.take(raw)
    if len(raw) <= _CHUNK:
        forward, backward = _FORWARD, _BACKWARD
    else:  # one very long text
        forward, backward = _powers(_P, len(raw) + 1), _powers(_INVERSE, len(raw) + 1)
    value *= forward[: len(raw)]
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(value, out=sums[1:])
    return s, e, mix((sums[e] - sums[s]) * backward[s] + (e - s).astype(np.uint64))


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words (texts are not told apart)."""
    size = max(len(h) - n + 1, 0)
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = out * _P + h[k : k + size]
    return mix(out)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the runs of two that every element of ``a`` makes with that of ``b``."""
    return mix((_TWO + a) * _P + b)


class Filter:
    """Bit table over hashes: says quickly that a hash is not among the keys.
    Sized by the keys (16 bits each, 64 kbit at least), so it never outgrows them."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(16, int(np.ceil(np.log2(max(len(keys), 1) * 16))))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(keys)] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def positions(self, h: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[self._slot(h)])
