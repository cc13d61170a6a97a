"""Prefix polynomial hashes and other array helpers that run inside tasks."""

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Longest string that is one polynomial; longer ones are chained from such pieces by a mixing step.
#: Long strings of two letters can be built whose polynomials modulo 2^64 agree for every odd base.
PIECE = 64
#: Two independent hashes: odd bases and values of the bytes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x):
    """Spread the bits of 64-bit integers (a bijection)."""
    x = np.array(x, dtype=np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_VALUES = [mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(s << 32)) for s in (0, 1)]


class _Powers:
    """Powers of the base and of its inverse mod 2^64, as far as texts needed them."""

    def __init__(self, base):
        self.base = base
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n):
        if len(self.up) < n:
            size = max(n, 1 << 20)
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in _BASES]


class PrefixHash:
    """Polynomial hash of any substring of a byte array (or code point array) in constant time."""

    def __init__(self, data, which=0):
        n = len(data)
        up, self._down = _POWERS[which].upto(n + 1)
        values = _VALUES[which][data] if data.dtype == np.uint8 else mix(data.astype(np.uint64) + np.uint64(1))
        values *= up[:n]
        self._prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=self._prefix[1:])

    def _polynomial(self, start, end):
        return (self._prefix[end] - self._prefix[start]) * self._down[start]

    def windows(self, length):
        """Raw hash of every substring of that length."""
        p, n = self._prefix, len(self._prefix) - length
        piece = min(length, PIECE)
        out = p[piece : piece + n] - p[:n]
        out *= self._down[:n]
        for done in range(PIECE, length, PIECE):
            upto = min(done + PIECE, length)
            out = mix(out) * _M1 + (p[upto : upto + n] - p[done : done + n]) * self._down[done : done + n]
        return out

    def raw(self, start, end):
        """Raw hash of [start, end); equal strings have equal hashes wherever they lie."""
        length = end - start
        if not np.size(length) or np.max(length) <= PIECE:
            return self._polynomial(start, end)
        out = self._polynomial(start, np.minimum(end, start + PIECE))
        more, done = np.flatnonzero(length > PIECE), PIECE
        while len(more):
            at = start[more] + done
            out[more] = mix(out[more]) * _M1 + self._polynomial(at, np.minimum(end[more], at + PIECE))
            done += PIECE
            more = more[length[more] > done]
        return out

    def of(self, start, end):
        """Mixed hash of [start, end), length included."""
        return mix(self.raw(start, end) + (end - start).astype(np.uint64) * _M2)


def utf8(column):
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets, size=1 << 20, each=0):
    """Cut documents into runs of about ``size`` bytes, ``each`` added per document (one longer document is a run by itself)."""
    n, first = len(offsets) - 1, 0
    offsets = offsets + np.arange(n + 1) * each
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def ranges(starts, lengths):
    """Concatenated aranges [start, start + length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def groups(*keys):
    """Order that puts equal keys together, first entries of the groups in it, group of each place."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for key in keys:
            k = key[order]
            new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1
