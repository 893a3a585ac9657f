"""Elias-Fano sequences as flat numpy arrays, queried many values at a time."""

from __future__ import annotations

import numpy as np

_SELECT = np.full((256, 8), 8, np.uint8)  # place of the k-th set bit of a byte
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _k] = _p
_SPAN = 8  # words of 64 bits between directory entries


class EliasFano:
    """A non-decreasing sequence of unsigned integers.

    The low ``l`` bits of each value are packed; the high parts are a unary bit
    vector with a directory of the set and clear bits before every 512 bits.  ``arrays``
    is all state, so a sequence can live in a memory-mapped file.
    """

    NAMES = ("meta", "low", "high", "ones", "zeros")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.n, self.l, self.top = (int(x) for x in arrays["meta"])
        self.low, self.high = arrays["low"], arrays["high"]
        self.ones, self.zeros = arrays["ones"], arrays["zeros"]

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        l = min(56, max(0, (last // max(n, 1)).bit_length() - 1))
        hi = (values >> np.uint64(l)).astype(np.int64)
        top = last >> l
        n_bits = n + top + 1
        words = -(-n_bits // (64 * _SPAN)) * _SPAN
        bits = np.ones(words * 64, np.uint8)  # the padding counts as set
        bits[:n_bits] = 0
        bits[hi + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        per = np.bitwise_count(high).reshape(-1, _SPAN).sum(1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(per)])
        zeros = np.arange(len(ones)) * (64 * _SPAN) - ones
        low = np.zeros(8, np.uint8)
        if l:
            out = []
            for a in range(0, n, 1 << 18):  # in slices, as the bits stand as bytes for a moment
                v = values[a:a + (1 << 18)]
                out.append(((v[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(-1))
            low = np.concatenate([np.packbits(np.concatenate(out or [np.zeros(0, np.uint8)]), bitorder="little"), low])
        return cls({"meta": np.array([n, l, top], np.int64), "low": low, "high": high, "ones": ones, "zeros": zeros})

    def _select(self, k: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        block = np.searchsorted(directory, k, "right") - 1
        rest = k - directory[block]
        word = block * _SPAN
        moving = np.ones(len(k), bool)
        for _ in range(_SPAN - 1):
            w = self.high[word]
            c = np.bitwise_count(~w if flip else w).astype(np.int64)
            moving &= rest >= c
            rest -= np.where(moving, c, 0)
            word += moving
        x = self.high[word]
        if flip:
            x = ~x
        shift = np.zeros(len(k), np.uint64)
        for width in (32, 16, 8):
            part = (x >> shift) & np.uint64((1 << width) - 1)
            c = np.bitwise_count(part).astype(np.int64)
            over = rest >= c
            rest -= np.where(over, c, 0)
            shift += np.where(over, np.uint64(width), np.uint64(0))
        byte = ((x >> shift) & np.uint64(255)).astype(np.int64)
        return word * 64 + shift.astype(np.int64) + _SELECT[byte, rest]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        at = i * self.l
        view = np.ndarray((len(self.low) - 7,), "<u8", self.low, 0, (1,))
        return (view[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at ``i``."""
        i = np.asarray(i, np.int64)
        hi = self._select(i, self.ones, False) - i
        return (hi.astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def successor(self, keys: np.ndarray) -> np.ndarray:
        """Index of the first value that is not less than each key (``n`` if there is none)."""
        keys = np.asarray(keys, np.uint64)
        if not self.n:
            return np.zeros(len(keys), np.int64)
        h = np.minimum(keys >> np.uint64(self.l), np.uint64(self.top + 1)).astype(np.int64)
        beyond = h > self.top
        h = np.where(beyond, self.top, h)
        end = self._select(h, self.zeros, True) - h
        start = np.zeros(len(h), np.int64)
        m = np.flatnonzero(h > 0)
        start[m] = self._select(h[m] - 1, self.zeros, True) - (h[m] - 1)
        if self.l:
            want = keys & np.uint64((1 << self.l) - 1)
            lo, hi = start, end.copy()
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                less = self._low(mid) < want[open_]
                lo[open_] = np.where(less, mid + 1, lo[open_])
                hi[open_] = np.where(less, hi[open_], mid)
            start = lo
        return np.where(beyond, self.n, start)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it is not in the sequence (the first of equal values)."""
        keys = np.asarray(keys, np.uint64)
        i = self.successor(keys)
        out = np.full(len(keys), -1, np.int64)
        m = np.flatnonzero(i < self.n)
        m = m[self.get(i[m]) == keys[m]]
        out[m] = i[m]
        return out
