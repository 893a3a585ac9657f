"""Vectorised text kernels used inside Arrow batches: slicing, hashing and tokenising with numpy."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _INV)):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def slice_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice ``codes[start:end]``; equal slices have equal hashes.

    One polynomial prefix sum modulo 2**64 serves all slices; the odd base is
    invertible, so a slice's value does not depend on where it lies.
    """
    n = len(codes)
    p, inv = _pow(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * p[:n], out=s[1:])
    h = (s[end] - s[start]) * inv[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_chunks(col: pa.Array, target: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` of a string column with their bytes and byte offsets (``hi - lo + 1``), null as empty.

    A chunk holds whole texts and about ``target`` bytes; a longer text is a chunk of its own.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64, n + 1, col.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + target, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def space_tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    n = len(data)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = word.copy()
    first[1:] &= ~word[:-1]
    cutpos = off[:-1][off[:-1] < n]
    first[cutpos] = word[cutpos]
    start = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    tail = off[1:][off[1:] > 0] - 1
    last[tail] = word[tail]
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(off, start, "right") - 1
    return start, end, row


def decode_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, str]:
    """Code points of a chunk, the texts' offsets in them, and the chunk as a string."""
    text = data.tobytes().decode("utf-8")
    if len(text) == len(data):
        return data.astype(np.uint32), off, text
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return cp, lead[off], text


SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    k = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        g = unicodedata.category(chr(c))[0]
        if g == "L":
            k[c] = LETTER
        elif g == "N":
            k[c] = NUMBER
    # code points with the White_Space property (fixed values)
    space = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
             0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    k[space] = SPACE
    return k


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each value among the distinct ones, and the distinct values in order of first occurrence."""
    d = pa.array(h).dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_numpy(zero_copy_only=False)


def ascii_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased bytes."""
    n = len(data)
    word = (data >= 0x80) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    first = word.copy()
    first[1:] &= ~word[:-1]
    head = off[:-1][off[:-1] < n]
    first[head] = word[head]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tail = off[1:][off[1:] > 0] - 1
    last[tail] = word[tail]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, "right") - 1


def shingles(data: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of each run of ``size`` words, word hashes, and the texts' offsets in them.

    A text of fewer words, but not none, has one shingle of them all.
    """
    data = lower_ascii(data)
    start, end, row = ascii_words(data, off)
    h = slice_hashes(data, start, end)
    n = len(off) - 1
    per = np.bincount(row, minlength=n)
    woff = np.concatenate([[0], np.cumsum(per)])
    runs = np.maximum(per - size + 1, (per > 0).astype(np.int64))
    srow = np.repeat(np.arange(n), runs)
    a = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + woff[srow]
    z = np.minimum(a + size, woff[srow + 1])
    return slice_hashes(h, a, z), srow, h, woff


def occurrences(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of each (value, how often it came before in its row): a multiset as a set."""
    idx, keys = distinct(h ^ mix64(row.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)))
    count = np.bincount(idx, minlength=len(keys))
    nth = np.zeros(len(h), np.uint64)
    again = np.flatnonzero(count[idx] > 1)
    if len(again):
        order = again[np.argsort(idx[again], kind="stable")]
        head = np.flatnonzero(np.diff(idx[order], prepend=-1))
        nth[order] = (np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))).astype(np.uint64)
    return mix64(h + nth * np.uint64(0xA0761D6478BD642F))
