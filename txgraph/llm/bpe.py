"""Byte-level BPE ids of whole text batches, through the ``tokenizers`` library.

Byte-level BPE works on each piece of its pre-tokenising pattern by itself, so
a text's ids are its pieces' ids one after another.  The pieces of a chunk are
cut with numpy, each distinct piece is encoded once by the library's model, and its ids
are kept for later chunks of the worker (``CACHE`` pieces at most, then the memory
starts afresh; it changes speed only).  Texts that hold the string of an added
token are encoded whole.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from txgraph.llm.kernels import (LETTER, OTHER, SPACE, char_classes, decode_points, distinct,
                                 slice_hashes, text_chunks)

CACHE = 1_500_000
END = 0


class Table:
    """Hash table from non-zero 64-bit keys to row numbers, many keys at a time."""

    def __init__(self, bits: int = 16):
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros(1 << bits, np.int32)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it is not there."""
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(keys), -1, np.int32)
        todo, slot = np.arange(len(keys)), (keys & mask).astype(np.int64)
        want = keys
        while len(todo):
            got = self.keys[slot]
            hit = got == want
            out[todo[hit]] = self.rows[slot[hit]]
            on = np.flatnonzero(~hit & (got != 0))
            todo, want, slot = todo[on], want[on], (slot[on] + 1) & int(mask)
        return out

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Add distinct keys that are not there."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            old, old_rows = self.keys, self.rows
            self.__init__(int(4 * (self.n + len(keys))).bit_length())
            full = old != 0
            self.add(old[full], old_rows[full])
        mask = len(self.keys) - 1
        self.n += len(keys)
        slot = (keys & np.uint64(mask)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # of several keys for one slot the last stays
            mine = self.keys[slot] == keys
            self.rows[slot[mine]] = rows[mine]
            keys, rows, slot = keys[~mine], rows[~mine], (slot[~mine] + 1) & mask


@functools.cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level BPE: printable bytes as they are, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_starts(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First code points of the pieces of
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    k = char_classes()[cp]
    space = k == SPACE
    begin = np.zeros(n + 1, bool)
    begin[off[:-1]] = True
    prev_k = np.roll(k, 1)
    s = k != prev_k
    prev_blank = np.roll(cp, 1) == 32
    # a blank before a word, number or sign run belongs to it
    s &= ~(prev_blank & ~space)
    # the last white-space character before anything else starts a piece
    next_other = np.zeros(n, bool)
    next_other[:-1] = ~space[1:] & ~begin[1:n]
    s |= space & next_other
    s |= begin[:n]
    # an apostrophe that starts a piece takes s, t, m, d, re, ve, ll with it
    q = np.flatnonzero((cp == 39) & s)
    q = q[q + 1 < n]
    if len(q):
        q = q[~begin[q + 1]]
        one = np.isin(cp[q + 1], [ord(c) for c in "stmd"])
        q2 = q[~one]
        q2 = q2[q2 + 2 < n]
        q2 = q2[~begin[q2 + 2]]
        a, b = cp[q2 + 1], cp[q2 + 2]
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for p, w in ((q[one], 2), (q2[two], 3)):
            for j in range(1, w):
                s[p + j] = False
            after = (p + w)[p + w < n]
            s[after[k[after] == LETTER]] = True
    return np.flatnonzero(s)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        if type(self.tok.pre_tokenizer).__name__ != "ByteLevel" or self.tok.normalizer is not None:
            raise ValueError("a byte-level BPE tokenizer without normaliser is needed")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.vocab = self.tok.get_vocab_size()
        self._reset()

    def _reset(self) -> None:
        self.at = Table()
        self.flat = np.zeros(1 << 16, np.int32)  # 0 is the end id
        self.off = np.zeros(1 << 12, np.int64)
        self.len = np.ones(1 << 12, np.int64)
        self.rows, self.used = 1, 1  # row 0: the end id

    def _add(self, keys: np.ndarray, pieces: list[str]) -> None:
        tokenize, letters = self.tok.model.tokenize, byte_letters()
        ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lens.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(ids) > len(self.off):
            self.off = np.concatenate([self.off, np.zeros_like(self.off)])
            self.len = np.concatenate([self.len, np.zeros_like(self.len)])
        self.flat[self.used:self.used + total] = [x for one in ids for x in one]
        self.off[self.rows:self.rows + len(ids)] = self.used + np.cumsum(lens) - lens
        self.len[self.rows:self.rows + len(ids)] = lens
        self.at.add(keys, np.arange(self.rows, self.rows + len(ids), dtype=np.int32))
        self.used += total
        self.rows += len(ids)

    def chunk(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts, each with the end id, and the texts' offsets in them."""
        cp, coff, text = decode_points(data, off)
        if any(a in text for a in self.added):
            return self._whole(text, coff)
        start = piece_starts(cp, coff)
        end = np.append(start[1:], len(cp)) if len(start) else start
        h = slice_hashes(cp, start, end) | np.uint64(1)
        rows = self.at.find(h)
        new = np.flatnonzero(rows < 0)
        if len(new):
            idx, keys = distinct(h[new])
            if self.rows + len(keys) > CACHE:
                self._reset()
                return self.chunk(data, off) if len(keys) < CACHE // 2 else self._whole(text, coff)
            # idx numbers the keys in order of first occurrence, so its running maximum grows there
            at = new[np.diff(np.maximum.accumulate(idx), prepend=-1) > 0]
            self._add(keys, [text[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            rows[new] = self.at.find(h[new])
        row = np.insert(rows, np.searchsorted(start, coff[1:], "left"), 0)
        lens = self.len[row]
        cum = np.zeros(len(row) + 1, np.int64)
        np.cumsum(lens, out=cum[1:])
        ids = self.flat[np.repeat(self.off[row] - cum[:-1], lens) + np.arange(cum[-1])]
        ends = np.searchsorted(start, coff[1:], "left") + np.arange(1, len(coff))
        return ids, np.concatenate([[0], cum[ends]])

    def _whole(self, text: str, coff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.array([*self.tok.encode(text[a:b], add_special_tokens=False).ids, END], np.int32)
                 for a, b in zip(coff[:-1].tolist(), coff[1:].tolist())]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def batches(self, col: pa.Array):
        """``lo, hi, ids, offsets`` for the rows ``lo:hi`` of a string column."""
        for lo, hi, data, off in text_chunks(col):
            yield (lo, hi, *self.chunk(data, off))


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)
