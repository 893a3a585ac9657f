import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from txgraph.llm import bpe
from txgraph.llm.elias_fano import EliasFano
from txgraph.llm.kernels import distinct, shingles, slice_hashes, text_chunks
from txgraph.llm.packing import CAPACITY, best_fit, lower_bound, solve
from txgraph.llm.token_files import decode_values, encode_values


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 63), max_size=300), st.lists(st.integers(0, 2 ** 64 - 1), max_size=50))
def test_elias_fano(values, keys):
    v = np.sort(np.array(values, np.uint64))
    e = EliasFano.build(v)
    if len(v):
        assert (e.get(np.arange(len(v))) == v).all()
    q = np.concatenate([v, np.array(keys, np.uint64)])
    assert (e.successor(q) == np.searchsorted(v, q)).all()
    assert [int(x) >= 0 for x in e.find(q)] == [x in set(v.tolist()) for x in q.tolist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=200))
def test_variable_length_code(values):
    v = np.array(values, np.uint32)
    control, data = encode_values(v)
    assert len(control) == -(-len(v) // 4)
    assert (decode_values(control, data, len(v)) == v).all()


def test_slice_hashes_do_not_depend_on_the_place():
    a = np.array([1, 2, 3, 9, 1, 2, 3, 0, 1, 2], np.uint8)
    h = slice_hashes(a, np.array([0, 4, 0, 8, 3]), np.array([3, 7, 2, 10, 3]))
    assert h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 3


def test_chunks_hold_every_text():
    col = pa.array(["a" * 50, None, "", "é" * 40, "x"]).slice(1)
    got = [bytes(d[a:b]).decode() for lo, hi, d, off in text_chunks(col, 10) for a, b in zip(off[:-1], off[1:])]
    assert got == ["", "", "é" * 40, "x"]


def test_shingles_of_short_texts():
    col = pa.array(["", "one two", "a b c d e f", "One  TWO!"])
    (_, _, data, off), = text_chunks(col)
    h, row, _, _ = shingles(data, off)
    assert row.tolist() == [1, 2, 2, 3] and h[0] == h[3]


PARTS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "É", "1", "٣", "!", "…", " ", "　", "x", "ß", "'s", "'S", "日本", "😀", "\r\n"]


def test_bpe_equals_the_library(monkeypatch):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|> b"]
    for cache in (bpe.CACHE, 200):
        monkeypatch.setattr(bpe, "CACHE", cache)
        enc = bpe.Encoder(bpe.public_path())
        want = [e.ids + [0] for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        got = []
        for k in range(0, len(texts), 500):
            for _, _, ids, off in enc.batches(pa.array(texts[k:k + 500])):
                got += [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
        assert got == want


def test_piece_table_grows_and_finds():
    t = bpe.Table(4)
    keys = np.unique(np.random.default_rng(0).integers(1, 2 ** 63, 5000, dtype=np.uint64))
    for a in range(0, len(keys), 700):
        t.add(keys[a:a + 700], np.arange(a, min(a + 700, len(keys)), dtype=np.int32))
    assert (t.find(keys) == np.arange(len(keys))).all()
    assert (t.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def _fewest(sizes, cap):
    """Fewest bins, by trying all placements."""
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in sorted({b: j for j, b in enumerate(bins)}.values()):
            if bins[j] + sizes[i] <= cap:
                place(i + 1, bins[:j] + [bins[j] + sizes[i]] + bins[j + 1:])
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best[0]


def test_solver_is_optimal_on_small_cases():
    r = random.Random(5)
    for _ in range(60):
        cap = r.choice([10, 17, 30])
        sizes = [r.randint(1, cap) for _ in range(r.randint(0, 9))]
        counts = np.bincount(sizes, minlength=cap + 1) if sizes else np.zeros(cap + 1, int)
        patterns, bound = solve(counts, cap)
        used = np.zeros(cap + 1, int)
        for p, n in patterns:
            assert sum(s * k for s, k in p) <= cap
            for s, k in p:
                used[s] += k * n
        assert (used == counts).all()
        assert bound <= sum(n for _, n in patterns) == (_fewest(sizes, cap) if sizes else 0)


def test_solver_beats_best_fit():
    c = np.bincount(np.random.default_rng(0).integers(200, 1100, 3000), minlength=CAPACITY + 1)
    got = sum(n for _, n in solve(c)[0])
    assert lower_bound(c, CAPACITY) <= got < sum(n for _, n in best_fit(c, CAPACITY))


def test_distinct_numbers_by_first_occurrence():
    idx, keys = distinct(np.array([5, 3, 5, 9, 3], np.uint64))
    assert idx.tolist() == [0, 1, 0, 2, 1] and keys.tolist() == [5, 3, 9]
