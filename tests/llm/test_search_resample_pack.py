"""Ranked search, importance resampling and group packing against plain reference versions."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tests.llm import brute
from tests.llm.conftest import VOCAB
from tokenizers import Tokenizer

from txgraph.llm import group_packing, importance, pipelined_search
from txgraph.llm.bpe import public_path

SF = "/root/testdata/sf0.001"
LAST = 1 << 62


def given(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def terms(text):
    return brute.WORD.findall(brute.lower(text))


def ranking(docs, items, top):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, size = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        mine = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) for w in terms(text)}
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // size
            score = sum(w * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in mine.items())
            if score > 0:
                scores.append((-score, LAST if i is None else i))
        out += [(item, k + 1, None if i == LAST else i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return collections.Counter(out)


def found(df):
    return collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in given("documents")]
    items = [(r["item_id"], r["text"]) for r in given("benchmark")]
    assert found(pipelined_search.op11_ranked_search(spark, SF)) == ranking(docs, items, 50)


@pytest.mark.parametrize("parts", [{"owners": 1}, {"owners": 4, "bundle": 2, "block_docs": 3, "query_terms": 40}])
def test_search_odd_rows_in_any_partition(spark, odd_docs, no_docs, parts):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = [(1, " ".join(VOCAB[:30])), (1, " ".join(VOCAB[:30])), (2, None), (None, "bar cest ÑANDÚ"), (4, ""), (5, "nowhere found"),
            (6, "x it s"), (7, " ".join(VOCAB))]
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, row int, block int")
    got = found(pipelined_search.search(odd_docs, items, 5, **parts))
    assert got == ranking(docs, rows, 5)
    assert pipelined_search.search(no_docs, items).count() == 0
    assert pipelined_search.search(odd_docs, items.where("1 = 0")).count() == 0


def drawn(docs, target, buckets=10000, percent=25, least=20):
    def features(text):
        w = terms(text)
        return [zlib.crc32(x.encode()) % buckets for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    have = [features(t) for _, t in docs]
    s, t = (collections.Counter(b for one in x for b in one) for x in (have, [features(x) for x in target]))
    size, goal = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * size / ((s[b] + 1) * goal)))
    rows = []
    for (i, text), f in zip(docs, have):
        w = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(text)) >= least))
    rows.sort(key=lambda r: (not r[4], -r[3], LAST if r[0] is None else r[0]))
    n = percent * sum(r[4] for r in rows) // 100
    return collections.Counter((*r[:4], k + 1 if k < n else None) for k, r in enumerate(rows))


def resampled(df):
    return collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_resampling_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in given("documents")]
    assert resampled(importance.op12_importance(spark, SF)) == drawn(docs, [r["text"] for r in given("benchmark")])


def test_resampling_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    more = spark.createDataFrame([(20 + k, "\n".join(["the same line again and again"] * k) + "\n\n" + "x" * 300 + "\r\nlast line") for k in range(8)],
                                 "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = ["bar cest\ndil", None, "", "the same line " + "x" * 300]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    for hot in (1024, 4):  # with 4 the frequent lines are broadcast, the others joined
        monkeypatch.setattr(importance, "HOT", hot)
        assert resampled(importance.resample(docs, goal, percent=60, min_words=3, buckets=97)) == drawn(rows, target, 97, 60, 3)
    assert resampled(importance.resample(docs, goal.where("1 = 0"))) == drawn(rows, [])
    assert importance.resample(no_docs, goal).count() == 0


def test_crc_of_runs():
    r = np.random.default_rng(5)
    data = r.integers(0, 256, 3000, dtype=np.uint8)
    start = r.integers(0, 2000, 200)
    end = start + np.where(np.arange(200) % 9 == 0, 900, r.integers(0, 70, 200))
    got = importance.word_states(data, start, end) ^ importance.ALL
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in zip(start, end)]
    pairs = importance.pair_states(data, start[1:], end[1:], importance.word_states(data, start, end)[:-1]) ^ importance.ALL
    runs = [data[a:b].tobytes() for a, b in zip(start, end)]
    assert pairs.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(runs, runs[1:])]


def check_packing(got, docs, capacity):
    t = Tokenizer.from_file(public_path())
    whole = [(i, np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4")) for i, x in docs]
    want = collections.Counter((i, a, min(capacity, len(ids) - a), zlib.crc32(ids[a:a + capacity]), len(ids))
                               for i, ids in whole for a in range(0, len(ids), capacity))
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0, *[n for _, n in pieces]])[:-1])
        assert sum(n for _, n in pieces) <= capacity
    return sequences


def test_group_packing(spark):
    docs = [(r["doc_id"], r["text"]) for r in given("documents")]
    got = group_packing.op13_group_packing(spark, SF).collect()
    n = len(check_packing(got, docs, 1024))
    assert 0 <= n * 1024 - sum(r.length for r in got) < 0.02 * n * 1024


def test_group_packing_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for limits in ({}, {"group_tokens": 100}, {"group_pieces": 3}):
        check_packing(group_packing.pack_groups(odd_docs, public_path(), 64, **limits).collect(), docs, 64)
    assert group_packing.pack_groups(no_docs, public_path()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_tournament_tree_is_first_fit_decreasing(seed):
    r = np.random.default_rng(seed)
    capacity = int(r.integers(5, 200))
    lengths = r.integers(1, capacity, int(r.integers(1, 400)))
    room, want = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        s = next((s for s, free in enumerate(room) if free >= lengths[k]), len(room))
        if s == len(room):
            room.append(capacity)
        want[k] = (s, capacity - room[s])
        room[s] -= lengths[k]
    sequence, offset = group_packing.first_fit_decreasing(lengths, capacity)
    assert {k: (int(sequence[k]), int(offset[k])) for k in want} == want
