"""Near copies that are just not similar: classes, and how many pairs are compared."""

import random

import brute
import pytest
from conftest import VOCAB

from txgraph.llm import center_join, near_dedup


def copies(n, edits, seed=5, words=240):
    r = random.Random(seed)
    base = [r.choice(VOCAB) + str(k) for k in range(words)]
    rows = []
    for k in range(n):
        w = list(base)
        for p in r.sample(range(words), edits):
            w[p] = f"x{k}p{p}"
        rows.append((k, " ".join(w)))
    return rows


@pytest.fixture
def compared(monkeypatch):
    """Counts of the pairs that went to verification."""
    got = []
    plain = center_join.candidates

    def counted(*args):
        out = plain(*args)
        got.append(out.count())
        return out

    monkeypatch.setattr(center_join, "candidates", counted)
    return got


def classes(spark, rows):
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[i] for i, _ in rows]


@pytest.mark.parametrize("edits", [3, 4])
def test_classes_of_copies_around_the_threshold(spark, compared, edits):
    rows = copies(200, edits)
    assert classes(spark, rows) == [rows[k][0] for k in brute.near_classes(rows)]
    assert compared[0] < 200 * 199 / 2 / 5


def test_pairs_with_any_centre(spark):
    """All similar pairs across roots are met or settled, with the group's centre near or far."""
    r = random.Random(9)
    rows = copies(40, 2) + [(100 + i, t) for i, t in copies(20, 1)] + [(200, " ".join(r.choice(VOCAB) for _ in range(90))), (201, "one two"), (202, "")]
    text = spark.createDataFrame(rows, "uid long, text string")
    for center in (0, 200, 201):
        groups = spark.createDataFrame([(center, i, i) for i, _ in rows], "center long, uid long, root long")
        near = center_join.around(groups, text, 0.8)
        found = {(p.a, p.b) for p in center_join.similar(near, center_join.candidates(near, 0.8), 0.8).collect()}
        sets = {i: brute.shingles(t) for i, t in rows}
        like = lambda a, b: sum((sets[a] & sets[b]).values()) / (sum((sets[a] | sets[b]).values()) or 1) >= 0.8
        assert found and all(like(a, b) for a, b in found)
        low = near.first().low.uid
        both = lambda a, b: all(x == low or tuple(sorted((x, low))) in found for x in (a, b))
        ids = sorted(sets)
        assert all((a, b) in found or both(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if like(a, b))
