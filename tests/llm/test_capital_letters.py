"""Letters whose lower case depends on their neighbours, across separators."""

import pytest
from tests.llm import brute

from txgraph.llm import winnowing

SIGMA = "ΑΣ"


@pytest.mark.parametrize("sign", ["'", ".", ":", "-", "­", " "])
def test_spans_with_capital_sigma(spark, sign):
    rows = [(1, sign.join([SIGMA] * 12)), (2, " ".join([SIGMA] * 10)), (3, sign.join([SIGMA] * 9)), (4, f"İI{sign}" * 11), (5, "ας " * 10)]
    asked = [("a", " ".join([SIGMA] * 10)), ("b", "İI " * 10), ("c", f"x{sign}{SIGMA}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(asked, "item_id string, text string")
    got = winnowing.contamination(docs, items).collect()
    want = {i: (n, hit, len(found)) for i, n, hit, found in brute.contamination(rows, asked)}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == want
    clean = {r.doc_id for r in winnowing.decontaminate(docs, items).collect()}
    assert clean == {i for i, (_, hit, _) in want.items() if not hit}


def test_many_items_with_one_window(spark):
    shared = " ".join(f"word{k}" for k in range(10))
    rows = [(k, f"{shared} tail{k} " * (1 + k % 3)) for k in range(12)]
    asked = [(k, f"{shared} item{k}") for k in range(30)] + [(None, shared), (3, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(asked, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in winnowing.contamination(docs, items).collect()}
    assert got == {i: (n, hit, len(found)) for i, n, hit, found in brute.contamination(rows, asked)}
