"""Codes of the language model reach down to the rarest bigram of the largest context."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F
from tests.llm.test_operators import model_scores

from txgraph.llm import ngram_lm


def test_codes_of_a_huge_context():
    total = 10 ** 8
    step = ngram_lm.code_step(total)
    p = np.array([1, 2, 7, 10 ** 4, total]) / (total + ngram_lm.MU)
    code = ngram_lm.quantise(p, step)
    assert len(set(code.tolist())) == len(p)
    assert np.abs(np.log10(ngram_lm.levels(step)[code] / p)).max() <= 0.5001 * step
    assert ngram_lm.code_step(10 ** 6) == ngram_lm.STEP


def test_scores_beyond_the_fixed_range(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "STEP", 1 / 255)  # ends at a tenth; contexts here are up to 300 times as large
    docs = [(3 * i, " ".join(f"a b{i}x{k}" for k in range(15))) for i in range(20)]
    got = {r.doc_id: r for r in ngram_lm.score(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") < 0).collect()}
    counts = collections.Counter(w for _, t in docs for w in t.split())
    half = 0.5001 * math.log10(max(counts.values()) + ngram_lm.MU) / 254
    for (i, _), x in zip(docs, model_scores(docs, lambda i: False, ngram_lm.MU)):
        assert abs(got[i].score - x[4]) <= half * x[0]
