"""The sums of a co-training round against a loop over single documents."""

import numpy as np
import pyarrow as pa

from txgraph.llm import quality as q

SF = "/root/testdata/sf0.001"


def test_round_sums_equal_a_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(5)
    model = {"mean": rng.normal(size=q.META), "std": rng.uniform(0.5, 2, q.META),
             "views": {t: ((rng.normal(size=q.DIM), 0.3), (rng.normal(size=q.META), -0.2)) for t in q.TARGETS}}
    got = q.pseudo_sums(docs.repartition(5), model)
    again = q.pseudo_sums(docs.coalesce(1), model)
    want = {t: np.zeros((2, q.CLASS_SUMS)) for t in q.TARGETS}
    taught = 0
    for r in q._columns(docs).toArrow().to_pylist():
        one = pa.RecordBatch.from_pylist([r], schema=pa.schema(
            [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]))
        (_, _, col, x), = q._chunks(iter([one]))
        assert len(set(col.tolist())) == len(col)
        x = np.rint((x[0] - model["mean"]) / model["std"] * 1024) / 1024
        for t, ((wt, bt), (wm, bm)) in model["views"].items():
            p_text = 1 / (1 + np.exp(-np.clip(sum(wt[i] for i in col) / max(len(col), 1) ** 0.5 + bt, -40, 40)))
            p_meta = 1 / (1 + np.exp(-np.clip(x @ wm + bm, -40, 40)))
            for c in (0, 1):
                s = want[t][c]
                if (p_meta if c else 1 - p_meta) >= q.SURE:
                    taught += 1
                    s[0] += 1
                    for i in col:
                        s[1 + i] += 1
                if (p_text if c else 1 - p_text) >= q.SURE:
                    taught += 1
                    m = s[q.TEXT_SUMS:]
                    m[0] += 1
                    m[1:1 + q.META] += x
                    m[1 + q.META:] += np.outer(x, x).reshape(-1)
    assert taught > 50
    for t in q.TARGETS:
        assert np.array_equal(got[t], want[t]) and np.array_equal(again[t], want[t])


def test_every_unlabelled_document_counts(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    sure = {"mean": np.zeros(q.META), "std": np.ones(q.META),
            "views": {"quality": ((np.zeros(q.DIM), 9.0), (np.zeros(q.META), 9.0))}}
    s = q.pseudo_sums(docs, sure)["quality"]
    assert s[1, 0] == s[1, q.TEXT_SUMS] == docs.count() and not s[0].any()


def test_pseudo_labels_weigh_no_more_than_labels():
    base, more = np.array([[4.0, 2], [6, 3]]), np.array([[8.0, 8], [3, 1]])
    assert q.balanced(base, more).tolist() == [[8, 6], [9, 4]]


def test_repeated_ids_of_a_label_stay_one_row(spark):
    docs = spark.createDataFrame([(1, f"text {i}", "en", "s", 5) for i in range(50)] + [(None, "x", None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    _, got = q.labelled_sample(docs, labels)
    assert got.num_rows == 1
