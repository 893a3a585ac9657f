import zlib

import corpus_pipeline

from txgraph.llm import language_id

HELD = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
LEARNED = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
COLUMNS = "doc_id long, text string, lang string, n_chars long"


def stage(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], COLUMNS)
    out = corpus_pipeline.language(spark, docs, None)
    assert out.columns == docs.columns
    return {r.doc_id: (r.text, r.lang, r.n_chars) for r in out.collect()}


def test_stage_learns_from_documents_that_op4_holds_out(spark):
    x, y = "aab abc bca cab", "zyx xyz zzy yzx"
    got = stage(spark, [(HELD[0], x, "x"), (HELD[1], y, "y"), (HELD[2], "12 !", "y"), (LEARNED[0], y, None)])
    assert got == {HELD[0]: (x, "x", 7), HELD[1]: (y, "y", 7), LEARNED[0]: (y, "y", 7)}


def test_language_found_goes_to_rows_without_a_label(spark):
    x, y = "aab abc bca cab", "zyx xyz zzy yzx"
    got = stage(spark, [(LEARNED[0], x, "x"), (HELD[0], y, "y"), (LEARNED[1], "cab aab", None), (HELD[1], "xyz zzy", None),
                        (LEARNED[2], "", None), (None, "abc", None), (LEARNED[3], x, "y")])
    assert {i: g for i, (_, g, _) in got.items()} == {LEARNED[0]: "x", HELD[0]: "y", LEARNED[1]: "x", HELD[1]: "y", None: "x", LEARNED[3]: "y"}


def test_labels_of_the_rows_do_not_change_what_op4_holds_out(spark):
    docs = spark.createDataFrame([(HELD[0], "aab abc", "x", 7), (LEARNED[0], "zyx xyz", "y", 7)], COLUMNS)
    assert {(r.doc_id, r.held_out, r.lang_pred) for r in language_id.predict(docs).collect()} == {(HELD[0], True, "y"), (LEARNED[0], False, "y")}
