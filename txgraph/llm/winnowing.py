"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Of the hashes of
all runs of ``K`` words the smallest in every ``WINDOW - K + 1`` consecutive runs is a
fingerprint, on both sides, so any shared span of ``WINDOW`` words shares one.  Documents that
share a fingerprint with an item are extended: their ``WINDOW``-word windows are compared with the
items' own.  An item of fewer words is one window; its length's runs are all fingerprints.

Both sides take fingerprints and windows from the same words, in which A-Z alone is lower-cased (a
language's own lower-casing may depend on neighbouring letters); windows are compared by 128 hashed bits.  A
document's windows meet the distinct windows of all items; which items hold them is looked up
afterwards, once for each document and window, however often it occurs and however many items share it.

The fingerprints are taken inside a document's row, so its text is never moved; the benchmark
side is a written table that Spark broadcasts only below its own size threshold, and a frequent passage
meets each document in the document's own partition or, in a shuffled join, is split by skew handling.

Defined cases: a null or empty text has no words; a null or empty item has no window;
repeated documents each get their row; rows with the same ``item_id`` are one item;
items without an id mark words but are not listed; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.common import table
from txgraph.session import cut

WINDOW = 10
K = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
RAW_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def runs(w: Column, k: int) -> Column:
    """Hash of every run of ``k`` words, in order (empty if there are fewer)."""
    n = F.size(w) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(w, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def winnow(w: Column, window: int = WINDOW, k: int = K) -> Column:
    """Distinct smallest run hashes of all windows (empty below ``window`` words)."""
    n = F.size(w) - window + 1
    h = F.transform(F.array(runs(w, k)), lambda g: F.transform(  # one value of the run hashes for all windows
        F.sequence(F.lit(1), n), lambda i: F.array_min(F.slice(g, i, window - k + 1))))
    return F.when(n > 0, F.array_distinct(h[0])).otherwise(F.array().cast("array<bigint>"))


def _windows(w: Column, k: int) -> Column:
    """Start (from 0), length and 128 hash bits of every run of ``k`` words."""
    n = F.size(w) - k + 1
    one = lambda i: F.struct((i - 1).alias("s"), F.lit(k).alias("len"),
                             F.xxhash64(F.slice(w, i, k)).alias("h1"), F.xxhash64(F.lit(1), F.slice(w, i, k)).alias("h2"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), one)) \
        .otherwise(F.array().cast("array<struct<s:int,len:int,h1:bigint,h2:bigint>>"))


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Occurrences ``doc_id, row, s, len, h1, h2`` of the items' windows in ``docs``, and the ``item_id, len, h1, h2`` of all windows.

    ``row`` is a hash of the document's id and text; equal rows have equal hits.
    """
    d = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text").where("text is not null")
    i = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    item_words = cut(i.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0"))
    # lengths below the window, at most window - 1 values
    short = sorted(r.n for r in item_words.where(F.size("w") < window).select(F.size("w").alias("n")).distinct().collect())
    prints = lambda w: F.concat(winnow(w, window, min(K, window)), *[runs(w, k) for k in short])
    item_prints = cut(item_words.select(F.explode(prints(F.col("w"))).alias("f")).distinct())
    found = cut(d.select("doc_id", "row", words(F.col("text")).alias("w"))
                .select("doc_id", "row", F.explode(prints(F.col("w"))).alias("f"))
                .join(item_prints, "f").select("doc_id", "row").distinct())
    lengths = [window, *short]
    item_windows = cut(item_words.select(
        "item_id", F.explode(F.concat(*[
            F.when((F.size("w") >= window) if k == window else (F.size("w") == k), _windows(F.col("w"), k))
            .otherwise(F.array().cast("array<struct<s:int,len:int,h1:bigint,h2:bigint>>")) for k in lengths])).alias("x"))
        .select("item_id", "x.len", "x.h1", "x.h2").distinct())
    same = (F.col("d.row") == F.col("c.row")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
    hits = (d.alias("d").join(found.alias("c"), same, "left_semi").dropDuplicates(["doc_id", "row"])
            .select("doc_id", "row", words(F.col("text")).alias("w"))
            .select("doc_id", "row", F.explode(F.concat(*[_windows(F.col("w"), k) for k in lengths])).alias("x"))
            .select("doc_id", "row", "x.*")
            .join(item_windows.select("len", "h1", "h2").distinct(), ["len", "h1", "h2"], "left_semi"))
    return hits.select("doc_id", "row", "s", "len", "h1", "h2"), item_windows


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hit words and items of every document, one row for each row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits, item_windows = find_hits(d, items, window)
    hits = cut(hits)
    in_doc = W.partitionBy("doc_id", "row").orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    spans = hits.groupBy("doc_id", "row", "s").agg((F.max("len") + F.col("s")).alias("e"))
    covered = (spans.withColumn("from", F.greatest("s", F.max("e").over(in_doc)))
               .groupBy("doc_id", "row").agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.col("from"))).alias("n_hit")))
    listed = (hits.select("doc_id", "row", "len", "h1", "h2").distinct().join(item_windows, ["len", "h1", "h2"])
              .select("doc_id", "row", "item_id").distinct().groupBy("doc_id", "row")
              .agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    by_doc = covered.join(listed, (covered["row"] == listed["row"]) & covered["doc_id"].eqNullSafe(listed["doc_id"])) \
        .select(covered["doc_id"].alias("hit_id"), covered["row"].alias("hit_row"), "n_hit", "items")
    every = d.select("doc_id", F.xxhash64("doc_id", "text").alias("row"),
                     F.coalesce(F.regexp_count("text", F.lit(RAW_WORDS)), F.lit(0)).cast("long").alias("n_words"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (every.join(by_doc, (F.col("row") == F.col("hit_row")) & F.col("doc_id").eqNullSafe(F.col("hit_id")), "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without any window of an item."""
    d = docs.select("doc_id", "text")
    bad = find_hits(d, items, window)[0].select("doc_id", "row").distinct() \
        .select(F.col("doc_id").alias("_bad_id"), F.col("row").alias("_bad_row"))
    return docs.join(bad, F.xxhash64("doc_id", "text").eqNullSafe(F.col("_bad_row"))
                     & F.col("doc_id").eqNullSafe(F.col("_bad_id")), "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared spans of at least ten words between all ``documents`` and ``benchmark``."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, len, list_slice(w, s, s + len - 1) AS g
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS len, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s
        FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len FROM item_windows),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
doc_windows AS (
  SELECT doc_id, len, s, list_slice(w, s, s + len - 1) AS g
  FROM (SELECT doc_id, w, lens.len AS len, unnest(range(1, len(w) - lens.len + 2)) AS s FROM dw, lens WHERE len(w) >= lens.len)),
hits AS (SELECT DISTINCT doc_id, s, d.len AS len, item_id FROM doc_windows d JOIN item_windows i ON d.len = i.len AND d.g = i.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + len)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
           FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
