"""Document fingerprints by SpotSigs, in DataFrame functions only.

Anchors are the ``ANCHORS`` most frequent words of the corpus (any languages).  Each occurrence of an
anchor starts a spot signature: the anchor and the chain of content words that
follow it, ``CHAIN`` at most, up to the next anchor; an anchor without content words after it gives
none.  A text's fingerprint is the set of its signatures, 32 hashed bits each, written in
ascending order as hexadecimal text.  A text without signature has its normalised
text as its only one, so every text has a fingerprint, and equal texts equal ones.

Likeness of two fingerprints is the Jaccard similarity of the sets.  ``pruned_jaccard`` answers
0 from the set sizes alone where those cannot reach a wanted likeness.
``near_pairs`` finds all similar documents: sets are partitioned by length so that sets of a
likeness can only lie in the same or the next partition, meet there by a rare signature, and are
compared through the pruned Jaccard.

Defined cases: a null text is empty; rows equal in ``doc_id`` and text are one document; documents
with the same id and other texts follow in the order of a hash of the text, null ids come first;
a single document is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm import setjoin
from txgraph.llm.common import parts_for, table
from txgraph.session import cut

ANCHORS = 64
CHAIN = 3


def normalised(text: Column) -> Column:
    """Lower-case words with one blank before and after each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def common_words(docs: DataFrame, n: int = ANCHORS) -> list[str]:
    """The ``n`` most frequent words of ``text`` (ties: by name)."""
    w = docs.select(F.explode(F.split(F.trim(normalised(F.col("text"))), " ")).alias("w")).where("w <> ''")
    return [r.w for r in w.groupBy("w").count().orderBy(F.desc("count"), "w").limit(n).collect()]


def signatures(d: DataFrame, text: str, name: str, anchors: list[str]) -> DataFrame:
    """``d`` with the distinct spot signatures of the column ``text`` as 32-bit hashes (at least one) in ``name``.

    One projection a step, so that no step's expression is copied into the next and evaluated again.
    """
    t, parts = f"{name}_words", f"{name}_parts"
    d = d.withColumn(t, normalised(F.col(text)))
    if not anchors:
        return d.withColumn(name, F.array(F.hash(t))).drop(t)
    # words are letters and digits only, so they stand for themselves in the pattern
    marked = F.regexp_replace(t, f" (?=(?:{'|'.join(anchors)}) )", "\n")
    d = d.withColumn(parts, F.slice(F.split(marked, "\n"), 2, 2 ** 30))
    chains = F.transform(parts, lambda p: F.substring_index(F.rtrim(p), " ", CHAIN + 1))
    d = d.withColumn(name, F.array_distinct(F.transform(F.filter(chains, lambda c: F.contains(c, F.lit(" "))), lambda c: F.hash(c))))
    return d.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.hash(t)))).drop(t, parts)


def fingerprint(spots: Column) -> Column:
    """Signatures in ascending order, 8 hexadecimal digits each."""
    return F.array_join(F.transform(F.array_sort(spots), lambda s: F.lower(F.lpad(
        F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two distinct arrays; 0 where their sizes rule out ``least``."""
    x, y = F.size(a), F.size(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.least(x, y) < F.greatest(x, y) * least, 0.0).otherwise(F.try_divide(shared.cast("double"), x + y - shared))


def _before(d: DataFrame) -> DataFrame:
    """``k, prev_k, quarter``: each document with the one before it (the first: the last one)."""
    spark = d.sparkSession
    asc = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    keys = cut(d.select("doc_id", "h", "k", F.length("text").alias("n")).dropDuplicates(["k"])
               .repartitionByRange(parts_for(0, spark), *asc).withColumn("part", F.spark_partition_id()))
    me = F.struct("doc_id", "h", "n", "k")
    inside = keys.withColumn("prev", F.lag(me).over(W.partitionBy("part").orderBy(*asc)))
    # one row a partition
    last = keys.groupBy("part").agg(F.max(me).alias("last"))
    ends = last.select("part", F.coalesce(
        F.lag("last").over(W.orderBy("part")),
        F.last("last").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("last"))
    prev = F.coalesce("prev", "last")
    return inside.join(ends, "part").select("k", prev["k"].alias("prev_k"), F.floor(prev["n"] / 4).cast("int").alias("quarter"))


def with_edits(docs: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are to those and to the next document's."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = common_words(d, anchors)
    # one key column, so that the texts are shuffled once for dropping repeats and both joins; signatures go with them
    d = d.withColumn("h", F.xxhash64("text"))
    d = d.withColumn("k", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex("h")))
    before = cut(_before(d))
    d = signatures(d.select("k", "doc_id", "text"), "text", "spots", names).dropDuplicates(["k"])
    # both sides need all columns of ``d``, so the shuffled texts are used again
    after = d.join(before, "k").select(F.col("prev_k").alias("k"), F.col("doc_id").alias("next_id"), F.col("spots").alias("next_spots"),
                                       F.substring(F.col("text"), F.lit(1), F.col("quarter")).alias("head"))
    n = F.length("text")
    e = (d.join(after, "k")
         .select("doc_id", "next_id", "spots", "next_spots", n.cast("long").alias("n_chars"),
                 F.concat(F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("head")).alias("edited")))
    e = signatures(e, "edited", "edited_spots", names)
    return e.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("spots")).alias("fingerprint"),
                    fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
                    pruned_jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
                    pruned_jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"), "next_id")


def near_pairs(docs: DataFrame, num: int = 4, den: int = 5, anchors: int = ANCHORS) -> DataFrame:
    """Pairs of different fingerprints with a likeness of at least ``num / den``.

    ``a, b, likeness``: the smallest ids of the documents with each fingerprint (documents of one
    fingerprint are one class and not paired; null if none has an id, and equal where fingerprints share their
    smallest id).  Null ids come first.  ``docs`` has ``doc_id`` and ``text``.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spots = cut(signatures(d, "text", "spots", common_words(d, anchors)).select("doc_id", F.array_sort("spots").alias("spots"))
                .groupBy("spots").agg(F.min("doc_id").alias("doc_id")).withColumn("id", F.xxhash64("spots")))
    rarity = setjoin.sketch(spots.select(F.explode("spots").alias("s")).select(F.xxhash64("s").alias("token")))
    sets = spots.withColumn("r", rarity.scalar()).select("id", F.size("spots").alias("n"), setjoin.ordered_tokens(F.col("spots"), F.col("r")).alias("t"))
    size = F.floor(F.log("n") / math.log(den / num)).cast("int")
    rows = (sets.select("id", "n", size.alias("part"), F.explode(F.slice("t", 1, setjoin.prefix_length(F.col("n"), num, den))).alias("t")))
    other = rows.unionByName(rows.withColumn("part", F.col("part") + 1))
    pairs = (rows.alias("x").join(other.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.part") == F.col("y.part"))
                                  & (F.col("x.n") * num <= F.col("y.n") * den) & (F.col("y.n") * num <= F.col("x.n") * den)
                                  & (F.col("x.id") != F.col("y.id")))
             .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    a, b = (spots.select(F.col("id").alias(c), F.struct("doc_id", "id").alias(f"d{c}"), F.col("spots").alias(f"s{c}")) for c in "ab")
    # a struct is compared field by field, nulls first
    return (pairs.join(a, "a").join(b, "b").select(F.least("da", "db")["doc_id"].alias("a"), F.greatest("da", "db")["doc_id"].alias("b"),
                                                   pruned_jaccard(F.col("sa"), F.col("sb"), num / den).alias("likeness"))
            .where(F.col("likeness") * den >= num - 1e-9))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return with_edits(table(spark, sf_dir, "documents"))
