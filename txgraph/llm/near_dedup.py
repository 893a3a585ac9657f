"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles, weighted by how often each occurs.
Element ``e`` of weight ``x`` is a region ``[0, x)`` on a weight axis.  Hashes of ``e`` and
the unit cell throw darts into it, a Poisson process along a rank axis, and give
each dart a coordinate; the earliest dart of each coordinate is the signature.  Two
documents agree in a coordinate with the probability of their weighted Jaccard
similarity.  Only darts before a bound of about ``K ln K + 2 K`` in a whole document are thrown,
so the cost is one hash a shingle and a fixed number of darts; documents with an empty
coordinate get a larger bound.

Shape of the job:

1. Signatures, and 128-bit hashes of the word sequence.  Documents of the same words
   are copies; one of each goes on.
2. Representatives meet by band.  Each bucket's members are compared with one member only, its
   head, by the exact similarity of their texts, and links give components.  This is repeated
   ``STARS`` times with other heads, for members that are not yet in the head's component.
   So a group of thousands of near copies makes one pair a member and round.
3. Buckets that still hold several components are gathered by centre (the root of a bucket's
   main component), and members outside the main component are joined with all members by what sets them apart
   from the centre (``center_join``).  This finds every link that can join two components,
   and near copies that are just not similar do not meet.

With 24 bands of 4 coordinates a pair of similarity 0.8 shares no band in 3 of a million cases; its
``K`` coordinates agree too little for a comparison with a head in 3 of 100,000.

Defined cases: a text with fewer than five words, but not none, is one shingle; texts without words
(null and empty ones too) are each alone, unless equal; repeated rows are copies;
the first of a class is the one with the smallest id (nulls first); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm import center_join
from txgraph.llm.common import components, table
from txgraph.llm.kernels import mix64, occurrences, shingles, slice_hashes, text_chunks
from txgraph.session import cut, discard

THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: Coordinates of a signature: those of the bands first.
K = 192
#: Rounds of comparisons with a head.
STARS = 2
#: Least agreement of signatures for a comparison: four standard deviations below the threshold.
AGREE = math.floor((THRESHOLD - 4 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / K)) * K)
_NEVER = np.uint64(2 ** 64 - 1)


def darts(unit: np.ndarray, row: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """Signatures (``n`` rows of ``k``) of weighted sets given as hashed unit regions.

    A signature entry is rank (as the bits of a 32-bit float, whose order is that of the numbers) and 32 bits of the
    dart's hash, so the smallest is the earliest dart.  Rows without units have ``_NEVER`` in all entries.
    """
    sig = np.full(n * k, _NEVER, np.uint64)
    weight = np.bincount(row, minlength=n).astype(np.float64)
    bound = np.divide(k * (math.log(k) + 2), weight, out=np.zeros(n), where=weight > 0)
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        if len(todo) == n:
            u, r = unit, row
        else:
            pick = np.zeros(n, bool)
            pick[todo] = True
            m = pick[row]
            u, r = unit[m], row[m]
        # the first dart of most units lies beyond the bound: tell by its hash alone
        least = np.exp(-np.minimum(bound, 700.0))
        rank = np.zeros(len(u))
        limit = bound[r]
        step, first = 0, True
        while len(u):
            step += 1
            x = mix64(u + np.uint64(step * 0xD1342543DE82EF95 % 2 ** 64))
            f = ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            if first:
                m = np.flatnonzero(f > least[r])
                u, r, x, f, rank, limit, first = u[m], r[m], x[m], f[m], rank[m], limit[m], False
            rank = rank - np.log(f)
            m = np.flatnonzero(rank < limit)
            u, r, x, rank, limit = u[m], r[m], x[m], rank[m], limit[m]
            y = mix64(x ^ np.uint64(0x2545F4914F6CDD1D))
            value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (y >> np.uint64(32))
            np.minimum.at(sig, r * k + (y & np.uint64(0xFFFFFFFF)).astype(np.int64) % k, value)
        empty = (sig.reshape(n, k)[todo] == _NEVER).any(1)
        todo = todo[empty]
        sig.reshape(n, k)[todo] = _NEVER
        bound[todo] *= 2
    return sig.reshape(n, k)


SIGNED = "uid long, doc_id long, h long, copy1 long, copy2 long, bands array<long>, sig array<int>"


def sign(docs: DataFrame) -> DataFrame:
    """Signature, band keys and copy keys of each row of ``docs``; ``h`` is a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(1)):
                n = hi - lo
                s, row, words, woff = shingles(data, off)
                sig = darts(occurrences(s, row), row, n)
                c1 = slice_hashes(words, woff[:-1], woff[1:])
                c2 = slice_hashes(mix64(words), woff[:-1], woff[1:])
                bare = np.diff(woff) == 0  # without words: the bytes decide
                if bare.any():
                    c1[bare] = slice_hashes(data, off[:-1], off[1:])[bare] ^ np.uint64(1)
                    c2[bare] = mix64(slice_hashes(mix64(data), off[:-1], off[1:]))[bare]
                v = np.ascontiguousarray(sig[:, :BANDS * ROWS]).reshape(n * BANDS, ROWS)
                key = slice_hashes(v.reshape(-1), np.arange(n * BANDS) * ROWS, np.arange(1, n * BANDS + 1) * ROWS)
                key = mix64(key + np.tile(np.arange(BANDS, dtype=np.uint64), n))
                filled = ~bare
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(filled * BANDS)]), pa.int32()),
                    pa.array(key.view(np.int64).reshape(n, BANDS)[filled].reshape(-1)))
                short = mix64(sig[filled].reshape(-1)).astype(np.uint32).view(np.int32)
                sigs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(filled * K)]), pa.int32()), pa.array(short))
                yield pa.record_batch(
                    [pa.array(uid + np.arange(n)), b.column(0).slice(lo, n), b.column(2).slice(lo, n),
                     pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), bands, sigs],
                    names=["uid", "doc_id", "h", "copy1", "copy2", "bands", "sig"])
                uid += n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).mapInArrow(run, SIGNED)


def similarity(pairs: DataFrame) -> DataFrame:
    """``a, b, similarity`` for ``a, b, text_a, text_b``: exact weighted Jaccard of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 64):
                part = b.slice(start, 64)
                n = part.num_rows
                keys, sizes = [], []
                for c in ("text_a", "text_b"):
                    units, rows = [], []
                    for lo, _, data, off in text_chunks(part.column(c)):
                        s, row, _, _ = shingles(data, off)
                        units.append(occurrences(s, row))
                        rows.append(row + lo)
                    row = np.concatenate(rows)
                    keys.append((np.concatenate(units) ^ mix64(row.astype(np.uint64) + np.uint64(7)), row))
                    sizes.append(np.bincount(row, minlength=n))
                shared = np.bincount(keys[0][1][np.isin(keys[0][0], keys[1][0])], minlength=n)
                union = sizes[0] + sizes[1] - shared
                sim = np.divide(shared, union, out=np.zeros(n), where=union > 0)
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(sim)], names=["a", "b", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, similarity double")


def texts_of(docs: DataFrame, signed: DataFrame, uids: DataFrame) -> DataFrame:
    """``uid, text`` of the ``uids``; a written table."""
    who = uids.distinct().join(signed.select("uid", "doc_id", "h"), "uid")
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("h", F.xxhash64("text")).alias("d")
               .join(who.alias("w"), (F.col("d.h") == F.col("w.h")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
               .select("uid", "text").dropDuplicates(["uid"]))


def links(docs: DataFrame, signed: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs(a, b)`` of uids whose texts have the similarity; a written table."""
    text = texts_of(docs, signed, pairs.select(F.col("a").alias("uid")).unionByName(pairs.select(F.col("b").alias("uid"))))
    with_b = pairs.join(text.select(F.col("uid").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(text.select(F.col("uid").alias("a"), F.col("text").alias("text_a")), "a")
    out = cut(similarity(both).where(F.col("similarity") >= threshold).select("a", "b"))
    discard(text)
    return out


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``uid, doc_id, h, first_uid, class_id, copy_id`` of each row: its class's first row, that row's id, its first copy's id."""
    signed = cut(sign(docs))
    order = F.struct("doc_id", "uid")
    copies = cut(signed.groupBy("copy1", "copy2").agg(F.min(order).alias("first")))
    reps = (signed.select("uid", "bands", "sig").join(copies.select(F.col("first.uid").alias("uid")), "uid", "left_semi"))
    # bucket members; only buckets with company
    bands = reps.select(F.posexplode("bands").alias("band", "key"), "uid")
    company = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    pool = cut(bands.join(company, "key"))
    sig = cut(signed.join(pool.select("uid").distinct(), "uid", "left_semi").select("uid", "sig", "bands"))
    side = lambda c: sig.select(F.col("uid").alias(c), F.col("sig").alias(f"s{c}"), F.col("bands").alias(f"k{c}"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda e: e)) >= AGREE
    near, comp = None, None

    def apart() -> DataFrame:
        """Members with their component, of the buckets that hold several."""
        if comp is None:
            return pool.withColumn("root", F.col("uid"))
        m = pool.join(comp.select(F.col("id").alias("uid"), "root"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        several = m.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        return m.join(several, "key", "left_semi")

    for turn in range(STARS):
        m = cut(apart())
        head = m.groupBy("key").agg(F.min_by(F.struct("uid", "root"), F.xxhash64("uid", F.lit(turn))).alias("h"))
        star = (m.join(head, "key").where("root <> h.root")
                .select(F.least("uid", "h.uid").alias("a"), F.greatest("uid", "h.uid").alias("b")).distinct())
        star = cut(star.join(side("a"), "a").join(side("b"), "b").where(agree).select("a", "b"))
        found = links(docs, signed, star, threshold)
        near = found if near is None else cut(near.unionByName(found))
        comp = cut(components(near))
        discard(m, star)
    m = cut(apart())
    # a bucket's centre is the root of the component with the most members; of equal ones the same in all buckets
    main = (m.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key")
            .agg(F.max_by("root", F.struct("n", F.xxhash64("root"), "root")).alias("center")))
    groups = cut(m.join(main, "key").select("center", "uid", "root").distinct())
    text = texts_of(docs, signed, groups.select("uid").unionByName(groups.select(F.col("center").alias("uid"))))
    around = center_join.around(groups, text, threshold)
    rest = center_join.candidates(around, threshold)
    more = center_join.similar(around, rest, threshold)
    discard(groups, text, around)
    comp = cut(components(near.unionByName(more)))
    discard(m, sig, pool, rest)
    copy = signed.join(copies, ["copy1", "copy2"]).select("uid", "doc_id", "h", F.col("first.uid").alias("rep"), F.col("first.doc_id").alias("copy_id"))
    rooted = copy.join(comp.select(F.col("id").alias("rep"), "root"), "rep", "left") \
        .select("uid", "doc_id", "h", "copy_id", F.coalesce("root", "rep").alias("root"))
    rooted = cut(rooted)
    first = rooted.groupBy("root").agg(F.min(order).alias("first"))
    return rooted.join(first, "root").select("uid", "doc_id", "h", F.col("first.uid").alias("first_uid"),
                                             F.col("first.doc_id").alias("class_id"), "copy_id")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, all columns."""
    kept = classes(docs, threshold).where("uid = first_uid").select(F.col("doc_id").alias("_kept_id"), F.col("h").alias("_kept_h"))
    text = F.coalesce("text", F.lit(""))
    return (docs.join(kept, (F.xxhash64(text) == F.col("_kept_h")) & F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
            .dropDuplicates(["doc_id", "text"]))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of all ``documents``: the smallest id of the class, and whether this row is it."""
    c = classes(table(spark, sf_dir, "documents"))
    return c.select("doc_id", "class_id", "copy_id", (F.col("uid") == F.col("first_uid")).alias("kept"))
