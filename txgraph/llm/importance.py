"""Target-distribution importance resampling with the features of each distinct line computed once.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, features all runs of one and two
words, hashed to ``BUCKETS`` buckets.  A newline separates words, so a text's features are those of its lines and
the pairs of words that cross from a line with words to the next one.  Distinct lines are found by a partial
aggregation of the lines of all texts; their buckets are computed once, in a written table, and counted as often as
the line occurs.  Pairs across lines are computed with the documents.  A document's gain is the sum over its lines
(joined by the line's 128-bit hash) and its own crossing pairs.

Skew: a document sends each of its distinct lines once.  Lines with more than 1 / ``HOT`` of all occurrences are
fewer than ``HOT``, so they are broadcast; the others meet in a shuffled join.  Nothing else of corpus size leaves
the tasks: the driver holds one gain for each bucket.  Ranks come from sorted ranges and the ranges' row counts.

Defined cases: a null or empty text has no features, weight 0 and no rank; documents with equal or null ids are scored
each for itself (a null id is hashed as ``7:``, and loses ties); of repeated rows any may rank first;
an empty ``documents`` gives no rows, an empty target no target features; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.common import table, texts
from txgraph.llm.kernels import ascii_words, lower_ascii, text_chunks
from txgraph.session import cut, discard

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
HOT = 1024
WORD_BYTE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
LONG_WORD = 64
ALL = np.uint32(0xFFFFFFFF)


@functools.cache
def crc_table() -> np.ndarray:
    """The byte table of crc32, by its polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def crc_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Running crc32 states after the bytes ``data[start:end]``, all runs a byte at a time, longest first."""
    t = crc_table()
    order = np.argsort(start - end, kind="stable")
    s, at, n = state[order], start[order], (end - start)[order]
    for j in range(min(LONG_WORD, int(n[0]) if len(n) else 0)):
        m = int(np.searchsorted(-n, -j, "left"))
        x = s[:m]
        s[:m] = t[(x ^ data[at[:m] + j]) & np.uint32(255)] ^ (x >> np.uint32(8))
    for i in range(int(np.searchsorted(-n, -LONG_WORD, "left"))):
        rest = data[at[i] + LONG_WORD:at[i] + n[i]].tobytes()
        s[i] = np.uint32(zlib.crc32(rest, int(s[i] ^ ALL))) ^ ALL
    out = np.empty_like(s)
    out[order] = s
    return out


def word_states(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return crc_runs(data, start, end, np.full(len(start), ALL, np.uint32))


def pair_states(data: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray) -> np.ndarray:
    """States of ``left word + blank + word`` from the states of the left words."""
    after = crc_table()[(left ^ np.uint32(32)) & np.uint32(255)] ^ (left >> np.uint32(8))
    return crc_runs(data, start, end, after)


def buckets_of(state: np.ndarray, buckets: int) -> np.ndarray:
    return ((state ^ ALL) % np.uint32(buckets)).astype(np.int32)


def lists(values: np.ndarray, per: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), pa.array(values))


def distinct_lines(docs: DataFrame, buckets: int) -> DataFrame:
    """``key, n, buckets`` of each distinct line with a word: its md5, its occurrences, its features' buckets."""
    lines = (docs.select(F.explode(F.split("text", "\n")).alias("line"))
             .where(F.rlike("line", F.lit(WORD_BYTE))).groupBy("line").agg(F.count("*").alias("n")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in text_chunks(b.column(0)):
                data = lower_ascii(raw)
                start, end, row = ascii_words(data, off)
                one = word_states(data, start, end)
                i = np.flatnonzero(row[1:] == row[:-1])
                two = pair_states(data, start[i + 1], end[i + 1], one[i])
                rows = np.concatenate([row, row[i]])
                found = buckets_of(np.concatenate([one, two]), buckets)[np.argsort(rows, kind="stable")]
                keys = [hashlib.md5(raw[x:y]).digest() for x, y in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.record_batch([pa.array(keys, pa.binary()), b.column(1).slice(lo, hi - lo),
                                       lists(found, np.bincount(rows, minlength=hi - lo))], names=["key", "n", "buckets"])

    return lines.mapInArrow(features, "key binary, n long, buckets array<int>")


def crossings(docs: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, n_words, buckets, keys, times``: buckets of the pairs across lines, and the md5s of the
    distinct lines with words, each with how often it occurs in the text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in text_chunks(b.column(1)):
                data = lower_ascii(raw)
                start, end, row = ascii_words(data, off)
                newline = np.flatnonzero(raw == 10)
                line = np.searchsorted(newline, start)
                same = row[1:] == row[:-1]
                i = np.flatnonzero(same & (line[1:] != line[:-1]))
                one = word_states(data, start[i], end[i])
                cross = buckets_of(pair_states(data, start[i + 1], end[i + 1], one), buckets)
                # a line with words lies between two newlines or ends of its text
                head = np.flatnonzero(np.concatenate([[True], ~same | (line[1:] != line[:-1])])) if len(start) else i
                a = np.concatenate([[0], newline + 1])[line[head]]
                z = np.concatenate([newline, [len(raw)]])[line[head]]
                a, z = np.maximum(a, off[row[head]]), np.minimum(z, off[row[head] + 1])
                keys, times, per = [], [], []
                each = [hashlib.md5(raw[x:y]).digest() for x, y in zip(a.tolist(), z.tolist())]
                cuts = np.searchsorted(row[head], np.arange(hi - lo + 1)).tolist()
                for x, y in zip(cuts[:-1], cuts[1:]):
                    count: dict[bytes, int] = {}
                    for k in each[x:y]:
                        count[k] = count.get(k, 0) + 1
                    keys += count.keys()
                    times += count.values()
                    per.append(len(count))
                where = pa.array(np.cumsum([0, *per]).astype(np.int32))
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.bincount(row, minlength=hi - lo).astype(np.int64)),
                     lists(cross, np.bincount(row[i], minlength=hi - lo)),
                     pa.ListArray.from_arrays(where, pa.array(keys, pa.binary())),
                     pa.ListArray.from_arrays(where, pa.array(times, pa.int32()))],
                    names=["doc_id", "n_words", "buckets", "keys", "times"])

    return docs.mapInArrow(make, "doc_id long, n_words long, buckets array<int>, keys array<binary>, times array<int>")


def bucket_counts(parts: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket of ``n, buckets``: a vector a task, summed; at most one row a bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            per = b.column(1).value_lengths().to_numpy()
            weight = np.repeat(b.column(0).to_numpy(), per)
            np.add.at(total, b.column(1).flatten().to_numpy(), weight)
        full = np.flatnonzero(total)
        yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in parts.select("n", "buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def with_gains(parts: DataFrame, gains: np.ndarray, columns: str) -> DataFrame:
    """``columns`` of ``parts`` with the sum of the gains of ``buckets`` (``gain``) and their number (``features``)."""
    shared = parts.sparkSession.sparkContext.broadcast(gains)  # one number a bucket
    names = [c.split()[0] for c in columns.split(", ")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            per = b.column(0).value_lengths().to_numpy().astype(np.int64)
            cum = np.concatenate([[0], np.cumsum(shared.value[b.column(0).flatten().to_numpy()])])
            end = np.cumsum(per)
            yield pa.record_batch([*b.columns[1:], pa.array(cum[end] - cum[end - per]), pa.array(per)],
                                  names=[*names, "gain", "features"])

    return parts.select("buckets", *names).mapInArrow(add, f"{columns}, gain long, features long")


def features(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Written tables of the distinct lines and of the documents, and the features in each bucket."""
    lines = cut(distinct_lines(docs, buckets))
    rows = cut(crossings(docs, buckets).withColumn("row", F.monotonically_increasing_id()))
    both = lines.select("n", "buckets").unionByName(rows.select(F.lit(1).cast("long").alias("n"), "buckets"))
    return lines, rows, bucket_counts(both, buckets)


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight`` of each document: the floored mean gain of its features."""
    *written, t = features(texts(target.withColumn("_", F.lit(0)), "_"), buckets)
    discard(*written)
    lines, rows, s = features(texts(docs), buckets)
    size, goal = int(s.sum()) + buckets, int(t.sum()) + buckets
    gains = np.array([math.floor(1000 * math.log((y + 1) * size / ((x + 1) * goal))) for x, y in zip(s.tolist(), t.tolist())], np.int64)
    known = with_gains(lines, gains, "key binary, n long")
    least = (lines.agg(F.sum("n")).first()[0] or 0) // HOT
    hot = F.broadcast(known.where(F.col("n") > least).drop("n"))  # fewer than HOT lines
    held = (rows.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x"))
            .select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("times")))
    cold = held.join(hot, "key", "left_anti").join(known.where(F.col("n") <= least).drop("n"), "key")
    own = with_gains(rows, gains, "row long, doc_id long, n_words long")
    parts = (held.join(hot, "key").unionByName(cold)
             .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_words"),
                     (F.col("gain") * F.col("times")).alias("gain"), (F.col("features") * F.col("times")).alias("features"))
             .unionByName(own))
    out = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"),
                                   F.sum("features").alias("n_features"), F.sum("gain").alias("gain"))
    floored = F.expr("(gain - pmod(gain, n_features)) div n_features")
    return out.select("row", "doc_id", "n_words", "n_features", F.when(F.col("n_features") > 0, floored).otherwise(0).cast("long").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of each document; ``rank`` is null where it is not drawn."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296)))
    scored = cut(weights(docs, target, buckets).withColumn("score", F.col("weight") + noise)
                 .withColumn("may", F.col("n_words") >= min_words))
    drawn = percent * scored.where("may").count() // 100
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranges = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(scored.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()))
    # one row a range; the window is over those alone
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("part").orderBy(*order)) + F.col("before")
    return (ranged.join(F.broadcast(before), "part").withColumn("place", place)
            .select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their weights towards ``benchmark`` and the rank of the drawn ones."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: crc32 bit by bit, over the bytes of each distinct feature.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
     b AS (SELECT coalesce({_WORDS}, []) AS w FROM benchmark),
     df AS (SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d),
     bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
     every AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
     steps AS (SELECT list(s ORDER BY k) AS t FROM (
         SELECT k, list_reduce(list_prepend(k, range(8)),
                               lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS s
         FROM range(256) AS x(k))),
     bytes AS (SELECT f, hex(encode(f)) AS x FROM every),
     hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2),
                    lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS b FROM bytes, steps),
     s AS (SELECT b, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY b),
     t AS (SELECT b, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY b),
     total AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::BIGINT + 10000 AS s, (SELECT coalesce(sum(t), 0) FROM t)::BIGINT + 10000 AS t),
     gains AS (SELECT s.b, floor(1000 * ln(((coalesce(t.t, 0) + 1) * total.t0)::DOUBLE / ((s.s + 1) * total.t1)::DOUBLE))::BIGINT AS g
               FROM s LEFT JOIN t USING (b), (SELECT s AS t0, t AS t1 FROM total) AS total),
     sums AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM df JOIN hashed USING (f) JOIN gains USING (b) GROUP BY r),
     weighed AS (SELECT d.r, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features,
                        coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
                        ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
                 FROM d LEFT JOIN sums USING (r)),
     scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score, words >= 20 AS may FROM weighed),
     ranked AS (SELECT *, row_number() OVER (ORDER BY may DESC, score DESC, doc_id, r) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 25 * (SELECT count(*) FROM scored WHERE may) // 100 THEN place END AS rank
FROM ranked
"""
