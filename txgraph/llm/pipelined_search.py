"""Ranked lexical search with pipelined term partitioning.

Terms are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  The item terms are divided among ``OWNERS``
term owners of about equal posting mass, rarest terms first.  A bundle of items starts with empty accumulators and
goes through the owners one after another: at each stage a cogroup brings the bundle and the owner's postings
together, the owner adds its terms' integer contributions, and the bundle moves on with its sparse accumulators
``(item, document, score)``.  The last owner, which holds the commonest terms, selects each item's best documents of the
bundle at once, so the longest accumulators are never sent; the best of all bundles are chosen in two windows.

A bundle is at most ``BUNDLE`` items over one block of at most ``BLOCK_DOCS`` documents, so no group, accumulator or
posting list grows with the corpus, however common a term is; a term's list lies in as many groups as there are
blocks.  Items are searched in blocks of about ``QUERY_TERMS`` terms: what is broadcast (the block's term hashes,
weights and item lists) is bounded by that, whatever the size of the two tables.  Terms meet by 64-bit hash.

Defined cases: a null or empty document has no terms and is not counted; a null or empty item finds nothing; rows with
equal ids are documents, or items, of their own; a null ``doc_id`` loses ties; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.common import table, texts
from txgraph.llm.kernels import ascii_words, lower_ascii, slice_hashes, text_chunks
from txgraph.session import cut

TOP = 50
OWNERS = 3
BUNDLE = 512
BLOCK_DOCS = 4096
BLOCK_BYTES = 8 << 20
QUERY_TERMS = 1 << 20
#: Pairs of an item and a posting that are expanded at a time.
PAIRS = 4 << 20
LAST = np.iinfo(np.int64).max
POSTINGS = "terms array<int>, counts array<int>, docs array<int>, tfs array<int>"
STATE = "block long, bundle int, item array<int>, doc array<int>, score array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """``row, terms``: the distinct terms of each text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, off in text_chunks(b.column(1)):
                data = lower_ascii(raw)
                start, end, row = ascii_words(data, off)
                terms: list[dict[str, None]] = [{} for _ in range(hi - lo)]
                for s, e, r in zip(start.tolist(), end.tolist(), row.tolist()):
                    terms[r][data[s:e].tobytes().decode()] = None
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array([list(t) for t in terms], pa.list_(pa.string()))],
                                      names=["row", "terms"])

    return items.mapInArrow(split, "row long, terms array<string>")


class Queries:
    """A block of items: sorted hashes of their terms, and for each term the items that hold it."""

    def __init__(self, rows: list, bundle: int):
        self.bundle = bundle
        self.rows = np.array([r.row for r in rows], np.int64)
        terms = sorted({t for r in rows for t in r.terms})
        data = np.frombuffer("".join(terms).encode(), np.uint8)
        end = np.cumsum([len(t.encode()) for t in terms])
        h = slice_hashes(data, np.concatenate([[0], end[:-1]]).astype(np.int64), end.astype(np.int64))
        order = np.argsort(h)
        self.hashes = h[order]
        number = {terms[k]: i for i, k in enumerate(order.tolist())}
        pairs = np.array([(number[t], i) for i, r in enumerate(rows) for t in r.terms], np.int64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        self.items = pairs[:, 1]
        self.at = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
        self.bundles = -(-len(rows) // bundle)
        #: for each bundle its terms, and whether it is the first bundle with the term
        self.held = [np.unique(pairs[pairs[:, 1] // bundle == k, 0]) for k in range(self.bundles)]
        self.first = self.items[self.at[:-1]] // bundle

    def of_bundle(self, term: int, k: int) -> np.ndarray:
        """The term's items in the ``k``-th bundle, counted from its first item."""
        x, low = self.items[self.at[term]:self.at[term + 1]], k * self.bundle
        return x[np.searchsorted(x, low):np.searchsorted(x, low + self.bundle)] - low


def index(docs: DataFrame, queries, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``block, bundle, doc_ids, n`` and postings by term of each block of documents, a row for each bundle of items
    that shares a term with it; the first bundle always has its row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        q = queries.value
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for top in range(0, b.num_rows, block_docs):
                part = b.slice(top, block_docs)
                for lo, hi, raw, off in text_chunks(part.column(1), BLOCK_BYTES):
                    data = lower_ascii(raw)
                    start, end, row = ascii_words(data, off)
                    n = np.bincount(row, minlength=hi - lo)
                    h = slice_hashes(data, start, end)
                    at = np.minimum(np.searchsorted(q.hashes, h), len(q.hashes) - 1)
                    hit = np.flatnonzero(q.hashes[at] == h)
                    key, tf = np.unique(at[hit] * (hi - lo) + row[hit], return_counts=True)
                    term, doc = key // (hi - lo), key % (hi - lo)
                    for k in range(q.bundles):
                        mine = np.flatnonzero(np.isin(term, q.held[k]))
                        if len(mine) or k == 0:
                            terms, counts = np.unique(term[mine], return_counts=True)
                            yield pa.record_batch(
                                [pa.array([block]), pa.array([k], pa.int32()),
                                 pa.array([part.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                                 *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (n, terms, counts, doc[mine], tf[mine]))],
                                names=["block", "bundle", "doc_ids", "n", "terms", "counts", "docs", "tfs"])
                    block += 1

    return docs.mapInArrow(make, f"block long, bundle int, doc_ids array<long>, n array<int>, {POSTINGS}")


def doc_frequencies(postings: DataFrame, queries, n_terms: int) -> np.ndarray:
    """Documents of each term: a vector a task, summed; at most one row a term reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            for r in range(b.num_rows):
                terms, n = (b.column(c)[r].values.to_numpy() for c in (1, 2))
                once = queries.value.first[terms] == b.column(0)[r].as_py()
                total[terms[once]] += n[once]
        full = np.flatnonzero(total)
        yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in postings.select("bundle", "terms", "counts").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def owned(postings: DataFrame, owner_of, stage: int) -> DataFrame:
    """The postings of a stage's owner; a bundle without any keeps its row, with empty lists."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                terms, counts, docs, tfs = (one.column(c)[0].values.to_numpy() for c in range(4, 8))
                mine = owner_of.value[terms] == stage
                each = np.repeat(mine, counts)
                yield pa.record_batch([*one.columns[:4], *(pa.array([x], pa.list_(pa.int32())) for x in (terms[mine], counts[mine], docs[each], tfs[each]))],
                                      names=one.schema.names)

    schema = f"block long, bundle int, doc_ids array<long>, n array<int>, {POSTINGS}"
    return postings.select("block", "bundle", "doc_ids", "n", "terms", "counts", "docs", "tfs").mapInArrow(choose, schema)


def search_block(docs: DataFrame, rows: list, top: int, owners: int, bundle: int, block_docs: int) -> DataFrame:
    """``row, doc_id, score``: at least the ``top`` best documents of each item of one block."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    q = Queries(rows, bundle)
    queries = sc.broadcast(q)
    postings = cut(index(docs, queries, block_docs))
    size = postings.where("bundle = 0").select(F.explode("n").alias("n")).where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_all = size.n, size.l or 1
    df = doc_frequencies(postings, queries, len(q.hashes))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    order = np.argsort(df, kind="stable")
    mass = np.cumsum(df[order]) - df[order]
    owner = np.empty(len(df), np.int64)
    owner[order] = np.minimum(mass * owners // max(1, int(df.sum())), owners - 1)
    owner_of, weights = sc.broadcast(owner), sc.broadcast(weight)

    def add(state: pa.Table, own: pa.Table) -> np.ndarray:
        """Accumulators of a bundle, an item a row and a document a column, with the owner's contributions."""
        q, w = queries.value, weights.value
        k = own.column("bundle")[0].as_py()
        n, terms, counts, docs, tfs = (own.column(c)[0].values.to_numpy() for c in ("n", "terms", "counts", "docs", "tfs"))
        items = min(q.bundle, len(q.rows) - k * q.bundle)
        acc = np.zeros(items * len(n), np.int64)
        item, doc, score = (state.column(c)[0].values.to_numpy() for c in ("item", "doc", "score"))
        acc[item.astype(np.int64) * len(n) + doc] = score
        m = 50 + 50 * n.astype(np.int64) * n_docs // n_all
        tf, docs = tfs.astype(np.int64), docs.astype(np.int64)
        part = np.repeat(w[terms], counts) * (1_000_000_000 * tf // (1000 * tf + 20 * m[docs]))
        end = np.cumsum(counts)
        for t, e, c in zip(terms.tolist(), end.tolist(), counts.tolist()):
            who = q.of_bundle(t, k)
            step = max(1, PAIRS // c)
            for x in range(0, len(who), step):  # a document is once in a term's list
                acc.reshape(items, -1)[who[x:x + step, None], docs[None, e - c:e]] += part[None, e - c:e]
        return acc.reshape(items, len(n))

    def forward(state: pa.Table, own: pa.Table) -> pa.Table:
        acc = add(state, own)
        item, doc = np.nonzero(acc)
        cols = [own.column("block"), own.column("bundle"), pa.array([item.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([doc.astype(np.int32)], pa.list_(pa.int32())), pa.array([acc[item, doc]], pa.list_(pa.int64()))]
        return pa.table(cols, names=["block", "bundle", "item", "doc", "score"])

    def best(state: pa.Table, own: pa.Table) -> pa.Table:
        acc = add(state, own)
        ids = own.column("doc_ids")[0].values
        key = ids.fill_null(LAST).to_numpy()
        who, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(len(acc)):
            d = np.flatnonzero(acc[i])
            if len(d) > top:
                least = np.partition(acc[i, d], len(d) - top)[len(d) - top]
                d = d[acc[i, d] >= least]
                d = d[np.lexsort((key[d], -acc[i, d]))[:top]]
            who.append(np.full(len(d), i))
            which.append(d)
        i, d = np.concatenate(who), np.concatenate(which)
        row = queries.value.rows[i + own.column("bundle")[0].as_py() * queries.value.bundle]
        return pa.table([own.column("block").take(pa.array(np.zeros(len(i), np.int64))), pa.array(row), ids.take(pa.array(d)), pa.array(acc[i, d])],
                        names=["block", "row", "doc_id", "score"])

    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("item", "int"), ("doc", "int"), ("score", "long"))]
    state = postings.select("block", "bundle", *none)
    for stage in range(owners):
        both = state.groupBy("block", "bundle").cogroup(owned(postings, owner_of, stage).groupBy("block", "bundle"))
        state = both.applyInArrow(forward, STATE) if stage < owners - 1 else both.applyInArrow(best, "block long, row long, doc_id long, score long")
    return state


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, query_terms: int = QUERY_TERMS,
           bundle: int = BUNDLE, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row of ``items`` (``item_id, text``)."""
    given = cut(items.select("item_id", F.col("text").cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id()))
    terms = cut(item_terms(given.select("row", "text")).where(F.size("terms") > 0))
    blocks = max(1, math.ceil((terms.agg(F.sum(F.size("terms"))).first()[0] or 0) / query_terms))
    found = []
    for k in range(blocks):
        rows = terms.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k).orderBy("row").collect()  # about query_terms terms
        if rows:
            found.append(search_block(texts(docs), rows, top, owners, bundle, block_docs))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    if not found:
        return given.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("1 = 0")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    # the best of each item within 1024 sets of blocks, then of all
    for group in (["row", F.pmod(F.xxhash64("block"), F.lit(1024))], ["row"]):
        out = out.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)
    return out.join(given.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best ``documents`` of each ``benchmark`` item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
     i AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
     t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, {_TERMS} AS term FROM d) GROUP BY r, term),
     n AS (SELECT r, sum(tf)::BIGINT AS n FROM t GROUP BY r),
     c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
     m AS (SELECT r, 50 + (50 * n * docs) // l AS m FROM n, c),
     f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, c GROUP BY term, docs),
     it AS (SELECT DISTINCT q, {_TERMS} AS term FROM i),
     s AS (SELECT q, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM it JOIN f USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY q, r),
     k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
           FROM s JOIN d USING (r) JOIN i USING (q) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 50
"""
