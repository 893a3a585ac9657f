"""First-fit decreasing with a tournament tree, in randomised groups of documents.

A document's ids are cut every ``capacity`` ids, so only documents above it are cut.  Full pieces are
sequences of their own.  The last pieces are dealt to groups by a hash of their row, a group being about
``GROUP_TOKENS`` ids or ``GROUP_PIECES`` pieces; a group is one task's work whatever the table's size.
In a group the pieces go, longest first, to the first sequence with room.  The tournament tree holds the
free room of each sequence in its leaves and the larger of two children in each inner node, so that
sequence is found in a walk from the root.  Sequences of two groups are never merged: each group ends
with one sequence that may be nearly empty, about ``capacity / GROUP_TOKENS`` of the ids in padding.

The pieces are a written table before they are grouped, so a lost executor repeats neither the tokenizer's
work nor the numbering of the rows.

Defined cases: a null or empty text is the end id alone; repeated documents, and documents with equal or
null ids, are packed each for itself; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm.bpe import encoder, public_path
from txgraph.llm.common import table, texts
from txgraph.session import cut

CAPACITY = 1024
#: Ids and pieces that a group is planned for.
GROUP_TOKENS = 1 << 22
GROUP_PIECES = 1 << 16
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; of equal pieces the first comes first."""
    total = int(lengths.sum())
    # of two sequences only the last can be filled to half or less
    most = max(1, min(len(lengths), 2 * total // capacity + 1))
    leaves = 1 << (most - 1).bit_length()
    room = [capacity] * (2 * leaves)
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for at, size in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        sequence[at] = node - leaves
        offset[at] = capacity - room[node]
        room[node] -= size
        while node > 1:
            node >>= 1
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return sequence, offset


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``capacity`` ids of each text, its last piece with what is left."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            for lo, hi, ids, off in enc.batches(b.column(1)):
                n = np.diff(off)
                k = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), k)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)) * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw = memoryview(ids.astype("<u4")).cast("B")
                a = (off[:-1][doc] + start) * 4
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), (a + length * 4).tolist())]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(start), pa.array(length),
                                       pa.array(crc, pa.int64()), pa.array(n[doc])],
                                      names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return texts(docs).mapInArrow(make, PIECES)


def pack_groups(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS,
                group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of ``docs`` (``doc_id, text``) with ``sequence_id`` (below 0: a full piece) and ``offset``."""
    p = cut(pieces(docs, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id()))
    whole = (p.where(F.col("length") == capacity)
             .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.col("row")).alias("sequence_id"),
                     F.lit(0).cast("long").alias("offset")))
    rest = p.where(F.col("length") < capacity)
    n = rest.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("ids"), F.count("*").alias("rows")).first()
    groups = max(1, math.ceil(n.ids / group_tokens), math.ceil(n.rows / group_pieces))

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        sequence, offset = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        first = group.column("grp")[0].as_py() << 32
        out = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return out.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))

    packed = (rest.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .groupBy("grp").applyInArrow(place, PIECES + ", sequence_id long, offset long"))
    return whole.unionByName(packed)


def op13_group_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens of the public 50k tokenizer."""
    return pack_groups(table(spark, sf_dir, "documents"), public_path())
