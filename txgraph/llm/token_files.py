"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are replaced by their frequency rank over the whole corpus (ties: the lower
id first), so the common ones need one byte.  A value takes 1 to 4 bytes; its length minus one
is a two-bit field of a separate control stream, four values a control byte,
and its bytes lie in the data stream, lowest first.  A reader finds the lengths
of four values at once by a 256-row table over the control bytes.

File format: a folder with two Parquet tables, so that any file system Spark
writes to can hold it and Spark's committer makes it whole.  ``ranks`` maps rank
to id.  ``blocks`` holds blocks of whole documents in ascending ``doc_id`` order:
``part, block`` (order of the blocks), ``start`` (ids in the part before it),
``doc_ids``, ``lens`` (ids of each, end id included), ``control``, ``data``.

Defined cases: a null or empty text is the end id alone; equal or null doc_ids
stay, ordered by ``doc_id`` (nulls first), then text; other columns are ignored;
an empty table gives files without blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.bpe import encoder, public_path
from txgraph.llm.common import parts_for, table, text_bytes, texts
from txgraph.session import checkpoint_dir

#: Ids of a block; a longer document is a block of its own.
BLOCK_IDS = 1 << 19

BLOCKS = "part int, block int, start long, doc_ids array<long>, lens array<int>, control binary, data binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode_values(v: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = v.astype(np.uint32)
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    pad = np.zeros(-len(v) % 4, np.uint8)
    c = np.concatenate([code, pad]).astype(np.uint8).reshape(-1, 4)
    control = c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6
    raw = v.astype("<u4").view(np.uint8).reshape(-1, 4)
    keep = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.astype(np.uint8).tobytes(), raw[keep].tobytes()


#: Lengths of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``encode_values``, by table lookup on the control bytes."""
    lens = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lens) - lens
    d = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = d[at].astype(np.uint32)
    for k in (1, 2, 3):
        m = np.flatnonzero(lens > k)
        out[m] |= d[at[m] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def id_counts(docs: DataFrame, path: str) -> DataFrame:
    """``id, n``: how often each id occurs in all texts, end ids included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        total = np.zeros(enc.vocab, np.int64)
        for b in batches:
            for _, _, ids, _ in enc.batches(b.column(0)):
                total += np.bincount(ids, minlength=enc.vocab)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    return docs.select("text").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Encode all texts of ``docs`` (``doc_id, text``) into the files of ``folder``."""
    spark = docs.sparkSession
    docs = texts(docs)
    # at most one row for each vocabulary entry
    ranked = [r.id for r in id_counts(docs, tokenizer).orderBy(F.desc("n"), "id").select("id").toLocalIterator()]
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    to_rank = np.zeros(max([0, *ranked]) + 1, np.uint32)
    to_rank[ranked] = np.arange(len(ranked))
    shared = spark.sparkContext.broadcast(to_rank)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc, rank = encoder(tokenizer), shared.value
        start = k = 0
        ids_of, lens_of, docs_of, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal start, k, ids_of, lens_of, docs_of, held
            lens = np.concatenate(lens_of).astype(np.int32)
            control, data = encode_values(rank[np.concatenate(ids_of)])
            row = pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([[x for one in docs_of for x in one]], pa.list_(pa.int64())),
                 pa.array([lens], pa.list_(pa.int32())), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "block", "start", "doc_ids", "lens", "control", "data"])
            start, k = start + held, k + 1
            ids_of, lens_of, docs_of, held = [], [], [], 0
            return row

        for b in batches:
            doc_ids = b.column(0)
            for lo, hi, ids, off in enc.batches(b.column(1)):
                if held and held + len(ids) > BLOCK_IDS:
                    yield flush()
                ids_of.append(ids)
                lens_of.append(np.diff(off))
                docs_of.append(doc_ids.slice(lo, hi - lo).to_pylist())
                held += len(ids)
        if held:
            yield flush()

    n = parts_for(text_bytes(docs), spark)
    (docs.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(blocks, BLOCKS).write.parquet(f"{folder}/blocks"))


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""
    to_id = np.zeros(spark.read.parquet(f"{folder}/ranks").count(), np.uint32)
    for r in spark.read.parquet(f"{folder}/ranks").toLocalIterator():  # bounded by the vocabulary
        to_id[r.rank] = r.id
    shared = spark.sparkContext.broadcast(to_id)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # one row for each part; the window is over those alone
    size = F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.groupBy("part").agg(F.sum(size).alias("n"))
    before = totals.select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = shared.value
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1)
                lens = row.column("lens").values.slice(row.column("lens").offsets[0].as_py(), len(row.column("lens")[0]))
                lens = lens.to_numpy().astype(np.int64)
                n = int(lens.sum())
                ids = ids_of[decode_values(row.column("control")[0].as_py(), row.column("data")[0].as_py(), n)].astype("<u4")
                cum = np.cumsum(lens)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - m):4 * e]) for e, m in zip(cum.tolist(), lens.tolist())]
                cols = [row.column("doc_ids")[0].values, pa.array(row.column("start")[0].as_py() + cum - lens),
                        pa.array(lens), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(np.split(ids.astype(np.int32), cum[:-1]), pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(cols, names=names)

    return (blocks.join(before, "part")
            .select("doc_ids", "lens", "control", "data", (F.col("start") + F.col("before")).alias("start"))
            .mapInArrow(decode, READ + (", ids array<int>" if with_ids else "")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written to token files with the public 50k tokenizer and read back."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), folder, public_path())
    return read(spark, folder)
