"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from its code point; a
trigram's vector binds its three letters' vectors, shifted by their places, by
multiplication; a text's vector bundles (adds) its trigrams', and a language's
prototype bundles all its training texts.  A text's language is the prototype
with the largest cosine.

Letters are lower-cased; whatever lies between letters counts as one blank, and a
text begins and ends with one.  Bundling is linear, so training adds trigram counts
first and multiplies them with the trigram vectors once a task; scoring multiplies
the count matrix of some documents with the vectors of their trigrams.  All sums are
integers, so results do not depend on the order of rows.

Only the prototypes, one vector for each ``lang`` value, are collected.  More than
``MAX_LANGS`` values are an error.

Defined cases: a null text or one without letters is ``und`` with score 0; without any
training text everything is ``und``; equal cosines go to the first language by name;
a null id is on the training side; null ``lang`` rows are not learned from; an empty
table gives no rows; other columns are kept by ``filter_language``, which holds no rows out, and ignored by ``predict``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm.common import table
from txgraph.llm.kernels import LETTER, char_classes, decode_points, distinct, mix64, text_chunks

DIM = 1024
MAX_LANGS = 20_000
#: Documents whose counts are multiplied at once.
ROWS = 256
UNKNOWN = "und"
BLANK = 32


@functools.cache
def lower_letters() -> np.ndarray:
    """Lower-case code point of each letter, blank for anything else."""
    out = np.full(0x110000, BLANK, np.uint32)
    letters = np.flatnonzero(char_classes() == LETTER)
    for c in letters.tolist():
        low = chr(c).lower()
        out[c] = ord(low) if len(low) == 1 else c
    return out


def letter_vectors(points: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Random signs of each code point, the same on every machine."""
    words = mix64(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(-(-dim // 64), dtype=np.uint64) + np.uint64(1))
    bits = np.unpackbits(words.view(np.uint8), axis=1, count=dim)
    return (bits.astype(np.int8) * 2 - 1)


def trigram_vectors(grams: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Bound vectors of trigrams, each three code points in one integer."""
    a, b, c = grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF
    points = np.unique(np.concatenate([a, b, c]))
    v = letter_vectors(points, dim)
    at = lambda x: np.searchsorted(points, x)
    return np.roll(v, 2, axis=1)[at(a)] * np.roll(v, 1, axis=1)[at(b)] * v[at(c)]


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of a chunk's texts, the row of each, and which rows have a letter."""
    cp, coff, _ = decode_points(data, off)
    n = len(off) - 1
    # a blank on both sides of each text
    sym = np.full(len(cp) + 2 * n, BLANK, np.uint32)
    row = np.repeat(np.arange(n), np.diff(coff) + 2)
    inner = np.ones(len(sym), bool)
    inner[coff[:-1] + 2 * np.arange(n)] = False
    inner[coff[1:] + 2 * np.arange(n) + 1] = False
    sym[inner] = lower_letters()[cp]
    has = np.bincount(row[sym != BLANK], minlength=n) > 0
    double = np.zeros(len(sym), bool)
    double[1:] = (sym[1:] == BLANK) & (sym[:-1] == BLANK) & (row[1:] == row[:-1])
    sym, row = sym[~double].astype(np.int64), row[~double]
    if len(sym) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    same = row[2:] == row[:-2]
    return ((sym[:-2] << 42) | (sym[1:-1] << 21) | sym[2:])[same], row[2:][same], has


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and their unit prototypes, from ``text`` and ``lang``."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[int, int]] = {}
        sums: dict[str, np.ndarray] = {}

        def add() -> None:
            for lang, c in counts.items():
                g = np.fromiter(c, np.int64, len(c))
                n = np.fromiter(c.values(), np.float64, len(c))
                for a in range(0, len(g), 8192):
                    part = n[a:a + 8192] @ trigram_vectors(g[a:a + 8192]).astype(np.float64)
                    sums[lang] = sums.get(lang, 0) + part
            counts.clear()

        for b in batches:
            langs = b.column(1).dictionary_encode()
            names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            for lo, hi, data, off in text_chunks(b.column(0)):
                gram, row, _ = trigrams(data, off)
                gi, grams = distinct(gram)
                pair, keys = distinct(code[lo:hi][row].astype(np.int64) * max(len(grams), 1) + gi)
                n = np.bincount(pair, minlength=len(keys))
                for k, g, m in zip((keys // max(len(grams), 1)).tolist(), grams[keys % max(len(grams), 1)].tolist(), n.tolist()):
                    c = counts.setdefault(names[k], {})
                    c[g] = c.get(g, 0) + m
                if sum(map(len, counts.values())) > 200_000:
                    add()
        add()
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([np.rint(v).astype(np.int64) for v in sums.values()])], names=["lang", "v"])

    parts = docs.where("lang is not null").select(F.coalesce("text", F.lit("")).alias("text"), "lang").mapInArrow(bundle, "lang string, v array<long>")
    rows = (parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("s"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("v"))  # DIM entries each
            .select("lang", F.col("v.s").alias("v")).orderBy("lang").limit(MAX_LANGS + 1).collect())
    if len(rows) > MAX_LANGS:
        raise ValueError(f"lang has more than {MAX_LANGS} values")
    m = np.array([r.v for r in rows], np.float64).reshape(len(rows), DIM)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return [r.lang for r in rows], np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def classify(col: pa.Array, names: list[str], protos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's language (-1: ``und``) and its cosine from 0 to 1."""
    best, cosine = np.full(len(col), -1, np.int64), np.zeros(len(col))
    if not names:
        return best, cosine
    protos = protos.astype(np.float32).T
    for lo, hi, data, off in text_chunks(col):
        for a in range(0, hi - lo, ROWS):
            z = min(a + ROWS, hi - lo)
            gram, row, has = trigrams(data[off[a]:off[z]], off[a:z + 1] - off[a])
            gi, grams = distinct(gram)
            h = np.zeros((z - a, DIM), np.float32)
            step = 1 << 15  # trigrams at once
            for g in range(0, len(grams), step):
                m = (gi >= g) & (gi < g + step) if len(grams) > step else slice(None)
                t = min(step, len(grams) - g)
                counts = np.bincount(row[m] * t + gi[m] - g, minlength=(z - a) * t).reshape(z - a, t)
                h += counts.astype(np.float32) @ trigram_vectors(grams[g:g + step]).astype(np.float32)
            dots = h @ protos
            norm = np.linalg.norm(h, axis=1)
            top = np.argmax(dots, axis=1)
            cos = np.divide(dots[np.arange(z - a), top], norm, out=np.zeros(z - a, np.float32), where=norm > 0)
            best[lo + a:lo + z] = np.where(has, top, -1)
            cosine[lo + a:lo + z] = np.where(has, np.clip(cos, 0, 1), 0)
    return best, cosine


def held_out_rule() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all documents, learned from those not held out."""
    held_out = held_out_rule() if held_out is None else held_out
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    names, protos = prototypes(d.where("not held_out").select("text", "lang"))
    shared = d.sparkSession.sparkContext.broadcast((names, protos))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, protos = shared.value
        for b in batches:
            best, cosine = classify(b.column(2), names, protos)
            lang = pa.array([*names, UNKNOWN]).take(pa.array(np.where(best < 0, len(names), best)))
            yield pa.record_batch([b.column(0), b.column(1), lang, pa.array(cosine)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    return d.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def filter_language(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language with at least ``min_score``; all columns stay.

    All labelled rows are learned from, as nothing is measured here, and a null ``lang`` becomes the language found.
    """
    names, protos = prototypes(docs.select("text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast((names, protos))
    at, label = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, protos = shared.value
        for b in batches:
            best, cosine = classify(b.column(at), names, protos)
            found = pa.array(names, b.column(label).type).take(pa.array(best, mask=best < 0))
            b = b.set_column(label, b.schema.field(label), pc.coalesce(b.column(label), found))
            yield b.filter(pc.and_(pa.array(best >= 0), pa.array(cosine >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``; those with ``crc32(doc_id) % 4 = 2`` are held out."""
    return predict(table(spark, sf_dir, "documents"))
