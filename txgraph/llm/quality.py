"""Quality and toxicity scores by co-training a text view and a page-metadata view.

Text view: presence of white-space separated tokens (case kept), lower-cased words and
their first ``STEM`` bytes, hashed to ``DIM`` features, each weighted by the logarithm of how much more
often it occurs in one class, shrunk where it is rare.  Metadata view: source, language and length of the
page and its layout (lines, line length, shares of capitals, digits, signs and blanks), never
its words.

The labels are learned from at most ``LABELLED`` labelled rows, chosen by a hash of the id, of which a
quarter is kept for calibration; every other document is unlabelled.  In each of ``ROUNDS`` rounds Spark tasks
score *all* unlabelled documents with both views.  A document that one view is sure of (calibrated probability
of at least ``SURE``) is a pseudo-labelled row of the *other* view.  The tasks return only sums over these rows,
of a size fixed by ``DIM``: how often each text feature occurs in either class, and the moments of the metadata.
Both views are fitted again from the sums of the labelled and the pseudo-labelled rows, the latter of a class
weighing together no more than its labelled rows:

* text: weights are the log ratios of the summed counts, each times a weight that a logistic regression on the
  labelled rows learns; a feature seen in pseudo-labelled documents alone has the mean weight;
* metadata: the linear discriminant of the summed moments.

Last, the calibrated views' log odds are combined by a logistic regression on the calibration rows, and every
document is scored from its whole text.  The driver holds the labelled sample, sums and weights only.

Defined cases: a null text is empty, a null source, language or length is a value of its own (length:
that of the text); several labels of a document count as several rows (of several texts with the id,
the one with the smallest hash is learned from); null labels are left out; a
target with one label value only gives its share (0.5 without labels) to all; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm.common import table
from txgraph.llm.kernels import ascii_words, distinct, lower_ascii, slice_hashes, space_tokens, text_chunks
from txgraph.session import cut, discard

LABELLED = 4000
ROUNDS = 3
SURE = 0.95
BUCKETS = 1 << 16
STEM = 6  # bytes
DIM = 3 * BUCKETS
NAMES = 32  # hashed values of source and of lang
LAYOUT = 9
TARGETS = ("quality", "toxic")
META = LAYOUT + 1 + 2 * NAMES
#: Sums of one class of one target: rows and feature counts (text), rows, sums and products (metadata).
TEXT_SUMS, META_SUMS = 1 + DIM, 1 + META + META * META
CLASS_SUMS = TEXT_SUMS + META_SUMS
#: Metadata values are multiples of this, so that their sums do not depend on the order of the rows.
GRAIN = 1 / 1024


def text_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each feature present in a chunk's texts."""
    start, end, row = space_tokens(data, off)
    a = (slice_hashes(data, start, end) % np.uint64(BUCKETS)).astype(np.int64)
    low = lower_ascii(data)
    s2, e2, row2 = ascii_words(low, off)
    b = (slice_hashes(low, s2, e2) % np.uint64(BUCKETS)).astype(np.int64) + BUCKETS
    c = (slice_hashes(low, s2, np.minimum(s2 + STEM, e2)) % np.uint64(BUCKETS)).astype(np.int64) + 2 * BUCKETS
    _, keys = distinct(np.concatenate([row, row2, row2]) * DIM + np.concatenate([a, b, c]))
    return keys // DIM, keys % DIM


def layout(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Layout numbers of a chunk's texts."""
    def share(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask)])
        return (c[off[1:]] - c[off[:-1]]).astype(np.float64)

    n = np.diff(off).astype(np.float64)
    upper, digit = share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57))
    letter = share((data >= 97) & (data <= 122)) + upper
    line, blank = share(data == 10), share((data == 32) | ((data >= 9) & (data <= 13)))
    high = share(data >= 128)
    sign = n - letter - digit - blank - high
    m = np.maximum(n, 1)
    return np.stack([np.log1p(n), np.log1p(line), np.log1p(n / (line + 1)), upper / np.maximum(letter, 1), digit / m,
                     sign / m, blank / m, high / m, np.sqrt(sign / m)], 1)


def _named(col: pa.Array, seed: bytes) -> np.ndarray:
    d = col.cast(pa.string()).fill_null("\0").dictionary_encode()
    codes = np.array([zlib.crc32(seed + v.encode()) % NAMES for v in d.dictionary.to_pylist()] or [0], np.int64)
    return codes[d.indices.to_numpy(zero_copy_only=False)]


def metadata(b: pa.RecordBatch, lo: int, hi: int, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Dense metadata view of the rows ``lo:hi``."""
    x = np.zeros((hi - lo, META))
    x[:, :LAYOUT] = layout(data, off)
    chars = b.column("n_chars").slice(lo, hi - lo)
    x[:, LAYOUT] = np.log1p(np.maximum(pc.if_else(pc.is_null(chars), pa.array(np.diff(off)), chars).to_numpy(zero_copy_only=False), 0))
    i = np.arange(hi - lo)
    x[i, LAYOUT + 1 + _named(b.column("source").slice(lo, hi - lo), b"s")] = 1
    x[i, LAYOUT + 1 + NAMES + _named(b.column("lang").slice(lo, hi - lo), b"l")] = 1
    return x


def scaled(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    return np.rint((x - mean) / std / GRAIN) * GRAIN


class Texts:
    """Text view of the labelled sample: rows of present features, scaled to unit length."""

    def __init__(self, rows: list[np.ndarray]):
        self.n, self.rows = len(rows), rows
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.row = np.repeat(np.arange(self.n), self.sizes)
        self.col = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
        self.value = (1 / np.sqrt(np.maximum(self.sizes, 1)))[self.row]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col] * self.value, self.n)

    def take(self, i: np.ndarray) -> "Texts":
        return Texts([self.rows[k] for k in i])


def class_sums(row: np.ndarray, col: np.ndarray, x: np.ndarray, teach_text: np.ndarray, teach_meta: np.ndarray) -> np.ndarray:
    """``CLASS_SUMS`` numbers over the rows marked for the text view and those marked for the metadata view."""
    m = x[teach_meta]
    return np.concatenate([[teach_text.sum()], np.bincount(col[teach_text[row]], minlength=DIM),
                           [len(m)], m.sum(0), (m.T @ m).reshape(-1)])


def balanced(base: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Sums of labelled and pseudo-labelled rows (``2, size``; first the rows), the latter weighing no more than the former."""
    share = np.minimum(1, base[:, 0] / np.maximum(more[:, 0], 1))
    return base + more * share[:, None]


def fit_text(x: Texts, y: np.ndarray, sums: np.ndarray, l2: float = 1e-5, steps: int = 60, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights from the log ratios of the counts, refined on the labelled rows; both classes of equal weight."""
    (r0, n0), (r1, n1) = ((c[0], c[1:]) for c in sums)
    ratio = np.log((n1 + 0.5) / (r1 + 1)) - np.log((n0 + 0.5) / (r0 + 1))
    df = n0 + n1
    factor = np.where(df >= 3, ratio * df / (df + 3), 0.0)  # shrunk where rare
    # weights are learned for the features that the labelled rows show often enough
    known = np.flatnonzero(np.bincount(x.col, minlength=DIM) >= 3)
    place = np.full(DIM, -1)
    place[known] = np.arange(len(known))
    seen = place[x.col] >= 0
    row, col, value = x.row[seen], place[x.col[seen]], (factor[x.col] * x.value)[seen]
    w, bias = np.zeros(len(known)), 0.0
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for t in range(1, steps + 1):
        r = weight * (sigmoid(np.bincount(row, w[col] * value, x.n) + bias) - y)
        g = np.append(np.bincount(col, r[row] * value, len(known)) + l2 * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        w, bias = w - step[:-1], bias - step[-1]
    size = np.abs(factor[known])
    every = np.full(DIM, (w @ size) / max(size.sum(), 1e-9))  # of the others: the mean weight
    every[known] = w
    return every * factor, bias


def fit_meta(sums: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Linear discriminant from both classes' rows, sums and products, both classes of equal weight."""
    mean = sums[:, 1:1 + META] / sums[:, :1]
    cov = sum(c[1 + META:].reshape(META, META) / c[0] - np.outer(k, k) for c, k in zip(sums, mean)) / 2
    w = np.linalg.solve(cov + ridge * np.eye(META), mean[1] - mean[0])
    return w, float(-w @ (mean[0] + mean[1]) / 2)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a small logistic regression of ``y`` on the columns of ``z``, by Newton steps with a weak prior."""
    x = np.column_stack([z, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w), -2, 2)
    return w


class Learner:
    """Co-training of one target on the labelled sample and on sums over pseudo-labelled rows.

    Every fourth labelled row calibrates.  ``views`` holds for each view weights, bias and calibration;
    it is empty if a class is missing.
    """

    def __init__(self, text: Texts, meta: np.ndarray, y: np.ndarray):
        known = np.flatnonzero(~np.isnan(y))
        held, base = known[np.arange(len(known)) % 4 == 3], known[np.arange(len(known)) % 4 != 3]
        self.share = float((y[known].sum() + 0.5) / (len(known) + 1))
        self.views = []
        if any(len(np.unique(y[k])) < 2 for k in (held, base)):
            return
        self.y, self.text = y[base], text.take(base)
        self.held_y, self.held_text, self.held_meta = y[held], text.take(held), meta[held]
        self.sums = np.stack([class_sums(self.text.row, self.text.col, meta[base], self.y == c, self.y == c) for c in (0, 1)])
        self.learn(np.zeros((2, CLASS_SUMS)))

    def learn(self, pseudo: np.ndarray) -> None:
        """Fit both views anew from the labelled rows and the sums of the pseudo-labelled ones."""
        text, meta = (balanced(self.sums[:, at], pseudo[:, at]) for at in (slice(TEXT_SUMS), slice(TEXT_SUMS, None)))
        wt, bt = fit_text(self.text, self.y, text)
        wm, bm = fit_meta(meta)
        z = self.held_text.dot(wt) + bt, self.held_meta @ wm + bm
        cal = [calibrate(k[:, None], self.held_y) for k in z]
        self.odds = np.column_stack([k * c[0] + c[1] for k, c in zip(z, cal)])
        # the calibration worked in
        self.views = [(w * c[0], b * c[0] + c[1]) for (w, b), c in zip(((wt, bt), (wm, bm)), cal)]

    def model(self) -> dict:
        """One weight vector a view, the calibration and the mixing worked in."""
        if not self.views:
            return {"share": self.share}
        mix = calibrate(self.odds, self.held_y)
        (wt, bt), (wm, bm) = self.views
        return {"text": wt * mix[0], "meta": wm * mix[1], "bias": float(bt * mix[0] + bm * mix[1] + mix[2])}


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a few megabytes of text with their text features (row and feature) and metadata."""
    for b in batches:
        for lo, hi, data, off in text_chunks(b.column("text")):
            row, col = text_features(data, off)
            yield b.slice(lo, hi - lo), row, col, metadata(b, lo, hi, data, off)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, pa.Table]:
    """The chosen labels, and their documents' features, ``LABELLED`` rows at most, in a fixed order."""
    chosen = cut(labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(t).cast("double").alias(t) for t in TARGETS])
                 .where(" or ".join(f"{t} is not null" for t in TARGETS)).orderBy(F.xxhash64("doc_id"), *TARGETS).limit(LABELLED))
    d = _columns(docs).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    one = d.groupBy("doc_id").agg(F.min_by(F.struct(*COLUMNS[1:]), F.xxhash64(*COLUMNS[1:])).alias("d")).select("doc_id", "d.*")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, col, x in _chunks(batches):
            order = np.argsort(row * DIM + col)
            at = np.searchsorted(row[order], np.arange(part.num_rows + 1))
            col = col[order].astype("<i4")
            yield pa.record_batch([part.column("doc_id"), pa.array([col[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()),
                                   pa.array([v.tobytes() for v in x], pa.binary())], names=["doc_id", "text", "meta"])

    got = one.mapInArrow(features, "doc_id long, text binary, meta binary").join(F.broadcast(chosen), "doc_id")
    return chosen, got.toArrow().sort_by([(c, "ascending") for c in ("doc_id", *TARGETS)])


def pseudo_sums(docs: DataFrame, model: dict) -> dict[str, np.ndarray]:
    """For each target the ``2, CLASS_SUMS`` sums over the documents that the views are sure of."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    names = list(model["views"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros((len(names), 2, CLASS_SUMS))
        for part, row, col, x in _chunks(batches):
            x = scaled(x, model["mean"], model["std"])
            per = np.sqrt(np.maximum(np.bincount(row, minlength=part.num_rows), 1))
            for k, t in enumerate(names):
                (wt, bt), (wm, bm) = model["views"][t]
                by_text = sigmoid(np.bincount(row, wt[col], part.num_rows) / per + bt)
                by_meta = sigmoid(x @ wm + bm)
                for c in (0, 1):
                    of_text, of_meta = ((p if c else 1 - p) >= SURE for p in (by_text, by_meta))
                    total[k, c] += class_sums(row, col, x, of_meta, of_text)  # each view teaches the other
        flat = total.reshape(-1)
        for at in np.array_split(np.flatnonzero(flat), max(1, len(flat) >> 16)):
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["i", "v"])

    got = _columns(docs).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    shared.unpersist()
    flat = np.zeros(len(names) * 2 * CLASS_SUMS)
    flat[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return dict(zip(names, flat.reshape(len(names), 2, CLASS_SUMS)))


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Models of all targets and the scale of the metadata view."""
    chosen, got = labelled_sample(docs, labels)
    x = np.array([np.frombuffer(v.as_py(), np.float64) for v in got.column("meta")]).reshape(-1, META)
    mean, std = (x.mean(0), x.std(0)) if len(x) else (np.zeros(META), np.ones(META))
    std = np.where(std > 0, std, 1)
    text = Texts([np.frombuffer(v.as_py(), "<i4") for v in got.column("text")])
    learners = {t: Learner(text, scaled(x, mean, std), got.column(t).to_numpy().astype(np.float64)) for t in TARGETS}
    rest = docs.join(F.broadcast(chosen.select(F.col("doc_id").alias("_id")).distinct()), F.col("doc_id").cast("long") == F.col("_id"), "left_anti")
    some = {t: k for t, k in learners.items() if k.views}
    for _ in range(ROUNDS if some else 0):
        sums = pseudo_sums(rest, {"mean": mean, "std": std, "views": {t: k.views for t, k in some.items()}})
        for t, k in some.items():
            k.learn(sums[t])
    discard(chosen)
    return {"mean": mean, "std": std, **{t: k.model() for t, k in learners.items()}}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id`` and the probability of each target, of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, row, col, x in _chunks(batches):
            n = part.num_rows
            per = np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
            x = scaled(x, model["mean"], model["std"])
            out = []
            for t in TARGETS:
                m = model[t]
                out.append(np.full(n, m["share"]) if "share" in m else
                           sigmoid(np.bincount(row, m["text"][col], n) / per + x @ m["meta"] + m["bias"]))
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, out)], names=["doc_id", *TARGETS])

    return _columns(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{t} double" for t in TARGETS))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of all ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    s = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return s.select("doc_id", F.col("quality").alias("quality_score"), F.col("toxic").alias("toxic_score"),
                    (F.col("toxic") >= 0.5).alias("toxic"), ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("keep"))
