"""Language-model scores from a sharded Elias-Fano bigram trie.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, then one
end token; a text begins after a start context.  With the unigram base
``P1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))`` the model is the smoothed bigram

    ``P(w | b) = c(b w) / (c(b) + MU)  +  MU / (c(b) + MU) * P1(w)``.

Shape of the job, all of it growing with the corpus and none of it on the driver:

1. Words are counted (one grouping); ``N``, ``V`` and the words that hold 1/1024 of
   all tokens or more (so 1024 at most) are the only things collected.
2. Documents are grouped into blocks by a hash of id and text.  A block sends each
   of its *distinct* bigrams once, with its training count, to the shard of the context.
   A frequent bigram is one entry a block.  A context that holds 1/1024 of the tokens
   is spread over several shards by its next word.
3. A shard merges the counts into a trie in a file of the task's own folder, maps
   it into memory, and answers every block in the order of its question.
4. A block and its answers meet again, and the documents are scored.

Trie levels: contexts (sorted hashes), pointers to their child ranges, running
totals (whose differences are the exact context counts) and children, all monotone
and kept as Elias-Fano; the first summands of ``P`` as 8-bit codes of their
logarithm.  A child is stored relative to its context: the rank of its word in the
shard's vocabulary, plus the context's number times the vocabulary's size, so a lookup
is a successor search inside the context's range.

Words are 64-bit hashes.  The codes reach down to a bigram seen once in the largest context, so no summand is
raised: with contexts of up to 9 million tokens a code is within 3.3 % of the summand it stands for, with
one of 150 million within 3.8 %, and with one of 10 billion within 4.7 %.
A lost task is computed again from its shuffle input, its file included.

Defined cases: a null or empty text is one end token; repeated documents count
as often as they occur; a null id belongs to the training side; without training
documents every count is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm.common import parts_for, table, texts
from txgraph.llm.elias_fano import EliasFano
from txgraph.llm.kernels import distinct, lower_ascii, mix64, slice_hashes, space_tokens, text_chunks
from txgraph.llm.token_files import decode_values, encode_values
from txgraph.session import cut

#: Strength of the unigram base in the smoothed bigram.
MU = 64.0
#: Bigram entries that one shard is planned for.
SHARD_ENTRIES = 2_000_000
#: A context with one in so many tokens or more is spread over shards.
HOT_SHARE = 1024
START = np.uint64(0x53544152545F5F5F)
STOP = np.uint64(0x454E445F5F5F5F5F)
_SALT = np.uint64(0x9E3779B97F4A7C15)
#: Codes 1..255 stand for 10 ** -(code - 1) * step; this is the step unless a context needs a larger one.
STEP = 7.0 / 255


def code_step(largest: int, mu: float = MU) -> float:
    """Step of the codes with which a bigram seen once in a context of ``largest`` tokens has a code of its own."""
    return max(STEP, float(np.log10(largest + mu)) / 254)


def quantise(p: np.ndarray, step: float) -> np.ndarray:
    """8-bit codes of probabilities, 0 for none."""
    with np.errstate(divide="ignore"):
        code = 1 + np.rint(-np.log10(p) / step)
    return np.where(p > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


def levels(step: float) -> np.ndarray:
    """Probability of each code."""
    return np.concatenate([[0.0], 10.0 ** (-step * np.arange(255))])


class Trie:
    """Context -> next word, in one memory-mapped file."""

    PARTS = ("contexts", "pointers", "totals", "words", "children")

    @staticmethod
    def write(path: str, contexts: np.ndarray, totals: np.ndarray, pointers: np.ndarray,
              words: np.ndarray, children: np.ndarray, codes: np.ndarray) -> None:
        levels = {"contexts": contexts, "pointers": pointers, "words": words, "children": children,
                  "totals": np.concatenate([[0], np.cumsum(totals)])}
        with open(path, "wb") as f:
            index = []
            for part, values in levels.items():
                for name, a in EliasFano.build(values).arrays.items():
                    index.append((f"{part}.{name}", str(a.dtype), f.tell(), len(a)))
                    f.write(a.tobytes())
                    f.write(b"\0" * (-f.tell() % 8))
            index.append(("codes", "uint8", f.tell(), len(codes)))
            f.write(codes.tobytes())
            head = repr(index).encode()
            f.write(head + len(head).to_bytes(8, "little"))

    def __init__(self, path: str):
        import ast
        raw = np.memmap(path, np.uint8, "r")
        n = int.from_bytes(raw[-8:].tobytes(), "little")
        a = {name: raw[at:at + size * np.dtype(kind).itemsize].view(kind)
             for name, kind, at, size in ast.literal_eval(raw[-8 - n:-8].tobytes().decode())}
        for part in self.PARTS:
            setattr(self, part, EliasFano({k: a[f"{part}.{k}"] for k in EliasFano.NAMES}))
        self.codes = a["codes"]

    def lookup(self, contexts: np.ndarray, per: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each context, and the code of each word after its context (``per`` words for each)."""
        i = self.contexts.find(contexts)
        m = np.flatnonzero(i >= 0)
        total = np.zeros(len(contexts), np.int64)
        if len(m):
            total[m] = (self.totals.get(i[m] + 1) - self.totals.get(i[m])).astype(np.int64)
        code = np.zeros(len(words), np.uint8)
        row = np.repeat(i, per)
        known = np.flatnonzero(row >= 0)
        rank = self.words.find(words[known])
        known, rank = known[rank >= 0], rank[rank >= 0]
        if len(known):
            row = row[known]
            at = self.children.successor((row * self.words.n + rank).astype(np.uint64))
            inside = at < self.pointers.get(row + 1).astype(np.int64)
            known, row, rank, at = known[inside], row[inside], rank[inside], at[inside]
            same = self.children.get(at).astype(np.int64) == row * self.words.n + rank
            code[known[same]] = self.codes[at[same]]
        return total, code


def _tokens(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of the rows ``lo:hi`` and the words of each row."""
    for lo, hi, data, off in text_chunks(col):
        data = lower_ascii(data)
        start, end, row = space_tokens(data, off)
        yield lo, hi, slice_hashes(data, start, end), np.bincount(row, minlength=hi - lo)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of all texts, words as hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [h for _, _, h, _ in _tokens(b.column(0))]
            idx, word = distinct(np.concatenate(got) if got else np.zeros(0, np.uint64))
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(np.bincount(idx, minlength=len(word)))], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Block:
    """Tokens of a block of documents and its distinct bigrams in the order of the questions."""

    def __init__(self, t: pa.Table, shards: int, hot: dict[int, tuple[int, int]]):
        # the rows of a group come in any order; questions and answers need the same
        t = t.select(["doc_id", "text", "train"]).sort_by([("doc_id", "ascending"), ("text", "ascending"), ("train", "ascending")])
        self.doc_id = t.column("doc_id")
        self.train = t.column("train").to_numpy().astype(bool)
        hashes, per = [], []
        for _, _, h, k in _tokens(t.column("text")):
            hashes.append(h)
            per.append(k)
        n_words = np.concatenate(per) if per else np.zeros(0, np.int64)
        self.n = n_words + 1
        ends = np.cumsum(self.n) - 1
        word = np.full(int(self.n.sum()) + 1, START, np.uint64)  # the start context has a number too
        word[ends] = STOP
        inner = np.ones(len(word), bool)
        inner[ends], inner[-1] = False, False
        word[inner] = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        del hashes, inner
        number, self.words = distinct(word)
        del word
        number = number.astype(np.int32)  # a block has far fewer words than 2 ** 31
        self.word, start = number[:-1], number[-1]
        self.ctx = np.roll(self.word, 1)
        self.ctx[ends - n_words] = start
        pair, keys = distinct(self.ctx.astype(np.int64) * len(self.words) + self.word)
        pair = pair.astype(np.int32)
        c, w = np.divmod(keys, len(self.words))
        splits = np.ones(len(self.words), np.uint64)
        for i in np.flatnonzero(np.isin(self.words, np.fromiter(hot, np.uint64, len(hot)))):
            splits[i] = hot[int(self.words[i])][1]
        sub = mix64(self.words[w]) % splits[c]
        shard = (mix64(self.words[c] + sub * _SALT) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard * len(self.words) ** 2 + keys) if shards * len(self.words) ** 2 < 2 ** 62 \
            else np.lexsort((keys, shard))
        self.shard, self.c, self.w = shard[order].astype(np.int32), c[order].astype(np.int32), w[order].astype(np.int32)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.pair = place[pair]  # question of each token

    def counts(self) -> np.ndarray:
        """Training count of each distinct bigram."""
        m = np.repeat(self.train, self.n)
        return np.bincount(self.pair[m], minlength=len(self.c))

    def questions(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """For each shard: the bigrams' slice, the contexts, and the words after each."""
        edge = np.flatnonzero(np.diff(self.shard, prepend=-1, append=1 << 60))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            head = np.flatnonzero(np.diff(self.c[a:b], prepend=-1))
            yield int(self.shard[a]), slice(a, b), self.c[a:b][head], np.diff(np.append(head, b - a))


ASK = "shard int, block int, contexts binary, per binary, words binary, counts binary, control binary"
ANSWER = "block int, shard int, totals binary, codes binary"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, held_out: Column, mu: float = MU) -> DataFrame:
    """Score all documents with the model of those that are not ``held_out`` (a condition on ``doc_id``)."""
    spark = docs.sparkSession
    d = texts(docs).select("doc_id", "text", (~F.coalesce(held_out, F.lit(False))).alias("train"))
    vocab = cut(vocabulary(d.where("train")))
    tokens, kinds = vocab.agg(F.sum("n"), F.count("*")).first()
    n_docs, n_bytes = d.agg(F.count_if("train"), F.sum(F.octet_length("text"))).first()
    N, V = (tokens or 0) + n_docs, kinds + (n_docs > 0)
    least = max(1, N // HOT_SHARE)
    # at most HOT_SHARE words can hold so large a share
    frequent = {r.word & (2 ** 64 - 1): r.n for r in vocab.where(F.col("n") >= least).collect()} | {int(START): n_docs}
    # a word that is not among them has fewer tokens than ``least``
    step = code_step(max(least, *frequent.values()), mu)
    blocks = parts_for(n_bytes, spark)
    shards = parts_for((n_bytes or 0) // 6, spark, SHARD_ENTRIES)  # six bytes a token: a plan, not a limit
    hot = {w: (n, -(-2 * n * shards // N)) for w, n in frequent.items() if n >= least} if N else {}
    shared = spark.sparkContext.broadcast(hot)
    d = d.select("doc_id", "text", "train", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))

    def ask(t: pa.Table) -> pa.Table:
        b = _Block(t, shards, shared.value)
        n = b.counts()
        block = t.column("block")[0].as_py()
        rows = []
        for shard, at, ctx, per in b.questions():
            control, data = encode_values(n[at])
            rows.append((shard, block, b.words[ctx].tobytes(), per.astype("<u4").tobytes(),
                         b.words[b.w[at]].tobytes(), data, control))
        return pa.table([pa.array(x) for x in zip(*rows)], schema=_schema(ASK))

    def answer(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asked, seen = [], []
        for r in range(t.num_rows):
            ctx, per, words, data, control = (t.column(k)[r].as_py() for k in ("contexts", "per", "words", "counts", "control"))
            words = np.frombuffer(words, np.uint64)
            asked.append((np.frombuffer(ctx, np.uint64), np.frombuffer(per, "<u4").astype(np.int32), words))
            n = decode_values(control, data, len(words))
            some = n > 0  # keep what was seen in training
            seen.append((np.repeat(asked[-1][0], asked[-1][1])[some], words[some], n[some].astype(np.uint32)))
        ctx, words, n = (np.concatenate(x) for x in zip(*seen))
        del seen
        ci, cs = distinct(ctx)
        wi, ws = distinct(words)
        del ctx, words
        c_rank, w_rank = np.empty(len(cs), np.int64), np.empty(len(ws), np.int64)
        c_rank[np.argsort(cs)] = np.arange(len(cs))
        w_rank[np.argsort(ws)] = np.arange(len(ws))
        pi, ps = distinct(c_rank[ci] * len(ws) + w_rank[wi])
        del ci, wi
        count = np.bincount(pi, n, len(ps))
        del pi, n
        order = np.argsort(ps)
        children, count = ps[order], count[order]
        del ps, order
        parent = children // max(len(ws), 1)
        cs, ws = np.sort(cs), np.sort(ws)
        totals = np.bincount(parent, count, len(cs)).astype(np.int64)
        for w in hot_here(cs, shared.value):
            totals[w] = shared.value[int(cs[w])][0]
        codes = quantise(count / (totals[parent] + mu), step)
        with tempfile.TemporaryDirectory() as own:
            path = os.path.join(own, "trie")
            Trie.write(path, cs, totals, np.searchsorted(parent, np.arange(len(cs) + 1)), ws, children, codes)
            del children, count, parent, codes, cs, ws
            trie = Trie(path)
            out = [trie.lookup(a[0], a[1], a[2]) for a in asked]
            del trie
        return pa.table([t.column("block"), t.column("shard"), pa.array([x.astype("<i8").tobytes() for x, _ in out], pa.binary()),
                         pa.array([y.tobytes() for _, y in out], pa.binary())], schema=_schema(ANSWER))

    level = levels(step)

    def finish(t: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Block(t, shards, shared.value)
        row_of = {s: r for r, s in enumerate(answers.column("shard").to_pylist())}
        totals, coded = answers.column("totals"), answers.column("codes")
        count = np.zeros(len(b.words), np.int64)
        codes = np.zeros(len(b.c), np.uint8)
        for shard, at, ctx, _ in b.questions():
            count[ctx] = np.frombuffer(totals[row_of[shard]].as_py(), "<i8")
            codes[at] = np.frombuffer(coded[row_of[shard]].as_py(), np.uint8)
        of_context = count.astype(np.float64)
        count[np.flatnonzero(b.words == STOP)] = n_docs
        p1 = (count + 0.5) / (N + 0.5 * (V + 1))
        p = level[codes[b.pair]]
        p += (mu / (of_context + mu))[b.ctx] * p1[b.word]
        np.log10(p, out=p)
        at = np.cumsum(b.n) - b.n
        add = lambda x: np.add.reduceat(x, at) if len(at) else x
        return pa.table([b.doc_id, pa.array(~b.train), pa.array(b.n), pa.array(add((count[b.word] > 0).astype(np.int64))),
                         pa.array(np.full(len(at), N, np.int64)), pa.array(add(np.log10(p1)[b.word])), pa.array(add(p))],
                        schema=_schema(SCORES))

    answers = (d.groupBy("block").applyInArrow(ask, ASK)
               .groupBy("shard").applyInArrow(answer, ANSWER))
    return d.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORES)


def hot_here(contexts: np.ndarray, hot: dict[int, tuple[int, int]]) -> np.ndarray:
    """Places of the contexts that are spread over shards."""
    return np.flatnonzero(np.isin(contexts, np.fromiter(hot, np.uint64, len(hot))))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored; those with ``crc32(doc_id) % 5 = 1`` are held out of the model."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return score(table(spark, sf_dir, "documents"), held_out)
