import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import VOCAB
from tokenizers import Tokenizer

from txgraph.llm import chat_threads, language_id, line_dedup, near_dedup, ngram_lm, packing, quality, spotsigs, token_files, winnowing
from txgraph.llm.bpe import public_path

SF = "/root/testdata/sf0.001"


def corpus(name="documents"):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def id_lists(rows):
    t = Tokenizer.from_file(public_path())
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4") for x in rows]


# --- 1: language-model scores

def model_scores(docs, held, mu):
    tok = [[*re.findall("[^\x20\x09-\x0D]+", brute.lower(t)), None] for _, t in docs]
    c, pair, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for (i, _), t in zip(docs, tok):
        if not held(i):
            c.update(t)
            ctx.update(["<s>", *t[:-1]])
            pair.update(zip(["<s>", *t[:-1]], t))
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    for t in tok:
        yield (len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(p1(w)) for w in t),
               sum(math.log10((pair[b, w] + mu * p1(w)) / (ctx[b] + mu)) for b, w in zip(["<s>", *t[:-1]], t)))


def check_scores(got, docs, held):
    want = collections.Counter((i, *x[:3], round(x[3], 6)) for (i, _), x in zip(docs, model_scores(docs, held, ngram_lm.MU)))
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    model = {(i, round(x[3], 6)): x[4] for (i, _), x in zip(docs, model_scores(docs, held, ngram_lm.MU))}
    for r in got:  # a code is within half a step of the logarithm it stands for
        assert abs(r.score - model[r.doc_id, round(r.base_score, 6)]) <= 0.5001 * ngram_lm.STEP * r.n_tokens
        assert r.held_out == held(r.doc_id)


def test_lm_scores(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    docs = [(r["doc_id"], r["text"]) for r in corpus()]
    got = ngram_lm.op1_lm_score(spark, SF).collect()
    check_scores(got, docs, held)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(ngram_lm, "HOT_SHARE", 20)  # several contexts are spread over shards
    held = lambda i: i is not None and i % 3 == 1
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_scores(ngram_lm.score(odd_docs, F.col("doc_id") % 3 == 1).collect(), docs, held)
    assert ngram_lm.score(no_docs, F.col("doc_id") % 3 == 1).count() == 0
    alone = ngram_lm.score(odd_docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in alone)


# --- 2: near duplicates

def test_near_classes_equal_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in corpus())
    got = {r.doc_id: r for r in near_dedup.op2_near_dedup(spark, SF).collect()}
    first = brute.near_classes(docs)
    assert [got[i].class_id for i, _ in docs] == [docs[k][0] for k in first]
    assert [got[i].kept for i, _ in docs] == [k == n for n, k in enumerate(first)]


def test_near_group_and_chain(spark):
    """A large group of near copies, and a chain whose ends are unlike."""
    r = random.Random(1)
    base = [r.choice(VOCAB) + str(k) for k in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        w[r.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(w)))
    link = [r.choice(VOCAB) + f"q{k}" for k in range(200)]
    for step in range(6):
        w = list(link)
        w[:step * 12] = [f"n{j}" for j in range(step * 12)]
        rows.append((1000 + step, " ".join(w)))
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.near_classes(rows)
    assert [got[i] for i, _ in rows] == [rows[k][0] for k in want]


def test_near_odd_rows(odd_docs, no_docs):
    docs = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    got = near_dedup.classes(odd_docs).collect()
    want = brute.near_classes(docs)
    assert collections.Counter((r.doc_id, r.class_id) for r in got) == collections.Counter((i, docs[k][0]) for (i, _), k in zip(docs, want))
    kept = near_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(want))
    assert near_dedup.keep_first(no_docs).count() == 0


def test_darts_estimate_weighted_jaccard():
    a, b = np.arange(1, 801, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(201, 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = near_dedup.darts(np.concatenate([a, b, a[:3]]), np.repeat([0, 1, 3], [800, 800, 3]), 4, 2000)
    assert (s[2] == 2 ** 64 - 1).all() and (s[[0, 1, 3]] != 2 ** 64 - 1).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.05


# --- 3: lines

def check_lines(docs, got):
    docs = sorted(docs, key=lambda d: d[0])
    assert {i: g for (i, _), g in zip(docs, brute.removed_lines(docs))} == \
        {r.doc_id: {int(x) for x in r.removed_lines.split(",") if x} for r in got}


def test_lines_equal_brute_force(spark):
    check_lines([(r["doc_id"], r["text"]) for r in corpus()], line_dedup.op3_line_dedup(spark, SF).collect())


def test_line_variants_of_a_hot_line(spark, tmp_path, monkeypatch):
    from txgraph.llm import setjoin
    monkeypatch.setattr(setjoin, "HOT", 8)
    r = random.Random(2)
    base = [r.choice(VOCAB) + str(k) for k in range(25)]
    rows = []
    for k in range(80):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(25)] = r.choice(VOCAB) + "y"
        rows.append((k, " ".join(w) + "\n" + " ".join(r.choice(VOCAB) for _ in range(12))))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check_lines(rows, line_dedup.op3_line_dedup(spark, str(tmp_path)).collect())


def test_lines_odd_rows(odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    texts = collections.defaultdict(list)
    for r in out.collect():
        texts[r.doc_id].append(r.text)
    assert texts[3] == [None] and texts[2] == [""] and texts[7] == ["!!! ???"]
    # the line of the row without id is the first one, so those of document 1 go
    assert len(texts[None][0].split()) == 30 and all(len(t.split("\n")) == 1 for t in texts[1])
    assert texts[4][0] == texts[4][1] and texts[4][0]
    assert line_dedup.dedup_lines(no_docs).count() == 0


# --- 4: languages

def test_language_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in corpus()}
    held = [r for r in language_id.op4_language_id(spark, SF).collect() if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_equals_plain_vectors(spark):
    """Prototypes and cosines from letter vectors, one text at a time."""
    texts = [("aab abc", "x"), ("bca cab aab", "x"), ("zyx xyz zzy", "y"), ("Zyz", "y")]
    d = spark.createDataFrame([(t, g) for t, g in texts], "text string, lang string")
    names, protos = language_id.prototypes(d)

    def vector(t):
        s = f" {t.lower()} "
        v = {c: language_id.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in s}
        return sum(np.roll(v[s[i]], 2) * np.roll(v[s[i + 1]], 1) * v[s[i + 2]] for i in range(len(s) - 2))

    for k, g in enumerate(("x", "y")):
        want = sum(vector(t) for t, lang in texts if lang == g)
        assert np.allclose(protos[k], want / np.linalg.norm(want))
    import pyarrow as pa
    best, cos = language_id.classify(pa.array(["abca", None, "12 !", "zyxz"]), names, protos)
    v = vector("abca")
    assert best.tolist() == [0, -1, -1, 1] and abs(cos[0] - v @ protos[0] / np.linalg.norm(v)) < 1e-5


def test_language_odd_rows(odd_docs, no_docs):
    got = collections.defaultdict(list)
    for r in language_id.predict(odd_docs).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
        assert 0 <= r.score <= 1
    assert got[2] == got[3] == got[7] == got[9] == [("und", 0.0)] and len(got[1]) == len(got[4]) == 2
    assert language_id.predict(no_docs).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language_id.filter_language(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (2, 3, 7, 9)").count() == 0 and kept.count() == odd_docs.count() - 4


# --- 5 and 7: tokens

def test_token_files_round_trip(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in corpus())
    got = {r.doc_id: r for r in token_files.op5_token_files(spark, SF).collect()}
    start = 0
    for (i, _), ids in zip(docs, id_lists([t for _, t in docs])):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_odd_rows(spark, odd_docs, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    token_files.write(odd_docs, f"{tmp_path}/a", public_path())
    got = sorted(token_files.read(spark, f"{tmp_path}/a", with_ids=True).collect(), key=lambda r: r.start)
    docs = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
    assert [(r.doc_id, r.ids) for r in got] == [(i, x.tolist()) for (i, _), x in zip(docs, id_lists([t for _, t in docs]))]
    token_files.write(no_docs, f"{tmp_path}/b", public_path())
    assert token_files.read(spark, f"{tmp_path}/b").count() == 0


def check_packing(rows, ids, cap=2048):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for s in by.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= cap
    pieces = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = collections.Counter()
    for i, x in ids:
        k = -(-len(x) // cap)
        first = len(x) - (k - 1) * cap
        for p in range(k):
            a = 0 if p == 0 else first + (p - 1) * cap
            z = first + p * cap
            want[i, p, a, z - a, zlib.crc32(x[a:z].tobytes())] += 1
    assert pieces == want
    return len(by)


def test_packing(spark):
    docs = corpus()
    ids = list(zip([r["doc_id"] for r in docs], id_lists([r["text"] for r in docs])))
    n = check_packing(packing.op7_packing(spark, SF).collect(), ids)
    assert n <= 1 + -(-sum(len(x) for _, x in ids) // 2048)


def test_packing_odd_rows(odd_docs, no_docs):
    docs = odd_docs.collect()
    check_packing(packing.pack(odd_docs, public_path(), 64).collect(), list(zip([r.doc_id for r in docs], id_lists([r.text for r in docs]))), 64)
    assert packing.pack(no_docs, public_path()).count() == 0


# --- 6: quality

def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = quality.score(docs, quality.train(docs, labels.where(~out))).withColumnRenamed("quality", "p").withColumnRenamed("toxic", "t")
    rows = labels.where(out).join(got, "doc_id").collect()
    assert sum((r.p >= 0.5) == (r.quality == 1) for r in rows) >= 0.9 * len(rows)
    assert sum((r.t >= 0.5) == (r.toxic == 1) for r in rows) >= 0.9 * len(rows)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 1, None, "x"), (None, 0, 1, "y"), (2, None, None, "z"), (99, 0, 0, "w")],
                                   "doc_id long, quality int, toxic int, lang string")
    got = quality.score(odd_docs, quality.train(odd_docs, labels)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.quality <= 1 and 0 <= r.toxic <= 1 for r in got)
    none = quality.train(odd_docs, labels.where("1 = 0"))
    assert {r.quality for r in quality.score(odd_docs, none).collect()} == {0.5}
    assert quality.score(no_docs, quality.train(no_docs, labels)).count() == 0


# --- 8: conversations

def test_threads_follow_quotes(spark):
    rows = [(1, 0, "user", "Where is the blue house of the mayor?\nAlso, when does it open?"),
            (1, 1, "assistant", "It stands behind the old market square."),
            (1, 2, "user", "On Monday bot wrote:\n> Where is the BLUE  house of the mayor?\nI asked about the garden too."),
            (1, 3, "assistant", "> I asked about the garden too.\n>> Where is the blue house of the mayor?\nThe garden is to the left."),
            (2, 0, "user", "> It stands behind the old market square.\nThank you."),
            (2, 1, None, None), (2, 1, None, None), (3, 5, "user", "> never said by anyone here\nHello")]
    got = {(r.conv_id, r.turn): r for r in chat_threads.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == 7
    parent = {k: (r.reply_conv, r.reply_turn, r.linked) for k, r in got.items()}
    assert parent == {(1, 0): (None, None, False), (1, 1): (1, 0, False), (1, 2): (1, 0, True), (1, 3): (1, 2, True),
                      (2, 0): (1, 1, True), (2, 1): (2, 0, False), (3, 5): (None, None, False)}
    assert got[1, 2].body == "I asked about the garden too." and got[1, 3].body == "The garden is to the left."
    order = [k for k, r in sorted(got.items(), key=lambda x: x[1].position) if (r.thread_conv, r.thread_turn) == (1, 0)]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1)] and got[2, 1].depth == 3
    assert got[2, 1].chat == "<|unknown|>\n\n<|end|>\n"


def test_threads_long_and_empty(spark):
    rows = [(7, t, "user", f"word{t} and something else") for t in range(300)] + [(None, None, "user", "x"), (7, None, "user", "no turn")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(1)).withColumn("depth", F.lit("x"))
    got = chat_threads.threads(d).collect()
    assert len(got) == 302
    chain = sorted((r for r in got if r.conv_id == 7), key=lambda r: r.position)
    assert [r.position for r in chain] == list(range(301)) == [r.depth for r in chain]
    assert chat_threads.threads(d.where("1 = 0")).count() == 0


def test_thread_roots_precede_and_cover(spark):
    got = chat_threads.op8_chat_threads(spark, SF).collect()
    assert len(got) == len(corpus("conversations"))
    assert all(r.reply_conv is None or (r.reply_conv, r.reply_turn) < (r.conv_id, r.turn) for r in got)


# --- 9: fingerprints

def plain_spots(text, anchors):
    words = re.findall(r"[^\W_]+", text.lower())
    out, k = set(), 0
    for k, w in enumerate(words):
        if w in anchors:
            chain = []
            for x in words[k + 1:]:
                if x in anchors:
                    break
                chain.append(x)
            if chain:
                out.add((w, *chain[:spotsigs.CHAIN]))
    return out or {tuple(words)}


def check_fingerprints(docs, got, anchors):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (plain_spots(t, anchors) for t in (text, edited, after))
        assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-6 and abs(r.near_next - len(a & c) / len(a | c)) < 1e-6
        assert len(r.fingerprint) == 8 * len(a) and len(r.edited_fingerprint) == 8 * len(b)


def test_fingerprints(spark):
    docs = [(r["doc_id"], r["text"]) for r in corpus()]
    got = {r.doc_id: r for r in spotsigs.op9_fingerprints(spark, SF).collect()}
    words = collections.Counter(w for _, t in docs for w in re.findall(r"[^\W_]+", t.lower()))
    anchors = {w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[:spotsigs.ANCHORS]}
    check_fingerprints(docs, got, anchors)


def test_fingerprints_odd_rows(odd_docs, no_docs):
    got = spotsigs.with_edits(odd_docs, 5).collect()
    assert len(got) == odd_docs.count() - 1  # one row is there twice
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint for r in got)
    alone = spotsigs.with_edits(odd_docs.where("doc_id = 5"), 5).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert spotsigs.with_edits(no_docs).count() == 0


def test_spot_pairs_equal_brute_force(spark):
    r = random.Random(4)
    texts = []
    for k in range(30):
        w = [r.choice(["the", "of", "and"]) if r.random() < 0.4 else r.choice(VOCAB) + r.choice("abcd") for _ in range(80)]
        texts.append(" ".join(w))
        w[r.randrange(80)] = "new"
        texts.append(" ".join(w))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    anchors = spotsigs.common_words(d, 3)
    assert sorted(anchors) == ["and", "of", "the"]
    s = [plain_spots(t, anchors) for t in texts]
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if s[a] != s[b] and 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b])}
    assert {(p.a, p.b) for p in spotsigs.near_pairs(d, anchors=3).collect()} == want and want
    # null and equal ids lose no pair
    ids = [None if k < 20 else 7 for k in range(60)]
    e = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    key = [frozenset(x) for x in s]
    least = {}
    for k, f in enumerate(key):
        least[f] = min([i for i in (least.get(f), ids[k]) if i is not None], default=None)
    classes = {frozenset((key[x], key[y])) for x, y in want}
    asked = collections.Counter(tuple(sorted((least[f] for f in c), key=lambda i: (i is not None, i or 0))) for c in classes)
    assert collections.Counter((p.a, p.b) for p in spotsigs.near_pairs(e, anchors=3).collect()) == asked


# --- 10: decontamination

@pytest.mark.parametrize("short", [False, True])
def test_contamination_equals_brute_force(spark, odd_docs, short):
    r = random.Random(6)
    line = next(x.text for x in odd_docs.collect() if x.doc_id is None).split()
    items = [(1, " ".join(line[3:20])), (2, "un related words " + " ".join(line[5:15])), (2, " ".join(line[8:19]).upper() + "!"), (3, None), (4, ""),
             (10, "  ".join(r.choice(VOCAB) for _ in range(40)))]
    if short:
        items += [(5, " ".join(line[1:4])), (6, line[7]), (None, " ".join(line[2:8]))]
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    docs = [(x.doc_id, x.text) for x in odd_docs.collect()]
    got = winnowing.contamination(odd_docs, b).collect()
    want = brute.contamination(docs, items)
    key = lambda i, n, h, found: (i, n, h, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), h > 0)
    assert collections.Counter(key(*w) for w in want) == collections.Counter(
        (x.doc_id, x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in got)
    kept = winnowing.decontaminate(odd_docs, b)
    assert kept.columns == odd_docs.columns and kept.count() == sum(w[2] == 0 for w in want)


def test_contamination_empty(spark, odd_docs, no_docs):
    b = spark.createDataFrame([], "item_id long, text string")
    got = winnowing.contamination(odd_docs, b).collect()
    assert len(got) == odd_docs.count() and not any(r.contaminated for r in got)
    assert winnowing.contamination(no_docs, b).count() == 0
