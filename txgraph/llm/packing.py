"""Best-fit packing of token pieces into sequences by bin completion.

Whatever the corpus, pieces have at most ``capacity`` different lengths, so the
packing problem is a histogram of that many counts, and a solution is a list of
patterns with multiplicities.  Spark counts the lengths and ranks the pieces
of each length; the solver sees the histogram only; Spark then maps a piece's
(length, rank) to its sequence and offset.

The solver takes the largest remaining length, enumerates undominated
fillings of the space around it, and applies the chosen one as often as the
counts allow.  It branches over the fillings, prunes a branch as soon as
its waste leaves no better result than the incumbent, and begins with best-fit
decreasing as incumbent.  It stops at the lower bound or after ``NODES`` steps.

The enumeration is truncated: a step keeps at most ``BRANCH`` fillings, found in at most 400 extensions with three
lengths tried a level, and a filling is never applied fewer times than the counts allow.  All pieces
are packed, but only a result at the lower bound is known to be optimal; an exhausted search proves nothing.

Defined cases: a null or empty text is the end id alone; equal doc_ids and texts
are packed each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.bpe import encoder, public_path
from txgraph.llm.common import table, texts
from txgraph.session import cut

CAPACITY = 2048
#: Steps of the search; the incumbent at that point is the result.
NODES = 30_000
#: Fillings tried at a step of the search, least waste first.
BRANCH = 4

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it in one sequence), longest first


def lower_bound(counts: np.ndarray, cap: int) -> int:
    """Sequences that any packing needs: total size, and the bound on pieces that cannot share."""
    size = np.arange(cap + 1)
    best = -(-int((counts * size).sum()) // cap)
    for k in np.flatnonzero(counts[: cap // 2 + 1]).tolist() + [0]:
        big = int(counts[cap - k + 1:].sum())
        mid = counts.copy()
        mid[cap - k + 1:] = 0
        half = int(mid[cap // 2 + 1:].sum())
        free = half * cap - int((mid * size)[cap // 2 + 1:].sum())
        small = int((mid * size)[k: cap // 2 + 1].sum())
        best = max(best, big + half + max(0, -(-(small - free) // cap)))
    return best


def best_fit(counts: np.ndarray, cap: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over the histogram, all pieces of a length at once."""
    open_bins: dict[int, dict[Pattern, int]] = {}
    room = np.zeros(cap + 1, bool)

    def put(r: int, p: Pattern, n: int) -> None:
        bins = open_bins.setdefault(r, {})
        bins[p] = bins.get(p, 0) + n
        room[r] = True

    for size in range(cap, 0, -1):
        left = int(counts[size])
        while left:
            fits = np.flatnonzero(room[size:])
            if len(fits):
                r = size + int(fits[0])
                p, n = open_bins[r].popitem()
                if not open_bins[r]:
                    room[r] = False
                k = min(n, left)
                if k < n:
                    put(r, p, n - k)
                q = (*p[:-1], (size, p[-1][1] + 1)) if p[-1][0] == size else (*p, (size, 1))
                put(r - size, q, k)
                left -= k
            else:
                per = cap // size
                n = left // per
                if n:
                    put(cap - per * size, ((size, per),), n)
                if left % per:
                    put(cap - left % per * size, ((size, left % per),), 1)
                left = 0
    return [(p, n) for bins in open_bins.values() for p, n in bins.items()]


def fillings(counts: np.ndarray, largest: int, space: int, limit: int = BRANCH) -> list[Pattern]:
    """Undominated fillings of ``space`` with pieces of at most ``largest``, least waste first.

    A filling is left out if a piece could be added to it, or if one remaining
    piece of the size of two of its pieces (or more, within the waste) could stand
    in for them.  One piece of exactly ``space`` dominates all others.
    """
    top = min(largest, space)
    if top > 0 and top == space and counts[space]:
        return [((space, 1),)]
    # sums that the remaining pieces can make, as bits
    reach, mask = 1, (1 << (space + 1)) - 1
    sizes = np.flatnonzero(counts[: top + 1])[::-1].tolist()
    for s in sizes:
        n, k = min(int(counts[s]), space // s), 1
        while n:
            step = min(k, n)
            reach |= (reach << (s * step)) & mask
            n, k = n - step, k * 2
        if reach >> space & 1:
            break
    best = reach.bit_length() - 1
    if best == 0:
        return [()]
    found: list[tuple[int, Pattern]] = []
    budget = 400

    def extend(i: int, left: int, got: tuple[int, ...]) -> None:
        nonlocal budget
        if len(found) >= 4 * limit or budget <= 0:
            return
        budget -= 1
        j = i
        while j < len(sizes) and (sizes[j] > left or counts[sizes[j]] <= got.count(sizes[j])):
            j += 1
        if j == len(sizes):
            if got:
                found.append((left, tuple((s, got.count(s)) for s in sorted(set(got), reverse=True))))
            return
        tried = 0
        while j < len(sizes) and tried < 3:
            s = sizes[j]
            if s <= left and counts[s] > got.count(s):
                # the exact complement, if there is one, before the greedy continuation
                rest = left - s
                if rest and rest < s and counts[rest] > got.count(rest):
                    found.append((0, tuple((x, (*got, s, rest).count(x)) for x in sorted({*got, s, rest}, reverse=True))))
                    if len(found) >= 4 * limit:
                        return
                else:
                    extend(j, rest, (*got, s))
                tried += 1
            j += 1

    extend(0, space, ())
    if all(w > space - best for w, _ in found):
        found.append((space - best, _subset(counts, sizes, best)))
    out: list[Pattern] = []
    for waste, p in sorted(found, key=lambda f: (f[0], [-s for s, _ in f[1]])):
        flat = [s for s, n in p for _ in range(n)]
        merged = any(counts[a + b] for i, a in enumerate(flat) for b in flat[i + 1:] if a + b <= top) if waste else False
        if p not in out and not merged:
            out.append(p)
    return out[:limit] or [sorted(found)[0][1]]


def _subset(counts: np.ndarray, sizes: list[int], target: int) -> Pattern:
    """Pieces that sum to ``target``, known to be reachable; larger pieces first."""
    mask = (1 << (target + 1)) - 1
    suffix = [1]  # sums of the sizes from the end on
    for s in reversed(sizes):
        r, n, k = suffix[-1], min(int(counts[s]), target // s), 1
        while n:
            step = min(k, n)
            r |= (r << (s * step)) & mask
            n, k = n - step, k * 2
        suffix.append(r)
    suffix.reverse()
    got, left = [], target
    for i, s in enumerate(sizes):
        for n in range(min(int(counts[s]), left // s), -1, -1):
            if suffix[i + 1] >> (left - n * s) & 1:
                if n:
                    got.append((s, n))
                left -= n * s
                break
    return tuple(got)


def solve(counts: np.ndarray, cap: int = CAPACITY, nodes: int = NODES) -> tuple[list[tuple[Pattern, int]], int]:
    """Patterns with multiplicities for ``counts[length]`` pieces, and the lower bound."""
    counts = np.asarray(counts, np.int64).copy()
    total, bound = int((counts * np.arange(cap + 1)).sum()), lower_bound(counts, cap)
    incumbent = best_fit(counts, cap)
    best = sum(n for _, n in incumbent)
    stack: list[list] = []  # [untried patterns, chosen pattern, times, waste of it]
    waste = 0
    chosen: list[tuple[Pattern, int]] = []
    spent = 0

    def step() -> list[Pattern]:
        size = int(np.flatnonzero(counts)[-1])
        counts[size] -= 1
        around = fillings(counts, size, cap - size)
        counts[size] += 1
        out = []
        for f in around:
            d = dict(f)
            d[size] = d.get(size, 0) + 1
            out.append(tuple(sorted(d.items(), reverse=True)))
        return out[::-1]

    def undo() -> None:
        nonlocal waste
        p, n, w = stack[-1][1:]
        for s, k in p:
            counts[s] += k * n
        waste -= w
        chosen.pop()
        stack[-1][1:] = [None, 0, 0]

    while best > bound and spent < nodes:
        if not counts.any():
            n = sum(k for _, k in chosen)
            if n < best:
                best, incumbent = n, list(chosen)
            if not stack:
                break
            undo()
        elif not stack or stack[-1][1] is not None:
            stack.append([step(), None, 0, 0])
        while stack:
            options = stack[-1][0]
            if not options:
                stack.pop()
                if stack:
                    undo()
                    continue
                return incumbent, bound
            p = options.pop()
            spent += 1
            n = min(int(counts[s]) // k for s, k in p)
            w = n * (cap - sum(s * k for s, k in p))
            if waste + w > (best - 1) * cap - total:
                continue
            for s, k in p:
                counts[s] -= k * n
            waste += w
            chosen.append((p, n))
            stack[-1][1:] = [p, n, w]
            break
        if not stack:
            break
    return incumbent, bound


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts with their rank ``nth`` among those of their length in their partition ``part``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            for lo, hi, ids, off in enc.batches(b.column(1)):
                n = np.diff(off)
                k = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), k)
                piece = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                # only the first piece may be shorter
                first = n - (k - 1) * capacity
                start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[doc])
                raw = memoryview(ids.astype("<u4")).cast("B")
                a = (off[:-1][doc] + start) * 4
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), (a + length * 4).tolist())]
                order = np.argsort(length, kind="stable")
                sizes = length[order]
                head = np.flatnonzero(np.diff(sizes, prepend=-1))
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length.astype(np.int32)), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(doc), part, np.int32)), pa.array(nth)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return texts(docs).mapInArrow(make, PIECES)


def layout(patterns: list[tuple[Pattern, int]], capacity: int) -> dict[int, np.ndarray]:
    """For each length its runs of ranks: first rank, first sequence, pieces a sequence, offset of the first."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for p, n in patterns:
        offset = 0
        for s, k in p:
            runs.setdefault(s, []).append((int(used[s]), sequence, k, offset))
            used[s] += k * n
            offset += k * s
        sequence += n
    return {s: np.array(r, np.int64) for s, r in runs.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Pieces of ``docs`` (``doc_id, text``) with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    p = cut(pieces(docs, tokenizer, capacity))
    by_part = p.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    # at most one row for each length
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    patterns, _ = solve(counts, capacity, nodes)
    shared = spark.sparkContext.broadcast(layout(patterns, capacity))  # bounded by the solver's steps
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for s in np.unique(length).tolist():
                m = np.flatnonzero(length == s)
                r = runs[s][np.searchsorted(runs[s][:, 0], rank[m], "right") - 1]
                j = rank[m] - r[:, 0]
                sequence[m] = r[:, 1] + j // r[:, 2]
                offset[m] = r[:, 3] + j % r[:, 2] * s
            cols = [b.column(c) for c in ("doc_id", "piece", "start")] + [pa.array(length.astype(np.int64)), b.column("ids_crc32")]
            yield pa.record_batch([*cols, pa.array(sequence), pa.array(offset)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (p.join(before, ["length", "part"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens of the public 50k tokenizer."""
    return pack(table(spark, sf_dir, "documents"), public_path())
