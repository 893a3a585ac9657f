"""Eigenvector centrality by power iteration on (I + A^T).

Semantics of the reference call: x0 = 1/n; each step y(v) = x(v) + sum over
in-edges u->v of x(u) (a self-loop adds x(v) once more), x = y / ||y||_2; a
week stops at its first step with sum |x - x_prev| < n * tol.  After
``max_iter`` steps without that, the week did not converge (the reference
raises): its last vector is kept with ``converged = false``.

All weeks advance together as one distributed table keyed by (week, node).
Scaling commutes with a step, so a block of steps runs without norms.  The edges (with an identity edge per
vertex) are pinned by week, each week dealt to a grid of ``side`` x ``side`` cells, by a hash of either end, so that a
cell has about ``chunk`` edges; ``side`` is 1 for a week with fewer.  A step joins a cell's edges with the values of
its sources and sums by target where the edges lie, so a step shuffles the accounts and no message of an edge: an account
goes to the ``side`` cells of its row, and as many partial sums come back.  Every step of a block is written once, as
rows of fixed width under one folder with the step as partition column, which goes with its block.  Norms and L1
changes of all of them then come from two per-week sums, and each week stops at its own first converged step, so results
equal running the weeks one by one, step by step.  Blocks are short while many accounts are left.
The edges are pinned anew, in fewer partitions, when the weeks left hold half of them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from txgraph.operators.edges import W, vertices
from txgraph.operators.stats import summarize
from txgraph.session import checkpoint_dir, cut, discard, pin, static_plans

MAX_ITER = 1000   # fixed value of the reference call
TOL = 1e-6        # fixed value: default tolerance of the reference library
BLOCK = 16        # tunable: most steps between two looks at convergence
LEAST_BLOCK = 6   # tunable: steps a block has however many accounts are left
BLOCK_ROWS = 8_000_000  # tunable: rows that the steps of a block write
CELL = 1 << 20    # tunable: edges of a week that are summed in one task
EDGES_PER_PARTITION = 100_000  # tunable: the working set shrinks as weeks converge, and its partitions with it


def _place(node: str, side: str = "side") -> Column:
    return F.pmod(F.xxhash64(node, F.lit(3)), F.col(side)).cast("int")


def _step(cur: DataFrame, adj: DataFrame, parts: int, split: bool) -> DataFrame:
    """One unnormalised step u' = (I + A^T) u, with the value before it; ``split``: weeks lie in cells."""
    state, key = cur.select(W, F.col("node").alias("frm"), "side", "u"), [W, "frm"]
    if split:
        key = [W, "row", "col", "frm"]
        state = state.withColumn("row", _place("frm")).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
    return (adj.hint("merge").join(state.repartition(parts, *key[:-1]), key)
            .groupBy(W, F.col("to").alias("node"))
            .agg(F.max("side").alias("side"), F.max(F.when(F.col("frm") == F.col("to"), F.col("u"))).alias("prev"), F.sum("u").alias("u")))


def _judge(values: DataFrame, steps: int, weeks: DataFrame, tol: float) -> DataFrame:
    """``(time_week, j, norm, converged)``: the first converged step of each week, else the last of the block, and its norm."""
    norms = cut(values.groupBy(W, "j").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("norm")))
    # the vector that the block began with is taken as it is
    before = norms.select(W, (F.col("j") + 1).alias("j"), F.col("norm").alias("norm_before"))
    change = (values.join(norms.join(before, [W, "j"], "left"), [W, "j"])
              .groupBy(W, "j", "norm")
              .agg(F.sum(F.abs(F.col("u") / F.col("norm") - F.col("prev") / F.coalesce("norm_before", F.lit(1.0)))).alias("l1")))
    ends = F.col("l1") < F.col("n") * tol
    first = F.min_by(F.struct("j", "norm", ends.alias("converged")), F.when(ends, F.col("j")).otherwise(F.lit(2 * steps) - F.col("j")))
    judged = cut(change.join(weeks, W).groupBy(W).agg(first.alias("x")).select(W, "x.*"))
    discard(norms)
    return judged


def eigenvector_iterate(e: DataFrame, max_iter: int = MAX_ITER, tol: float = TOL,
                        block: int = BLOCK, chunk: int = CELL) -> tuple[DataFrame, DataFrame]:
    """Return ``(nodes(time_week, node, eigenvector_centrality, converged), weeks(time_week, iterations, converged))``."""
    e = e if hasattr(e, "_cut_path") else cut(e.select(W, "src", "dst"))
    spark = e.sparkSession
    nodes = cut(vertices(e))
    # one row a week: vertices, edges with the identity, cells in a row of the grid
    n, m = (t.groupBy(W).agg(F.count(F.lit(1)).alias(c)) for t, c in ((nodes, "n"), (e, "m")))
    weeks = cut(n.join(m, W).select(W, "n", (F.col("m") + F.col("n")).alias("m"))
                .withColumn("side", F.ceil(F.sqrt(F.col("m") / F.lit(chunk))).cast("int")))
    every = e.select(W, F.col("src").alias("frm"), F.col("dst").alias("to")).unionByName(
        nodes.select(W, F.col("node").alias("frm"), F.col("node").alias("to")))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sizes(left: DataFrame) -> Row:
        return left.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "mn"], F.coalesce(F.max("side"), F.lit(1)).alias("side")).first()

    def pinned(left: DataFrame, size: Row) -> tuple[DataFrame, int, bool]:
        """The edges of the weeks ``left``, in how many partitions, and whether any week is split into cells."""
        parts, split = max(1, min(most, -(-size["m"] // EDGES_PER_PARTITION))), size["side"] > 1
        cells = [W, "row", "col"] if split else [W]
        a = every.join(left.select(W, "side"), W)
        a = a.select(W, _place("frm").alias("row"), _place("to").alias("col"), "frm", "to") if split else a.drop("side")
        return pin(a, *cells, partitions=parts, order=(*cells, "frm")), parts, split

    size = held = sizes(weeks)
    adj, parts, split = pinned(weeks, size)
    state = nodes.join(weeks, W).select(W, "node", "side", (1.0 / F.col("n")).alias("u"))
    finished, done = [], 0
    while True:
        steps = min(block, max_iter - done, max(LEAST_BLOCK, BLOCK_ROWS // max(size["n"], 1)))
        folder = f"{checkpoint_dir(spark).rstrip('/')}/cut-steps-{uuid.uuid4().hex}"
        cur = state
        with static_plans(spark, parts):
            for j in range(1, steps + 1):
                nxt = _step(cur, adj, parts, split)
                nxt.write.parquet(f"{folder}/j={j}")
                cur = spark.read.schema(nxt.schema).parquet(f"{folder}/j={j}")
        values = spark.read.schema(f"{', '.join(f'{c} {t}' for c, t in nxt.dtypes)}, j int").parquet(folder)
        values._cut_path = folder
        judged = _judge(values, steps, weeks, tol)
        ended = F.col("converged") | F.lit(done + steps >= max_iter)
        cnt = judged.agg(F.count_if(ended).alias("ended"), F.count_if(~ended).alias("active")).first()
        res = values.join(judged, [W, "j"]).select(
            W, "node", "side", (F.col("u") / F.col("norm")).alias("x"), (F.lit(done) + F.col("j")).alias("it"), "converged")
        if cnt["ended"] or not cnt["active"]:  # no edges at all: an empty table
            finished.append(cut(res.where(ended).select(W, "node", "x", "it", "converged")))
            if len(finished) >= 32:  # keep the final union (and the driver's plan) small
                many, finished = finished, [cut(reduce(DataFrame.unionByName, finished))]
                discard(*many)
        if not cnt["active"]:
            break
        before, state = state, cut(res.where(~ended).select(W, "node", "side", F.col("x").alias("u")))
        discard(before, values)
        done += steps
        if cnt["ended"]:
            left = weeks.join(judged.where(~ended).select(W), W, "left_semi")
            size = sizes(left)
            if 2 * size["m"] <= held["m"]:  # the converged weeks' edges go
                adj.unpersist()
                held, (adj, parts, split) = size, pinned(left, size)
    adj.unpersist()  # the results read cut tables only
    discard(state, values)
    out = reduce(DataFrame.unionByName, finished)
    nodes = out.select(W, "node", F.col("x").alias("eigenvector_centrality"), "converged")
    per_week = out.groupBy(W).agg(F.max("it").cast("bigint").alias("iterations"),
                                  F.max("converged").alias("converged"))
    return nodes, per_week


def eigenvector_centrality(e: DataFrame, **kw) -> DataFrame:
    """``(time_week, node, eigenvector_centrality, converged)``; the last vector of a week that did not converge."""
    return eigenvector_iterate(e, **kw)[0]


def summarize_converged(nodes: DataFrame, weeks: DataFrame) -> DataFrame:
    """Weekly mean, deviation and Gini with ``converged``; NULL statistics where it is false."""
    s = summarize(nodes.where("converged").drop("converged"), "eigenvector_centrality", "eigenvector")
    return weeks.select(W, "converged").join(s, W, "left")


def eigenvector_summary(e: DataFrame, **kw) -> DataFrame:
    return summarize_converged(*eigenvector_iterate(e, **kw))
