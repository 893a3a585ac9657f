"""Triangles and clustering.

Self-loops are dropped; each unordered pair {u, v} of a week carries
``s = a_uv + a_vu`` (1, or 2 when reciprocal).  Pairs are oriented from the
lower to the higher (degree, id) endpoint, so every node has at most
O(sqrt(m)) oriented out-neighbours and a hub of degree 50k does not explode
into 50k^2 wedges: wedges ``(a->b, a->c, b < c)`` are closed by ``b->c``.

A triangle {a, b, c} adds ``2 s_ab s_bc s_ac`` to the directed count
T(u) = ((A + A^T)^3)_uu of each corner, and 1 to the undirected count.

* directed:   c(u) = T(u) / (2 (d(d-1) - 2 d_recip)),  d = in + out without loops
* undirected: c(u) = 2 t(u) / (k (k-1)),  k = distinct neighbours without loops
Zero when there is no triangle; averages run over all vertices (zeros included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.operators.edges import W, vertices
from txgraph.operators.hubs import HUB_CHUNK, attach
from txgraph.session import cut


def weighted_pairs(e: DataFrame) -> DataFrame:
    """``(time_week, u, v, s)`` with u < v, no loops, s = number of directions (1 or 2)."""
    return (e.where(F.col("src") != F.col("dst"))
            .groupBy(W, F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
            .agg(F.count(F.lit(1)).alias("s")))


def pair_degrees(p: DataFrame) -> DataFrame:
    """Per node: ``k`` distinct neighbours, ``d`` = sum of s, ``recip`` = pairs with s = 2."""
    ends = p.select(W, F.explode(F.array("u", "v")).alias("node"), "s")
    return ends.groupBy(W, "node").agg(
        F.count(F.lit(1)).alias("k"), F.sum("s").alias("d"),
        F.count(F.when(F.col("s") == 2, 1)).alias("recip"))


def triangles(e: DataFrame, chunk: int = HUB_CHUNK) -> DataFrame:
    """``(time_week, a, b, c, w)``: each triangle once, w = s_ab * s_bc * s_ac."""
    p = cut(weighted_pairs(e))
    return _closed(p, cut(pair_degrees(p)), chunk)


def _closed(p: DataFrame, degrees: DataFrame, chunk: int = HUB_CHUNK) -> DataFrame:
    """``triangles`` of the written tables of ``weighted_pairs`` and ``pair_degrees``."""
    k = degrees.select(W, "node", "k")
    # orient every pair from the lower to the higher (k, id) endpoint
    pk = attach(attach(p, k.withColumnsRenamed({"node": "u", "k": "ku"}), "u", chunk, count="ku"),
                k.withColumnsRenamed({"node": "v", "k": "kv"}), "v", chunk, count="kv")
    lo_first = (F.col("ku") < F.col("kv")) | ((F.col("ku") == F.col("kv")) & (F.col("u") < F.col("v")))
    o = pk.select(W,
                  F.when(lo_first, F.col("u")).otherwise(F.col("v")).alias("a"),
                  F.when(lo_first, F.col("v")).otherwise(F.col("u")).alias("b"),
                  F.when(lo_first, F.col("kv")).otherwise(F.col("ku")).alias("kb"),
                  "s")
    o = cut(o)  # three join inputs read it
    # b is the first end of the closing pair too: pairs to an account without any go before the wedges are made
    first = o.select(W, F.col("a").alias("b")).distinct()
    o1 = o.select(W, "a", "b", "kb", F.col("s").alias("s_ab")).join(first, [W, "b"], "left_semi")
    o2 = o.select(W, "a", F.col("b").alias("c"), F.col("kb").alias("kc"), F.col("s").alias("s_ac"))
    wedges = (o1.join(o2, [W, "a"])
              .where((F.col("kb") < F.col("kc")) | ((F.col("kb") == F.col("kc")) & (F.col("b") < F.col("c")))))
    o3 = o.select(W, F.col("a").alias("b"), F.col("b").alias("c"), F.col("s").alias("s_bc"))
    return (wedges.join(o3, [W, "b", "c"])
            .select(W, "a", "b", "c", (F.col("s_ab") * F.col("s_bc") * F.col("s_ac")).alias("w")))


def _corner_sums(t: DataFrame) -> DataFrame:
    corners = t.select(W, F.explode(F.array("a", "b", "c")).alias("node"), "w")
    return corners.groupBy(W, "node").agg(
        F.sum(2 * F.col("w")).alias("t_dir"), F.count(F.lit(1)).alias("t_und"))


def clustering(e: DataFrame) -> DataFrame:
    """``(time_week, node, clustering_directed, clustering_undirected)`` for every vertex."""
    e = e if hasattr(e, "_cut_path") else cut(e)
    p = cut(weighted_pairs(e))
    pd_ = cut(pair_degrees(p))
    t = _corner_sums(_closed(p, pd_))
    v = vertices(e)
    j = v.join(pd_, [W, "node"], "left").join(t, [W, "node"], "left")
    den_dir = 2 * (F.col("d") * (F.col("d") - 1) - 2 * F.col("recip"))
    den_und = F.col("k") * (F.col("k") - 1)
    return j.select(
        W, "node",
        F.when(F.coalesce(F.col("t_dir"), F.lit(0)) > 0, F.col("t_dir") / den_dir).otherwise(0.0)
        .alias("clustering_directed"),
        F.when(F.coalesce(F.col("t_und"), F.lit(0)) > 0, 2 * F.col("t_und") / den_und).otherwise(0.0)
        .alias("clustering_undirected"))


def average_clustering(e: DataFrame) -> DataFrame:
    """G10/G11 ``(time_week, avg_clustering, avg_clustering_undirected)``."""
    return (clustering(e).groupBy(W)
            .agg(F.avg("clustering_directed").alias("avg_clustering"),
                 F.avg("clustering_undirected").alias("avg_clustering_undirected")))


def triangle_count(e: DataFrame) -> DataFrame:
    """``(time_week, triangles)`` number of undirected triangles (0 weeks omitted)."""
    return triangles(e).groupBy(W).agg(F.count(F.lit(1)).alias("triangles"))
