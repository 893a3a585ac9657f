"""Degrees and degree-derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.functions.safe import safe_div
from txgraph.operators.edges import W, endpoints, week_counts


def node_degree(e: DataFrame) -> DataFrame:
    """G3 total degree ``(time_week, node, degree)``: in + out, a self-loop counts 2."""
    return endpoints(e).groupBy(W, "node").agg(F.count(F.lit(1)).alias("degree"))


def in_out_degree(e: DataFrame) -> DataFrame:
    """``(time_week, node, out_degree, in_degree)`` over all vertices (0 when absent)."""
    ends = e.select(W, F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    return (ends.groupBy(W, F.col("x.node").alias("node"))
            .agg(F.sum("x.o").cast("bigint").alias("out_degree"),
                 F.sum("x.i").cast("bigint").alias("in_degree")))


def density(n, m):
    """G5 directed density m / (n (n-1)); 0 when m = 0 or n <= 1."""
    n = F.col(n) if isinstance(n, str) else n
    m = F.col(m) if isinstance(m, str) else m
    return F.when((m == 0) | (n <= 1), F.lit(0.0)).otherwise(safe_div(m, n * (n - 1)))


def degree_stats(e: DataFrame) -> DataFrame:
    """``nr_nodes, nr_edges, mean_degree, median_degree, density`` per week.

    ``percentile`` is exact and keeps a value->count map per group, so its
    state is bounded by the number of distinct degrees, not of nodes.
    """
    # one pass over the degrees: the degree sum is 2m (a self-loop counts 2),
    # so the edge table is not scanned a second time for the edge count
    per_week = (node_degree(e).groupBy(W).agg(
        F.count(F.lit(1)).alias("nr_nodes"),
        (F.sum("degree") / 2).cast("bigint").alias("nr_edges"),
        F.avg("degree").alias("mean_degree"),
        F.percentile("degree", 0.5).alias("median_degree")))
    return per_week.select(W, "nr_nodes", "nr_edges", "mean_degree", "median_degree",
                           density("nr_nodes", "nr_edges").alias("density"))


def degree_centrality(e: DataFrame) -> DataFrame:
    """G6 ``(time_week, node, degree_centrality)`` = degree / (n - 1); 1 when n <= 1."""
    deg = node_degree(e)
    # one row a week; reads the same column of the same degrees, so Spark reuses their exchange
    n = deg.groupBy(W).agg(F.count("degree").alias("n"))
    return (deg.join(n, W)
            .select(W, "node", F.when(F.col("n") <= 1, F.lit(1.0))
                    .otherwise(safe_div("degree", F.col("n") - 1)).alias("degree_centrality")))


def degree_pdf(e: DataFrame) -> DataFrame:
    """A9 empirical PDF over unit bins ``kmin..kmax`` (last bin closed).

    ``(time_week, degree, probability)``: the left edge of each occupied bin and
    count / n; degrees kmax-1 and kmax share the last bin, a single value is
    one bin. Empty bins are not emitted (the reference drops them before plotting).
    """
    deg = node_degree(e)
    rng = deg.groupBy(W).agg(F.min("degree").alias("kmin"), F.max("degree").alias("kmax"),
                             F.count(F.lit(1)).alias("n"))
    b = (deg.join(rng, W)
         .withColumn("bin", F.when(F.col("kmax") > F.col("kmin"),
                                   F.least(F.col("degree"), F.col("kmax") - 1))
                     .otherwise(F.col("degree"))))
    return (b.groupBy(W, "bin").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
            .select(W, F.col("bin").cast("bigint").alias("degree"),
                    safe_div("c", "n").alias("probability")))


def degree_histogram(e: DataFrame, bins: int = 30) -> DataFrame:
    """A10 equal-width histogram of degrees over ``[min, max]`` with ``bins`` bins.

    ``(time_week, bin, bin_left, bin_right, count, density)``; the last bin is
    closed, density = count / (n * width); min = max gives one bin of width 1.
    Only occupied bins are emitted.
    """
    deg = node_degree(e)
    rng = deg.groupBy(W).agg(F.min("degree").alias("lo"), F.max("degree").alias("hi"),
                             F.count(F.lit(1)).alias("n"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.lit(bins)).otherwise(F.lit(1.0))
    b = (deg.join(rng, W).withColumn("width", width)
         # exact integer bin index: floor(bins * (x - lo) / (hi - lo)) + 1, max closed
         .withColumn("bin", F.when(F.col("hi") > F.col("lo"),
                                   F.least(F.expr(f"({bins} * (degree - lo)) div (hi - lo)") + 1,
                                           F.lit(bins)))
                     .otherwise(F.lit(1)).cast("bigint")))
    return (b.groupBy(W, "bin").agg(F.count(F.lit(1)).alias("count"), F.first("n").alias("n"),
                                    F.first("lo").alias("lo"), F.first("width").alias("width"))
            .select(W, "bin",
                    (F.col("lo") + (F.col("bin") - 1) * F.col("width")).cast("double").alias("bin_left"),
                    (F.col("lo") + F.col("bin") * F.col("width")).cast("double").alias("bin_right"),
                    "count",
                    safe_div("count", F.col("n") * F.col("width")).alias("density")))
