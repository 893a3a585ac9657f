"""Degree assortativity.

Pearson correlation, over the edges of a week, of the out-degree of the source
and the in-degree of the target (self-loops included, as in the degree
counts).  The degrees are attached to the edges by ``hubs.attach``, so a hub is no single key.  Covariance and deviations are Spark's centred aggregates, which do not cancel for
hubs; a zero deviation yields NULL instead of an ANSI divide-by-zero error (``corr`` raises there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.operators.degree import in_out_degree
from txgraph.operators.edges import W
from txgraph.operators.hubs import HUB_CHUNK, attach
from txgraph.session import cut


def degree_assortativity(e: DataFrame, chunk: int = HUB_CHUNK) -> DataFrame:
    """``(time_week, degree_assortativity)``; NULL when either variance is 0."""
    e = e if hasattr(e, "_cut_path") else cut(e.select(W, "src", "dst"))  # degrees and both ends read it
    io = in_out_degree(e)
    x = io.select(W, F.col("node").alias("src"), F.col("out_degree").cast("double").alias("x"))
    y = io.select(W, F.col("node").alias("dst"), F.col("in_degree").cast("double").alias("y"))
    xy = attach(attach(e.select(W, "src", "dst"), x, "src", chunk, count="x"), y, "dst", chunk, count="y")
    s = xy.groupBy(W).agg(F.covar_pop("x", "y").alias("cov"), F.stddev_pop("x").alias("dx"), F.stddev_pop("y").alias("dy"))
    r = F.when((F.col("dx") > 0) & (F.col("dy") > 0), F.col("cov") / F.col("dx") / F.col("dy"))
    return s.select(W, r.alias("degree_assortativity"))
