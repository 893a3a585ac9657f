"""Helpers shared by the operators: table access, written tables, sizing, components."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.session import cut, discard

#: Text bytes that one task or block is planned for.
BLOCK_BYTES = 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` of a table with any other columns; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def parts_for(n_bytes: int | None, spark: SparkSession, per: int = BLOCK_BYTES) -> int:
    """Partitions so that each holds about ``per`` bytes, at least the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil((n_bytes or 0) / per))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``id, root`` (the smallest id), one row per endpoint.

    Large-star / small-star rounds: each node links its larger neighbours, then
    its smaller ones, to its smallest neighbour, until the edge set is a forest of
    stars.  Every round is a join-free pair of groupings with a written table
    between, so nothing but a convergence scalar reaches the driver.  Rounds grow
    with the logarithm of the longest chain; passing ``max_rounds`` is an error.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("u <> v").distinct())
    last = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(m, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        before, large = e, cut(large)
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(m2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m2.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        e = cut(small)
        discard(before, large)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root")
    return star.unionByName(star.select(F.col("root").alias("id"), "root").distinct())
