"""Transaction tables derived by Spark from the TPC-H-like test tables.

F1: a customer pays the suppliers of the lines of its order; customers and
    suppliers share one id space (sparse, nearly acyclic weekly graphs).
F2: same rows with ids folded to ``greatest(5, count(customer) div 100)`` accounts
    (src = custkey % k, dst = partkey % k), each payment with a refund back unless
    (src + dst) % 5 = 0: dense, cyclic weekly graphs whose number of accounts grows with the tables.

The week of a transaction is the week of ``o_orderdate``.  Every line item
is one transaction, so the work grows with ``lineitem``; only the columns
used are read (the scan's ReadSchema shows the pruning).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.functions.weeks import week_key_from_ts

ROWS_PER_PARTITION = 1 << 20  # tunable: lines of a task where the session's partitions would hold more


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions of about ``ROWS_PER_PARTITION`` lines, if the session's shuffle partitions would hold more; counted in the files' footers."""
    n = math.ceil(load_table(spark, sf_dir, "lineitem").count() / ROWS_PER_PARTITION)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _orders_lines(spark: SparkSession, sf_dir: str, line_col: str, parts: int | None = None) -> DataFrame:
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", line_col)
    if parts:
        o, li = o.repartition(parts, "o_orderkey"), li.repartition(parts, "l_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def transactions_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions ``(time_week STRING, src BIGINT, dst BIGINT)`` of fixture F1.

    Nearly every pair of a week is there once, so large tables are dealt by the pair before they are grouped, in a number of
    partitions that grows with them: a task's sort and hash tables stay of one size, and the grouping moves no row again.
    """
    parts = _partitions(spark, sf_dir)
    j = _orders_lines(spark, sf_dir, "l_suppkey", parts)
    tx = j.select(week_key_from_ts("o_orderdate").alias("time_week"),
                  F.col("o_custkey").cast("bigint").alias("src"),
                  F.col("l_suppkey").cast("bigint").alias("dst"))
    return tx.repartition(parts, "time_week", "src", "dst") if parts else tx


def accounts_f2(spark: SparkSession, sf_dir: str) -> Column:
    """Number of accounts of fixture F2, as a scalar subquery."""
    return (load_table(spark, sf_dir, "customer")
            .select(F.greatest(F.lit(5), F.floor(F.count(F.lit(1)) / 100)).cast("bigint").alias("k")).scalar())


def transactions_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of fixture F2 (ids folded to ``accounts_f2``, payments and refunds)."""
    k = accounts_f2(spark, sf_dir)
    j = _orders_lines(spark, sf_dir, "l_partkey")
    paid = j.select(week_key_from_ts("o_orderdate").alias("time_week"),
                    F.pmod(F.col("o_custkey").cast("bigint"), k).alias("src"),
                    F.pmod(F.col("l_partkey").cast("bigint"), k).alias("dst"))
    pay, refund = F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    both = F.when((F.col("src") + F.col("dst")) % 5 > 0, F.array(pay, refund)).otherwise(F.array(pay))
    return paid.select("time_week", F.explode(both).alias("x")).select("time_week", "x.*")
