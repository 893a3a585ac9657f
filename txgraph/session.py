"""Session helpers: sane defaults for tests/bench and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "txgraph",
              shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench; on a cluster use spark-submit's own."""
    b = (SparkSession.builder
         .master(master or os.environ.get("TXGRAPH_MASTER", "local[8]"))
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g"))
    for k, v in extra.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests, bench) is a
    scratch folder created; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        conf = tempfile.mkdtemp(prefix="txgraph-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Executions inside delete their own shuffle files as they end, instead of when the driver next collects garbage.

    Shuffles of tables that are persisted stay: they belong to the execution that filled the cache.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Written as Parquet and read back with the known schema: the result is a
    plain scan, so an iteration's plan never grows with the number of steps
    (``Dataset.checkpoint`` keeps the origin plan of every earlier step, which
    the optimizer re-walks).  Files live under ``spark.checkpoint.dir``, so a
    lost executor costs a re-read, not a recomputation.  ``discard`` deletes them.
    The shuffle files of the write go with its end; nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def cut_all(frames: Iterable[DataFrame]) -> DataFrame:
    """``cut`` of the rows of ``frames``, of one schema, written one after the other: each one's shuffle files go before the next is made."""
    out = path = None
    for df in frames:
        spark = df.sparkSession
        if path is None:
            path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
            out = spark.read.schema(df.schema)
        with shuffles_dropped(spark):
            df.write.mode("append").parquet(path)
    out = out.parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``cut`` wrote and that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_cut_path", None)
        if path:
            jvm = t.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def static_plans(spark: SparkSession, partitions: int):
    """Plan without adaptive stages and with ``partitions`` shuffle partitions inside: for chains of many
    shuffles of one size, where one job of many stages costs far less than one job a stage.  A side that is pinned by
    some of a join's keys stays where it is, and the other comes to it."""
    inside = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(partitions),
              "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in inside}
    for k, v in inside.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def pin(df: DataFrame, *keys: str, partitions: int | None = None, order: tuple[str, ...] = (), then=None) -> DataFrame:
    """Hash-partition ``df`` on ``keys`` and keep it in memory (spilling to disk).

    For the loop-invariant side of an iteration (the adjacency): the cached
    table keeps its hash partitioning, so each step shuffles only the small
    state side of the join, never the adjacency.  Its lineage must be short
    (a scan of a ``cut`` table and a repartition): a lost executor's blocks are
    recomputed from that, not from the whole job.  ``then`` is applied to the partitioned rows (a grouping by
    ``keys`` moves none of them); partitions sorted by ``order`` need no sort in a merge join on it.
    """
    from pyspark import StorageLevel
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartition(n, *keys)
    out = out if then is None else then(out)
    out = (out.sortWithinPartitions(*order) if order else out).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out
