"""Versioned weekly sinks: one commit for all tables of a run, and the files that each week was computed from.

A run writes its weeks under ``<sink>/tables/<table>/run=<run>/date=<week>``, a folder of its own, so nothing that
readers use is overwritten.  When every table is there, one small file ``<sink>/commits/<number>.json`` names the run and its
weeks; it appears by a rename, and it alone makes the run visible.  For every table a reader takes a week from
the last run whose commit names it, so it never sees a week's new nodes with its old statistics, whatever fails in between.
A number is claimed by creating a file, which only one of two concurrent runs can do.

The ``manifest`` table of a run lists names, sizes and times of the source files that its weeks were read from, taken before
they were read.  A week is pending if its folder now differs from the manifest of its last run: late, replaced
and removed files reopen it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.sources.transactions import PART, select_weeks, write_weekly

FILES = "time_week string, name string, size long, modified timestamp"
FILE_COLS = ["time_week", "name", "size", "modified"]


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def write_version(df: DataFrame, sink: str, table: str, run: str, fmt: str = "parquet", files: int = 8) -> None:
    """The weeks of ``df`` as a table of ``run``; not visible before ``commit``."""
    write_weekly(df, f"{sink}/tables/{table}/run={run}", fmt=fmt, files=files)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def commit(spark: SparkSession, sink: str, run: str, weeks: list[str]) -> int:
    """Make ``run`` the version of ``weeks`` in all tables; returns the commit's number."""
    jvm, folder, fs = _fs(spark, f"{sink}/commits")
    path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(folder)
    taken = [int(n.split(".")[0]) for n in (f.getPath().getName() for f in fs.listStatus(folder)) if n[0].isdigit()]
    number = max(taken, default=0) + 1
    while not fs.createNewFile(path(folder, f"{number:012d}.claim")):  # False: another run has this number
        number += 1
    draft = path(folder, f"_draft-{run}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"number": number, "run": run, "weeks": weeks}).encode()))
    out.close()
    if not fs.rename(draft, path(folder, f"{number:012d}.json")):
        raise RuntimeError(f"commit {number} of {run} could not be named")
    return number


def versions(spark: SparkSession, sink: str) -> DataFrame:
    """``time_week, run``: the committed version of each week."""
    try:
        got = spark.read.schema("number long, run string, weeks array<string>").option("pathGlobFilter", "*.json").json(f"{sink}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "time_week string, run string")
    return (got.select("number", "run", F.explode("weeks").alias("time_week"))
            .groupBy("time_week").agg(F.max_by("run", "number").alias("run")))


def read_committed(spark: SparkSession, sink: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table with the committed version of each week; the small join prunes the folders of other runs."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true").option("inferSchema", "true")
    df = r.load(f"{sink}/tables/{table}")
    df = df.withColumn(PART, F.col(PART).cast("string")).withColumnRenamed(PART, "time_week")
    return df.join(versions(spark, sink), ["time_week", "run"], "left_semi").drop("run")


def week_files(spark: SparkSession, root: str) -> DataFrame:
    """``time_week, name, size, modified`` of the files of each week folder, from the listing: no file is opened."""
    try:
        files = spark.read.format("binaryFile").load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    if PART not in files.columns:
        return spark.createDataFrame([], FILES)
    return files.select(F.col(PART).cast("string").alias("time_week"), F.element_at(F.split("path", "/"), -1).alias("name"),
                        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def changed_weeks(spark: SparkSession, files: DataFrame, sink: str, prefix: str | None = None) -> list[str]:
    """Weeks of ``files`` (``week_files``) whose files are not those of their committed manifest."""
    files = select_weeks(files, prefix)
    try:
        kept = read_committed(spark, sink, "manifest").select(FILE_COLS)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = spark.createDataFrame([], FILES)
    new = files.join(kept, FILE_COLS, "left_anti").select("time_week")
    gone = kept.join(files, FILE_COLS, "left_anti").select("time_week").join(files, "time_week", "left_semi")
    return sorted(r.time_week for r in new.unionByName(gone).distinct().collect())


def superseded(spark: SparkSession, sink: str, table: str) -> DataFrame:
    """``run, time_week`` of the folders of a table that no commit makes visible (failed or replaced); they may be deleted."""
    files = spark.read.format("binaryFile").load(f"{sink}/tables/{table}")
    stored = files.select(F.col("run").cast("string").alias("run"), F.col(PART).cast("string").alias("time_week")).distinct()
    return stored.join(versions(spark, sink), ["run", "time_week"], "left_anti")
