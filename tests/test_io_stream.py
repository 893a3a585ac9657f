"""Weekly store round trip, incremental skip, per-week overwrite and the file stream."""

import os

import pytest
from tests.paths import SF0001

from pyspark.sql import functions as F

from txgraph.operators.edges import edges
from txgraph.plans.series import exclude_rows, series
from txgraph.plans.weekly import run_incremental
from txgraph.sources.fixtures import transactions_f1
from txgraph.sources.transactions import (of_weeks, pending_weeks, read_transactions, read_week,
                                          read_weekly, select_weeks, write_weekly)
from txgraph.sources.versions import read_committed
from txgraph.streaming import start_weekly_stream

CHEAP = ("degree", "degree_centrality", "attributes")


def filters(df):
    """Partition filters of the scan in the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(x.split("PushedFilters")[0] for x in plan.split("PartitionFilters: ")[1:])


def write_store(spark, root, weeks=None):
    tx = transactions_f1(spark, SF0001)
    if weeks is not None:
        tx = tx.where(F.col("time_week").isin(weeks))
    (tx.select(F.col("src").cast("string").alias("SenderId"), F.col("dst").cast("string").alias("TargetId"),
               F.substring("time_week", 1, 4).cast("int").alias("Year_no"),
               F.substring("time_week", 5, 2).cast("int").alias("Week_no"),
               F.col("time_week").alias("date"))
     .write.mode("append").partitionBy("date").option("header", "true").csv(root))


def test_csv_store_roundtrip(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "raw")
    write_store(spark, root)
    got = edges(read_transactions(spark, root))
    want = edges(transactions_f1(spark, SF0001))
    a = got.select("time_week", F.col("src").cast("bigint"), F.col("dst").cast("bigint"), "n_tx")
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0
    # week keys stay strings, prefix selection prunes partitions
    assert dict(read_transactions(spark, root).dtypes)["time_week"] == "string"
    pruned = select_weeks(read_transactions(spark, root), "1995")
    assert "StartsWith(date" in filters(pruned) and pruned.count() > 0
    assert pruned.where(~F.col("time_week").startswith("1995")).count() == 0


def test_incremental_runs_only_new_weeks(spark, tmpdir_fresh):
    root, sink = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "out")
    write_store(spark, root, ["19951", "19952"])
    assert run_incremental(spark, root, sink, metrics=CHEAP) == 2
    assert run_incremental(spark, root, sink, metrics=CHEAP) == 0       # rerun skips finished weeks
    write_store(spark, root, ["19953"])
    assert run_incremental(spark, root, sink, metrics=CHEAP) == 1
    stats = read_committed(spark, sink, "stats")
    assert sorted(r.time_week for r in stats.select("time_week").collect()) == ["19951", "19952", "19953"]
    for node_sink in ("degree", "degree_centrality"):
        nodes = read_committed(spark, sink, f"node_{node_sink}")
        assert sorted(r.time_week for r in nodes.select("time_week").distinct().collect()) == ["19951", "19952", "19953"]
        assert nodes.where("time_week = '19952'").count() > 0
    files = [f for d, _, names in os.walk(f"{sink}/tables/node_degree") for f in names if f.endswith(".parquet")]
    assert len(files) <= 3 * 8


def test_only_pending_folders_are_read(spark, tmpdir_fresh):
    root, sink = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "out")
    write_store(spark, root, ["19951", "19952", "19953"])
    write_weekly(spark.createDataFrame([("19951", 1)], "time_week string, v int"), sink)
    assert pending_weeks(spark, root, sink) == ["19952", "19953"]
    assert pending_weeks(spark, root, sink, prefix="19953") == ["19953"]
    tx = of_weeks(read_transactions(spark, root), pending_weeks(spark, root, sink))
    assert "19952" in filters(tx) and "19953" in filters(tx) and "19951" not in filters(tx)
    assert sorted(r.time_week for r in tx.select("time_week").distinct().collect()) == ["19952", "19953"]


def test_week_without_complete_edges_is_not_pending_for_ever(spark, tmpdir_fresh):
    root, sink = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "out")
    write_store(spark, root, ["19951"])
    (spark.createDataFrame([("a", None, 1995, 7, "19957")], "SenderId string, TargetId string, Year_no int, Week_no int, date string")
     .write.mode("append").partitionBy("date").option("header", "true").csv(root))
    assert run_incremental(spark, root, sink, metrics=("degree",)) == 2
    assert run_incremental(spark, root, sink, metrics=("degree",)) == 0
    got = {r.time_week: r.nr_nodes for r in read_committed(spark, sink, "stats").collect()}
    assert got["19957"] == 0 and got["19951"] > 0


def test_csv_sink(spark, tmpdir_fresh):
    sink = os.path.join(tmpdir_fresh, "csv")
    write_weekly(spark.createDataFrame([("20221", 1.5), ("20222", 2.5)], "time_week string, v double"), sink, fmt="csv")
    assert {r.time_week: r.v for r in read_weekly(spark, sink, fmt="csv").collect()} == {"20221": 1.5, "20222": 2.5}
    assert [r.v for r in read_week(spark, sink, "20222", fmt="csv").collect()] == [2.5]


def test_edges_are_built_once(spark, tmpdir_fresh):
    """The report reads one written edge table, never the transactions again."""
    from txgraph.plans.weekly import weekly_report
    rep = weekly_report(edges(transactions_f1(spark, SF0001)), CHEAP)
    assert "lineitem" not in rep._jdf.queryExecution().optimizedPlan().toString()


def test_overwrite_replaces_only_its_week(spark, tmpdir_fresh):
    sink = os.path.join(tmpdir_fresh, "sink")
    df = spark.createDataFrame([("20221", 1.0), ("20222", 2.0)], "time_week string, v double")
    write_weekly(df, sink)
    write_weekly(spark.createDataFrame([("20222", 5.0)], "time_week string, v double"), sink)
    got = {r.time_week: r.v for r in read_weekly(spark, sink).collect()}
    assert got == {"20221": 1.0, "20222": 5.0}


def test_series_exclusion_and_order(spark):
    df = spark.createDataFrame([("201810", 1.0), ("201830", 2.0), ("20182", 3.0), ("202236", 4.0)],
                               "time_week string, v double")
    s = series(df).collect()
    assert [r.time_week for r in s] == ["201830"]  # weeks 2 and 10 of 2018 and 36 of 2022 are excluded
    edge = spark.createDataFrame([("201825", 1.0), ("201826", 2.0), ("202234", 3.0), ("202260", 4.0), ("20180", 5.0)], df.schema)
    assert [r.time_week for r in series(edge).collect()] == ["201826", "202234"]  # open ends
    s2 = series(df, exclude=()).collect()
    assert [r.week for r in s2] == [2, 10, 30, 36]  # numeric order, not string order
    assert str(s2[0].date)[:10] == "2018-01-15"
    ex = spark.createDataFrame([("201810", None)], "time_week string, v double")
    assert exclude_rows(spark.createDataFrame([("201810", None)], "time_week string, v double"), ex).count() == 0


def test_stream_processes_new_week_folders(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "raw")
    sink = os.path.join(tmpdir_fresh, "stream_out")
    write_store(spark, root, ["19951", "19952", "19953"])
    q = start_weekly_stream(spark, root, sink, os.path.join(tmpdir_fresh, "ckpt"), metrics=CHEAP,
                            trigger_once=True)
    q.awaitTermination(600)
    got = read_weekly(spark, sink)
    assert sorted(r.time_week for r in got.select("time_week").collect()) == ["19951", "19952", "19953"]
    assert {"nr_nodes", "avg_clustering", "degree_assortativity"} <= set(got.columns)
