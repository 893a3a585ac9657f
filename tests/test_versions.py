"""Late files, one commit a run, set-aside lines and CSV files with different headers."""

import os
import time

import pytest

from txgraph.plans import weekly
from txgraph.sources.transactions import read_transactions, read_weekly, rejected_lines
from txgraph.sources.versions import changed_weeks, commit, new_run, read_committed, superseded, versions, week_files, write_version

HEAD = "SenderId,TargetId,Year_no,Week_no\n"


def put(root, week, name, text, head=HEAD):
    os.makedirs(f"{root}/date={week}", exist_ok=True)
    with open(f"{root}/date={week}/{name}", "w") as f:
        f.write(head + text)


def degrees(spark, sink):
    return {(r.time_week, r.node): r.degree for r in read_committed(spark, sink, "node_degree").collect()}


def test_late_and_changed_files_reopen_their_week(spark, tmpdir_fresh):
    root, sink = f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/out"
    put(root, "20221", "a.csv", "x,y,2022,1\n")
    put(root, "20222", "a.csv", "x,y,2022,2\ny,z,2022,2\n")
    run = lambda: weekly.run_incremental(spark, root, sink, metrics=("degree",))
    assert run() == 2 and run() == 0
    put(root, "20221", "late.csv", "x,z,2022,1\n")
    assert run() == 1 and run() == 0
    assert degrees(spark, sink) == {("20221", "x"): 2, ("20221", "y"): 1, ("20221", "z"): 1,
                                    ("20222", "x"): 1, ("20222", "y"): 2, ("20222", "z"): 1}
    put(root, "20222", "a.csv", "x,y,2022,2\ny,q,2022,2\n")  # replaced by one of the same size
    os.utime(f"{root}/date=20222/a.csv", (time.time() + 5, time.time() + 5))
    os.remove(f"{root}/date=20221/late.csv")
    assert changed_weeks(spark, week_files(spark, root), sink) == ["20221", "20222"]
    assert changed_weeks(spark, week_files(spark, root), sink, prefix="20222") == ["20222"]
    assert run() == 2 and run() == 0
    got = degrees(spark, sink)
    assert ("20221", "z") not in got and got["20222", "q"] == 1
    assert superseded(spark, sink, "stats").count() == 3


def test_nothing_of_a_failed_run_is_visible(spark, tmpdir_fresh, monkeypatch):
    root, sink = f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/out"
    put(root, "20221", "a.csv", "x,y,2022,1\n")
    assert weekly.run_incremental(spark, root, sink, metrics=("degree",)) == 1
    before = degrees(spark, sink)
    put(root, "20221", "b.csv", "y,z,2022,1\n")

    def fail(*_):
        raise OSError("no commit")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(weekly, "commit", fail)
        weekly.run_incremental(spark, root, sink, metrics=("degree",))
    assert degrees(spark, sink) == before  # all tables of the run were written
    assert [r.nr_nodes for r in read_committed(spark, sink, "stats").collect()] == [2]
    assert weekly.run_incremental(spark, root, sink, metrics=("degree",)) == 1
    assert [r.nr_nodes for r in read_committed(spark, sink, "stats").collect()] == [3]


def test_commits_are_numbered_apart(spark, tmpdir_fresh):
    sink = f"{tmpdir_fresh}/out"
    for k, weeks in enumerate((["20221", "20222"], ["20222"], ["20223"])):
        run = new_run()
        rows = [(w, k) for w in ["20221", "20222", "20223"]]
        write_version(spark.createDataFrame(rows, "time_week string, v int"), sink, "t", run)
        if k == 1:
            os.makedirs(f"{sink}/commits", exist_ok=True)
            open(f"{sink}/commits/000000000002.claim", "w").close()  # another run is about to commit
        assert commit(spark, sink, run, weeks) == (1, 3, 4)[k]
    assert {r.time_week: r.v for r in read_committed(spark, sink, "t").collect()} == {"20221": 0, "20222": 1, "20223": 2}
    assert versions(spark, sink).count() == 3 and superseded(spark, sink, "t").count() == 6
    assert versions(spark, f"{tmpdir_fresh}/none").count() == 0


def test_lines_that_do_not_fit_are_set_aside(spark, tmpdir_fresh):
    root, sink = f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/out"
    put(root, "20221", "a.csv", "x,y,2022,1\nx\nx,z,twenty,1\n,y,2022,1\nx,y,2022,1,more\nz,x,2022,1\n")
    put(root, "20222", "a.csv", "a,b,2022,2\n")
    assert sorted(map(tuple, rejected_lines(spark, root).collect())) == \
        [("20221", "x"), ("20221", "x,y,2022,1,more"), ("20221", "x,z,twenty,1")]
    got = read_transactions(spark, root)
    assert sorted((r.time_week, r.src or "", r.dst) for r in got.select("time_week", "src", "dst").collect()) == \
        [("20221", "", "y"), ("20221", "x", "y"), ("20221", "z", "x"), ("20222", "a", "b")]
    assert got.count() == 4 and got.select("dst").where("src is null").count() == 1  # one real null, under any pruning
    assert weekly.run_incremental(spark, root, sink, metrics=("degree",)) == 2
    assert {r.time_week: r.rejected_lines for r in read_committed(spark, sink, "stats").collect()} == {"20221": 3, "20222": 0}
    assert read_committed(spark, sink, "rejects").count() == 3


def test_csv_files_are_read_by_their_own_header(spark, tmpdir_fresh):
    root = f"{tmpdir_fresh}/stats"
    put(root, "20221", "a.csv", "5,1.5\n", "nr_nodes,density\n")
    put(root, "20222", "a.csv", "0.25,7\n", "density,nr_nodes\n")
    put(root, "20222", "b.csv", "8,0.5,new\n", "nr_nodes,density,note\n")
    put(root, "20223", "a.csv", "9,2.5\n", "nr_nodes,density\n")
    put(root, "20223", "b.csv", "", "nr_nodes,density\n")
    got = read_weekly(spark, root, fmt="csv")
    assert sorted((r.time_week, r.nr_nodes, r.density, r.note or "") for r in got.collect()) == \
        [("20221", 5, 1.5, ""), ("20222", 7, 0.25, ""), ("20222", 8, 0.5, "new"), ("20223", 9, 2.5, "")]
