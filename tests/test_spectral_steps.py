"""What a step of the power iteration moves, and where a regular week stops."""

from pyspark.sql import functions as F

from txgraph.operators import spectral
from txgraph.session import pin, static_plans


def test_step_shuffles_accounts_only(spark):
    rows = [("20201", k, (k * 7 + i) % 40) for k in range(40) for i in range(5)] + [("20201", k, k) for k in range(40)]
    adj = pin(spark.createDataFrame(rows, "time_week string, frm long, to long"), "time_week", partitions=3, order=("time_week", "frm"))
    state = spark.createDataFrame([("20201", k, 1, 1.0) for k in range(40)], "time_week string, node long, side int, u double")
    with static_plans(spark, 3):
        t = spectral._step(state, adj, 3, False)
        plan = t._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert t.agg(F.sum("u")).first()[0] == len(rows)
    adj.unpersist()
    assert "Exchange" not in plan.split("SortMergeJoin")[0]  # the sums are taken where the edges lie
    assert "Exchange" not in plan.split("SortMergeJoin")[1]  # and the pinned edges stay there


def test_regular_week_needs_a_second_step(spark):
    """The first step is compared with 1/n as it is, as in the reference: its norm is not 1."""
    e = spark.createDataFrame([("20201", 1, 2), ("20201", 2, 3), ("20201", 3, 1)], "time_week string, src long, dst long")
    _, weeks = spectral.eigenvector_iterate(e)
    assert [tuple(r) for r in weeks.collect()] == [("20201", 2, True)]
