"""The number of partitions of the F1 transactions grows with the lines, so a task's does not."""

from tests.paths import SF0001

from txgraph.plans.catalog import QUERIES
from txgraph.sources import fixtures


def test_large_tables_get_more_partitions_and_the_same_rows(spark, monkeypatch):
    names = ("node_degree", "in_out_degree", "week_counts")
    rows = lambda q: sorted(map(tuple, QUERIES[q](spark, SF0001).collect()))
    before = {q: rows(q) for q in names}
    lines = fixtures.load_table(spark, SF0001, "lineitem").count()
    monkeypatch.setattr(fixtures, "ROWS_PER_PARTITION", -(-lines // 20))
    tx = fixtures.transactions_f1(spark, SF0001)
    assert tx.rdd.getNumPartitions() == 20 and tx.count() == lines
    # the grouping of the pairs finds its rows in place
    plan = QUERIES["edges_dedup"](spark, SF0001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3
    assert {q: rows(q) for q in names} == before
