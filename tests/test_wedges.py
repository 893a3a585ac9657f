"""Pairs to an account that begins no pair make no wedges, and every triangle is still there once."""

import itertools
import random

from txgraph.operators.triangles import triangles


def test_triangles_with_pruned_wedges(spark):
    r = random.Random(3)
    edges = {(r.randrange(14), r.randrange(14)) for _ in range(60)} | {(k, 100 + k % 3) for k in range(30, 60)}
    t = triangles(spark.createDataFrame([("20201", a, b) for a, b in edges], "time_week string, src long, dst long"))
    assert "LeftSemi" in t._jdf.queryExecution().optimizedPlan().toString()
    near = lambda a, b: (a, b) in edges or (b, a) in edges
    want = [x for x in itertools.combinations(sorted({v for e in edges for v in e}), 3) if all(near(a, b) for a, b in itertools.combinations(x, 2))]
    assert want and sorted(tuple(sorted((x.a, x.b, x.c))) for x in t.collect()) == want


def test_eigenvector_of_named_accounts(spark):
    from txgraph.operators.spectral import eigenvector_iterate
    e = spark.createDataFrame([("20201", "a", "b"), ("20201", "b", "a")], "time_week string, src string, dst string")
    nodes, _ = eigenvector_iterate(e)
    assert sorted((x.node, round(x.eigenvector_centrality, 9)) for x in nodes.collect()) == [("a", 0.707106781), ("b", 0.707106781)]
