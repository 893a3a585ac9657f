"""Every metric on the micro-graphs of FIXTURES.md section 4, all weeks in one job."""

import math

import pytest
from micro import A, B, C, H, WEEK, node_map, tx

from txgraph.operators import degree as D
from txgraph.operators import edges as E
from txgraph.operators import stats as S
from txgraph.operators.core import core_periphery
from txgraph.operators.mixing import degree_assortativity
from txgraph.operators.paths import betweenness, closeness, eccentricity_stats
from txgraph.operators.spectral import eigenvector_iterate
from txgraph.operators.triangles import average_clustering, clustering

approx = pytest.approx


@pytest.fixture(scope="module")
def e(spark):
    return E.edges(tx(spark)).cache()


def week_rows(df):
    return {r["time_week"]: r.asDict() for r in df.collect()}


def test_dedup_and_nulls(e):
    dup = [r for r in e.collect() if r.time_week == "20205"]
    assert len(dup) == 1 and dup[0].n_tx == 3 and (dup[0].src, dup[0].dst) == (A, B)
    assert "20206" not in week_rows(E.week_counts(e))  # EMPTY: no row for a week without edges


def test_degree_stats(e):
    s = week_rows(D.degree_stats(e))
    assert s[WEEK["C3"]]["density"] == approx(0.5)
    star = s[WEEK["STAR"]]
    assert (star["nr_nodes"], star["nr_edges"]) == (4, 3)
    assert star["mean_degree"] == approx(1.5) and star["median_degree"] == approx(1.0)
    assert star["density"] == approx(0.25)
    assert s[WEEK["PATH3"]]["density"] == approx(1 / 3)
    loop = s[WEEK["LOOP"]]
    assert (loop["nr_nodes"], loop["nr_edges"], loop["density"]) == (2, 2, approx(1.0))
    assert (s["20205"]["nr_nodes"], s["20205"]["nr_edges"]) == (2, 1)


def test_degrees_and_centrality(e):
    deg = node_map(D.node_degree(e), "degree")
    assert deg[(WEEK["LOOP"], A)] == 3 and deg[(WEEK["LOOP"], B)] == 1
    assert [deg[(WEEK["STAR"], x)] for x in (H, A, B, C)] == [3, 1, 1, 1]
    dc = node_map(D.degree_centrality(e), "degree_centrality")
    assert dc[(WEEK["STAR"], H)] == approx(1.0) and dc[(WEEK["STAR"], A)] == approx(1 / 3)
    assert all(dc[(WEEK["C3"], x)] == approx(1.0) for x in (A, B, C))


def test_gini(e):
    g = week_rows(S.gini(D.node_degree(e), "degree"))
    assert g[WEEK["C3"]]["gini_coefficient"] == approx(0.0)
    assert g[WEEK["STAR"]]["gini_coefficient"] == approx(0.25)
    assert g[WEEK["MIX"]]["gini_coefficient"] == approx(1 / 12)


def test_gini_all_zero_is_null(spark):
    df = spark.createDataFrame([("1", 0.0), ("1", 0.0)], "time_week string, x double")
    assert S.gini(df, "x").collect()[0]["gini_coefficient"] is None


def test_closeness(e):
    c = node_map(closeness(e), "closeness")
    assert all(c[(WEEK["C3"], x)] == approx(2 / 3) for x in (A, B, C))
    assert c[(WEEK["STAR"], H)] == 0.0 and c[(WEEK["STAR"], A)] == approx(1 / 3)
    assert [c[(WEEK["PATH3"], x)] for x in (A, B, C)] == [0.0, approx(0.5), approx(2 / 3)]
    assert [c[(WEEK["MIX"], x)] for x in (A, B, C)] == [approx(1.0), approx(2 / 3), approx(2 / 3)]


def test_betweenness(e):
    b = node_map(betweenness(e), "betweenness")
    assert all(b[(WEEK["C3"], x)] == approx(0.5) for x in (A, B, C))
    assert all(b[(WEEK["STAR"], x)] == 0.0 for x in (H, A, B, C))
    assert [b[(WEEK["PATH3"], x)] for x in (A, B, C)] == [0.0, approx(0.5), 0.0]
    assert [b[(WEEK["MIX"], x)] for x in (A, B, C)] == [approx(0.5), approx(0.5), 0.0]
    summ = week_rows(S.summarize(betweenness(e), "betweenness", "betweenness"))
    assert summ[WEEK["STAR"]]["gini_coefficient"] is None


def test_eigenvector(e):
    nodes, weeks = eigenvector_iterate(e, max_iter=40)  # the acyclic weeks would need hundreds of steps
    x = node_map(nodes, "eigenvector_centrality")
    assert all(x[(WEEK["C3"], v)] == approx(1 / math.sqrt(3)) for v in (A, B, C))
    w = week_rows(weeks)
    assert w[WEEK["C3"]]["converged"]
    # L2 norm is 1 in every converged week
    norms = {}
    for (wk, _), val in x.items():
        norms[wk] = norms.get(wk, 0.0) + val * val
    assert all(v == approx(1.0) for k, v in norms.items() if w[k]["converged"])


def test_clustering(e):
    c = week_rows(average_clustering(e))
    assert c[WEEK["C3"]]["avg_clustering"] == approx(0.5)
    assert c[WEEK["C3"]]["avg_clustering_undirected"] == approx(1.0)
    assert c[WEEK["STAR"]]["avg_clustering"] == 0.0 and c[WEEK["LOOP"]]["avg_clustering"] == 0.0
    assert c[WEEK["MIX"]]["avg_clustering"] == approx(2 / 3)
    n = node_map(clustering(e), "clustering_directed")
    assert [n[(WEEK["MIX"], x)] for x in (A, B, C)] == [approx(0.5), approx(0.5), approx(1.0)]


def test_assortativity(e):
    a = week_rows(degree_assortativity(e))
    assert a[WEEK["C3"]]["degree_assortativity"] is None
    assert a[WEEK["PATH3"]]["degree_assortativity"] is None
    assert a[WEEK["MIX"]]["degree_assortativity"] == approx(0.0, abs=1e-12)


def test_eccentricity(e):
    s = week_rows(eccentricity_stats(e))
    assert s[WEEK["C3"]]["diameter_strict"] == 2
    assert s[WEEK["MIX"]]["diameter_strict"] == 2
    assert s[WEEK["STAR"]]["diameter_strict"] is None
    assert s[WEEK["C3"]]["reach_fraction"] == approx(1.0)


def test_core_periphery(e):
    cp = week_rows(core_periphery(e))
    star = cp[WEEK["STAR"]]
    # prefixes of (h, a, b, c) have 0, 1, 2 core edges of 3, 2, 1 left: the hub with one leaf has the densest core
    assert star["network_size"] == 4
    from txgraph.operators.core import core_scores, coreness
    best = max((r for r in core_scores(e).collect() if r.time_week == WEEK["STAR"] and r.valid), key=lambda r: (round(r.score, 9), -r.k))
    assert star["core_count"] == best.k
    marks = node_map(coreness(e), "coreness")
    assert [marks[(WEEK["STAR"], x)] for x in (H, A, B, C)] == [int(k < star["core_count"]) for k in range(4)]


def test_weekly_report_all_metrics_one_job(e):
    from txgraph.plans.weekly import weekly_report
    rep = week_rows(weekly_report(e, eigenvector_steps=40))
    c3 = rep[WEEK["C3"]]
    assert (c3["nr_nodes"], c3["nr_edges"]) == (3, 3)
    assert c3["mean_closeness"] == approx(2 / 3) and c3["mean_betweenness"] == approx(0.5)
    assert c3["mean_eigenvector"] == approx(1 / math.sqrt(3)) and c3["eigenvector_converged"]
    assert c3["avg_clustering"] == approx(0.5) and c3["avg_clustering_undirected"] == approx(1.0)
    assert c3["diameter_strict"] == 2 and c3["degree_assortativity"] is None
    assert c3["gini_centrality"] == approx(0.0)
    mix = rep[WEEK["MIX"]]
    assert mix["avg_clustering"] == approx(2 / 3) and mix["degree_assortativity"] == approx(0.0, abs=1e-12)
    assert rep[WEEK["STAR"]]["gini_betweenness"] is None
    assert set(rep) == set(WEEK.values()) | {"20205"}


def test_weekly_report_string_ids(spark):
    """Account ids of the transaction store are strings: every operator takes them."""
    from pyspark.sql import functions as F
    from txgraph.plans.weekly import weekly_report
    t = tx(spark).select("time_week", F.concat(F.lit("acct"), F.col("src")).alias("src"),
                         F.concat(F.lit("acct"), F.col("dst")).alias("dst"))
    rep = week_rows(weekly_report(E.edges(t), eigenvector_steps=40))
    c3, mix = rep[WEEK["C3"]], rep[WEEK["MIX"]]
    assert c3["mean_closeness"] == approx(2 / 3) and c3["mean_eigenvector"] == approx(1 / math.sqrt(3))
    assert mix["avg_clustering"] == approx(2 / 3) and mix["mean_betweenness"] == approx(1 / 3)
    assert rep[WEEK["STAR"]]["core_count"] >= 1


def test_relationship_label_and_concat(e, spark):
    from txgraph.plans.series import concat, degree_distribution
    assert {r.relationship for r in E.edges(tx(spark), relationship="txs").collect()} == {"txs"}
    both = concat([E.week_counts(e), E.week_counts(e).drop("m")])
    assert both.columns == ["time_week", "n", "m"] and both.where("m is null").count() == E.week_counts(e).count()
    dd = degree_distribution(e)
    star = [r for r in dd["pdf"].collect() if r.time_week == WEEK["STAR"]]
    assert {r.degree: r.probability for r in star} == {1: approx(0.75), 2: approx(0.25)}  # the last bin is closed
    assert [r["median"] for r in dd["markers"].collect() if r.time_week == WEEK["STAR"]] == [approx(1.0)]
    assert sum(r["count"] for r in dd["histogram"].collect() if r.time_week == WEEK["STAR"]) == 4


def test_hyperball_error_is_bounded_on_large_balls(spark):
    """Balls above the sketch size: a layered graph in which every node is reached by thousands."""
    from txgraph.operators.paths import closeness_approx
    n = 6000
    rows = [("20201", k, n + k % 3) for k in range(n)] + [("20201", n + j, n + 10) for j in range(3)]
    got = node_map(closeness_approx(E.edges(spark.createDataFrame(rows, "time_week string, src long, dst long"))), "closeness_approx")
    reach, total, size = n + 3, 2 * n + 3, n + 4
    want = (reach / total) * (reach / (size - 1))
    assert got[("20201", n + 10)] == approx(want, rel=0.1)
