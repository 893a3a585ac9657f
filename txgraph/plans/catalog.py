"""Named queries over the test tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Every query reads ``orders`` and ``lineitem`` in full (fixtures F1/F2 of
``txgraph.sources.fixtures``), so its work grows with the tables.
Doubles are rounded to 9 significant digits for the comparison (``round(x, 6)``
in the oracles' text stands for that rounding); counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txgraph.operators import degree as deg_ops
from txgraph.operators import edges as edge_ops
from txgraph.operators import stats
from txgraph.plans import oracle as O
from txgraph.session import cut
from txgraph.sources.fixtures import transactions_f1, transactions_f2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def significant(c):
    """Round to 9 significant digits so that two engines agree: snap to 12 digits
    first (removes last-bit noise of different summation orders), then round half away
    from zero at the ninth; the scale is an exact power of ten, so Spark and DuckDB
    evaluate all steps identically.  Values below 1e-14 are noise around zero."""
    p = F.pow(F.lit(10.0), 8 - F.least(F.lit(8), F.floor(F.log10(F.abs(c) * 1.000000001))))
    r = F.round(F.round(c * p * 1000.0) / 1000.0) / p
    return F.when(F.abs(c) < 1e-14, F.lit(0.0)).when(c.isNotNull(), r)


def rounded(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(significant(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = O.significant_columns(sql)
        return fn
    return deco


def f1(spark, d):
    """Edges of fixture F1, as a plan: operators that read them more than once or in
    a loop write them once themselves."""
    return edge_ops.edges(transactions_f1(spark, d))


def f1_once(spark, d):
    """Edge table of fixture F1, written once for queries with several metric branches."""
    return cut(f1(spark, d))


def f2(spark, d):
    return edge_ops.edges(transactions_f2(spark, d))


# ---------------------------------------------------------------- step 1: graph + degrees

@query("edges_dedup", O.with_base("f1", "", "SELECT time_week, src, dst, n_tx FROM e"))
def q_edges_dedup(spark, d):
    """A1/G1: distinct directed pairs per week with transaction multiplicity."""
    return f1(spark, d)


@query("vertices", O.with_base("f1", "", "SELECT time_week, node FROM v"))
def q_vertices(spark, d):
    return edge_ops.vertices(f1(spark, d))


@query("node_degree", O.with_base("f1", "", "SELECT time_week, node, degree FROM deg"))
def q_node_degree(spark, d):
    return deg_ops.node_degree(f1(spark, d))


@query("in_out_degree", O.with_base("f1", """
io AS (SELECT time_week, node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM
  (SELECT time_week, src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT time_week, dst, 0, 1 FROM e) GROUP BY ALL)""",
    "SELECT time_week, node, out_degree, in_degree FROM io"))
def q_in_out_degree(spark, d):
    return deg_ops.in_out_degree(f1(spark, d))


@query("week_counts", O.with_base("f1", "", "SELECT time_week, n, m FROM wc"))
def q_week_counts(spark, d):
    return edge_ops.week_counts(f1(spark, d))


@query("degree_stats", O.with_base("f1", "", """
SELECT d.time_week, count(*) AS nr_nodes, any_value(wc.m) AS nr_edges,
       round(avg(degree), 6) AS mean_degree,
       round(quantile_cont(degree, 0.5), 6) AS median_degree,
       round(CASE WHEN any_value(wc.m) = 0 OR count(*) <= 1 THEN 0.0
                  ELSE any_value(wc.m) / (count(*) * (count(*) - 1.0)) END, 6) AS density
FROM deg d JOIN wc USING (time_week) GROUP BY d.time_week"""))
def q_degree_stats(spark, d):
    """G4 (flagship): nodes, edges, mean and median degree, density per week."""
    return deg_ops.degree_stats(f1(spark, d))


# ---------------------------------------------------------------- step 2-3: distributions

@query("degree_percentiles", O.with_base("f1", "", """
SELECT time_week, count(*) AS n, round(avg(degree), 6) AS mean,
       round(quantile_cont(degree, 0.5), 6) AS median, round(quantile_cont(degree, 0.95), 6) AS p95,
       round(quantile_cont(degree, 0.99), 6) AS p99,
       CAST(min(degree) AS DOUBLE) AS min, CAST(max(degree) AS DOUBLE) AS max
FROM deg GROUP BY time_week"""))
def q_degree_percentiles(spark, d):
    """A4-A7 on degrees: the markers of the degree-distribution plot."""
    return stats.percentiles(deg_ops.node_degree(f1(spark, d)), "degree")


@query("degree_gini", O.with_base("f1", "", f"""
SELECT time_week, round(gini_coefficient, 6) AS gini_coefficient FROM {O.gini_sql('deg', 'degree')} g"""))
def q_degree_gini(spark, d):
    """A8 Gini coefficient of the degree sequence."""
    return stats.gini(deg_ops.node_degree(f1(spark, d)), "degree")


_DC = """dc AS (SELECT d.time_week, d.node,
   CASE WHEN wc.n <= 1 THEN 1.0 ELSE d.degree / (wc.n - 1.0) END AS degree_centrality
   FROM deg d JOIN wc USING (time_week))"""


@query("degree_centrality", O.with_base("f1", _DC,
       "SELECT time_week, node, round(degree_centrality, 6) AS degree_centrality FROM dc"))
def q_degree_centrality(spark, d):
    return deg_ops.degree_centrality(f1(spark, d))


@query("summary_degree_centrality", O.with_base("f1", _DC, f"""
SELECT s.time_week, round(mean_centrality, 6) AS mean_centrality, round(std_centrality, 6) AS std_centrality,
       round(g.gini_coefficient, 6) AS gini_coefficient
FROM (SELECT time_week, avg(degree_centrality) AS mean_centrality, stddev_pop(degree_centrality) AS std_centrality
      FROM dc GROUP BY time_week) s
LEFT JOIN {O.gini_sql('dc', 'degree_centrality')} g USING (time_week)"""))
def q_summary_degree_centrality(spark, d):
    """G6 + G16: mean, population std and Gini of degree centrality."""
    # mean, deviation and Gini read the node table, which is written once
    return stats.summarize(cut(deg_ops.degree_centrality(f1(spark, d))), "degree_centrality", "centrality")


@query("degree_pdf", O.with_base("f1", "", """
SELECT time_week, CAST(bin AS BIGINT) AS degree, round(count(*) / any_value(n), 6) AS probability FROM
 (SELECT time_week, CASE WHEN kmax > kmin THEN least(degree, kmax - 1) ELSE degree END AS bin, n FROM deg
  JOIN (SELECT time_week, min(degree) AS kmin, max(degree) AS kmax, count(*) AS n FROM deg GROUP BY ALL) r
  USING (time_week)) GROUP BY time_week, bin"""))
def q_degree_pdf(spark, d):
    """Unit-bin empirical PDF of degrees."""
    return deg_ops.degree_pdf(f1(spark, d))


@query("degree_histogram30", O.with_base("f1", "", """
SELECT time_week, bin,
  round(CAST(lo + (bin - 1) * width AS DOUBLE), 6) AS bin_left, round(CAST(lo + bin * width AS DOUBLE), 6) AS bin_right,
  count(*) AS count, round(count(*) / (any_value(n) * width), 6) AS density
FROM (SELECT time_week, lo, n,
        CASE WHEN hi > lo THEN (hi - lo) / 30.0 ELSE 1.0 END AS width,
        CAST(CASE WHEN hi > lo THEN least((30 * (degree - lo)) // (hi - lo) + 1, 30) ELSE 1 END AS BIGINT) AS bin
      FROM deg JOIN (SELECT time_week, min(degree) AS lo, max(degree) AS hi, count(*) AS n FROM deg GROUP BY ALL) r
      USING (time_week))
GROUP BY time_week, bin, lo, width"""))
def q_degree_histogram30(spark, d):
    """A10: 30 equal-width bins with density."""
    return deg_ops.degree_histogram(f1(spark, d), 30)


# ---------------------------------------------------------------- step 4-5: mixing, triangles

@query("degree_assortativity", O.with_base("f1", """
io AS (SELECT time_week, node, sum(o) AS od, sum(i) AS id FROM
  (SELECT time_week, src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT time_week, dst, 0, 1 FROM e) GROUP BY ALL),
xy AS (SELECT e.time_week, CAST(a.od AS DOUBLE) AS x, CAST(b.id AS DOUBLE) AS y FROM e
       JOIN io a ON a.time_week = e.time_week AND a.node = e.src
       JOIN io b ON b.time_week = e.time_week AND b.node = e.dst)""", """
SELECT time_week, round(CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0
                             THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END, 6) AS degree_assortativity
FROM xy GROUP BY time_week"""))
def q_degree_assortativity(spark, d):
    """G12 ."""
    from txgraph.operators.mixing import degree_assortativity
    return degree_assortativity(f1(spark, d))


@query("edges_undirected", O.with_base("f1", "",
       "SELECT DISTINCT time_week, least(src, dst) AS u, greatest(src, dst) AS v FROM e"))
def q_edges_undirected(spark, d):
    """Simple undirected graph (self-loops kept as (u, u))."""
    return edge_ops.undirected(f1(spark, d))


_CLUST = """
S AS (SELECT time_week, x, y, count(*) AS s FROM
      (SELECT time_week, src AS x, dst AS y FROM e WHERE src <> dst
       UNION ALL SELECT time_week, dst, src FROM e WHERE src <> dst) GROUP BY ALL),
TT AS (SELECT s1.time_week, s1.x AS node, sum(s1.s * s2.s * s3.s) AS t, count(*) AS walks
       FROM S s1 JOIN S s2 ON s2.time_week = s1.time_week AND s2.x = s1.y
                 JOIN S s3 ON s3.time_week = s1.time_week AND s3.x = s2.y AND s3.y = s1.x
       GROUP BY ALL),
DD AS (SELECT time_week, x AS node, sum(s) AS d, count(*) AS k, count(*) FILTER (WHERE s = 2) AS recip
       FROM S GROUP BY ALL),
C AS (SELECT v.time_week, v.node,
        CASE WHEN coalesce(TT.t, 0) > 0 THEN TT.t / (2.0 * (DD.d * (DD.d - 1) - 2 * DD.recip)) ELSE 0.0 END AS cd,
        CASE WHEN coalesce(TT.walks, 0) > 0 THEN TT.walks / (DD.k * (DD.k - 1.0)) ELSE 0.0 END AS cu
      FROM v LEFT JOIN DD USING (time_week, node) LEFT JOIN TT USING (time_week, node))"""


@query("clustering_nodes", O.with_base("f1", _CLUST,
       "SELECT time_week, node, round(cd, 6) AS clustering_directed, round(cu, 6) AS clustering_undirected FROM C"))
def q_clustering_nodes(spark, d):
    """G10/G11 per node."""
    from txgraph.operators.triangles import clustering
    return clustering(f1(spark, d))


@query("clustering_directed", O.with_base("f1", _CLUST,
       "SELECT time_week, round(avg(cd), 6) AS avg_clustering FROM C GROUP BY time_week"))
def q_clustering_directed(spark, d):
    """G10 average directed clustering (zeros included)."""
    from txgraph.operators.triangles import average_clustering
    return average_clustering(f1(spark, d)).select("time_week", "avg_clustering")


@query("clustering_undirected", O.with_base("f1", _CLUST,
       "SELECT time_week, round(avg(cu), 6) AS avg_clustering_undirected FROM C GROUP BY time_week"))
def q_clustering_undirected(spark, d):
    """G11 average clustering of the undirected graph."""
    from txgraph.operators.triangles import average_clustering
    return average_clustering(f1(spark, d)).select("time_week", "avg_clustering_undirected")


@query("triangle_count", O.with_base("f1", _CLUST,
       "SELECT time_week, CAST(sum(walks) / 6 AS BIGINT) AS triangles FROM TT GROUP BY time_week HAVING sum(walks) > 0"))
def q_triangle_count(spark, d):
    from txgraph.operators.triangles import triangle_count
    return triangle_count(f1(spark, d))


@query("attributes", O.with_base("f1", _CLUST + """,
io AS (SELECT time_week, node, sum(o) AS od, sum(i) AS id FROM
  (SELECT time_week, src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT time_week, dst, 0, 1 FROM e) GROUP BY ALL),
xy AS (SELECT e.time_week, CAST(a.od AS DOUBLE) AS x, CAST(b.id AS DOUBLE) AS y FROM e
       JOIN io a ON a.time_week = e.time_week AND a.node = e.src
       JOIN io b ON b.time_week = e.time_week AND b.node = e.dst)""", """
SELECT c.time_week, round(c.avg_clustering, 6) AS avg_clustering, round(a.r, 6) AS degree_assortativity
FROM (SELECT time_week, avg(cd) AS avg_clustering FROM C GROUP BY ALL) c
JOIN (SELECT time_week, CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0
             THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r FROM xy GROUP BY ALL) a
USING (time_week)"""))
def q_attributes(spark, d):
    """Weekly attributes row: average directed clustering + degree assortativity."""
    from txgraph.operators.mixing import degree_assortativity
    from txgraph.operators.triangles import average_clustering
    e = f1_once(spark, d)
    return (average_clustering(e).select("time_week", "avg_clustering")
            .join(degree_assortativity(e), "time_week"))


# ---------------------------------------------------------------- step 6-7: shortest paths

_CLOSE = O.BFS + """,
cl AS (SELECT v.time_week, v.node,
         CASE WHEN coalesce(p.tot, 0) > 0 AND wc.n > 1 THEN (p.r1 / p.tot) * (p.r1 / (wc.n - 1.0)) ELSE 0.0 END
         AS closeness
       FROM v JOIN wc USING (time_week)
       LEFT JOIN (SELECT time_week, t AS node, count(*) AS r1, sum(d) AS tot FROM bfs WHERE d > 0 GROUP BY ALL) p
       USING (time_week, node))"""

# Brandes' dependency as a pair sum: v lies on sigma(s,v) * sigma(v,t) of the
# sigma(s,t) shortest s-t paths exactly when d(s,v) + d(v,t) = d(s,t)
_BETW = O.BFS + """,
bt AS (SELECT a.time_week, a.t AS node, sum(a.sigma * b.sigma / c.sigma) AS bc
       FROM bfs a JOIN bfs b ON b.time_week = a.time_week AND b.s = a.t
                  JOIN bfs c ON c.time_week = a.time_week AND c.s = a.s AND c.t = b.t
       WHERE a.d > 0 AND b.d > 0 AND a.s <> b.t AND c.d = a.d + b.d
       GROUP BY ALL),
bw AS (SELECT v.time_week, v.node,
         CASE WHEN wc.n > 2 THEN coalesce(bt.bc, 0.0) / ((wc.n - 1.0) * (wc.n - 2.0)) ELSE coalesce(bt.bc, 0.0) END
         AS betweenness
       FROM v JOIN wc USING (time_week) LEFT JOIN bt USING (time_week, node))"""


def _summary_sql(rel: str, value: str, prefix: str) -> str:
    return f"""
SELECT s.time_week, round(s.m, 6) AS mean_{prefix}, round(s.sd, 6) AS std_{prefix},
       round(g.gini_coefficient, 6) AS gini_coefficient
FROM (SELECT time_week, avg({value}) AS m, stddev_pop({value}) AS sd FROM {rel} GROUP BY ALL) s
LEFT JOIN {O.gini_sql(rel, value)} g USING (time_week)"""


@query("closeness", O.with_base("f1", _CLOSE,
       "SELECT time_week, node, round(closeness, 6) AS closeness FROM cl", recursive=True))
def q_closeness(spark, d):
    """G7 closeness (in-distance, Wasserman-Faust scaling), exact BFS from every vertex."""
    from txgraph.operators.paths import closeness
    return closeness(f1(spark, d))


@query("summary_closeness", O.with_base("f1", _CLOSE, _summary_sql("cl", "closeness", "closeness"),
                                        recursive=True))
def q_summary_closeness(spark, d):
    from txgraph.operators.paths import closeness
    return stats.summarize(closeness(f1(spark, d)), "closeness", "closeness")


@query("closeness_percentiles", O.with_base("f1", _CLOSE, """
SELECT time_week, count(*) AS n, round(quantile_cont(closeness, 0.5), 6) AS median,
       round(quantile_cont(closeness, 0.95), 6) AS p95, round(quantile_cont(closeness, 0.99), 6) AS p99
FROM cl GROUP BY time_week""", recursive=True))
def q_closeness_percentiles(spark, d):
    """A6, A7 of a real-valued metric: median, 95th and 99th percentile of closeness."""
    from txgraph.operators.paths import closeness
    return stats.quantiles(closeness(f1(spark, d)), "closeness", {"median": 0.5, "p95": 0.95, "p99": 0.99})


@query("betweenness", O.with_base("f1", _BETW,
       "SELECT time_week, node, round(betweenness, 6) AS betweenness FROM bw", recursive=True))
def q_betweenness(spark, d):
    """G8 exact Brandes betweenness."""
    from txgraph.operators.paths import betweenness
    return betweenness(f1(spark, d))


@query("summary_betweenness", O.with_base("f1", _BETW, _summary_sql("bw", "betweenness", "betweenness"),
                                          recursive=True))
def q_summary_betweenness(spark, d):
    from txgraph.operators.paths import betweenness
    return stats.summarize(betweenness(f1(spark, d)), "betweenness", "betweenness")


_SCC = O.BFS + """,
scc AS (SELECT a.time_week, a.s AS node, min(a.t) AS component
        FROM bfs a JOIN bfs b ON b.time_week = a.time_week AND b.s = a.t AND b.t = a.s GROUP BY ALL)"""


@query("strong_components", O.with_base("f2", _SCC, "SELECT time_week, node, component FROM scc", recursive=True))
def q_strong_components(spark, d):
    """The strongly connected component of every account, named by its smallest account."""
    from txgraph.operators.components import strongly_connected
    return strongly_connected(f2(spark, d))


@query("diameter_strict", O.with_base("f2", _SCC + """,
sizes AS (SELECT time_week, component, count(*) AS s FROM scc GROUP BY ALL),
far AS (SELECT time_week, max(d) AS d, count(*) AS pairs FROM bfs GROUP BY ALL)""", """
SELECT time_week, CAST(sum(s) AS BIGINT) AS nodes, count(*) AS components, max(s) AS largest_component,
       CASE WHEN any_value(pairs) = sum(s) * sum(s) THEN CAST(any_value(d) AS BIGINT) END AS diameter_strict
FROM sizes JOIN far USING (time_week) GROUP BY time_week""", recursive=True))
def q_diameter_strict(spark, d):
    """Components of every week, and the diameter of the weeks that are one component."""
    from txgraph.operators.components import diameter_strict
    return diameter_strict(f2(spark, d))


@query("eccentricity_stats", O.with_base("f1", O.BFS + """,
ec AS (SELECT time_week, s AS node, max(d) AS ecc, count(*) AS reach FROM bfs GROUP BY ALL)""", """
SELECT time_week, round(avg(ecc), 6) AS mean_ecc, round(stddev_pop(ecc), 6) AS std_ecc,
       CAST(max(ecc) AS BIGINT) AS diameter_finite,
       CASE WHEN sum(reach) = count(*) * count(*) THEN CAST(max(ecc) AS BIGINT) END AS diameter_strict,
       round(sum(reach) / (count(*) * count(*)), 6) AS reach_fraction
FROM ec GROUP BY time_week""", recursive=True))
def q_eccentricity_stats(spark, d):
    """G13 eccentricity mean/std, finite and strict diameter, reachable share of pairs."""
    from txgraph.operators.paths import eccentricity_stats
    return eccentricity_stats(f1(spark, d))


# ---------------------------------------------------------------- step 8: eigenvector

# power iteration with per-week stop: identity edges give y = x + A^T x in one join;
# a week's rows stop being expanded once it converged or spent 1000 steps
_EIG = """
E2 AS (SELECT time_week, src, dst, 0 AS ident FROM e UNION ALL SELECT time_week, node, node, 1 FROM v),
pw(time_week, node, x, it, conv, fin) USING KEY (time_week, node) AS (
  SELECT time_week, node, 1.0 / count(*) OVER (PARTITION BY time_week), 0, false, false FROM v
  UNION
  SELECT time_week, node, xn, it + 1, l1 < n * 1e-6, l1 < n * 1e-6 OR it + 1 >= 1000 FROM (
    SELECT *, sum(abs(xn - xo)) OVER (PARTITION BY time_week) AS l1,
              count(*) OVER (PARTITION BY time_week) AS n FROM (
      SELECT *, y / sqrt(sum(y * y) OVER (PARTITION BY time_week)) AS xn FROM (
        SELECT p.time_week, E2.dst AS node, sum(p.x) AS y, any_value(p.it) AS it,
               sum(CASE WHEN E2.ident = 1 THEN p.x END) AS xo
        FROM pw p JOIN E2 ON E2.time_week = p.time_week AND E2.src = p.node
        WHERE NOT p.fin
        GROUP BY p.time_week, E2.dst))))"""


@query("eigenvector", O.with_base("f2", _EIG,
       "SELECT time_week, node, round(x, 6) AS eigenvector_centrality, conv AS converged FROM pw", recursive=True))
def q_eigenvector(spark, d):
    """G9 eigenvector centrality on F2; weeks that do not converge in 1000 steps have ``converged = false``."""
    from txgraph.operators.spectral import eigenvector_centrality
    return eigenvector_centrality(f2(spark, d))


@query("eigenvector_convergence", O.with_base("f2", _EIG, """
SELECT time_week, CAST(max(it) AS BIGINT) AS iterations, bool_or(conv) AS converged FROM pw GROUP BY time_week""",
       recursive=True))
def q_eigenvector_convergence(spark, d):
    """Steps used per week and whether the week converged."""
    from txgraph.operators.spectral import eigenvector_iterate
    return eigenvector_iterate(f2(spark, d))[1]


_EIG_SUMMARY = O.with_base("f2", _EIG + ",\nev AS (SELECT time_week, node, x FROM pw WHERE conv)", f"""
SELECT w.time_week, s.mean_eigenvector, s.std_eigenvector, s.gini_coefficient, w.converged
FROM (SELECT time_week, bool_or(conv) AS converged FROM pw GROUP BY time_week) w
LEFT JOIN ({_summary_sql("ev", "x", "eigenvector")}) s USING (time_week)""", recursive=True)


@query("summary_eigenvector", _EIG_SUMMARY)
def q_summary_eigenvector(spark, d):
    """G9 + G16; a week that did not converge has NULL statistics."""
    from txgraph.operators.spectral import eigenvector_summary
    return eigenvector_summary(f2(spark, d))


# ---------------------------------------------------------------- sources and set operations

@query("edges_labelled", O.with_base("f1", "",
       "SELECT time_week, src, dst, n_tx, 'txs' AS relationship FROM e WHERE time_week LIKE '1996%'"))
def q_edges_labelled(spark, d):
    """S2 + P4: the weeks of one year by prefix, with the constant edge label."""
    from txgraph.sources.transactions import select_weeks
    tx = select_weeks(transactions_f1(spark, d), "1996")
    return edge_ops.edges(tx, relationship="txs")


@query("edges_null_endpoints", O.with_base("f1", "", """
SELECT time_week, src, dst, count(*) AS n_tx FROM (SELECT time_week, nullif(src, 1) AS src, nullif(dst, 2) AS dst FROM tx) x
WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY ALL"""))
def q_edges_null_endpoints(spark, d):
    """P3 on transactions some of whose endpoints are null (customer 1 and supplier 2 are blanked)."""
    tx = transactions_f1(spark, d)
    return edge_ops.edges(tx.select("time_week", F.nullif("src", F.lit(1)).alias("src"), F.nullif("dst", F.lit(2)).alias("dst")))


@query("concat_years", O.with_base("f1", "", """
SELECT time_week, n, CAST(-1 AS BIGINT) AS m FROM wc WHERE time_week LIKE '1995%'
UNION ALL SELECT time_week, n, m FROM wc WHERE time_week LIKE '1996%'"""))
def q_concat_years(spark, d):
    """Weekly results with different columns, concatenated; a missing count is -1."""
    from txgraph.plans.series import concat
    c = edge_ops.week_counts(f1(spark, d))
    return concat([c.where(F.col("time_week").startswith("1995")).drop("m"), c.where(F.col("time_week").startswith("1996"))]).fillna(-1, ["m"])


# the sources of a sampled run: an md5 below the fraction, which both engines evaluate alike
_BETW_SAMPLED = _BETW.split("bw AS")[0].replace(
    "c.d = a.d + b.d", "c.d = a.d + b.d AND substr(md5(a.time_week || '|' || a.s), 1, 8) < '40000000'") + """
k AS (SELECT time_week, count(*) AS k FROM v WHERE substr(md5(time_week || '|' || node), 1, 8) < '40000000' GROUP BY ALL),
bw AS (SELECT v.time_week, v.node, coalesce(bt.bc * wc.n / k.k, 0.0) /
         CASE WHEN wc.n > 2 THEN (wc.n - 1.0) * (wc.n - 2.0) ELSE 1.0 END AS betweenness
       FROM v JOIN wc USING (time_week) LEFT JOIN k USING (time_week) LEFT JOIN bt USING (time_week, node))"""


@query("betweenness_sampled", O.with_base("f1", _BETW_SAMPLED,
       "SELECT time_week, node, round(betweenness, 6) AS betweenness FROM bw", recursive=True))
def q_betweenness_sampled(spark, d):
    """G8 from a quarter of the sources, chosen by a hash and scaled by n / k (Brandes-Pich)."""
    from txgraph.operators.paths import betweenness
    return betweenness(f1(spark, d), sample_fraction=0.25)


# ---------------------------------------------------------------- step 9: core-periphery

_CORE = """
P AS (SELECT DISTINCT time_week, least(src, dst) AS u, greatest(src, dst) AS v FROM e WHERE src <> dst),
K AS (SELECT v.time_week, v.node, count(P.u) AS kd FROM v
      LEFT JOIN P ON P.time_week = v.time_week AND (P.u = v.node OR P.v = v.node) GROUP BY ALL),
R AS (SELECT time_week, node, row_number() OVER (PARTITION BY time_week ORDER BY kd DESC, node) AS r,
             count(*) OVER (PARTITION BY time_week) AS n FROM K),
PE AS (SELECT P.time_week, greatest(a.r, b.r) AS hi, least(a.r, b.r) AS lo FROM P
       JOIN R a ON a.time_week = P.time_week AND a.node = P.u JOIN R b ON b.time_week = P.time_week AND b.node = P.v),
X AS (SELECT R.time_week, R.r AS k, R.n,
        (SELECT count(*) FROM PE WHERE PE.time_week = R.time_week) AS L,
        (SELECT count(*) FROM PE WHERE PE.time_week = R.time_week AND PE.hi <= R.r) AS l_c,
        (SELECT count(*) FROM PE WHERE PE.time_week = R.time_week AND PE.lo <= R.r AND PE.hi > R.r) AS l_cp
      FROM R WHERE R.r < R.n),
S AS (SELECT *, L - l_c - l_cp AS l_p, k * (k - 1) / 2.0 AS vc, k * (n - k) * 1.0 AS vcp,
             (n - k) * (n - k - 1) / 2.0 AS vp, n * (n - 1) / 2.0 AS vt FROM X),
SC AS (SELECT time_week, k, L * (
          (CASE WHEN l_c > 0 THEN (l_c / L) * ln((l_c / L) / (vc / vt)) ELSE 0 END) +
          (CASE WHEN l_cp > 0 THEN (l_cp / L) * ln((l_cp / L) / (vcp / vt)) ELSE 0 END) +
          (CASE WHEN l_p > 0 THEN (l_p / L) * ln((l_p / L) / (vp / vt)) ELSE 0 END)) AS score
       FROM S WHERE L > 0 AND l_c * vp >= l_p * vc),
B AS (SELECT time_week, arg_max(k, (round(score, 9), -k)) AS core_count FROM SC GROUP BY ALL),
CP AS (SELECT wc.time_week, CAST(coalesce(B.core_count, 0) AS BIGINT) AS core_count, wc.n AS network_size
       FROM (SELECT time_week, count(*) AS n FROM v GROUP BY ALL) wc LEFT JOIN B USING (time_week))"""


@query("core_periphery", O.with_base("f1", _CORE, "SELECT time_week, core_count, network_size FROM CP"))
def q_core_periphery(spark, d):
    """G14 + A11: core size by the best degree-ordered surprise cut, and network size."""
    from txgraph.operators.core import core_periphery
    return core_periphery(f1(spark, d))


@query("coreness", O.with_base("f1", _CORE, """
SELECT R.time_week, R.node, CASE WHEN R.r <= CP.core_count THEN 1 ELSE 0 END AS coreness
FROM R JOIN CP ON CP.time_week = R.time_week"""))
def q_coreness(spark, d):
    """G14 per node: 1 in the core, 0 in the periphery."""
    from txgraph.operators.core import coreness
    return coreness(f1_once(spark, d))


@query("core_ratio", O.with_base("f1", _CORE, """
SELECT time_week, core_count, network_size, round(core_count / network_size, 6) AS core_ratio FROM CP"""))
def q_core_ratio(spark, d):
    """P8 core ratio per week."""
    from txgraph.operators.core import core_periphery, core_ratio
    return core_ratio(core_periphery(f1(spark, d)))


# ---------------------------------------------------------------- step 10: series

def _series_sql(inner: str, exclude: str) -> str:
    """Date columns + exclusion around a weekly oracle query."""
    return f"""
SELECT CAST(make_date(year, 1, 1) + 7 * week AS TIMESTAMP) AS date, * FROM (
  SELECT CAST(substr(time_week, 1, 4) AS INT) AS year, CAST(substr(time_week, 5) AS INT) AS week, s.*
  FROM ({inner}) s)
WHERE NOT ({exclude})"""


_REFERENCE = "(year = 2018 AND week < 26) OR (year = 2022 AND week > 34)"


@query("core_refined", None)
def q_core_refined(spark, d):
    """G14 beyond degree order: score of the best prefix, and after accounts changed sides while that gained (iterative: no SQL)."""
    from txgraph.operators.core import refined_core
    return refined_core(f2(spark, d))[1]


def _series(name: str, base_name: str, cols: list[str] | None = None, exclude=None, exclude_sql: str = _REFERENCE):
    inner = ORACLE[base_name]
    if cols:
        inner = f"SELECT time_week, {', '.join(cols)} FROM ({inner}) b"

    @query(name, _series_sql(inner, exclude_sql))
    def q(spark, d):
        from txgraph.plans.series import REFERENCE_EXCLUDE, series
        df = QUERIES[base_name](spark, d)
        if cols:
            df = df.select("time_week", *cols)
        return series(df, REFERENCE_EXCLUDE if exclude is None else exclude)
    q.__doc__ = f"Dated series of {base_name}."
    return q


_series("series_basic", "degree_stats", ["nr_nodes", "nr_edges", "density"])
# an exclusion of weeks that the tables have: the reference's ranges lie after them
_series("series_basic_excluded", "degree_stats", ["nr_nodes", "nr_edges", "density"],
        ((1996, None, 26), (1998, 34, None)), "(year = 1996 AND week < 26) OR (year = 1998 AND week > 34)")
_series("series_degree_centrality", "summary_degree_centrality")
_series("series_closeness", "summary_closeness")
_series("series_betweenness", "summary_betweenness")
_series("series_eigenvector", "summary_eigenvector")
_series("series_attributes", "attributes")
_series("series_clustering_undirected", "clustering_undirected")
_series("series_eccentricity", "eccentricity_stats")
_series("series_core_ratio", "core_ratio", ["core_ratio"])


# ---------------------------------------------------------------- step 12: approximate closeness

@query("closeness_approx", O.with_base("f1", _CLOSE,
       "SELECT time_week, node, round(closeness, 6) AS closeness_approx FROM cl", recursive=True))
def q_closeness_approx(spark, d):
    """G7 by HyperBall (HLL balls, O(sketch) state per node).  Sketches are exact
    for the small balls of these weeks, so the exact oracle applies."""
    from txgraph.operators.paths import closeness_approx
    return closeness_approx(f1(spark, d))
