"""DuckDB SQL text for the fixtures and the per-query oracles.

The oracles are written independently of the Spark plans where possible
(brute-force pair sums for Gini, recursive CTEs for BFS and power iteration)
so that a wrong Spark plan is not mirrored by a wrong oracle.
Doubles are rounded to 9 significant digits on both sides; counts are BIGINT.
"""

from __future__ import annotations

# fixed value of the week key: year || (floor((day_of_year - 1) / 7) + 1), unpadded
_WEEK = ("CAST(year(o_orderdate) AS VARCHAR) || "
         "CAST(CAST(floor((dayofyear(o_orderdate) - 1) / 7) + 1 AS INT) AS VARCHAR)")


def tx_sql(fixture: str) -> str:
    if fixture == "f1":
        s, d = "o_custkey", "l_suppkey"
    else:
        k = "(SELECT greatest(5, count(*) // 100) FROM customer)"
        s, d = f"o_custkey % {k}", f"l_partkey % {k}"
    paid = (f"SELECT {_WEEK} AS time_week, CAST({s} AS BIGINT) AS src, CAST({d} AS BIGINT) AS dst "
            f"FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
    if fixture == "f1":
        return paid
    return (f"SELECT time_week, src, dst FROM ({paid}) a UNION ALL "
            f"SELECT time_week, dst, src FROM ({paid}) b WHERE (src + dst) % 5 > 0")


def base(fixture: str) -> str:
    """CTEs ``tx``, ``e`` (edges), ``v`` (vertices), ``deg`` (total degree), ``wc`` (n, m)."""
    return f"""
tx AS ({tx_sql(fixture)}),
e AS (SELECT time_week, src, dst, count(*) AS n_tx FROM tx
      WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY time_week, src, dst),
v AS (SELECT time_week, src AS node FROM e UNION SELECT time_week, dst FROM e),
deg AS (SELECT time_week, node, count(*) AS degree FROM
        (SELECT time_week, src AS node FROM e UNION ALL SELECT time_week, dst FROM e) GROUP BY ALL),
wc AS (SELECT time_week, (SELECT count(*) FROM v WHERE v.time_week = x.time_week) AS n, count(*) AS m
       FROM e x GROUP BY time_week)"""


def with_base(fixture: str, ctes: str, select: str, recursive: bool = False) -> str:
    extra = (",\n" + ctes) if ctes.strip() else ""
    return f"WITH {'RECURSIVE ' if recursive else ''}{base(fixture)}{extra}\n{select}"


# all-sources BFS: one row per (week, source s, reached t) with distance d and
# number of shortest paths sigma; USING KEY keeps the first (shortest) visit
BFS = """
bfs(time_week, s, t, d, sigma) USING KEY (time_week, s, t) AS (
  SELECT time_week, node, node, 0, CAST(1.0 AS DOUBLE) FROM v
  UNION
  SELECT e.time_week, b.s, e.dst, any_value(b.d) + 1, sum(b.sigma)
  FROM bfs b JOIN e ON e.time_week = b.time_week AND e.src = b.t
  WHERE e.src <> e.dst
    AND NOT EXISTS (SELECT 1 FROM recurring.bfs r
                    WHERE r.time_week = e.time_week AND r.s = b.s AND r.t = e.dst)
  GROUP BY ALL)"""


def gini_sql(vals: str, value: str, out: str = "gini_coefficient") -> str:
    """Brute-force Gini over a ``(time_week, <value>)`` relation.

    Pairs of distinct values weighted by their counts: sum c_a c_b |x_a - x_b| / 2
    is the sum over unordered pairs, and sum c_a c_b x_a = n * sum(x) = n^2 * mean.
    """
    return f"""(SELECT a.time_week,
        CASE WHEN sum(a.c * b.c * a.x) = 0 THEN NULL
             ELSE (sum(a.c * b.c * abs(a.x - b.x)) / 2.0) / sum(a.c * b.c * a.x) END AS {out}
      FROM (SELECT time_week, CAST({value} AS DOUBLE) AS x, count(*) AS c FROM {vals} GROUP BY ALL) a
      JOIN (SELECT time_week, CAST({value} AS DOUBLE) AS x, count(*) AS c FROM {vals} GROUP BY ALL) b
        USING (time_week)
      GROUP BY a.time_week)"""


def significant_sql(x: str) -> str:
    """``x`` to 9 significant digits by the same steps as ``catalog.significant``."""
    x = f"CAST({x} AS DOUBLE)"
    p = f"pow(10.0, 8 - least(8, floor(log10(abs({x}) * 1.000000001))))"
    r = f"round(round({x} * {p} * 1000.0) / 1000.0) / {p}"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) < 1e-14 THEN 0.0 ELSE {r} END)"


def significant_columns(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` of an oracle's text as ``significant_sql(<expr>)``."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 5, None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma is not None and sql[comma + 1:k].strip() == "6":
            out.append(sql[i:j])
            out.append(significant_sql(significant_columns(sql[j + 6:comma])))
            i = k + 1
        else:
            out.append(sql[i:j + 6])
            i = j + 6
