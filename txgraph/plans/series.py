"""Dated weekly series.

A weekly table gets ``year``, ``week`` (numeric, so week 10 sorts after week 2)
and ``date`` (Jan 1 + 7 * week days), loses the excluded week ranges, and is
sorted last (sorting before the exclusion would not survive it).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txgraph.functions.weeks import in_weeks, week_date, week_number, week_year
from txgraph.operators.edges import W

# fixed values of the reference plots: (year, after week, before week) left out, None for an open end
REFERENCE_EXCLUDE = ((2018, None, 26), (2022, 34, None))


def with_dates(df: DataFrame, week: str = W) -> DataFrame:
    """P6 + P7: add ``year``, ``week`` and ``date`` (a time-zone free timestamp at midnight)."""
    return df.select("*", week_year(week).alias("year"), week_number(week).alias("week"),
                     week_date(week).cast("timestamp_ntz").alias("date"))


def exclude_rows(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows of ``df`` with no null-safe equal row in ``excluded`` (left anti join)."""
    cols = df.columns
    ex = excluded.select(*[F.col(c).alias(f"_x_{c}") for c in cols])
    cond: Column = reduce(lambda a, b: a & b, [df[c].eqNullSafe(ex[f"_x_{c}"]) for c in cols])
    return df.join(ex, cond, "left_anti")


def series(df: DataFrame, exclude=REFERENCE_EXCLUDE, week: str = W) -> DataFrame:
    """Weekly metrics as a dated series: ``date, year, week, <metrics>`` sorted by (year, week)."""
    d = with_dates(df, week)
    if exclude:
        # P9; the same as J1 against the excluded rows, without evaluating the metrics twice
        d = d.where(~F.coalesce(in_weeks("year", "week", exclude), F.lit(False)))
    metrics = [c for c in df.columns if c != week]
    return d.select("date", "year", "week", week, *metrics).orderBy("year", "week")  # J3


def concat(parts: list[DataFrame]) -> DataFrame:
    """Union of weekly results by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def degree_distribution(e: DataFrame, bins: int = 30) -> dict[str, DataFrame]:
    """V7: the tables behind the degree-distribution figure, for every week.

    ``pdf`` unit-bin PDF (A9, empty bins dropped as P10), ``markers`` median,
    p95, p99 (A6, A7) and ``histogram`` the equal-width density histogram (A10).
    """
    from txgraph.operators.degree import degree_histogram, degree_pdf, node_degree
    from txgraph.operators.stats import percentiles
    return {"pdf": degree_pdf(e), "markers": percentiles(node_degree(e), "degree"),
            "histogram": degree_histogram(e, bins)}
