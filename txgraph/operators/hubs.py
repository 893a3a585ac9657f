"""Attach one row per node to many edges when a few nodes have most of the edges.

A plain join of edges with a node table sends all edges of a hub to one task.  Here the hubs are found by a
partial count of the edges' ends, which no task sees unaggregated.  A hub has more than ``chunk`` edges and more than
1 / ``HUB_ROWS`` of all, so there are fewer than ``HUB_ROWS`` of them whatever the data, and their table may
be broadcast.  A hub's edges are dealt to ``ceil(edges / chunk)`` salts by a hash of the row and its node row is
repeated as often; all other keys keep salt 0.  So one shuffled join serves hubs and the rest, and no key of it has
more than about ``max(chunk, edges / HUB_ROWS)`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.operators.edges import W

HUB_CHUNK = 1 << 14  # tunable: edges of a node that are joined under one key
HUB_ROWS = 1 << 16


def hubs(rows: DataFrame, key: str, chunk: int = HUB_CHUNK) -> DataFrame:
    """``(time_week, key, _parts)`` of the nodes whose rows are split; fewer than ``HUB_ROWS`` rows."""
    return hubs_of(rows.groupBy(W, key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", chunk)


def hubs_of(counts: DataFrame, key: str, count: str, chunk: int = HUB_CHUNK) -> DataFrame:
    """The same from a table with the ``count`` of rows (or an upper bound) of each ``(time_week, key)``."""
    share = counts.agg(F.floor(F.coalesce(F.sum(count), F.lit(0)) / F.lit(HUB_ROWS)).alias("n")).scalar()
    return (counts.where(F.col(count) > F.greatest(F.lit(chunk).cast("long"), share.cast("long")))
            .select(W, key, F.ceil(F.col(count) / F.lit(chunk)).cast("int").alias("_parts")))


def salted(rows: DataFrame, key: str, hub: DataFrame) -> DataFrame:
    """``rows`` with the salt of their hub (0 elsewhere)."""
    part = F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int")
    return rows.join(F.broadcast(hub), [W, key], "left").withColumn("_salt", F.coalesce(part, F.lit(0))).drop("_parts")


def repeated(values: DataFrame, key: str, hub: DataFrame) -> DataFrame:
    """``values``, a hub's row once for each of its salts."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return values.join(F.broadcast(hub), [W, key], "left").withColumn("_salt", F.explode(salts)).drop("_parts")


def attach(rows: DataFrame, values: DataFrame, key: str, chunk: int = HUB_CHUNK, how: str = "inner",
           count: str | None = None) -> DataFrame:
    """``rows`` with the columns of ``values``, one row per ``(time_week, key)``.

    ``count`` names the column of ``values`` that is the number of the key's rows, or above it (a degree); without it
    ``rows`` are counted, so they are read twice and should be a written table or a short plan.
    """
    hub = hubs(rows, key, chunk) if count is None else hubs_of(values.select(W, key, count), key, count, chunk)
    return salted(rows, key, hub).join(repeated(values, key, hub), [W, key, "_salt"], how).drop("_salt")
