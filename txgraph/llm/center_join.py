"""Similar pairs within groups of near copies, by what sets the members apart from a centre.

A group's members are sets (the numbered shingles of texts).  With a set ``C`` a member ``x`` is held as
``D(x)``, the elements that only one of the two has.  Elements that cancel do so twice, so for any two members

    |x - y| + |y - x| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|

and the Jaccard similarity follows exactly, without the sets themselves.  With ``g = (1 + t) / (1 - t)`` and
``r(x) = g |D(x)| - |x|`` two members have the similarity ``t`` if and only if ``r(x) + r(y) <= 2 g |D(x) & D(y)|``:

* Where ``r(x) + r(y) <= 0`` they are similar whatever they share.  Then both are similar to the member
  of the least ``r`` as well, so one pair with that one for each member keeps the components.
* Else they share an element of ``D``, and the prefix, positional and bitmap filters apply, rarest elements first.
  Near copies have their changes in ``D``, which few others share; so thousands of copies that all are
  somewhat less similar to each other than ``t`` do not meet, though they share most of their shingles.

``C`` is the text of one member, with the elements changed that more than half of the members set apart.
All is exact for any centre; a centre far from its members costs candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.kernels import mix64, occurrences, shingles, text_chunks
from txgraph.session import cut, discard

#: Members that read one copy of their centre's text.
BLOCK = 256
#: Words of a member's bitmap: two members share at most half of what the bits in which they differ leave.
WORDS = 4
#: Slack of filters in floating point; the verification has none.
SLACK = 1e-6


def units(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbered five-word shingles of a column of texts, with their row."""
    got, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for lo, _, data, off in text_chunks(col):
        s, row, _, _ = shingles(data, off)
        got.append(occurrences(s, row))
        rows.append(row + lo)
    return np.concatenate(got), np.concatenate(rows)


def in_row(unit: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Units that differ between rows, so that rows can be compared all at once."""
    return unit ^ mix64(row.astype(np.uint64) + np.uint64(7))


def differences(pairs: DataFrame) -> DataFrame:
    """``center, uid, root, n, n_center, e`` for ``center, uid, root, text, text_c``; odd ``e`` are the centre's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1)
        for b in batches:
            for start in range(0, b.num_rows, 64):
                part = b.slice(start, 64)
                n = part.num_rows
                (x, rx), (c, rc) = units(part.column("text")), units(part.column("text_c"))
                kx, kc = in_row(x, rx), in_row(c, rc)
                more, less = ~np.isin(kx, kc), ~np.isin(kc, kx)
                row = np.concatenate([rx[more], rc[less]])
                e = np.concatenate([x[more] & ~one, c[less] | one])[np.argsort(row, kind="stable")]
                off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
                yield pa.record_batch(
                    [part.column("center"), part.column("uid"), part.column("root"), pa.array(np.bincount(rx, minlength=n)),
                     pa.array(np.bincount(rc, minlength=n)), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(e.view(np.int64)))],
                    names=["center", "uid", "root", "n", "n_center", "e"])

    return pairs.select("center", "uid", "root", "text", "text_c").mapInArrow(
        run, "center long, uid long, root long, n long, n_center long, e array<long>")


def bitmap(e: Column) -> list[Column]:
    """``WORDS`` words of 64 bits, one bit for each element."""
    def word(k: int) -> Column:
        mine = F.filter(e, lambda t: F.pmod(F.shiftrightunsigned(t, 16), F.lit(WORDS)) == k)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda a, t: a.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(t, 32), F.lit(64)).cast("int"))))

    return [word(k).alias(f"b{k}") for k in range(WORDS)]


def around(groups: DataFrame, text: DataFrame, threshold: float) -> DataFrame:
    """Members of ``groups(center, uid, root)`` as differences from their group's centre; a written table.

    ``text(uid, text)`` has all members and centres.  Columns: ``center, uid, root, n, size_c, e, d, r, b0..., low``; ``size_c`` is the
    size of the centre after its changes, ``b0...`` the bitmap of ``e`` and ``low`` the member of the least ``r``.
    """
    g = (1 + threshold) / (1 - threshold)
    blocks = groups.groupBy("center").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    centers = (text.select(F.col("uid").alias("center"), F.col("text").alias("text_c")).join(blocks, "center")
               .select("center", "text_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")))
    members = groups.join(blocks, "center").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks"))).drop("blocks")
    apart = cut(differences(members.join(text, "uid").join(centers, ["center", "block"])))
    size = apart.groupBy("center").agg(F.count("*").alias("size"))
    change = (apart.select("center", F.explode("e").alias("t")).groupBy("center", "t").agg(F.count("*").alias("f"))
              .join(size, "center").where("2 * f > size").groupBy("center").agg(F.collect_list("t").alias("change")))
    own = lambda keep: F.size(F.filter("change", lambda t: t.bitwiseAND(F.lit(1)) == keep))
    none = F.col("change").isNull()
    moved = (apart.join(change, "center", "left")
             .withColumn("size_c", F.when(none, F.col("n_center")).otherwise(F.col("n_center") + own(0) - own(1)))
             .withColumn("e", F.when(none, F.col("e")).otherwise(F.concat(F.array_except("e", "change"), F.array_except("change", "e"))))
             .withColumn("d", F.size("e").cast("long")).withColumn("r", F.col("d") * g - F.col("n")))
    moved = cut(moved.select("center", "uid", "root", "n", "size_c", "e", "d", "r", *bitmap(F.col("e"))))
    low = moved.groupBy("center").agg(F.min(F.struct("r", "uid")).alias("low"))
    out = cut(moved.join(low, "center"))
    discard(apart, moved)
    return out


def candidates(near: DataFrame, threshold: float) -> DataFrame:
    """``center, a, b``, ``a < b``: pairs of different ``root`` in a group of which one is not of the centre's root.

    With every pair of the similarity either it is here, or both its members are here with the group's ``low``.
    """
    g = (1 + threshold) / (1 - threshold)
    ends = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    settled = (near.where((F.col("r") + F.col("low.r") <= SLACK) & (F.col("uid") != F.col("low.uid")))
               .select("center", *ends("uid", "low.uid")))
    bits = [f"b{k}" for k in range(WORDS)]
    rows = near.select("center", "uid", "root", "d", "r", "size_c", *bits, F.col("low.r").alias("least"), F.explode("e").alias("t"))
    # an element of one member only is shared with none; those come first in every order
    shared = rows.groupBy("center", "t").agg(F.count("*").alias("f")).where("f > 1")
    rows = rows.join(shared, ["center", "t"])
    mine = W.partitionBy("center", "uid")
    rows = rows.withColumn("p", F.col("d") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("f", "t")))
    # least overlap with any similar member
    need = F.greatest(F.lit(1), F.ceil((F.col("r") - F.col("size_c")) / (g + 1) - SLACK), F.ceil((F.col("r") + F.col("least")) / (2 * g) - SLACK))
    rows = rows.where(F.col("p") <= F.col("d") - need + 1).select("center", "t", "uid", "root", "d", "r", "p", *bits)
    rows = cut(rows)
    x, y = rows.where("root <> center").alias("x"), rows.alias("y")
    c = F.col
    reach = 1 + F.least(c("x.d") - c("x.p"), c("y.d") - c("y.p"))
    differ = sum(F.bit_count(c(f"x.{b}").bitwiseXOR(c(f"y.{b}"))) for b in bits)
    meet = (x.join(y, (c("x.center") == c("y.center")) & (c("x.t") == c("y.t")) & (c("x.root") != c("y.root"))
                   & ((c("x.uid") < c("y.uid")) | (c("y.root") == c("y.center")))
                   & (reach * (2 * g) >= c("x.r") + c("y.r") - SLACK)
                   & ((c("x.d") + c("y.d") - differ) * g >= c("x.r") + c("y.r") - SLACK))
            .select("x.center", *ends("x.uid", "y.uid")))
    out = cut(settled.unionByName(meet).groupBy("a", "b").agg(F.min("center").alias("center")))
    discard(rows)
    return out


def similar(near: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs(center, a, b)`` that have the similarity, as ``a, b``; a written table."""
    side = lambda k: near.select("center", F.col("uid").alias(k), *[F.col(v).alias(v + k) for v in ("n", "e", "d")])
    both = pairs.join(side("a"), ["center", "a"]).join(side("b"), ["center", "b"])
    differ = F.col("da") + F.col("db") - 2 * F.size(F.array_intersect("ea", "eb"))
    total = F.col("na") + F.col("nb")
    return cut(both.where(F.try_divide((total - differ).cast("double"), (total + differ).cast("double")) >= threshold).select("a", "b"))
