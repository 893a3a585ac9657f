"""Week keys.

A week is the string ``<year><week>`` with the week NOT zero-padded
(``20221`` is week 1 of 2022, ``202210`` week 10), the folder naming of the
transaction store (``date=<key>``).  Year = first four characters, week = rest.
Week ``w`` of year ``y`` is plotted at ``y-01-01 + 7*w`` days.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_key_from_ts(ts) -> Column:
    """Week key of a timestamp: week = floor((day_of_year - 1) / 7) + 1."""
    ts = _c(ts)
    wk = (F.floor((F.dayofyear(ts) - 1) / 7) + 1).cast("int")
    return F.concat(F.year(ts).cast("string"), wk.cast("string"))


def week_year(key) -> Column:
    """``int(key[:4])``."""
    return F.substring(_c(key), 1, 4).cast("int")


def week_number(key) -> Column:
    """``int(key[4:])``."""
    return F.substring(_c(key), 5, 1 << 20).cast("int")


def week_date(key) -> Column:
    """Jan 1 of the year plus 7 * week days (week 1 of 2022 -> 2022-01-08)."""
    return F.date_add(F.make_date(week_year(key), F.lit(1), F.lit(1)), week_number(key) * 7)


def in_weeks(year, week, ranges) -> Column:
    """Boolean predicate for ``(year == y and after < week < before)`` ranges, OR-ed; None is an open end."""
    year, week = _c(year), _c(week)
    out = F.lit(False)
    for y, after, before in ranges:
        part = year == y
        if after is not None:
            part = part & (week > after)
        if before is not None:
            part = part & (week < before)
        out = out | part
    return out
