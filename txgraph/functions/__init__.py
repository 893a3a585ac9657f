"""Column expressions (all built-in, JVM-side; no Python UDFs)."""

from txgraph.functions.weeks import (week_key_from_ts, week_year, week_number,
                                     week_date, in_weeks)
from txgraph.functions.safe import safe_div

__all__ = ["week_key_from_ts", "week_year", "week_number", "week_date", "in_weeks", "safe_div"]
