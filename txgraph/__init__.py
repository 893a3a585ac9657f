"""txgraph: weekly transaction-network analytics as distributed Spark plans.

Every metric is computed for all weeks of a transaction table in one job;
``time_week`` is a key of every group-by, join and window, never a driver loop.
"""

from txgraph.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
