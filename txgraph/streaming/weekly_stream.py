"""Weekly metrics as a file-source stream.

The transaction store grows by week folders (``date=<key>``).  A file stream
over the store notices new files; each micro-batch names the weeks it touched,
those weeks are re-read whole from the store (a week may arrive in several
files over several batches) and recomputed together, and their rows replace
the same weeks in the sink (dynamic partition overwrite).  Re-running a batch
after a failure rewrites the same weeks with the same values, so the sink is
idempotent; progress is kept in the query's checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txgraph.operators.edges import W, edges
from txgraph.plans.weekly import METRICS, weekly_report
from txgraph.sources.transactions import PART, TX_SCHEMA, of_weeks, read_transactions, reader_options, write_weekly


def start_weekly_stream(spark: SparkSession, source_root: str, sink_root: str, checkpoint: str,
                        fmt: str = "csv", metrics=METRICS, trigger_once: bool = False,
                        max_files_per_trigger: int | None = None, interval: str = "1 minute") -> StreamingQuery:
    r = reader_options(spark.readStream.format(fmt).schema(TX_SCHEMA).option("basePath", source_root), fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.load(source_root).select(F.col(PART).cast("string").alias(W))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # one key a touched week: they prune the folders that are read again
        weeks = sorted(r[W] for r in batch.select(W).distinct().collect())
        if not weeks:
            return
        tx = of_weeks(read_transactions(spark, source_root, fmt=fmt), weeks)
        write_weekly(weekly_report(edges(tx), metrics), sink_root, files=1)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime=interval)
    return w.start()
