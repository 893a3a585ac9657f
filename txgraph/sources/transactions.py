"""Weekly transaction store: ``<root>/date=<time_week>/*.csv|parquet``.

* S1 scan with an explicit schema (no inference pass); all weeks at once via
  partition discovery, the folder value kept as STRING ``time_week``.  Lines that do not fit the
  schema are set aside (``rejected_lines``), never read as rows with null endpoints.
* S2 week selection by prefix is a partition filter -> partition pruning.
* S3 incremental run: weeks of the source whose folder is not yet in the sink,
  found from the folder listing of both, never by reading rows.
* S4 sink: partitioned by week with dynamic partition overwrite, so a rerun
  replaces exactly the weeks it recomputes and nothing else.
* S5 result re-read: one scan over the partitioned sink root; CSV files are read by their own header and
  united by column name, as the files of different versions may order or extend the columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "date"  # folder key of the store: date=<year><week>

TX_SCHEMA = T.StructType([
    T.StructField("SenderId", T.StringType()),
    T.StructField("TargetId", T.StringType()),
    T.StructField("Year_no", T.IntegerType()),
    T.StructField("Week_no", T.IntegerType()),
    T.StructField(PART, T.StringType()),
])


def reader_options(reader, fmt: str, header: bool = True, trim: bool = True):
    """Options of the weekly files, for batch and stream readers."""
    if fmt == "csv":
        reader = (reader.option("header", str(header).lower())
                  .option("ignoreLeadingWhiteSpace", str(trim).lower())
                  .option("ignoreTrailingWhiteSpace", str(trim).lower()))
    return reader


REJECTED = "_rejected"


def _scan(spark: SparkSession, root: str, fmt: str, schema: T.StructType | None, header: bool, prefix: str | None,
          trim: bool) -> DataFrame:
    """All rows of the store; ``_rejected`` holds the whole line of a row that does not fit ``schema``."""
    r = spark.read.format(fmt)
    marked = fmt == "csv" and schema is not None
    if marked:
        r = r.schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])) \
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    elif schema is not None:
        r = r.schema(schema)
    elif fmt == "csv":
        r = r.option("inferSchema", "true")
    df = reader_options(r, fmt, header, trim).load(root)
    line = F.lit(None).cast("string")
    if marked:
        # always true, and refers to every field: a line is judged by all of them, whatever columns a query needs
        parsed = F.xxhash64(*[f.name for f in schema.fields if f.name != PART]) <= F.lit((1 << 63) - 1)
        line = F.when(parsed, F.col(REJECTED))
    return select_weeks(df.select(F.col(PART).cast("string").alias("time_week"), F.col("SenderId").alias("src"), F.col("TargetId").alias("dst"),
                                  "Year_no", "Week_no", line.alias(REJECTED)), prefix)


def read_transactions(spark: SparkSession, root: str, fmt: str = "csv",
                      schema: T.StructType | None = TX_SCHEMA, header: bool = True,
                      prefix: str | None = None, trim: bool = True) -> DataFrame:
    """Scan every week under ``root``; returns ``(time_week, src, dst, Year_no, Week_no)`` of the lines that fit the schema."""
    df = _scan(spark, root, fmt, schema, header, prefix, trim)
    return df.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_lines(spark: SparkSession, root: str, fmt: str = "csv", schema: T.StructType | None = TX_SCHEMA,
                   header: bool = True, prefix: str | None = None, trim: bool = True) -> DataFrame:
    """``(time_week, line)`` of the lines with too few or too many fields, or with a field of another type."""
    df = _scan(spark, root, fmt, schema, header, prefix, trim)
    return df.where(F.col(REJECTED).isNotNull()).select("time_week", F.col(REJECTED).alias("line"))


def select_weeks(df: DataFrame, prefix: str | None, week: str = "time_week") -> DataFrame:
    """Keep weeks whose key starts with ``prefix`` (``'2022'``, ``'20'``); None keeps all."""
    return df if not prefix else df.where(F.col(week).startswith(prefix))


def read_weekly(spark: SparkSession, root: str, fmt: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """Re-read a weekly sink as one DataFrame with ``time_week``."""
    if fmt == "csv" and schema is None:
        df = _read_by_header(spark, root)
    else:
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.option("header", "true")
        df = (r if schema is None else r.schema(schema)).load(root)
    return df.withColumn(PART, F.col(PART).cast("string")).withColumnRenamed(PART, "time_week")


def _read_by_header(spark: SparkSession, root: str) -> DataFrame:
    """The CSV files of a weekly root, those of each header read apart and united by column name.

    A file's header is its first line: in the split at offset 0 it is the row with the smallest number, as a split is
    read in order.  The driver gets the distinct headers and, for each, the names of its files.
    """
    lines = spark.read.text(root).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                         "value", F.monotonically_increasing_id().alias("n"))
    heads = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    read = spark.read.option("header", "true").option("inferSchema", "true").option("basePath", root)
    if not groups:  # no line at all
        return read.csv(root)
    parts = [read.csv(g.files) for g in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_week(spark: SparkSession, root: str, key: str, fmt: str = "parquet") -> DataFrame:
    """One week of a weekly sink (a partition filter, so only its folder is listed)."""
    return read_weekly(spark, root, fmt).where(F.col("time_week") == key)


def stored_weeks(spark: SparkSession, root: str) -> DataFrame:
    """``time_week`` of each week folder under ``root``, from the file listing: no file is opened.

    A root that does not exist holds no week; any other error is raised.
    """
    try:
        files = spark.read.format("binaryFile").load(root)  # without its content column: paths only
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "time_week string")
    if PART not in files.columns:
        return spark.createDataFrame([], "time_week string")
    return files.select(F.col(PART).cast("string").alias("time_week")).distinct()


def pending_weeks(spark: SparkSession, source_root: str, sink_root: str, prefix: str | None = None) -> list[str]:
    """S3: weeks of the store without a folder in the sink (``left_anti`` on one row a folder).

    The keys go into the partition filter of the store's scan, so finished weeks are not read.
    """
    todo = select_weeks(stored_weeks(spark, source_root), prefix).join(stored_weeks(spark, sink_root), "time_week", "left_anti")
    return sorted(r.time_week for r in todo.collect())


def of_weeks(df: DataFrame, weeks: list[str], week: str = "time_week") -> DataFrame:
    """Rows of the given weeks: a partition filter on a weekly store."""
    return df.where(F.col(week).isin(weeks))


def write_weekly(df: DataFrame, sink_root: str, fmt: str = "parquet",
                 week: str = "time_week", files: int = 8) -> None:
    """Write ``df`` partitioned by week; only the weeks present in ``df`` are replaced.

    At most ``files`` files a week: rows are dealt by week and a hash of the whole row, so a week that is a
    third of all rows is still written by several tasks.
    """
    out = df.withColumnRenamed(week, PART)
    salt = F.pmod(F.xxhash64(*out.columns), F.lit(files)) if files > 1 else F.lit(0)
    w = (out.repartition(F.col(PART), salt).sortWithinPartitions(PART).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(PART))
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(sink_root)
