"""Batch and streaming readers for the layer tables and telemetry logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.schema import RAW


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    since: str | None = None,
) -> DataFrame:
    """Batch read of a layer table.

    ``merge_schema`` unions the column sets of all files (schema evolution);
    ``since`` keeps ``eventDate >= since``, which prunes whole partitions.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.load(path)
    if since is not None:
        df = df.filter(df["eventDate"] >= since)
    return df


#: Directory columns of the tables that per-batch writers make.
_BATCH_COLUMNS = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.IntegerType())])


def stored_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType | None:
    """The schema that a table's own files have, united over all of them (metadata only); None if it has no file yet."""
    try:
        return spark.read.format(fmt).option("mergeSchema", "true").load(path).schema
    except AnalysisException as e:
        # (a streamed table whose commit log lists no file has a condition without a name)
        if e.getCondition() == "PATH_NOT_FOUND" or "Unable to infer schema" in str(e):
            return None
        raise


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    partition_cols: tuple = ("eventDate",),
    batch_partitioned: bool = False,
) -> DataFrame:
    """Streaming scan of a table directory: all existing files first, then appends.

    The stream has the columns and types that the table's files have when it
    starts (files of an older or newer schema included), whatever the contract
    says of them, in ``schema``'s order and then the others. So missing, extra
    and differently typed columns reach the schema rule and Bronze as they
    are. ``schema`` is declared only for a table that has no file yet; columns
    that come later are seen from the next start on.

    ``max_files_per_trigger`` bounds a micro-batch (and with it the work any
    one key can bring to one task). A declared schema has the partition
    columns last, which is the order Spark produces for a partitioned
    directory. (Declared in the middle, an empty micro-batch comes out with
    names in one order and types in the other.) ``batch_partitioned`` is for
    tables written by per-batch writers (``query_id=<id>/batch_id=<n>/``):
    these columns are declared too, and then dropped.
    """
    found = stored_schema(spark, path, fmt)
    if found is None:
        head = [f for f in schema.fields if f.name not in partition_cols]
        tail = [f for f in schema.fields if f.name in partition_cols]
    else:
        head = [f for f in found.fields if not (batch_partitioned and f.name in _BATCH_COLUMNS.names)]
        tail = []
    if batch_partitioned:
        tail = tail + _BATCH_COLUMNS.fields
    names = [f.name for f in head + tail if not (batch_partitioned and f.name in _BATCH_COLUMNS.names)]
    order = [c for c in schema.names if c in names]
    reader = spark.readStream.format(fmt).schema(T.StructType(head + tail))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(*order, *[c for c in names if c not in order])


def read_batch_table_stream(spark, path, schema, fmt="parquet", max_files_per_trigger=None):
    """Stream over a table written by a per-batch writer (``batch_id=<n>``
    directories; a Delta table is appended to directly)."""
    return read_stream(spark, path, schema, fmt, max_files_per_trigger, partition_cols=(),
                       batch_partitioned=fmt != "delta")


_FILE_POSITION = {"log_file": "_metadata.file_path", "log_split": "_metadata.file_block_start"}


def with_log_line(lines: DataFrame) -> DataFrame:
    """Add ``log_line`` to lines as they come from the scan: it grows with the
    line's place within a split (with ``log_file`` and ``log_split`` before it,
    the whole log position). Lines that have it, as those of a tailed log, keep it."""
    return lines if "log_line" in lines.columns else lines.withColumn("log_line", F.monotonically_increasing_id())


def telemetry_lines(spark: SparkSession, path: str) -> DataFrame:
    """Receiver log files (JSON lines), batch: ``value`` and the columns of LOG_POSITION."""
    lines = spark.read.text(path)
    return with_log_line(lines.select("value", *[F.col(c).alias(n) for n, c in _FILE_POSITION.items()]))


def telemetry_lines_stream(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """Closed log files (JSON lines), stream: ``value``, ``log_file`` and
    ``log_split``; each micro-batch adds ``log_line`` (streams refuse it).

    Each file is read once, when it appears: what is appended later is not
    seen. Logs that grow are for ``sources.tail.tail_lines``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("value", *[F.col(c).alias(n) for n, c in _FILE_POSITION.items()])


def export_gold(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
                partition_by: str | None = None) -> None:
    """Copy a Gold table to Parquet for BI tools (overwrite).

    The files hold all columns; with ``partition_by`` that column moves into
    the directory names.
    """
    writer = spark.read.format(fmt).load(src).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(dst)
