"""What streams drop and what they keep: an audit table of their progress, and reports on their state.

A watermark drops late rows without a trace in the output. The listener here
writes each micro-batch's counts to a table beside the layers, so rows in can be
held against rows out, duplicates and late rows; the reports read state stores
with Spark's state data source, so nobody has to guess what a query holds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from playback_qos.streaming.sinks import ROWS_IN, ROWS_OUT, _fs, ensure_dir

AUDIT = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("late_rows", T.LongType()),
    T.StructField("duplicate_rows", T.LongType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("operators", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("rows", T.LongType()),
        T.StructField("late", T.LongType()), T.StructField("duplicates", T.LongType()),
    ]))),
])


class ProgressAudit(StreamingQueryListener):
    """Writes a small file for each micro-batch of the session's named queries; a replayed batch replaces its file.

    ``rows_in`` and ``rows_out`` are counted in the query's own plan, before its
    stateful part and at its sink (null where a query does not count them).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        operators = [
            {"name": s.operatorName, "rows": s.numRowsTotal, "late": s.numRowsDroppedByWatermark,
             "duplicates": (s.customMetrics or {}).get("numDroppedDuplicateRows", 0)}
            for s in p.stateOperators
        ]
        counted = {k: v.asDict()["n"] for k, v in (p.observedMetrics or {}).items() if k in (ROWS_IN, ROWS_OUT)}
        row = {
            "query": p.name, "query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId, "at": p.timestamp,
            "source_rows": sum(s.numInputRows for s in p.sources),
            "rows_in": counted.get(ROWS_IN), "rows_out": counted.get(ROWS_OUT),
            "late_rows": sum(o["late"] for o in operators), "duplicate_rows": sum(o["duplicates"] for o in operators),
            "state_rows": sum(o["rows"] for o in operators), "watermark": (p.eventTime or {}).get("watermark"),
            "operators": operators,
        }
        target, fs = _fs(self.spark, f"{self.path}/{p.id}-{p.batchId:012d}.json")
        out = fs.create(target, True)
        out.write((json.dumps(row) + "\n").encode())
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_audit(spark: SparkSession, path: str) -> ProgressAudit:
    """Audit all queries of the session from now on; ``spark.streams.removeListener`` ends it."""
    ensure_dir(spark, path)
    audit = ProgressAudit(spark, path)
    spark.streams.addListener(audit)
    return audit


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT).json(path)


def balance(audit: DataFrame) -> DataFrame:
    """Sums a query, and ``unexplained`` = rows in less rows out, duplicates and late rows.

    0 for queries that pass each row on or drop it (the dedupes). An aggregation
    counts late rows after its partial aggregate, so there it is an upper bound
    of nothing: look at ``late_rows`` alone.
    """
    names = ("source_rows", "rows_in", "rows_out", "late_rows", "duplicate_rows")
    sums = audit.groupBy("query", "query_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.max_by("state_rows", "batch_id").alias("state_rows"))
    return sums.withColumn("unexplained", F.expr("rows_in - rows_out - duplicate_rows - late_rows"))


# --- state ------------------------------------------------------------------


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Keys and values of a stateful operator after a micro-batch (the last one by default)."""
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if batch is not None:
        reader = reader.option("batchId", str(batch))
    return reader.load(checkpoint)


def keys_by_day(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(eventDate, keys) that a dedupe or aggregation holds; a day that the watermark has passed has no row."""
    rows = state_rows(spark, checkpoint, operator, batch)
    return rows.groupBy(F.col("key.eventDate").alias("eventDate")).agg(F.count(F.lit(1)).alias("keys"))


def hottest_keys(
    spark: SparkSession, checkpoint: str, by: Sequence[str], n: int = 20, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """The ``n`` values of some key columns with most state: (columns, keys, events).

    ``keys`` is the number of keys in state; ``events`` the number of rows that
    Gold's aggregation has seen for them (null for a dedupe, which keeps no
    count). Counts are partial sums before they move; ``n`` rows are the report.
    """
    rows = state_rows(spark, checkpoint, operator, batch)
    value = rows.schema["value"].dataType
    counts = [i for i, f in enumerate(value.fields) if f.name == "count" and not f.nullable]  # count(1), which is never null
    if counts:  # names repeat in an aggregation's buffer: go by position
        names = T.StructType([T.StructField(f"v{i}", f.dataType) for i, f in enumerate(value.fields)])
        events = F.sum(F.col("value").cast(names).getField(f"v{counts[-1]}"))
    else:
        events = F.lit(None).cast("long")
    columns = [F.col("key").getField(c).alias(c) for c in by]
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("keys"), events.alias("events")).orderBy(
        F.desc_nulls_last("events"), F.desc("keys"), *by).limit(n)
