"""Streaming stages: raw -> bronze -> validated (+DQ) -> silver -> gold,
and the telemetry path. Each stage is its own query with its own
checkpoint, decoupled from the next one by a table."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playback_qos.operators import bronze as B
from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.operators import silver as S
from playback_qos.operators import telemetry as TM
from playback_qos.schema import (
    DISTRIBUTION,
    KEYS,
    LOG_POSITION,
    TELEMETRY,
    TELEMETRY_ORDER,
    raw_schema,
    silver_schema,
)
from playback_qos.session import multi_state_store
from playback_qos.sources import tables as TB
from playback_qos.sources.tail import tail_lines
from playback_qos.streaming import sinks as K
from playback_qos.streaming.layout import Layout
from playback_qos.streaming.state import LATE, SLOT_MS, buffering_intervals_stream

#: Input files of one telemetry micro-batch, which bounds what a session brings to one task.
TELEMETRY_FILES_PER_TRIGGER = 64

#: Columns of the accepted telemetry table.
TELEMETRY_STORED = T.StructType(LOG_POSITION.fields + TELEMETRY.fields)

#: New log bytes of one micro-batch of tailed logs.
TELEMETRY_BYTES_PER_TRIGGER = 1 << 30

_DAY = "_event_day"
_SALT = "_salt"


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    return False


def _day_watermark(df: DataFrame, late_days: int) -> DataFrame:
    """Event-time column of the day, rows ``late_days`` behind the newest day being on time.

    (Spark drops what is as old as the watermark itself, so that is a second older.)
    """
    return df.withColumn(_DAY, F.to_timestamp(F.col("eventDate"))).withWatermark(_DAY, f"{int(late_days)} days 1 second")


def dedupe_stream(df: DataFrame, keys: Sequence[str] = KEYS, late_days: int | None = None,
                  salt_buckets: int | None = None) -> DataFrame:
    """Streaming dedupe on ``keys`` (first arriving row per key survives).

    ``late_days=None`` keeps every key in state forever (reference behaviour).
    ``late_days=n`` adds a watermark on the event day and puts that day in the
    key: same result for data at most ``n`` days late, state evicted per day,
    later rows dropped by the watermark.

    ``salt_buckets=n`` splits hot keys: a first stateful dedupe on
    (keys, hash(row) mod n) spreads one key's rows over n tasks and lets at
    most n rows per key through, ever; the second dedupe on ``keys`` then
    keeps one. Without it, all rows of a key in a micro-batch meet in one task.
    """
    keys = list(keys)
    if late_days is not None:
        df = _day_watermark(df, late_days)
        keys = [*keys, _DAY]
    if salt_buckets:
        hashable = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in hashable]), F.lit(int(salt_buckets)))
        df = df.withColumn(_SALT, salt).dropDuplicates([*keys, _SALT]).drop(_SALT)
    out = df.dropDuplicates(keys)
    return out.drop(_DAY) if late_days is not None else out


def dedupe_first_stream(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ("serverTimestamp", "agentTimestamp"),
    late_days: int = 1,
) -> DataFrame:
    """Deterministic streaming dedupe: per key, the row first by ``order``.

    An event-time aggregation (``min_by`` per key and day) under a watermark
    of ``late_days`` on the event day, in append mode: each key's row is
    emitted once its day is closed, and the day's state is then dropped. Spark
    plans a partial aggregate before the state shuffle, so a hot key reaches
    the state store as one row per map task. The price is latency (a day plus
    ``late_days``); rows with a null ``eventDate`` never close and are not
    emitted, so use it after validation (Silver), where the date is required.
    """
    keys = list(keys)
    columns = df.columns
    best, payload = B.first_row(df.schema, [c for c in columns if c not in keys], order)
    out = {c: F.col(c) for c in keys} | payload
    return (
        _day_watermark(df, late_days)
        .groupBy(*keys, _DAY)
        .agg(best.alias("_best"))
        .select(*[out[c] for c in columns])
    )


def stream_bronze(spark: SparkSession, layout: Layout, fmt: str = "parquet",
                  trigger: str | None = "30 seconds", late_days: int | None = None,
                  max_files_per_trigger: int | None = None,
                  tier_type: T.DataType = DISTRIBUTION,
                  salt_buckets: int | None = None) -> StreamingQuery:
    """Raw table stream -> id filter -> dedupe -> Bronze (partitioned by eventDate).

    Bronze gets every column of the source. ``tier_type`` is the value type of
    ``qualityDistribution`` where the source has no file yet.
    """
    raw = TB.read_stream(spark, layout.source_raw, raw_schema(tier_type), fmt,
                         max_files_per_trigger)
    out = dedupe_stream(K.counted(B.minimal_validation(raw), K.ROWS_IN), KEYS, late_days, salt_buckets)
    return K.append_stream(out, layout.bronze, layout.checkpoint("source_to_bronze"), fmt,
                           "eventDate", trigger, name="source_to_bronze")


def stream_validation(spark: SparkSession, layout: Layout, bounds: Q.Bounds = Q.DEFAULT_BOUNDS,
                      fmt: str = "parquet", trigger: str | None = None,
                      max_files_per_trigger: int | None = None,
                      tier_type: T.DataType = DISTRIBUTION) -> StreamingQuery:
    """Bronze stream -> per micro-batch: valid rows + four DQ rows (idempotent)."""
    bronze = TB.read_stream(spark, layout.bronze, raw_schema(tier_type), fmt,
                            max_files_per_trigger)
    w = (
        bronze.writeStream.foreachBatch(
            K.validation_batch_writer(layout.validated, layout.dq_results, bounds, fmt)
        )
        .option("checkpointLocation", layout.checkpoint("bronze_to_bronze_validated"))
        .queryName("bronze_to_bronze_validated")
    )
    return w.trigger(**K.trigger_kwargs(trigger)).start()


def stream_silver(spark: SparkSession, layout: Layout, fmt: str = "parquet",
                  trigger: str | None = "30 seconds", late_days: int | None = None,
                  max_files_per_trigger: int | None = None,
                  tier_type: T.DataType = DISTRIBUTION,
                  dedupe_mode: str = "first_seen",
                  salt_buckets: int | None = None) -> StreamingQuery:
    """Validated stream -> clamp, tiers, flatten -> dedupe -> Silver.

    ``dedupe_mode="first_seen"`` keeps the first arriving row per key
    (reference behaviour); ``"first_by_order"`` keeps the earliest by server
    and agent time, deterministically, emitted when the day closes (needs
    ``late_days``).
    """
    valid = TB.read_batch_table_stream(spark, layout.validated, raw_schema(tier_type), fmt,
                                       max_files_per_trigger)
    flat = K.counted(S.silver_rows(valid), K.ROWS_IN)
    if dedupe_mode == "first_seen":
        out = dedupe_stream(flat, KEYS, late_days, salt_buckets)
    elif dedupe_mode == "first_by_order":
        if late_days is None:
            raise ValueError("first_by_order needs late_days (the watermark delay)")
        if trigger == "available_now":
            raise ValueError("first_by_order holds days back until the watermark has passed them, so a run that drains its "
                             "input and stops leaves them out; streaming.incremental keeps the first row of each chunk")
        out = dedupe_first_stream(flat, KEYS, late_days=late_days)
    else:
        raise ValueError(f"unknown dedupe_mode {dedupe_mode!r}")
    return K.append_stream(out, layout.silver, layout.checkpoint("bronze_to_silver"), fmt,
                           "eventDate", trigger, name="bronze_to_silver")


def stream_gold(spark: SparkSession, layout: Layout, fmt: str = "parquet",
                trigger: str | None = None, quality_order: str = "lexical",
                max_files_per_trigger: int | None = None,
                tier_type: T.DataType = DISTRIBUTION, mode: str = "merge",
                late_days: int | None = None, combined: bool = True) -> list[StreamingQuery]:
    """Silver stream -> QoS fields -> daily aggregates per viewer and per content.

    * ``mode="merge"`` (default): update-mode aggregation emits only changed
      groups and :func:`sinks.partition_merge_writer` rewrites only the days
      they touch, so a trigger's cost follows the new data, not the table
      size. The table content is the same as in complete mode.
    * ``mode="complete"`` (reference behaviour): every trigger rewrites the
      whole Gold table from the full state.

    ``combined=True`` (default) runs ONE query with a grouping-sets aggregate
    for both tables: Silver is read once per trigger and one state store
    holds both levels; each micro-batch is split by grouping id. With
    ``combined=False`` there are two queries, as in the reference.
    ``late_days`` adds a watermark on the event day, so state for days older
    than that is evicted (later rows for them are dropped).
    """
    if mode not in ("merge", "complete"):
        raise ValueError(f"unknown gold mode {mode!r}")
    silver = TB.read_stream(spark, layout.silver, silver_schema(tier_type), fmt,
                            max_files_per_trigger)
    qos = G.add_qos_fields(silver, quality_order)
    extra: tuple = ()
    if late_days is not None:
        qos = _day_watermark(qos, late_days)
        extra = (_DAY,)
    targets = (("customerId", layout.gold_viewer, "gold_viewer"),
               ("contentId", layout.gold_content, "gold_content"))

    def writer(key, path):
        if mode == "complete":
            return K.complete_table_writer(path, "eventDate", fmt)
        return K.partition_merge_writer(path, [key], "eventDate", fmt)

    output_mode = "complete" if mode == "complete" else "update"
    if combined:
        if extra:
            keys = [k for k, _, _ in targets]
            agg = qos.groupingSets([[k, "eventDate", *extra] for k in keys], *keys, "eventDate",
                                   *extra).agg(*G.qos_measures(quality_order),
                                               F.grouping_id().alias("_gid"))
            agg = agg.drop(*extra)
        else:
            _, agg = G.qos_by_both(qos, [k for k, _, _ in targets], quality_order=quality_order)
        writers = {k: writer(k, path) for k, path, _ in targets}

        def process(batch_df: DataFrame, batch_id: int) -> None:
            batch_df.persist()
            try:
                views = G.split_levels(batch_df, list(writers), quality_order=quality_order,
                                       trailing=1 + len(extra))
                for k, fn in writers.items():
                    fn(views[k], batch_id)
            finally:
                batch_df.unpersist()

        w = (agg.writeStream.outputMode(output_mode).foreachBatch(process)
             .option("checkpointLocation", layout.checkpoint("gold")).queryName("gold"))
        return [w.trigger(**K.trigger_kwargs(trigger)).start()]

    queries = []
    for key, path, name in targets:
        agg = G.qos_by(qos, key, quality_order=quality_order, extra_keys=extra)
        if extra:
            agg = agg.drop(*extra)
        w = (agg.writeStream.outputMode(output_mode).foreachBatch(writer(key, path))
             .option("checkpointLocation", layout.checkpoint(name)).queryName(name))
        queries.append(w.trigger(**K.trigger_kwargs(trigger)).start())
    return queries


def await_all(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for every query, watching all at once; raise the first failure as it happens."""
    end = None if timeout is None else time.monotonic() + timeout
    while True:
        active = [q for q in queries if q.isActive]
        for q in queries:
            if q not in active and (err := q.exception()) is not None:
                raise err
        if not active or end is not None and time.monotonic() >= end:
            return
        active[0].awaitTermination(0.2)


def run_available_now(spark: SparkSession, layout: Layout, fmt: str = "parquet",
                      bounds: Q.Bounds = Q.DEFAULT_BOUNDS, late_days: int | None = None,
                      quality_order: str = "lexical",
                      tier_type: T.DataType = DISTRIBUTION, gold_mode: str = "merge",
                      salt_buckets: int | None = None,
                      max_files_per_trigger: int | None = None,
                      silver_dedupe: str = "first_seen") -> None:
    """Run the four stages in order, each draining what is available, then stop.

    Re-running processes only new input (checkpoints), so this is the batch
    schedule of the same streaming chain.
    """
    now = "available_now"
    mf = max_files_per_trigger
    await_all([stream_bronze(spark, layout, fmt, now, late_days, mf, tier_type=tier_type,
                             salt_buckets=salt_buckets)])
    await_all([stream_validation(spark, layout, bounds, fmt, now, mf, tier_type=tier_type)])
    await_all([stream_silver(spark, layout, fmt, now, late_days, mf, tier_type=tier_type,
                             dedupe_mode=silver_dedupe, salt_buckets=salt_buckets)])
    await_all(stream_gold(spark, layout, fmt, now, quality_order, mf, tier_type=tier_type,
                          mode=gold_mode, late_days=late_days))


# --- telemetry --------------------------------------------------------------


def telemetry_batch_writer(accepted_path: str, quarantine_path: str, fmt: str = "parquet"):
    """``foreachBatch``: contract split of one micro-batch of JSON lines, both
    outputs under ``batch_id=<n>`` (idempotent on replay)."""

    def process(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        checked = TM.parse_telemetry(TB.with_log_line(batch_df)).persist()
        try:
            K.write_batch_once(
                spark,
                lambda: checked.filter(F.col("reason").isNull()).drop("value", "reason"),
                accepted_path, batch_id, fmt,
            )
            K.write_batch_once(
                spark,
                lambda: checked.filter(F.col("reason").isNotNull()).select("value", "reason"),
                quarantine_path, batch_id, fmt,
            )
        finally:
            checked.unpersist()

    return process


def stream_telemetry(spark: SparkSession, incoming: str, layout: Layout, fmt: str = "parquet",
                     trigger: str | None = None,
                     max_files_per_trigger: int | None = TELEMETRY_FILES_PER_TRIGGER,
                     source: str = "tail",
                     max_bytes_per_trigger: int | None = TELEMETRY_BYTES_PER_TRIGGER,
                     pattern: str = "*") -> StreamingQuery:
    """Receiver logs (JSON lines) -> accepted events, with their log position, + quarantine.

    ``source="tail"`` reads on in logs that grow, each line once (see
    ``sources.tail``); ``incoming`` is their folder or a single log, ``pattern``
    picks names. ``source="files"`` is for closed files on storage that only
    Spark reads: each file is read once, when it appears. A checkpoint belongs
    to the source it was made with. A draining run over tailed logs is one
    micro-batch.
    """
    if source == "tail":
        limit = None if trigger == "available_now" else max_bytes_per_trigger
        lines = tail_lines(spark, incoming, limit, pattern=pattern)
    elif source == "files":
        lines = TB.telemetry_lines_stream(spark, incoming, max_files_per_trigger)
    else:
        raise ValueError(f"unknown source {source!r}")
    w = (
        lines.writeStream.foreachBatch(
            telemetry_batch_writer(layout.telemetry, layout.telemetry_quarantine, fmt)
        )
        .option("checkpointLocation", layout.checkpoint("telemetry_contract"))
        .queryName("telemetry_contract")
    )
    return w.trigger(**K.trigger_kwargs(trigger)).start()


def stream_buffering_intervals(spark: SparkSession, layout: Layout, fmt: str = "parquet",
                               trigger: str | None = None, order=TELEMETRY_ORDER,
                               max_files_per_trigger: int | None = TELEMETRY_FILES_PER_TRIGGER,
                               pending_days: int | None = None, late: str = LATE,
                               slot_ms: int = SLOT_MS) -> StreamingQuery:
    """Accepted telemetry stream -> buffering intervals, paired in event time (stateful, append).

    The result does not depend on the order in which events arrive, up to
    ``late`` (see ``state.buffering_intervals_stream``). A checkpoint of the
    earlier pairing by arrival cannot go on with this one. The query gets the
    RocksDB state store, which it needs, whatever the session's default is.
    """
    tele = TB.read_batch_table_stream(spark, layout.telemetry,
                                      TELEMETRY_STORED, fmt, max_files_per_trigger)
    out = buffering_intervals_stream(tele, order, late, slot_ms, pending_days)
    with multi_state_store(spark):
        return K.append_stream(out, layout.buffering_intervals,
                               layout.checkpoint("buffering_intervals"), fmt, None, trigger,
                               name="buffering_intervals")
