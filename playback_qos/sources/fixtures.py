"""Heartbeat-shaped rows derived by Spark from the driver's ``events`` table.

The driver ships generic ``events`` (event_id, ts, user_id, event_type,
value, props); these mappings turn every event into a player heartbeat so
that all layers run over the whole table and grow with it. The mapping is a
single narrow projection (no shuffle); the modulo arithmetic only injects
nulls, negative metrics, out-of-range responses and absent tiers, it never
filters rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playback_qos.functions.qos import tier_column
from playback_qos.schema import (
    EVT_BUFFER_END,
    EVT_BUFFER_START,
    EVT_QUALITY,
    TIERS,
)
from playback_qos.sources import tail

# Fixed epoch (2024-01-01T00:00:00Z in ms) used for heartbeat clocks.
EPOCH_MS = 1704067200000


# Layout of the driver's ``events`` table (fixed; declaring it skips the
# footer read that schema inference would do on every query).
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def epoch_millis(col: str) -> str:
    """SQL: epoch milliseconds of a ``timestamp_ntz`` (truncated; no time-zone shift)."""
    return f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})"


# Heartbeat columns as SQL expressions over ``events``: one JVM call per
# column to build (a Column tree would cost hundreds of driver round trips).
SILVER_EXPRS = [
    ("customerId", "case when event_id % 97 = 0 then null else concat('cust-', cast(user_id % 40 as string)) end"),
    ("contentId", "case when event_id % 89 = 0 then null else concat('content-', cast(event_id % 7 as string)) end"),
    ("clientId", "case when event_id % 83 = 0 then null else concat('client-', cast(user_id as string)) end"),
    ("eventDate", "cast(ts as date)"),
    ("serverTimestamp", f"{EPOCH_MS} + event_id * 1000"),
    ("agentTimestamp", f"{EPOCH_MS} + event_id * 1000 - event_id % 500"),
    ("bufferings", "case when event_id % 31 = 0 then null else cast(event_id % 7 - 1 as int) end"),
    ("bufferingTime", "cast((event_id * 37) % 5000 - 100 as int)"),
    ("src_requests", "cast(event_id % 9 as int)"),
    ("src_responses", "case when event_id % 29 = 0 then null else cast(event_id % 5 as double) / 2 end"),
    ("src_requestedData", "(event_id * 131) % 100000"),
    ("src_receivedData", "case when event_id % 11 = 0 then 0L else (event_id * 131) % 100000 end"),
    ("p2p_requests", "cast(event_id % 6 as int)"),
    ("p2p_responses", "cast(event_id % 4 as double)"),
    ("p2p_requestedData", "(event_id * 173) % 80000"),
    ("p2p_receivedData", "case when event_id % 13 = 0 then null when event_id % 11 = 0 then 0L "
                         "else (event_id * 173) % 80000 end"),
    ("quality_240p", "case when event_id % 2 = 0 then event_id % 10 end"),
    ("quality_360p", "case when event_id % 3 = 0 then event_id % 10 end"),
    ("quality_480p", "case when event_id % 5 = 0 then event_id % 10 end"),
    ("quality_720p", "case when event_id % 7 = 0 then event_id % 10 end"),
    ("quality_1080p", "case when event_id % 4 = 1 then event_id % 10 end"),
]


def _select(df: DataFrame, exprs) -> DataFrame:
    return df.selectExpr(*[f"{sql} as {name}" for name, sql in exprs])


def silver_from_events(ev: DataFrame) -> DataFrame:
    """Flat SILVER rows (21 columns), one per event."""
    return _select(ev, SILVER_EXPRS)


def _traffic(prefix: str) -> str:
    return (
        f"named_struct('requests', {prefix}_requests, 'responses', {prefix}_responses, "
        f"'requestedData', {prefix}_requestedData, 'receivedData', {prefix}_receivedData)"
    )


def nest(silver: DataFrame) -> DataFrame:
    """Flat SILVER rows -> RAW nested layout (inverse of ``flatten``).

    ``qualityDistribution`` holds only the non-null tiers, so a tier read back
    with ``getItem`` equals the flat column.
    """
    entries = ", ".join(
        f"named_struct('key', '{t}', 'value', {tier_column(t)})" for t in TIERS
    )
    return _select(
        silver,
        [
            ("customerId", "customerId"),
            ("contentId", "contentId"),
            ("clientId", "clientId"),
            ("eventDate", "eventDate"),
            ("timestampInfo", "named_struct('server', serverTimestamp, 'agent', agentTimestamp)"),
            ("player", "named_struct('bufferings', bufferings, 'bufferingTime', bufferingTime)"),
            (
                "totalDistribution",
                f"named_struct('sourceTraffic', {_traffic('src')}, 'p2pTraffic', {_traffic('p2p')})",
            ),
            (
                "qualityDistribution",
                f"map_from_entries(filter(array({entries}), e -> e.value is not null))",
            ),
        ],
    )


def raw_from_events(ev: DataFrame) -> DataFrame:
    """RAW nested heartbeats, one per event."""
    return nest(silver_from_events(ev))


def silver_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_from_events(events(spark, sf_dir))


def raw_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(events(spark, sf_dir))


# ---------------------------------------------------------------------------
# Telemetry (player events) derived from ``events``
# ---------------------------------------------------------------------------

# events.event_type -> telemetry event_type
TELEMETRY_TYPE = {
    "click": EVT_BUFFER_START,
    "view": EVT_BUFFER_END,
    "purchase": EVT_QUALITY,
    "signup": "playback_start",
    "error": "error",
}

# Ladder used for quality_change payloads: (height, bitrate) per level index.
LADDER = [(240, 320000), (360, 578000), (480, 1000000), (720, 1900000)]


def telemetry_from_events(ev: DataFrame) -> DataFrame:
    """Typed telemetry rows (TELEMETRY schema + ``seq``) from ``events``.

    session = user, order = (timestamp, seq); ``timestamp`` is the epoch
    millisecond of ``ts``. Buffering-end events carry a payload whose start is
    ``duration`` ms before the end.
    """
    ms = epoch_millis("ts")
    mapped = " ".join(f"when '{a}' then '{b}'" for a, b in TELEMETRY_TYPE.items())
    heights = ", ".join(str(h) for h, _ in LADDER)
    rates = ", ".join(f"{b}L" for _, b in LADDER)
    level = f"cast(event_id % {len(LADDER)} as int)"
    return _select(
        ev,
        [
            ("event_type", f"case event_type {mapped} end"),
            ("playback_position", "value"),
            (
                "quality",
                f"case when event_type = 'purchase' then named_struct('level_index', {level}, "
                f"'height', element_at(array({heights}), {level} + 1), "
                f"'bitrate', element_at(array({rates}), {level} + 1)) end",
            ),
            (
                "buffering",
                f"case when event_type = 'view' then named_struct("
                f"'started_at', {ms} - event_id % 5000, 'ended_at', {ms}, "
                f"'duration_ms', event_id % 5000) end",
            ),
            ("sessionId", "concat('sess-', cast(user_id as string))"),
            ("viewerId", "concat('user-', cast(user_id % 40 as string))"),
            ("eventId", "concat('evt-', cast(event_id as string))"),
            ("timestamp", ms),
            ("seq", "event_id"),
        ],
    )


def telemetry_json_from_events(ev: DataFrame) -> DataFrame:
    """JSON lines (column ``value``) as the receiver would log them, with faults.

    Faults injected by event id: a missing ``sessionId`` (id % 53 == 0), a
    non-numeric ``timestamp`` (id % 47 == 0), a payload that is no object
    (id % 61 == 0, where it is absent), a truncated line (id % 101 == 0).
    Every line also carries an unknown key that the contract drops; quality
    payloads have a key and a fractional bitrate (id % 3 == 0) that it keeps.
    """
    # 1. one JSON text per event (numeric timestamp, every field written)
    body = (
        "to_json(named_struct('event_type', event_type, "
        "'playback_position', playback_position, 'quality', quality, "
        "'buffering', buffering, 'sessionId', case when seq % 53 <> 0 then sessionId end, "
        "'viewerId', viewerId, 'eventId', eventId, 'timestamp', timestamp, "
        "'agent', 'web'), map('ignoreNullFields', 'false'))"
    )
    lines = _select(telemetry_from_events(ev), [("seq", "seq"), ("line", body)])
    # 2. faults: text timestamp, then truncation (each step reads the previous column)
    lines = _select(
        lines,
        [
            ("seq", "seq"),
            (
                "line",
                "case when seq % 47 = 0 then "
                "regexp_replace(line, '\"timestamp\":-?[0-9]+', '\"timestamp\":\"n/a\"') "
                "else line end",
            ),
        ],
    )
    lines = _select(
        lines,
        [
            ("seq", "seq"),
            (
                "line",
                "case when seq % 61 = 0 then replace(line, '\"buffering\":null', '\"buffering\":\"n/a\"') "
                "when seq % 3 = 0 then "
                "regexp_replace(line, '\"bitrate\":([0-9]+)', '\"bitrate\":$1.75,\"codec\":\"avc1\"') "
                "else line end",
            ),
        ],
    )
    return _select(
        lines,
        [("seq", "seq"), ("value", "case when seq % 101 = 0 then substring(line, 1, 40) else line end")],
    )


def grow_logs(lines: DataFrame, folder: str, n_logs: int, upto: int | None = None) -> int:
    """Let ``n_logs`` receiver logs in ``folder`` hold the lines (``seq``, ``value``) below ``upto``; returns their number.

    A log is the lines of ``seq`` modulo ``n_logs`` in order, so each call with
    a larger ``upto`` makes the logs longer. The last line of a log that has
    more to come is cut in its middle and has no end yet. Tasks write the logs,
    each by a hidden file that is renamed when it is whole.
    """
    cloudpickle.register_pickle_by_value(sys.modules[tail.__name__])
    open_path = tail.open_path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_path(folder)
        fs.create_dir(root, recursive=True)
        log, out, n, closed = None, None, 0, False
        part = f"{root}/.part-{TaskContext.get().taskAttemptId()}"

        def finish() -> None:
            if out is not None:
                out.close()
                fs.move(part, f"{root}/log-{log:05d}.jsonl")

        for b in batches:
            for own, seq, value in zip(*(b.column(c).to_pylist() for c in ("log", "seq", "value")), strict=True):
                if own != log:
                    finish()
                    log, out, closed = own, fs.open_output_stream(part), False
                raw = value.encode() + b"\n"
                if upto is None or seq < upto:
                    out.write(raw)
                    n += 1
                elif not closed:
                    out.write(raw[: len(raw) // 2])
                    closed = True
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    dealt = lines.withColumn("log", F.expr(f"cast(pmod(seq, {n_logs}) as int)")).repartition(n_logs, "log")
    return dealt.sortWithinPartitions("log", "seq").mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
