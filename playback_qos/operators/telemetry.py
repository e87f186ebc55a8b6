"""Player telemetry: contract check on JSON lines, payload flattening, and
buffering intervals (start paired with the next end of the same session).

Input of the contract check is a frame of JSON lines in a string column
``value`` -- what ``spark.read.text(dir)`` / ``spark.readStream.text(dir)``
give for the receiver's log files -- so batch and stream share one code
path and the raw line survives for the quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.operators.sequence import DEFAULT_BUCKET, with_previous
from playback_qos.schema import (
    EVT_BUFFER_END,
    EVT_BUFFER_START,
    TELEMETRY,
    TELEMETRY_ORDER,
    TELEMETRY_PAYLOADS,
    TELEMETRY_REQUIRED,
)

CORRUPT = "_corrupt_record"

# Parse schema: ``timestamp`` is read as text and cast after parsing so that a
# present-but-unusable value is told apart from an absent one. Payloads are
# variants in TELEMETRY, which keep whatever keys, values and types they have.
_PARSE = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType) for f in TELEMETRY.fields]
    + [T.StructField(CORRUPT, T.StringType())]
)


def _is_object(variant: Column) -> Column:
    return F.schema_of_variant(variant).startswith("OBJECT")


def _payload(name: str) -> Column:
    """A payload as it is kept: JSON null is null, and a string that holds JSON is that JSON."""
    raw = F.col(name)
    text = F.schema_of_variant(raw) == "STRING"
    return F.when(F.is_variant_null(raw), None).when(text, F.try_parse_json(F.try_variant_get(raw, "$", "string"))).otherwise(raw)


def parse_telemetry(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON lines -> typed TELEMETRY columns plus ``reason`` (null = accepted).

    One JSON parse per line, payloads included. Unknown top-level keys are
    dropped; absent optional fields become null. A payload may be any JSON
    object and is kept whole, as a variant (a quoted string that itself holds an
    object counts as that object). ``reason`` is the first failed check of: ``malformed`` (not a
    JSON object), ``missing:<field>`` (required field absent or null),
    ``bad_type:timestamp`` (not an integer), ``bad_type:payload`` (a field of
    the wrong JSON type, a payload that is no object).
    """
    parsed = F.from_json(
        F.col(value_col), _PARSE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    keep = [c for c in lines.columns if c != value_col]
    # ``inline`` makes the parse a Generate node: predicates on its outputs are
    # not pushed below it, so each line is parsed once, not once per field use.
    df = lines.select(*keep, F.col(value_col), F.inline(F.array(parsed)))
    ts = F.expr("try_cast(timestamp as bigint)")
    fields = [f for f in TELEMETRY.fieldNames()]
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f).isNull()
    reason: Column = F.when(F.col(CORRUPT).isNotNull() & all_null, F.lit("malformed")).when(
        all_null & F.col(value_col).isNotNull() & ~F.col(value_col).rlike(r"^\s*\{"),
        F.lit("malformed"),
    )
    for f in TELEMETRY_REQUIRED:
        reason = reason.when(F.col(f).isNull(), F.lit(f"missing:{f}"))
    reason = reason.when(ts.isNull(), F.lit("bad_type:timestamp")).when(
        F.col(CORRUPT).isNotNull(), F.lit("bad_type:payload")
    )
    for f in TELEMETRY_PAYLOADS:
        given = F.col(f).isNotNull() & ~F.is_variant_null(F.col(f))
        reason = reason.when(given & ~F.coalesce(_is_object(_payload(f)), F.lit(False)), F.lit("bad_type:payload"))
    return df.select(
        *keep,
        F.col(value_col),
        *[(_payload(f) if f in TELEMETRY_PAYLOADS else F.col(f)).alias(f) for f in fields if f != "timestamp"],
        ts.alias("timestamp"),
        reason.alias("reason"),
    ).select(*keep, value_col, *fields, "reason")


def split_contract(lines: DataFrame, value_col: str = "value"):
    """-> (accepted TELEMETRY rows, quarantined ``value, reason`` rows)."""
    keep = [c for c in lines.columns if c != value_col]
    checked = parse_telemetry(lines, value_col)
    accepted = checked.filter(F.col("reason").isNull()).select(*keep, *TELEMETRY.fieldNames())
    quarantined = checked.filter(F.col("reason").isNotNull()).select(*keep, value_col, "reason")
    return accepted, quarantined


def _typed_payload(payload: str, kind: T.DataType, fields: T.StructType) -> list[Column]:
    """The fields of ``payload``, taken from a struct, or by casts of their own from a variant or JSON text."""
    if isinstance(kind, T.StructType):
        return [F.col(f"{payload}.{f.name}") for f in fields]
    variant = F.col(payload) if isinstance(kind, T.VariantType) else F.try_parse_json(payload)

    def typed(f: T.StructField) -> Column:
        name, path = f.dataType.simpleString(), f"$.{f.name}"
        whole = F.try_variant_get(variant, path, name)
        return F.coalesce(whole, F.try_variant_get(variant, path, "double").try_cast(f.dataType)).alias(f.name)

    return [typed(f) for f in fields]


def flatten_payloads(df: DataFrame) -> DataFrame:
    """Telemetry -> flat columns (null payload gives nulls).

    Payload values are read as integers: a fraction is cut off towards zero,
    and what is no number (``"auto"``) becomes null. Other keys of a payload
    stay in the accepted rows and are not among the flat columns.
    """
    for payload, fields in TELEMETRY_PAYLOADS.items():
        base = [c for c in df.columns if c != payload]
        df = df.select(*base, *_typed_payload(payload, df.schema[payload].dataType, fields))
    return df


def buffering_intervals(
    df: DataFrame,
    session: str = "sessionId",
    order=TELEMETRY_ORDER,
    start_type: str = EVT_BUFFER_START,
    end_type: str = EVT_BUFFER_END,
    bucket_ms: int = DEFAULT_BUCKET,
) -> DataFrame:
    """Pair each buffering end with the start right before it.

    Per session, in ``order``: a later start replaces an earlier pending one,
    an end with no pending start is ignored, and an end clears the pending
    start. So an interval is emitted at an end whose previous start/end event
    is a start: ``started_at`` = that start's time, ``ended_at`` = the end's
    time, ``duration_ms`` = their difference.

    The first ``order`` column is the event time in epoch ms; the others must
    tell apart events of the same millisecond (the position in the log, a
    sequence number), so time alone is refused. ``bucket_ms`` bounds what one
    session brings to one task (see ``sequence.with_previous``).
    """
    order = list(order)
    if len(order) < 2:
        raise ValueError("events of one millisecond need a second order column")
    time_col = order[0]
    marks = df.filter(
        F.col("event_type").isin(start_type, end_type)
        & F.col(session).isNotNull()
        & F.col(time_col).isNotNull()
    ).select(session, *order, "event_type")
    paired = with_previous(marks, session, order, ["event_type", time_col], bucket_ms)
    return paired.filter(
        (F.col("event_type") == end_type) & (F.col("prev_event_type") == start_type)
    ).select(
        F.col(session).alias("sessionId"),
        F.col(f"prev_{time_col}").alias("started_at"),
        F.col(time_col).alias("ended_at"),
        (F.col(time_col) - F.col(f"prev_{time_col}")).alias("duration_ms"),
    )
