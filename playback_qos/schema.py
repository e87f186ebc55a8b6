"""Table schemas and fixed contract values for every layer.

Every layer gets an explicit ``StructType``: file streams need one, and
inferring from Python dicts turns structs into maps.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------

# Business key of one heartbeat per client, content and day.
KEYS = ["customerId", "contentId", "clientId", "eventDate"]

# Quality tiers read out of ``qualityDistribution``, in this order.
TIERS = ["240p", "360p", "480p", "720p", "1080p"]

# Data contract for the validated layer: top-level column -> type-name prefix.
EXPECTED_SCHEMA = {
    "customerId": "string",
    "contentId": "string",
    "clientId": "string",
    "eventDate": "date",
    "timestampInfo": "struct",
    "player": "struct",
    "totalDistribution": "struct",
    "qualityDistribution": "map",
}

# Data-quality rule names, in output order.
RULE_SCHEMA = "schema_validation"
RULE_REQUIRED = "required_fields_not_null"
RULE_BUFFERINGS = "bufferings_non_negative"
RULE_RESPONSES = "responses_between_0_and_1"
RULES = [RULE_SCHEMA, RULE_REQUIRED, RULE_BUFFERINGS, RULE_RESPONSES]

# Telemetry fields the receiver requires (the rest default to null).
TELEMETRY_REQUIRED = ["event_type", "sessionId", "viewerId", "eventId", "timestamp"]

# Telemetry event types sent by the player collector.
EVT_QUALITY = "quality_change"
EVT_BUFFER_START = "buffering_start"
EVT_BUFFER_END = "buffering_end"

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

TRAFFIC = T.StructType(
    [
        T.StructField("requests", T.IntegerType()),
        T.StructField("responses", T.DoubleType()),
        T.StructField("requestedData", T.LongType()),
        T.StructField("receivedData", T.LongType()),
    ]
)

DISTRIBUTION = T.StructType(
    [
        T.StructField("sourceTraffic", TRAFFIC),
        T.StructField("p2pTraffic", TRAFFIC),
    ]
)


def raw_schema(tier_type: T.DataType = DISTRIBUTION) -> T.StructType:
    """RAW = BRONZE = VALIDATED layout. ``tier_type`` is the map's value type."""
    return T.StructType(
        [
            T.StructField("customerId", T.StringType()),
            T.StructField("contentId", T.StringType()),
            T.StructField("clientId", T.StringType()),
            T.StructField("eventDate", T.DateType()),
            T.StructField(
                "timestampInfo",
                T.StructType(
                    [
                        T.StructField("server", T.LongType()),
                        T.StructField("agent", T.LongType()),
                    ]
                ),
            ),
            T.StructField(
                "player",
                T.StructType(
                    [
                        T.StructField("bufferings", T.IntegerType()),
                        T.StructField("bufferingTime", T.IntegerType()),
                    ]
                ),
            ),
            T.StructField("totalDistribution", DISTRIBUTION),
            T.StructField("qualityDistribution", T.MapType(T.StringType(), tier_type)),
        ]
    )


RAW = raw_schema()


def silver_schema(tier_type: T.DataType = DISTRIBUTION) -> T.StructType:
    """Flat SILVER layout (21 columns)."""
    fields = [
        T.StructField("customerId", T.StringType()),
        T.StructField("contentId", T.StringType()),
        T.StructField("clientId", T.StringType()),
        T.StructField("eventDate", T.DateType()),
        T.StructField("serverTimestamp", T.LongType()),
        T.StructField("agentTimestamp", T.LongType()),
        T.StructField("bufferings", T.IntegerType()),
        T.StructField("bufferingTime", T.IntegerType()),
    ]
    for prefix in ("src", "p2p"):
        fields += [
            T.StructField(f"{prefix}_requests", T.IntegerType()),
            T.StructField(f"{prefix}_responses", T.DoubleType()),
            T.StructField(f"{prefix}_requestedData", T.LongType()),
            T.StructField(f"{prefix}_receivedData", T.LongType()),
        ]
    fields += [T.StructField(f"quality_{q}", tier_type) for q in TIERS]
    return T.StructType(fields)


SILVER = silver_schema()
SILVER_COLUMNS = SILVER.fieldNames()

TELEMETRY_QUALITY = T.StructType(
    [
        T.StructField("level_index", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("bitrate", T.LongType()),
    ]
)

TELEMETRY_BUFFERING = T.StructType(
    [
        T.StructField("started_at", T.LongType()),
        T.StructField("ended_at", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

# Payloads are free-form objects, kept whole as variants; these are the fields read from them.
TELEMETRY_PAYLOADS = {"quality": TELEMETRY_QUALITY, "buffering": TELEMETRY_BUFFERING}

TELEMETRY = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("playback_position", T.DoubleType()),
        T.StructField("quality", T.VariantType()),
        T.StructField("buffering", T.VariantType()),
        T.StructField("sessionId", T.StringType()),
        T.StructField("viewerId", T.StringType()),
        T.StructField("eventId", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# Where a line stands in the receiver's log: file, split of the file, line in reading order.
LOG_POSITION = T.StructType(
    [
        T.StructField("log_file", T.StringType()),
        T.StructField("log_split", T.LongType()),
        T.StructField("log_line", T.LongType()),
    ]
)

#: Event time, then the log position of events of the same millisecond.
TELEMETRY_ORDER = ("timestamp", *LOG_POSITION.fieldNames())

INTERVALS = T.StructType(
    [
        T.StructField("sessionId", T.StringType()),
        T.StructField("started_at", T.LongType()),
        T.StructField("ended_at", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)
