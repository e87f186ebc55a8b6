"""Silver layer: clamp player metrics, read tiers out of the map, flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.functions.paths import col_or_null, has_path
from playback_qos.functions.qos import clamp_non_negative, tier_column
from playback_qos.schema import DISTRIBUTION, SILVER, TIERS


def clamp_player(df: DataFrame) -> DataFrame:
    """Replace negative ``player.bufferings`` / ``player.bufferingTime`` by 0.

    ``player`` is rebuilt with exactly these two fields; a null ``player``
    becomes a (non-null) struct of nulls.
    """
    sch = df.schema
    return df.withColumn(
        "player",
        F.struct(
            clamp_non_negative(col_or_null(sch, "player.bufferings")).alias("bufferings"),
            clamp_non_negative(col_or_null(sch, "player.bufferingTime")).alias("bufferingTime"),
        ),
    )


def tier_values(df: DataFrame, tiers=TIERS) -> dict:
    """``quality_<tier>`` -> value of the tier in the map (a missing key or column is null)."""
    if "qualityDistribution" not in df.columns:
        return {tier_column(t): F.lit(None).cast(DISTRIBUTION) for t in tiers}
    return {tier_column(t): F.col("qualityDistribution").getItem(t) for t in tiers}


def quality_tiers(df: DataFrame, tiers=TIERS) -> DataFrame:
    """One ``quality_<tier>`` column per tier (map lookup; a missing key is null)."""
    return df.withColumns(tier_values(df, tiers))


# Flat SILVER column -> nested source path.
FLAT_PATHS = [
    ("customerId", "customerId"),
    ("contentId", "contentId"),
    ("clientId", "clientId"),
    ("eventDate", "eventDate"),
    ("serverTimestamp", "timestampInfo.server"),
    ("agentTimestamp", "timestampInfo.agent"),
    ("bufferings", "player.bufferings"),
    ("bufferingTime", "player.bufferingTime"),
    ("src_requests", "totalDistribution.sourceTraffic.requests"),
    ("src_responses", "totalDistribution.sourceTraffic.responses"),
    ("src_requestedData", "totalDistribution.sourceTraffic.requestedData"),
    ("src_receivedData", "totalDistribution.sourceTraffic.receivedData"),
    ("p2p_requests", "totalDistribution.p2pTraffic.requests"),
    ("p2p_responses", "totalDistribution.p2pTraffic.responses"),
    ("p2p_requestedData", "totalDistribution.p2pTraffic.requestedData"),
    ("p2p_receivedData", "totalDistribution.p2pTraffic.receivedData"),
] + [(tier_column(t), tier_column(t)) for t in TIERS]


def flatten(df: DataFrame) -> DataFrame:
    """Nested rows (with tier columns) -> the 21 flat SILVER columns, in order.

    One ``select`` of dotted paths: Catalyst prunes unread nested fields at the
    Parquet scan. A null parent struct gives null children; a missing column
    is null, of the contract's type.
    """
    sch = df.schema
    return df.select(
        *[
            (F.col(path) if has_path(sch, path) else F.lit(None).cast(SILVER[name].dataType)).alias(name)
            for name, path in FLAT_PATHS
        ]
    )


def silver_rows(df: DataFrame) -> DataFrame:
    """Validated nested rows -> flat Silver rows (no dedupe)."""
    return flatten(quality_tiers(clamp_player(df)))
