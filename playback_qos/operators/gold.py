"""Gold layer: per-event QoS fields and daily aggregates per viewer / content.

Aggregation is a plain ``groupBy().agg()``: Spark plans a partial
(map-side) hash aggregate before the shuffle, so a key that holds a large
share of all rows is reduced to one buffer per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.functions.qos import (
    dominant_quality,
    quality_name,
    quality_rank,
    ratio_or_zero,
    total_received,
)


def add_qos_fields(df: DataFrame, quality_order: str = "lexical") -> DataFrame:
    """Add ``total_received_data``, ``buffering_ratio``, ``p2p_share``, ``dominant_quality``.

    * ``buffering_ratio`` is buffering milliseconds per received byte;
    * ``p2p_share`` is the peer share of received bytes;
    both are 0.0 when nothing was received and null when their numerator is null.
    """
    total = total_received()
    return df.withColumns(
        {
            "total_received_data": total,
            "buffering_ratio": ratio_or_zero("bufferingTime", total),
            "p2p_share": ratio_or_zero("p2p_receivedData", total),
            "dominant_quality": dominant_quality(quality_order),
        }
    )


def qos_measures(quality_order: str) -> list:
    return [
        F.sum("bufferingTime").cast("bigint").alias("total_buffering_time"),
        F.sum("bufferings").cast("bigint").alias("total_bufferings"),
        F.sum("total_received_data").cast("bigint").alias("total_received_data"),
        F.avg("buffering_ratio").alias("avg_buffering_ratio"),
        F.avg("p2p_share").alias("avg_p2p_share"),
        F.count(F.lit(1)).alias("event_count"),
        F.max(quality_rank("dominant_quality", quality_order)).alias("_max_rank"),
    ]


_MEASURES_OUT = [
    "total_buffering_time",
    "total_bufferings",
    "total_received_data",
    "avg_buffering_ratio",
    "avg_p2p_share",
    "event_count",
]


def qos_finish(quality_order: str) -> list:
    """Post-aggregate columns: tier name from its rank, ratio of sums."""
    return [
        *_MEASURES_OUT,
        quality_name("_max_rank", quality_order).alias("max_quality"),
        ratio_or_zero("total_buffering_time", "total_received_data").alias("buffering_ratio"),
    ]


def qos_by(
    df: DataFrame,
    key: str,
    date_col: str = "eventDate",
    quality_order: str = "lexical",
    extra_keys: tuple = (),
) -> DataFrame:
    """Daily QoS aggregate per ``key`` over rows that carry the QoS fields.

    ``buffering_ratio`` here is a ratio of sums (time over bytes), distinct
    from ``avg_buffering_ratio`` (mean of per-event ratios). ``max_quality``
    is the highest ``dominant_quality`` under ``quality_order``; it is
    aggregated as an int rank so every buffer is fixed-width and Spark plans a
    hash aggregate (a string ``max`` would force a sort aggregate).
    ``extra_keys`` are carried through the grouping (e.g. an event-time column
    a streaming watermark needs); they must be functions of the date.
    """
    agg = df.groupBy(key, date_col, *extra_keys).agg(*qos_measures(quality_order))
    return agg.select(key, date_col, *extra_keys, *qos_finish(quality_order))


def qos_by_both(
    df: DataFrame,
    keys=("customerId", "contentId"),
    date_col: str = "eventDate",
    quality_order: str = "lexical",
) -> dict:
    """Daily QoS per each of ``keys`` from ONE scan and ONE shuffle.

    A grouping-sets aggregate ((k1, date), (k2, date)): Spark expands each
    row once per set before the partial aggregate, so both Gold tables share
    the scan of the input. Returns ``{key: DataFrame}`` views of the combined
    result, told apart by ``grouping_id`` (a null key value stays a group of
    its own). Persist the combined result before writing both views if the
    input is expensive to scan twice.
    """
    keys = list(keys)
    combined = df.groupingSets([[k, date_col] for k in keys], *keys, date_col).agg(
        *qos_measures(quality_order), F.grouping_id().alias("_gid")
    )
    return split_levels(combined, keys, date_col, quality_order), combined


def split_levels(
    combined: DataFrame, keys=("customerId", "contentId"), date_col: str = "eventDate",
    quality_order: str = "lexical", trailing: int = 1,
) -> dict:
    """``{key: Gold rows}`` from a :func:`qos_by_both` result (or a micro-batch of it).

    ``trailing`` is the number of grouping columns after the keys (the date,
    plus any event-time column a watermark needed).
    """
    keys = list(keys)
    width = len(keys) + trailing
    out = {}
    for k in keys:
        # grouping_id sets a bit for each grouping column NOT in the set,
        # the first grouping column being the highest bit
        gid = sum(1 << (width - 1 - j) for j, other in enumerate(keys) if other != k)
        view = combined.filter(F.col("_gid") == F.lit(gid))
        out[k] = view.select(k, date_col, *qos_finish(quality_order))
    return out


def viewer_qos(df: DataFrame, quality_order: str = "lexical") -> DataFrame:
    """Silver rows -> daily QoS per viewer (``customerId``)."""
    return qos_by(add_qos_fields(df, quality_order), "customerId", quality_order=quality_order)


def content_qos(df: DataFrame, quality_order: str = "lexical") -> DataFrame:
    """Silver rows -> daily QoS per content (``contentId``)."""
    return qos_by(add_qos_fields(df, quality_order), "contentId", quality_order=quality_order)
