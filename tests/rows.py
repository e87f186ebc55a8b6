"""Builders for small nested fixtures with explicit schemas."""

from __future__ import annotations

import datetime as dt

from playback_qos.schema import raw_schema, silver_schema
from pyspark.sql import types as T

D = dt.date(2025, 11, 13)


def traffic(requests=1, responses=0.5, requested=100, received=100):
    return (requests, responses, requested, received)


def raw_row(
    customer="c1",
    content="v1",
    client="x",
    date=D,
    server=1,
    agent=1,
    bufferings=0,
    buffering_time=0,
    src=None,
    p2p=None,
    tiers=None,
):
    return (
        customer,
        content,
        client,
        date,
        (server, agent),
        (bufferings, buffering_time),
        (src if src is not None else traffic(), p2p if p2p is not None else traffic()),
        tiers if tiers is not None else {"720p": 1},
    )


INT_TIER_RAW = raw_schema(T.IntegerType())


def raw_df(spark, rows, schema=INT_TIER_RAW):
    return spark.createDataFrame(rows, schema)


def silver_row(
    customer="c1",
    content="v1",
    client="x",
    date=D,
    server=1,
    buffering_time=0,
    bufferings=0,
    src_rx=0,
    p2p_rx=0,
    tiers=(None, None, None, 1, None),
):
    return (
        customer, content, client, date, server, server, bufferings, buffering_time,
        1, 0.5, 0, src_rx, 1, 0.5, 0, p2p_rx, *tiers,
    )


INT_SILVER = silver_schema(T.IntegerType())


def silver_df(spark, rows):
    return spark.createDataFrame(rows, INT_SILVER)


__all__ = ["raw_row", "raw_df", "silver_row", "silver_df", "traffic", "INT_TIER_RAW", "INT_SILVER", "D"]
