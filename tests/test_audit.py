"""Rows in = rows out + duplicates + late rows; reports on state and its eviction."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import INT_TIER_RAW, raw_df, raw_row

from playback_qos.operators import gold as G
from playback_qos.sources import fixtures as X
from playback_qos.streaming import audit, jobs
from playback_qos.streaming.layout import Layout

SF = "/root/testdata/sf0.001"
LONG = T.LongType()


def settled(spark, path, batches):
    """The audit table once the listener has been told of so many micro-batches."""
    for _ in range(100):
        found = audit.read_audit(spark, path)
        if found.count() >= batches:
            break
        time.sleep(0.1)
    return found


def test_late_rows_are_counted(spark, tmp_dir):
    """Days arrive out of order behind a bound of one day: what is gone is in the audit table, over restarts."""
    layout, path = Layout(tmp_dir), f"{tmp_dir}/audit"
    day = lambda n: dt.date(2024, 1, n)
    batches = [
        [raw_row(customer=f"c{i}", date=day(1)) for i in range(5)] + [raw_row(customer="c0", date=day(1)), raw_row(customer=None, date=day(1))],
        [raw_row(customer=f"c{i}", date=day(10)) for i in range(4)],
        [raw_row(customer=f"late{i}", date=day(2)) for i in range(3)] + [raw_row(customer="in", date=day(9)), raw_row(customer="c1", date=day(10))],
    ]
    listener = audit.start_audit(spark, path)
    try:
        for rows in batches:
            raw_df(spark, rows, INT_TIER_RAW).coalesce(1).write.mode("append").parquet(layout.source_raw)
            jobs.await_all([jobs.stream_bronze(spark, layout, trigger="available_now", late_days=1, tier_type=T.IntegerType())])
        got = audit.balance(settled(spark, path, 5)).collect()
    finally:
        spark.streams.removeListener(listener)
    assert len(got) == 1 and got[0]["query"] == "source_to_bronze"
    r = got[0]
    written = spark.read.parquet(layout.bronze).count()
    assert (r.source_rows, r.rows_in, r.rows_out) == (16, 15, written) and written == 10
    assert (r.duplicate_rows, r.late_rows, r.unexplained) == (2, 3, 0)


def test_state_by_day_and_eviction(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw = X.raw_fixture(spark, SF)
    raw.write.parquet(layout.source_raw)
    run = lambda: jobs.await_all([jobs.stream_bronze(spark, layout, trigger="available_now", late_days=1, tier_type=LONG)])
    run()
    at = layout.checkpoint("source_to_bronze")
    want = {r.eventDate: r.n for r in spark.read.parquet(layout.bronze).groupBy("eventDate").agg(F.count("*").alias("n")).collect()}
    first = {r.eventDate: r["keys"] for r in audit.keys_by_day(spark, at, batch=0).collect()}
    assert first == want and len(first) == 30
    last = {r.eventDate: r["keys"] for r in audit.keys_by_day(spark, at).collect()}  # the watermark has passed all but the end
    assert last == {d: n for d, n in want.items() if d >= dt.date(2024, 1, 29)}
    hot = audit.hottest_keys(spark, at, ["customerId"], n=3, batch=0).collect()
    n = spark.read.parquet(layout.bronze).groupBy("customerId").count().orderBy(F.desc("count"), "customerId").limit(3).collect()
    assert [(r.customerId, r["keys"], r.events) for r in hot] == [(r.customerId, r["count"], None) for r in n]


@pytest.mark.parametrize("combined", [True, False])
def test_hottest_keys_of_gold(spark, tmp_dir, combined):
    layout = Layout(tmp_dir)
    silver = X.silver_fixture(spark, SF).withColumn("customerId", F.expr("case when serverTimestamp % 3000 = 0 then 'hot' else customerId end"))
    silver.write.parquet(layout.silver)
    jobs.await_all(jobs.stream_gold(spark, layout, trigger="available_now", tier_type=LONG, combined=combined))
    hot = audit.hottest_keys(spark, layout.checkpoint("gold" if combined else "gold_viewer"), ["customerId"], n=50)
    got = {r.customerId: r.events for r in hot.collect() if r.customerId is not None}
    want = G.viewer_qos(silver).groupBy("customerId").agg(F.sum("event_count").alias("n")).filter("customerId IS NOT NULL").collect()
    assert got == {r.customerId: r.n for r in want} and max(got, key=got.get) == "hot"


def test_first_by_order_does_not_drain(spark, tmp_dir):
    X.raw_fixture(spark, SF).limit(1).write.parquet(Layout(tmp_dir).validated)
    with pytest.raises(ValueError, match="drains"):
        jobs.stream_silver(spark, Layout(tmp_dir), trigger="available_now", dedupe_mode="first_by_order", late_days=1)
