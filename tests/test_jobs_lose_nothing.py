"""Sinks and rebuilds keep all rows through replaced checkpoints, crashes, null days and backfills."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playback_qos.operators import bronze as B
from playback_qos.plans import layers as L
from playback_qos.sources import fixtures as X
from playback_qos.sources.tables import export_gold
from playback_qos.streaming import jobs, sinks
from playback_qos.streaming.layout import Layout

SF = "/root/testdata/sf0.001"


def run_validation(spark, layout, checkpoint):
    stream = spark.readStream.schema(X.raw_fixture(spark, SF).schema).parquet(layout.bronze)
    q = (stream.writeStream.foreachBatch(sinks.validation_batch_writer(layout.validated, layout.dq_results))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def test_new_checkpoint_on_an_old_table_writes_again(spark, tmp_dir):
    layout = Layout(tmp_dir)
    X.raw_fixture(spark, SF).limit(300).write.parquet(layout.bronze)
    run_validation(spark, layout, f"{tmp_dir}/c1")
    once = spark.read.parquet(layout.validated).count()
    run_validation(spark, layout, f"{tmp_dir}/c1")  # the same query: nothing new
    assert once and spark.read.parquet(layout.validated).count() == once
    run_validation(spark, layout, f"{tmp_dir}/c2")
    assert spark.read.parquet(layout.validated).count() == 2 * once


def gold(spark, rows):
    return spark.createDataFrame(rows, "customerId string, n long, eventDate date")


def test_merge_keeps_null_days_and_survives_a_dead_first_batch(spark, tmp_dir):
    path, day = f"{tmp_dir}/gold", dt.date(2024, 1, 2)
    merge = sinks.partition_merge_writer(path, ["customerId"])
    os.makedirs(f"{path}/_staging/batch_id=0")  # an attempt that died before its commit
    os.makedirs(f"{path}__staging/direct/batch_id=0/eventDate=2024-01-02")
    merge(gold(spark, [("a", 1, None), ("b", 1, None), ("a", 1, day), ("c", 1, day)]), 0)
    merge(gold(spark, [("a", 2, None), ("c", 5, day)]), 1)
    merge(gold(spark, [("a", 2, None), ("c", 5, day)]), 1)  # replay
    got = {(r.customerId, r.n, r.eventDate) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 2, None), ("b", 1, None), ("a", 1, day), ("c", 5, day)}


def test_full_rebuild_replaces_and_backfill_is_scoped(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw = X.raw_fixture(spark, SF)
    L.write_layers(spark, raw, layout)
    days = sorted(r[0] for r in spark.read.parquet(layout.gold_viewer).select("eventDate").distinct().collect())
    cut = days[-2].isoformat()
    before = {p: spark.read.parquet(p).filter(F.col("eventDate") < cut).count() for p in (layout.silver, layout.gold_viewer)}
    runs = spark.read.parquet(layout.dq_results).count()
    L.write_layers(spark, raw.filter(F.col("eventDate") != days[-1]), layout, since=cut)  # the last day is gone
    assert spark.read.parquet(layout.gold_viewer).filter(F.col("eventDate") == days[-1]).count() == 0
    assert {p: spark.read.parquet(p).filter(F.col("eventDate") < cut).count() for p in before} == before
    dq = spark.read.parquet(layout.dq_results).orderBy(F.desc("run_timestamp")).limit(4).collect()
    n = spark.read.parquet(layout.bronze).filter(F.col("eventDate") >= cut).count()
    assert spark.read.parquet(layout.dq_results).count() == 2 * runs
    assert max(r.passed_count + r.failed_count for r in dq) == n
    L.write_layers(spark, raw.filter(F.col("eventDate") != days[0]), layout)  # a full rebuild without the first day
    for p in before:
        assert spark.read.parquet(p).filter(F.col("eventDate") == days[0]).count() == 0
    export_gold(spark, layout.gold_viewer, f"{tmp_dir}/out")
    assert not [x for x in os.listdir(f"{tmp_dir}/out") if "=" in x]


def test_rebuild_refuses_streamed_tables(spark, tmp_dir):
    layout = Layout(tmp_dir)
    os.makedirs(f"{layout.silver}/_spark_metadata")
    with pytest.raises(ValueError, match="streams"):
        L.write_layers(spark, X.raw_fixture(spark, SF), layout)
    assert not os.path.exists(layout.bronze)


def test_ties_do_not_depend_on_partitioning(spark):
    raw = X.raw_fixture(spark, SF).withColumn("timestampInfo", F.struct(F.lit(1).cast("long").alias("server"), F.lit(2).cast("long").alias("agent")))
    pick = lambda df: sorted(r[0] for r in B.dedupe_first(df, order=L.FIRST_SEEN).select(F.to_json(F.struct("*"))).collect())
    assert pick(raw.repartition(1)) == pick(raw.repartition(7, "player"))


def test_await_all_raises_the_failure_of_a_later_query(spark, tmp_dir):
    src = spark.readStream.format("rate").load()
    slow = src.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/a").start()

    def fail(df, n):
        raise RuntimeError("broken batch")

    bad = src.writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_dir}/b").start()
    try:
        with pytest.raises(Exception, match="broken batch"):
            jobs.await_all([slow, bad], timeout=60)
    finally:
        slow.stop()
        bad.stop()
