import datetime as dt
import os

from playback_qos.operators.gold import viewer_qos
from playback_qos.sources.fixtures import silver_fixture
from playback_qos.sources.tables import export_gold, read_table


def test_since_prunes_partitions_and_export_roundtrip(spark, tmp_dir):
    gold = viewer_qos(silver_fixture(spark, "/root/testdata/sf0.001"))
    src = os.path.join(tmp_dir, "gold")
    gold.write.partitionBy("eventDate").parquet(src)
    since = dt.date(2024, 1, 15)
    recent = read_table(spark, src, since=since.isoformat())
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "eventDate" in plan
    assert recent.count() == gold.filter(gold.eventDate >= since).count()
    dst = os.path.join(tmp_dir, "export")
    export_gold(spark, src, dst)
    out = spark.read.parquet(dst).select(*gold.columns)
    assert out.exceptAll(gold).count() == 0 and gold.exceptAll(out).count() == 0


def test_merge_schema_reads_evolved_table(spark, tmp_dir):
    from pyspark.sql import functions as F

    base = silver_fixture(spark, "/root/testdata/sf0.001").limit(5)
    path = os.path.join(tmp_dir, "silver")
    base.write.parquet(path)
    base.withColumn("extra", F.lit(1)).write.mode("append").parquet(path)
    df = read_table(spark, path, merge_schema=True)
    assert "extra" in df.columns and df.count() == 10
