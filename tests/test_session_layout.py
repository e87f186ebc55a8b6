import subprocess
import sys

from playback_qos.session import checkpoint_dir
from playback_qos.streaming.layout import Layout


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert checkpoint_dir(spark)  # the shared folder is read from the session
    assert spark.createDataFrame([(1, "a")], "x int, y string").count() == 1


def test_layout_has_no_side_effects(tmp_dir):
    layout = Layout(tmp_dir + "/nowhere")
    paths = [layout.source_raw, layout.bronze, layout.validated, layout.dq_results,
             layout.silver, layout.gold_viewer, layout.gold_content,
             layout.checkpoint("source_to_bronze")]
    assert len(set(paths)) == len(paths)
    assert all(p.startswith(tmp_dir + "/nowhere/") for p in paths)
    import os
    assert not os.path.exists(tmp_dir + "/nowhere")


def test_cli_help():
    out = subprocess.run([sys.executable, "-m", "playback_qos", "run", "--help"],
                         capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.returncode == 0 and "--gold-mode" in out.stdout


def test_cli_batch_rebuild(spark, tmp_dir):
    from pyspark.sql import types as T

    from playback_qos.__main__ import main
    from playback_qos.plans.layers import run_batch
    from playback_qos.sources.fixtures import raw_fixture
    from playback_qos.sources.tables import read_table

    layout = Layout(tmp_dir)
    raw = raw_fixture(spark, "/root/testdata/sf0.001")
    raw.write.parquet(layout.source_raw)
    main(["batch", "--base", tmp_dir, "--tier-type", "long"])
    want = run_batch(raw).viewer_qos
    got = read_table(spark, layout.gold_viewer).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert T.LongType() == raw.schema["qualityDistribution"].dataType.valueType
