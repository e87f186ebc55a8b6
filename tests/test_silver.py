from pyspark.sql import functions as F

from playback_qos.operators.silver import clamp_player, flatten, quality_tiers, silver_rows
from playback_qos.schema import RAW, SILVER_COLUMNS
from playback_qos.sources.fixtures import nest, silver_fixture
from tests.rows import raw_df, raw_row


def test_clamp_negative_player_metrics(spark):
    df = raw_df(spark, [raw_row(bufferings=-5, buffering_time=-200)])
    p = clamp_player(df).select("player.*").collect()[0]
    assert (p["bufferings"], p["bufferingTime"]) == (0, 0)


def test_clamp_keeps_null_and_builds_struct_for_null_player(spark):
    rows = [raw_row(bufferings=None, buffering_time=7)]
    rows.append(raw_row()[:5] + (None,) + raw_row()[6:])
    out = clamp_player(raw_df(spark, rows)).select("player").collect()
    players = sorted([(r["player"]["bufferings"], r["player"]["bufferingTime"]) for r in out],
                     key=str)
    assert all(r["player"] is not None for r in out)
    assert players == sorted([(None, 7), (None, None)], key=str)


def test_quality_tiers_from_map(spark):
    df = quality_tiers(raw_df(spark, [raw_row(tiers={"720p": 1, "4k": 9})]))
    r = df.collect()[0]
    assert r["quality_720p"] == 1
    assert r["quality_1080p"] is None and r["quality_240p"] is None
    assert "quality_4k" not in df.columns


def test_quality_tiers_with_struct_values(spark):
    row = (
        "c1", "v1", "x", None, (1, 1), (0, 0),
        ((1, 0.5, 1, 1), (1, 0.5, 1, 1)),
        {"480p": ((1, 1.0, 10, 10), (2, 2.0, 20, 20))},
    )
    df = quality_tiers(spark.createDataFrame([row], RAW))
    r = df.collect()[0]
    assert r["quality_480p"]["p2pTraffic"]["receivedData"] == 20
    assert r["quality_720p"] is None


def test_flatten_has_exact_silver_columns(spark):
    out = flatten(quality_tiers(raw_df(spark, [raw_row()])))
    assert out.columns == SILVER_COLUMNS
    assert len(out.columns) == 21


def test_flatten_ignores_extra_columns(spark):
    df = raw_df(spark, [raw_row()]).withColumn("extra", F.lit(1))
    assert flatten(quality_tiers(df)).columns == SILVER_COLUMNS


def test_flatten_inverts_nest(spark):
    flat = silver_fixture(spark, "/root/testdata/sf0.001")
    back = flatten(quality_tiers(nest(flat)))
    assert back.exceptAll(flat).count() == 0
    assert flat.exceptAll(back).count() == 0


def test_silver_rows_clamps_and_flattens(spark):
    df = raw_df(spark, [raw_row(bufferings=-1, buffering_time=-3)])
    r = silver_rows(df).collect()[0]
    assert (r["bufferings"], r["bufferingTime"]) == (0, 0)
