from pyspark.sql import functions as F

from playback_qos.operators.bronze import bronze, dedupe, dedupe_first, minimal_validation
from playback_qos.schema import KEYS
from tests.rows import D, raw_df, raw_row


def test_minimal_validation_drops_null_ids(spark):
    df = raw_df(
        spark,
        [
            raw_row(),
            raw_row(customer=None),
            raw_row(content=None),
            raw_row(client=None),
            raw_row(date=None),  # eventDate is not checked at this stage
            raw_row(customer=""),  # empty strings pass
        ],
    )
    out = minimal_validation(df).select("customerId", "contentId", "clientId").collect()
    assert sorted(tuple(r) for r in out) == [("", "v1", "x"), ("c1", "v1", "x"), ("c1", "v1", "x")]


def test_dedupe_on_business_key(spark):
    df = raw_df(spark, [raw_row(), raw_row(server=2), raw_row(customer="c2", content="v2", client="y")])
    assert dedupe(df).count() == 2


def test_dedupe_null_keys_are_equal(spark):
    df = raw_df(spark, [raw_row(date=None, server=1), raw_row(date=None, server=2)])
    assert dedupe(df).count() == 1
    assert dedupe_first(df, KEYS, ["timestampInfo.server"]).count() == 1


def test_dedupe_first_keeps_earliest(spark):
    df = raw_df(
        spark,
        [raw_row(server=5, agent=1, bufferings=5), raw_row(server=3, agent=9, bufferings=3),
         raw_row(server=3, agent=2, bufferings=32)],
    )
    out = dedupe_first(df, KEYS, ["timestampInfo.server", "timestampInfo.agent"]).collect()
    assert len(out) == 1
    assert out[0]["player"]["bufferings"] == 32
    assert out[0]["timestampInfo"]["agent"] == 2
    assert dedupe_first(df, KEYS, ["timestampInfo.server"]).columns == df.columns


def test_dedupe_first_matches_row_number(spark):
    from playback_qos.sources.fixtures import silver_fixture
    from pyspark.sql import Window

    s = silver_fixture(spark, "/root/testdata/sf0.001")
    order = ["serverTimestamp", "agentTimestamp"]
    w = Window.partitionBy(*KEYS).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    expected = s.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = dedupe_first(s, KEYS, order)
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_bronze_is_filter_then_dedupe(spark):
    df = raw_df(spark, [raw_row(), raw_row(server=0), raw_row(client=None), raw_row(date=D)])
    assert bronze(df).count() == 1
    out = bronze(df, order=["timestampInfo.server"]).collect()
    assert out[0]["timestampInfo"]["server"] == 0
