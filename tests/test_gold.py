import pytest

from playback_qos.operators.gold import add_qos_fields, content_qos, qos_by, viewer_qos
from tests.rows import D, silver_df, silver_row

ALL_TIERS = (0, 0, 0, 1, 0)


def test_derived_fields(spark):
    df = silver_df(spark, [silver_row(buffering_time=100, src_rx=500, p2p_rx=500, tiers=ALL_TIERS)])
    r = add_qos_fields(df).collect()[0]
    assert r["total_received_data"] == 1000
    assert r["buffering_ratio"] == pytest.approx(0.10)
    assert r["p2p_share"] == pytest.approx(0.50)
    assert r["dominant_quality"] == "720p"


@pytest.mark.parametrize(
    "tiers,expected,height",
    [
        ((None, None, None, None, 1), "1080p", "1080p"),
        ((1, None, None, None, 1), "240p", "1080p"),
        ((None, None, None, None, None), None, None),
        ((None, 0, None, None, None), "360p", "360p"),
    ],
)
def test_dominant_quality_orders(spark, tiers, expected, height):
    df = silver_df(spark, [silver_row(tiers=tiers)])
    assert add_qos_fields(df).collect()[0]["dominant_quality"] == expected
    assert add_qos_fields(df, "height").collect()[0]["dominant_quality"] == height


def test_null_p2p_and_zero_totals(spark):
    df = silver_df(
        spark,
        [
            silver_row(src_rx=100, p2p_rx=None, buffering_time=10),
            silver_row(server=2, src_rx=0, p2p_rx=0, buffering_time=10),
            silver_row(server=3, src_rx=None, p2p_rx=None, buffering_time=None),
        ],
    )
    rows = sorted(add_qos_fields(df).collect(), key=lambda r: r["serverTimestamp"])
    assert rows[0]["p2p_share"] is None and rows[0]["buffering_ratio"] == pytest.approx(0.1)
    assert (rows[1]["p2p_share"], rows[1]["buffering_ratio"]) == (0.0, 0.0)
    assert rows[2]["total_received_data"] == 0 and rows[2]["buffering_ratio"] == 0.0
    g = viewer_qos(df).collect()[0]
    assert g["avg_p2p_share"] == pytest.approx(0.0)  # the null share is skipped
    assert g["event_count"] == 3


def test_viewer_aggregate(spark):
    df = silver_df(
        spark,
        [
            silver_row(client="a", buffering_time=100, bufferings=2, src_rx=500, p2p_rx=500,
                       tiers=(None, None, None, 1, None)),
            silver_row(client="b", buffering_time=200, bufferings=3, src_rx=1500, p2p_rx=500,
                       tiers=(None, None, 1, None, None)),
        ],
    )
    g = viewer_qos(df).collect()[0]
    assert g["customerId"] == "c1" and g["eventDate"] == D
    assert (g["total_buffering_time"], g["total_bufferings"], g["total_received_data"]) == (300, 5, 3000)
    assert g["buffering_ratio"] == pytest.approx(0.10)
    assert g["avg_p2p_share"] == pytest.approx(0.375)
    assert g["max_quality"] == "720p"
    assert g["event_count"] == 2


def test_content_aggregate(spark):
    df = silver_df(
        spark,
        [
            silver_row(customer="a", buffering_time=50, bufferings=1, src_rx=250, p2p_rx=250,
                       tiers=(None, None, None, 1, None)),
            silver_row(customer="b", buffering_time=150, bufferings=2, src_rx=1125, p2p_rx=375,
                       tiers=(None, None, 1, None, None)),
        ],
    )
    g = content_qos(df).collect()[0]
    assert g["contentId"] == "v1"
    assert (g["total_buffering_time"], g["total_bufferings"], g["total_received_data"]) == (200, 3, 2000)
    assert g["buffering_ratio"] == pytest.approx(0.10)
    assert g["avg_p2p_share"] == pytest.approx(0.375)
    assert (g["max_quality"], g["event_count"]) == ("720p", 2)


def test_golden_gold_row(spark):
    # Five Silver rows of one customer / content / day (see FIXTURES.md section 3).
    vals = [
        ("a", 3, 10909, 162996, 15296056),
        ("b", 0, 0, 0, 265268),
        ("c", 0, 0, 4756212, 0),
        ("d", 0, 0, 4795316, 10773904),
        ("e", 0, 0, 211124, 4355396),
    ]
    rows = [
        silver_row(client=c, bufferings=b, buffering_time=t, src_rx=s, p2p_rx=p,
                   tiers=(None, None, None, 1, None))
        for c, b, t, s, p in vals
    ]
    df = silver_df(spark, rows)
    for g in (viewer_qos(df).collect()[0], content_qos(df).collect()[0]):
        assert g["total_buffering_time"] == 10909
        assert g["total_bufferings"] == 3
        assert g["total_received_data"] == 40616272
        assert g["avg_buffering_ratio"] == pytest.approx(1.4113413940259727e-4, rel=1e-12)
        assert g["avg_p2p_share"] == pytest.approx(0.7270446996699452, rel=1e-12)
        assert g["event_count"] == 5
        assert g["max_quality"] == "720p"
        assert g["buffering_ratio"] == pytest.approx(2.6858693481272725e-4, rel=1e-12)


def test_gold_schema_order(spark):
    df = add_qos_fields(silver_df(spark, [silver_row()]))
    assert qos_by(df, "customerId").columns == [
        "customerId", "eventDate", "total_buffering_time", "total_bufferings",
        "total_received_data", "avg_buffering_ratio", "avg_p2p_share", "event_count",
        "max_quality", "buffering_ratio",
    ]


def test_max_quality_follows_the_chosen_order(spark):
    df = silver_df(
        spark,
        [
            silver_row(client="a", tiers=(None, None, None, None, 1)),  # 1080p only
            silver_row(client="b", tiers=(None, None, None, 1, None)),  # 720p only
            silver_row(client="c", tiers=(None, None, None, None, None)),  # none
        ],
    )
    assert viewer_qos(df).collect()[0]["max_quality"] == "720p"
    assert viewer_qos(df, "height").collect()[0]["max_quality"] == "1080p"
    none = silver_df(spark, [silver_row(tiers=(None, None, None, None, None))])
    assert viewer_qos(none).collect()[0]["max_quality"] is None



def test_both_gold_tables_from_one_aggregate(spark):
    from playback_qos.operators.gold import qos_by_both
    from playback_qos.sources.fixtures import silver_fixture

    s = add_qos_fields(silver_fixture(spark, "/root/testdata/sf0.001"))
    views, _ = qos_by_both(s)
    for key in ("customerId", "contentId"):
        want = qos_by(s, key)
        got = views[key]
        assert got.columns == want.columns
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0
