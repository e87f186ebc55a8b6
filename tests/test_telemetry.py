import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playback_qos.operators.sequence import with_previous
from playback_qos.operators.telemetry import (
    buffering_intervals,
    flatten_payloads,
    parse_telemetry,
    split_contract,
)
from playback_qos.schema import TELEMETRY
from playback_qos.sources.fixtures import events, telemetry_from_events
from playback_qos.sources.tables import telemetry_lines


def line(**kw):
    base = {"event_type": "quality_change", "playback_position": 1.5,
            "quality": {"level_index": 0, "height": 240, "bitrate": 320000},
            "buffering": None, "sessionId": "s", "viewerId": "v", "eventId": "e",
            "timestamp": 1772166724999}
    base.update(kw)
    for k, v in list(base.items()):
        if v is ...:
            del base[k]
    return json.dumps(base)


def test_contract_reasons(spark):
    lines = [
        line(),
        line(sessionId=...),
        line(viewerId=None),
        line(timestamp="n/a"),
        line(timestamp=12.5),
        line(quality="abc"),
        '{"event_type": "x", "sessi',
        line(extra_key=1, playback_position=...),
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "n int, value string")
    got = {r["n"]: r["reason"] for r in parse_telemetry(df).collect()}
    assert got == {0: None, 1: "missing:sessionId", 2: "missing:viewerId",
                   3: "bad_type:timestamp", 4: "bad_type:timestamp",
                   5: "bad_type:payload", 6: "malformed", 7: None}
    accepted, quarantined = split_contract(df)
    assert accepted.columns == ["n"] + TELEMETRY.fieldNames()
    assert accepted.count() == 2
    assert quarantined.columns == ["n", "value", "reason"]
    assert quarantined.count() == 6
    r = accepted.filter("n = 7").collect()[0]
    assert r["playback_position"] is None and r["timestamp"] == 1772166724999


def test_flatten_payloads(spark):
    df = spark.createDataFrame([(line(),), (line(quality=None, buffering={
        "started_at": 1, "ended_at": 5, "duration_ms": 4}),)], "value string")
    acc, _ = split_contract(df)
    flat = sorted(flatten_payloads(acc).collect(), key=lambda r: str(r["height"]))
    assert flat[0]["height"] == 240 and flat[0]["duration_ms"] is None
    assert flat[1]["height"] is None and flat[1]["duration_ms"] == 4


def seq_df(spark, types, session="s"):
    rows = [(session, t, 1000 * (i + 1), i) for i, t in enumerate(types)]
    return spark.createDataFrame(rows, "sessionId string, event_type string, timestamp long, seq long")


def test_start_start_end_end_gives_one_interval(spark):
    df = seq_df(spark, ["buffering_start", "buffering_start", "buffering_end", "buffering_end"])
    out = buffering_intervals(df, order=("timestamp", "seq")).collect()
    assert [(r["started_at"], r["ended_at"], r["duration_ms"]) for r in out] == [(2000, 3000, 1000)]


def test_end_without_start_and_other_events(spark):
    df = seq_df(spark, ["buffering_end", "quality_change", "buffering_start", "quality_change",
                        "buffering_end", "buffering_start"])
    out = buffering_intervals(df, order=("timestamp", "seq")).collect()
    assert [(r["started_at"], r["ended_at"]) for r in out] == [(3000, 5000)]


def plain_lag(df, key, order, carry):
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in carry})


def intervals_by_lag(t):
    marks = t.filter(F.col("event_type").isin("buffering_start", "buffering_end"))
    want = plain_lag(marks, "sessionId", ["timestamp", "seq"], ["event_type", "timestamp"])
    return want.filter("event_type = 'buffering_end' and prev_event_type = 'buffering_start'").select(
        "sessionId", F.col("prev_timestamp").alias("started_at"), F.col("timestamp").alias("ended_at"),
        (F.col("timestamp") - F.col("prev_timestamp")).alias("duration_ms"))


@pytest.mark.parametrize("width", [1, 3_600_000, 10**9, 10**15])
def test_with_previous_matches_plain_lag(spark, width):
    t = telemetry_from_events(events(spark, "/root/testdata/sf0.001")).select(
        "sessionId", "timestamp", "seq", "event_type")
    want = plain_lag(t, "sessionId", ["timestamp", "seq"], ["event_type", "timestamp"])
    got = with_previous(t, "sessionId", ["timestamp", "seq"], ["event_type", "timestamp"], width)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_hot_session_split_matches_brute_force(spark):
    # one session holds a third of the rows, spread over many buckets
    t = telemetry_from_events(events(spark, "/root/testdata/sf0.01")).withColumn(
        "sessionId", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("sessionId")))
    got, want = buffering_intervals(t, order=("timestamp", "seq")), intervals_by_lag(t)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_ties_do_not_depend_on_partitioning(spark):
    t = telemetry_from_events(events(spark, "/root/testdata/sf0.001")).withColumns(
        {"timestamp": F.expr("timestamp div 86400000"), "seq": F.col("seq") % 3})  # not even seq is unique
    one = buffering_intervals(t.repartition(1), order=("timestamp", "seq"))
    other = buffering_intervals(t.repartition(7, "eventId"), order=("timestamp", "seq"))
    assert one.count() == other.count() and one.exceptAll(other).count() == 0
    with pytest.raises(ValueError, match="second order column"):
        buffering_intervals(t, order=("timestamp",))


def test_log_position_orders_events_of_one_millisecond(spark, tmp_dir):
    kinds = ["buffering_start", "buffering_end"] * 50 + ["buffering_end", "buffering_start"] * 50
    with open(f"{tmp_dir}/telemetry.log", "w") as f:
        f.writelines(line(event_type=k, eventId=str(i)) + "\n" for i, k in enumerate(kinds))
    accepted, _ = split_contract(telemetry_lines(spark, tmp_dir))
    assert buffering_intervals(accepted.repartition(5, "eventId")).count() == 99


def test_payloads_are_kept_whole_and_typed_late(spark):
    lines = [line(quality={"bitrate": 320000.5, "height": "auto", "codec": {"name": "avc1"}}),
             "  " + line(), line(quality={}), line(quality=7), '   {"other": 1}',
             line(quality={"bitrate": 9007199254740993})]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "n int, value string")
    got = {r["n"]: r for r in parse_telemetry(df).collect()}
    assert {n: r["reason"] for n, r in got.items()} == {
        0: None, 1: None, 2: None, 3: "bad_type:payload", 4: "missing:event_type", 5: None}
    assert got[0]["quality"].toPython()["codec"] == {"name": "avc1"}
    flat = {r["n"]: r for r in flatten_payloads(split_contract(df)[0]).collect()}
    assert (flat[0]["bitrate"], flat[0]["height"], flat[1]["height"]) == (320000, None, 240)
    assert flat[2]["bitrate"] is None and flat[5]["bitrate"] == 9007199254740993


def test_payload_values_keep_their_types(spark, tmp_dir):
    """Nested and mixed values survive the table; null, quoted objects and other JSON as the contract says."""
    lines = [line(quality={"a": [1, {"b": None}], "c": 2**60, "d": "x", "e": 0.25, "f": True}), line(quality=None), line(quality=...),
             line(quality='{"height": 5}'), line(quality=[1]), line(quality="{broken"), line(quality=False)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "n int, value string")
    parse_telemetry(df).write.parquet(f"{tmp_dir}/t")
    got = {r["n"]: r for r in spark.read.parquet(f"{tmp_dir}/t").collect()}
    value = got[0]["quality"].toPython()
    assert value == {"a": [1, {"b": None}], "c": 2**60, "d": "x", "e": pytest.approx(0.25), "f": True} and value["f"] is True
    assert got[1]["quality"] is None and got[2]["quality"] is None and got[3]["quality"].toPython() == {"height": 5}
    assert {n: r["reason"] for n, r in got.items()} == {0: None, 1: None, 2: None, 3: None, 4: "bad_type:payload", 5: "bad_type:payload", 6: "bad_type:payload"}
