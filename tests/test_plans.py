"""Guard the physical plans that the scale design depends on."""

import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda name: queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?<![A-Za-z])Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan))


def test_gold_is_one_shuffle_of_hash_aggregates(static_plans):
    for name in ("viewer_qos", "content_qos"):
        plan = static_plans(name)
        assert shuffles(plan) == 1
        assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_end_to_end_chain_is_two_shuffles(static_plans):
    plan = static_plans("viewer_qos_end_to_end")
    assert shuffles(plan) == 2  # bronze dedupe, gold aggregate


def test_dq_rules_are_one_aggregate(static_plans):
    plan = static_plans("dq_results")
    assert shuffles(plan) == 1 and "SinglePartition" in plan


def test_scans_read_only_needed_columns(static_plans):
    assert "ReadSchema: struct<event_id:bigint>" in static_plans("silver_clamp")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in static_plans("content_qos")


def test_telemetry_parse_happens_once(static_plans):
    assert static_plans("telemetry_quarantine").count("from_json") == 1
    contract = static_plans("telemetry_contract")
    assert contract.count("from_json") == 1  # payloads are variants of the same parse
    assert contract.count("variant_get") and "try_parse_json(quality" not in contract


def test_intervals_scan_and_shuffle_the_events_once(static_plans):
    plan = static_plans("buffering_intervals")
    assert plan.count("FileScan") == 1 and "Broadcast" not in plan
    assert shuffles(plan) - plan.count("ReusedExchange") == 2  # all marks by session and bucket; the edges of buckets by session


def test_both_gold_tables_share_one_scan_and_shuffle(spark):
    from playback_qos.operators.gold import add_qos_fields, qos_by_both
    from playback_qos.sources.fixtures import silver_fixture

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, combined = qos_by_both(add_qos_fields(silver_fixture(spark, SF)))
        plan = combined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shuffles(plan) == 1
    assert plan.count("FileScan") == 1 and "Expand" in plan
    assert "SortAggregate" not in plan
