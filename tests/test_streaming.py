"""Batch-vs-stream equality, restart from checkpoints, idempotent sinks."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.operators import telemetry as TM
from playback_qos.plans import layers as L
from playback_qos.plans.catalog import QUERIES
from playback_qos.schema import INTERVALS, KEYS, LOG_POSITION, TELEMETRY, TELEMETRY_PAYLOADS, raw_schema, silver_schema
from playback_qos.session import HDFS_BACKED, STATE_STORE
from playback_qos.sources import fixtures as X
from playback_qos.sources.tables import read_table
from playback_qos.streaming import jobs as J
from playback_qos.streaming.layout import Layout
from playback_qos.streaming.sinks import validation_batch_writer

SF = "/root/testdata/sf0.001"
LONG = T.LongType()
RAW = raw_schema(LONG)
SILVER = silver_schema(LONG)


def write_parts(df, path, bounds, col="seq"):
    """Append ``df`` to ``path`` in id ranges (one file set per append)."""
    lo = None
    for hi in bounds + [None]:
        part = df
        if lo is not None:
            part = part.filter(F.col(col) >= lo)
        if hi is not None:
            part = part.filter(F.col(col) < hi)
        part.drop(col).coalesce(1).write.mode("append").parquet(path)
        lo = hi


def raw_with_seq(spark):
    ev = X.events(spark, SF)
    return X.nest(X.silver_from_events(ev)).withColumn("seq", F.col("timestampInfo.server"))


YEARS = 3650


def later(spark, path, schema):
    """An event far behind all others, so that the watermark passes them."""
    row = dict.fromkeys(schema.names) | {"event_type": "buffering_start", "sessionId": "far", "timestamp": 2**42}
    spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("append").parquet(path)


def keyset(df):
    return sorted(tuple(r) for r in df.select(*KEYS).collect())


def test_stream_chain_matches_batch_and_restarts(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw = raw_with_seq(spark)
    cut = [1704067200000 + 333 * 1000, 1704067200000 + 666 * 1000]
    write_parts(raw, layout.source_raw, cut)

    J.run_available_now(spark, layout, tier_type=LONG)

    batch_raw = spark.read.schema(RAW).parquet(layout.source_raw)
    out = L.run_batch(batch_raw, deterministic=False)
    bronze = read_table(spark, layout.bronze)
    assert keyset(bronze) == keyset(out["bronze"])
    silver = read_table(spark, layout.silver, schema=SILVER)
    assert keyset(silver) == keyset(out["silver"])
    assert silver.count() == silver.select(*KEYS).distinct().count()

    # DQ: four rows per micro-batch; totals add up to the bronze row count
    dq = read_table(spark, layout.dq_results)
    n_batches = dq.select("batch_id").distinct().count()
    assert dq.count() == 4 * n_batches
    totals = {r["rule_name"]: r["t"] for r in dq.groupBy("rule_name").agg(
        F.sum(F.col("passed_count") + F.col("failed_count")).alias("t")).collect()}
    n = bronze.count()
    assert totals["required_fields_not_null"] == n
    assert totals["bufferings_non_negative"] == n

    # gold equals the batch aggregate of the streamed silver table
    gold = read_table(spark, layout.gold_viewer)
    want = G.viewer_qos(silver)
    cols = want.columns
    assert gold.select(*cols).exceptAll(want).count() == 0
    assert want.exceptAll(gold.select(*cols)).count() == 0

    # restart with no new input: nothing changes
    before = silver.count()
    J.run_available_now(spark, layout, tier_type=LONG)
    assert read_table(spark, layout.silver, schema=SILVER).count() == before

    # one more file with only already-seen keys plus new ones: no duplicates
    extra = raw.filter(F.col("seq") < cut[0]).withColumn(
        "customerId", F.concat(F.col("customerId"), F.lit("-late")))
    extra = extra.unionByName(raw.filter(F.col("seq") >= cut[1]))
    extra.drop("seq").coalesce(1).write.mode("append").parquet(layout.source_raw)
    J.run_available_now(spark, layout, tier_type=LONG)
    silver2 = read_table(spark, layout.silver, schema=SILVER)
    assert silver2.count() == silver2.select(*KEYS).distinct().count()
    assert silver2.count() > before


def test_validation_batch_writer_is_idempotent(spark, tmp_dir):
    layout = Layout(tmp_dir)
    bronze = X.raw_fixture(spark, SF)
    write = validation_batch_writer(layout.validated, layout.dq_results)
    write(bronze, 7)
    write(bronze, 7)  # replay of the same batch id
    valid = read_table(spark, layout.validated)
    assert valid.count() == Q.valid_rows(bronze).count()
    dq = read_table(spark, layout.dq_results)
    assert dq.count() == 4
    # replay after the DQ output was lost: recomputed, valid rows not duplicated
    import shutil
    shutil.rmtree(os.path.join(layout.dq_results, "batch_id=7"))
    write(bronze, 7)
    assert read_table(spark, layout.dq_results).count() == 4
    assert read_table(spark, layout.validated).count() == valid.count()
    got = {r["rule_name"]: r["failed_count"] for r in read_table(spark, layout.dq_results).collect()}
    want = {r["rule_name"]: r["failed_count"] for r in Q.dq_results(bronze).collect()}
    assert got == want


def test_bounded_state_dedupe_same_result_on_time(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw = raw_with_seq(spark)
    write_parts(raw, layout.source_raw, [1704067200000 + 500 * 1000])
    q = J.stream_bronze(spark, layout, trigger="available_now", late_days=40, tier_type=LONG)
    q.awaitTermination()
    bronze = read_table(spark, layout.bronze)
    want = L.bronze_layer(spark.read.schema(RAW).parquet(layout.source_raw), deterministic=False)
    assert keyset(bronze) == keyset(want)


def test_telemetry_stream_contract_and_intervals(spark, tmp_dir):
    layout = Layout(tmp_dir)
    ev = X.events(spark, SF)
    incoming = os.path.join(tmp_dir, "incoming")
    lines = X.telemetry_json_from_events(ev)
    # three log files, in time order
    cut = [333, 666]
    lo = None
    for hi in cut + [None]:
        part = lines
        if lo is not None:
            part = part.filter(F.col("seq") >= lo)
        if hi is not None:
            part = part.filter(F.col("seq") < hi)
        part.select("value").coalesce(1).write.mode("append").text(incoming)
        lo = hi
    J.stream_telemetry(spark, incoming, layout, trigger="available_now", source="files",
                       max_files_per_trigger=1).awaitTermination()
    accepted = read_table(spark, layout.telemetry).drop("batch_id")
    assert set(LOG_POSITION.names) <= set(accepted.columns)
    acc_batch, quar_batch = TM.split_contract(lines.drop("seq"))
    assert accepted.count() == acc_batch.count()
    text = lambda df: df.select(*[F.to_json(c).alias(c) if c in TELEMETRY_PAYLOADS else c for c in TELEMETRY.fieldNames()])
    assert text(accepted).exceptAll(text(acc_batch)).count() == 0
    quarantine = read_table(spark, layout.telemetry_quarantine)
    assert quarantine.count() == quar_batch.count()

    later(spark, f"{layout.telemetry}/query_id=later/batch_id=0", accepted.drop("query_id").schema)
    J.stream_buffering_intervals(spark, layout, trigger="available_now", late=f"{YEARS} days",
                                 max_files_per_trigger=1).awaitTermination()
    got = read_table(spark, layout.buffering_intervals)
    want = TM.buffering_intervals(TM.split_contract(lines)[0], order=("timestamp", "seq"))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


import pytest  # noqa: E402


@pytest.mark.parametrize("mode,combined,late_days", [
    ("merge", True, None), ("complete", True, None), ("merge", False, None),
    ("complete", False, None), ("merge", True, 60)])
def test_gold_stream_modes_match_batch(spark, tmp_dir, mode, combined, late_days):
    """Gold over several micro-batches, merged into days or fully rewritten."""
    layout = Layout(tmp_dir)
    silver = X.silver_from_events(X.events(spark, SF)).withColumn(
        "seq", F.col("serverTimestamp"))
    cuts = [1704067200000 + k * 1000 for k in (250, 500, 750)]
    write_parts(silver, layout.silver, cuts)
    qs = J.stream_gold(spark, layout, trigger="available_now", tier_type=LONG, mode=mode,
                       max_files_per_trigger=1, combined=combined, late_days=late_days)
    J.await_all(qs)
    flat = spark.read.schema(SILVER).parquet(layout.silver)
    for path, fn in ((layout.gold_viewer, G.viewer_qos), (layout.gold_content, G.content_qos)):
        got = read_table(spark, path)
        want = fn(flat)
        got = got.select(*want.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0
    if mode != "merge":
        return
    # a replay of a finished batch changes nothing
    from playback_qos.streaming.sinks import partition_merge_writer
    before = read_table(spark, layout.gold_viewer).count()
    last = G.viewer_qos(flat.filter(F.col("serverTimestamp") >= cuts[-1]))
    partition_merge_writer(layout.gold_viewer, ["customerId"])(last, 99)
    assert read_table(spark, layout.gold_viewer).count() == before


def test_write_layers_matches_lazy_chain(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw = X.raw_fixture(spark, SF)
    L.write_layers(spark, raw, layout)
    chain = L.run_batch(raw)
    for name, path in (("viewer_qos", layout.gold_viewer), ("content_qos", layout.gold_content),
                       ("silver", layout.silver)):
        want = chain[name]
        got = read_table(spark, path).select(*want.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0
    dq = {r["rule_name"]: (r["passed_count"], r["failed_count"])
          for r in read_table(spark, layout.dq_results).collect()}
    want = {r["rule_name"]: (r["passed_count"], r["failed_count"])
            for r in chain.dq_results.collect()}
    assert dq == want
    # a second run (backfill) replaces the day tables and appends its DQ rows
    L.write_layers(spark, raw, layout)
    assert read_table(spark, layout.gold_viewer).count() == chain.viewer_qos.count()
    assert read_table(spark, layout.dq_results).count() == 8


def test_deterministic_stream_dedupe_matches_batch_first(spark, tmp_dir):
    """Silver dedupe as an event-time aggregation: same rows as batch D3."""
    from playback_qos.operators.bronze import dedupe_first
    from playback_qos.streaming.sinks import append_stream
    from playback_qos.sources.tables import read_stream

    src = os.path.join(tmp_dir, "silver_in")
    silver = X.silver_from_events(X.events(spark, SF)).withColumn("seq", F.col("serverTimestamp"))
    # duplicates of every key, arriving in a later file with later timestamps
    dup = silver.withColumn("serverTimestamp", F.col("serverTimestamp") + 10**9)
    write_parts(silver.unionByName(dup), src, [1704067200000 + 500 * 1000])
    stream = read_stream(spark, src, SILVER, max_files_per_trigger=1)
    out = J.dedupe_first_stream(stream, KEYS, late_days=1)
    dst = os.path.join(tmp_dir, "silver_out")
    append_stream(out, dst, os.path.join(tmp_dir, "ckpt"), partition_by=None,
                  trigger="available_now").awaitTermination()
    got = spark.read.schema(SILVER).parquet(dst)
    flat = spark.read.schema(SILVER).parquet(src)
    # days still open at the end (within the watermark delay) are not emitted yet
    last_day = flat.agg(F.max("eventDate")).first()[0]
    want = dedupe_first(flat, KEYS, ["serverTimestamp", "agentTimestamp"])
    want = want.filter(F.col("eventDate") < F.lit(last_day) - F.expr("INTERVAL 1 DAY"))
    got = got.filter(F.col("eventDate") < F.lit(last_day) - F.expr("INTERVAL 1 DAY"))
    assert want.count() > 0
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_intervals_do_not_depend_on_arrival(spark, tmp_dir):
    """Events dealt at random over micro-batches and two runs: the same rows as the batch form."""
    layout = Layout(tmp_dir)
    tele = X.telemetry_from_events(X.events(spark, SF)).withColumn(
        "sessionId", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("sessionId")))
    order = ("timestamp", "seq")
    for k in range(2):  # the first run reads three of them
        for p in range(3 - k):
            tele.filter(F.pmod(F.hash("seq"), F.lit(5)) == 3 * k + p).coalesce(1).write.mode("append").parquet(layout.telemetry)
        if k:
            later(spark, layout.telemetry, tele.schema)
        # a new query object on the same checkpoint: state and timers are restored from RocksDB
        J.stream_buffering_intervals(spark, layout, trigger="available_now", order=order, late=f"{YEARS} days",
                                     max_files_per_trigger=1, slot_ms=3_600_000).awaitTermination()
        if not k:
            assert read_table(spark, layout.buffering_intervals, schema=INTERVALS).count() == 0
    got = read_table(spark, layout.buffering_intervals)
    want = TM.buffering_intervals(tele, order=order)
    assert got.count() == want.count() > 50
    assert got.exceptAll(want).count() == 0


def test_intervals_in_order_come_out_as_the_watermark_goes(spark, tmp_dir, monkeypatch):
    """Within the bound nothing is lost; late events are dropped; an old start is forgotten; slices of two rows."""
    from playback_qos.streaming import state

    monkeypatch.setattr(state, "SLICE", 2)
    layout = Layout(tmp_dir)
    start, end, minute = "buffering_start", "buffering_end", 60_000

    def put(*events):
        rows = [(kind, session, t * minute, i) for i, (kind, session, t) in enumerate(events)]
        df = spark.createDataFrame(rows, "event_type string, sessionId string, timestamp long, seq long")
        df.coalesce(1).write.mode("append").parquet(layout.telemetry)
        J.stream_buffering_intervals(spark, layout, trigger="available_now", order=("timestamp", "seq"), late="10 minutes",
                                     slot_ms=minute, pending_days=1).awaitTermination()
        return sorted((r.sessionId, r.started_at // minute, r.ended_at // minute)
                      for r in read_table(spark, layout.buffering_intervals, schema=INTERVALS).collect())

    assert put((end, "a", 105), (start, "a", 101), (start, "a", 100), (start, "b", 103), (None, "a", 104), (end, None, 104)) == []
    assert put((end, "b", 104), (end, "a", 103), (start, "c", 120)) == [("a", 101, 103), ("b", 103, 104)]
    # before the watermark (110): dropped, and the end at 105 stays without a start
    assert put((start, "a", 104), (end, "c", 119), (end, "c", 121), (start, "d", 125)) == [("a", 101, 103), ("b", 103, 104)]
    day = 24 * 60
    put((start, "e", 2 * day))
    assert put((end, "d", 2 * day - 5), (end, "d", 2 * day - 4), (start, "x", 2 * day + 30)) == [
        ("a", 101, 103), ("b", 103, 104), ("c", 120, 121)]


def test_drifted_source_reaches_bronze_and_the_schema_rule(spark, tmp_dir):
    """One column missing, one of another type, one too many, and a newer file with yet another column."""
    layout = Layout(tmp_dir)
    raw = X.raw_fixture(spark, SF).drop("timestampInfo").withColumn("newField", F.lit(7))
    drifted = raw.withColumn("player", F.to_json("player"))
    drifted.filter("eventDate < '2024-01-10'").write.parquet(layout.source_raw)
    drifted.withColumn("later", F.lit("x")).filter("eventDate >= '2024-01-10'").write.mode("append").parquet(
        layout.source_raw)
    J.stream_bronze(spark, layout, trigger="available_now", tier_type=LONG).awaitTermination()
    bronze = read_table(spark, layout.bronze)
    assert {"newField", "later"} <= set(bronze.columns) and "timestampInfo" not in bronze.columns
    assert bronze.filter("newField = 7").count() == bronze.count() > 0
    J.stream_validation(spark, layout, trigger="available_now", tier_type=LONG).awaitTermination()
    dq = {r["rule_name"]: r for r in read_table(spark, layout.dq_results).collect()}
    rule = next(r for r in dq.values() if r["missing_cols"] is not None)
    assert rule["failed_count"] > 0
    assert "timestampInfo" in str(rule["missing_cols"]) and "player" in str(rule["wrong_type_cols"])
    assert "newField" in str(rule["unexpected_cols"]) and "later" in str(rule["unexpected_cols"])


def test_salted_stream_dedupe_splits_hot_key(spark, tmp_dir):
    """Two-level salted dedupe: one row per key, same key set, hot key split."""
    layout = Layout(tmp_dir)
    raw = raw_with_seq(spark)
    # a hot key: a third of the rows share one business key
    hot = raw.withColumn("customerId", F.when(F.col("seq") % 3 == 0, F.lit("hot"))
                         .otherwise(F.col("customerId")))
    hot = hot.withColumn("contentId", F.when(F.col("seq") % 3 == 0, F.lit("v"))
                         .otherwise(F.col("contentId")))
    hot = hot.withColumn("clientId", F.when(F.col("seq") % 3 == 0, F.lit("x"))
                         .otherwise(F.col("clientId")))
    hot = hot.withColumn("eventDate", F.when(F.col("seq") % 3 == 0, F.lit("2024-01-02").cast("date"))
                         .otherwise(F.col("eventDate")))
    write_parts(hot, layout.source_raw, [1704067200000 + 500 * 1000])
    J.stream_bronze(spark, layout, trigger="available_now", tier_type=LONG,
                    salt_buckets=8).awaitTermination()
    bronze = read_table(spark, layout.bronze)
    want = L.bronze_layer(spark.read.schema(RAW).parquet(layout.source_raw), deterministic=False)
    assert bronze.count() == bronze.select(*KEYS).distinct().count()
    assert keyset(bronze) == keyset(want)


def test_concurrent_processing_time_streams(spark, tmp_dir):
    """Bronze and validation running at once (empty first batches included)."""
    import time

    from playback_qos.streaming.sinks import ensure_dir

    layout = Layout(tmp_dir)
    X.raw_fixture(spark, SF).write.parquet(layout.source_raw)
    for p in (layout.bronze, layout.validated):
        ensure_dir(spark, p)
    qb = J.stream_bronze(spark, layout, trigger="2 seconds", tier_type=LONG)
    qv = J.stream_validation(spark, layout, trigger="2 seconds", tier_type=LONG)
    # silver starts while its input has no batch_id=<n> directories yet
    qs = J.stream_silver(spark, layout, trigger="2 seconds", tier_type=LONG)
    try:
        deadline = time.time() + 120
        while time.time() < deadline:
            time.sleep(2)
            for q in (qb, qv, qs):
                assert q.exception() is None
            try:  # the tables may not have a committed file yet
                dq = read_table(spark, layout.dq_results)
                done = dq.filter("rule_name = 'required_fields_not_null'").agg(
                    F.sum(F.col("passed_count") + F.col("failed_count"))).first()[0]
                n = read_table(spark, layout.bronze).count()
            except Exception:  # noqa: BLE001
                continue
            if done and done == n:
                try:
                    n_silver = read_table(spark, layout.silver, schema=SILVER).count()
                except Exception:  # noqa: BLE001
                    continue
                n_valid = read_table(spark, layout.validated).count()
                if n_silver == n_valid:
                    break
        else:
            raise AssertionError("the stages did not catch up")
    finally:
        for q in (qb, qv, qs):
            q.stop()
    bronze = read_table(spark, layout.bronze)
    assert read_table(spark, layout.validated).count() == Q.valid_rows(bronze).count()
    silver = read_table(spark, layout.silver, schema=SILVER)
    assert silver.count() == silver.select(*KEYS).distinct().count()


@pytest.mark.parametrize("store", [None, HDFS_BACKED])
def test_intervals_bring_their_state_store(spark, tmp_dir, store):
    """In a session with Spark's default state store: no error, the rows of the batch form, the setting untouched."""
    events = [(i, f"2024-01-0{1 + i % 3} 00:0{i % 7}:00", i % 2, kind, 1.0, None)
              for i, kind in enumerate(["click", "click", "view", "view", "purchase", "view", "click", "click", "view"] * 3)]
    df = spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    was = spark.conf.get(STATE_STORE)
    try:
        if store is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, store)
        got = QUERIES["buffering_intervals_stream"](spark, tmp_dir)
        assert spark.conf.get(STATE_STORE, None) == store
    finally:
        spark.conf.set(STATE_STORE, was)
    want = QUERIES["buffering_intervals"](spark, tmp_dir)
    assert sorted(got.collect()) == sorted(want.collect()) != []


def test_intervals_of_busy_and_quiet_sessions(spark, tmp_dir, monkeypatch):
    """Sessions over and under ``SLICE`` open rows, arriving in no order, closed in several steps: the rows of the batch form."""
    from playback_qos.streaming import state

    monkeypatch.setattr(state, "SLICE", 8)
    layout, minute = Layout(tmp_dir), 60_000
    schema = "event_type string, sessionId string, timestamp long, seq long"
    rows = [("buffering_start" if i * 7 % 3 else "buffering_end", "quiet" if i % 20 == 0 else f"busy{i % 2}", i * 7 % 120 * minute // 2, i)
            for i in range(240)]
    put = lambda some: spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(layout.telemetry)
    counts = []
    for part in (rows[::-2], rows[::2], [("buffering_start", "far", 85 * minute, 900)], [("buffering_start", "far", 200 * minute, 901)]):
        put(part)
        J.stream_buffering_intervals(spark, layout, trigger="available_now", order=("timestamp", "seq"), late="60 minutes",
                                     slot_ms=4 * minute).awaitTermination()
        counts.append(read_table(spark, layout.buffering_intervals, schema=INTERVALS).count())
    got = read_table(spark, layout.buffering_intervals).collect()
    want = TM.buffering_intervals(spark.createDataFrame(rows, schema), order=("timestamp", "seq")).collect()
    assert sorted(got) == sorted(want)
    assert counts[:2] == [0, 0] and 0 < counts[2] < counts[3] and {r.sessionId for r in want} == {"quiet", "busy0", "busy1"}
