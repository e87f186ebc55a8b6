"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver table(s) under ``sf_dir`` (through the
Spark-side mappings in ``sources.fixtures``) and returns flat columns whose
names match the DuckDB oracle in ``plans.oracle``. Doubles whose value
depends on summation order are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.operators import bronze as B
from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.operators import silver as S
from playback_qos.operators import telemetry as TM
from playback_qos.plans import layers as L
from playback_qos.schema import INTERVALS, KEYS, SILVER_COLUMNS, TELEMETRY
from playback_qos.session import scratch_dir
from playback_qos.sources import fixtures as X
from playback_qos.sources.tables import read_table
from playback_qos.streaming import incremental as I  # noqa: E741
from playback_qos.streaming import jobs as J
from playback_qos.streaming.layout import Layout
from playback_qos.streaming.sinks import ensure_dir

DIGITS = 9
GOLD_DOUBLES = ["avg_buffering_ratio", "avg_p2p_share", "buffering_ratio"]


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in cols})


def _flat(raw_like: DataFrame) -> DataFrame:
    """Nested rows -> 21 flat columns (tiers read from the map, no clamping)."""
    return S.flatten(S.quality_tiers(raw_like))


# --- Gold ---------------------------------------------------------------


def q_viewer_qos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(G.viewer_qos(X.silver_fixture(spark, sf_dir)), GOLD_DOUBLES)


def q_content_qos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(G.content_qos(X.silver_fixture(spark, sf_dir)), GOLD_DOUBLES)


def q_qos_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = G.add_qos_fields(X.silver_fixture(spark, sf_dir))
    return df.select(
        "serverTimestamp", "customerId", "total_received_data", "buffering_ratio", "p2p_share"
    )


def q_qos_dominant_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = G.add_qos_fields(X.silver_fixture(spark, sf_dir))
    return df.select("serverTimestamp", "dominant_quality")


def q_gold_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both Gold tables as the jobs build them: one grouping-sets aggregate."""
    views, _ = G.qos_by_both(G.add_qos_fields(X.silver_fixture(spark, sf_dir)))
    out = [v.withColumnRenamed(k, "key").withColumn("level", F.lit(k)) for k, v in views.items()]
    return _round(out[0].unionByName(out[1]), GOLD_DOUBLES)


# --- Silver -------------------------------------------------------------


def q_silver_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.clamp_player(X.raw_fixture(spark, sf_dir))
    return df.select(
        F.col("timestampInfo.server").alias("serverTimestamp"),
        F.col("player.bufferings").alias("bufferings"),
        F.col("player.bufferingTime").alias("bufferingTime"),
    )


def q_silver_quality_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.quality_tiers(X.raw_fixture(spark, sf_dir))
    return df.select(
        F.col("timestampInfo.server").alias("serverTimestamp"),
        *[c for c in df.columns if c.startswith("quality_")],
    )


def q_silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(X.raw_fixture(spark, sf_dir))


def q_silver_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.dedupe_first(X.silver_fixture(spark, sf_dir), KEYS, L.FIRST_SEEN_FLAT)


def q_silver_dedupe_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clocks equal: the other columns alone decide which row of a key stays."""
    same = X.silver_fixture(spark, sf_dir).withColumns(
        {"serverTimestamp": F.lit(X.EPOCH_MS), "agentTimestamp": F.lit(X.EPOCH_MS)}
    )
    return B.dedupe_first(same, KEYS, L.FIRST_SEEN_FLAT)


def q_silver_dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = Q.valid_rows(X.raw_fixture(spark, sf_dir))
    return B.dedupe(S.silver_rows(valid)).select(*KEYS)


def q_silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = Q.valid_rows(X.raw_fixture(spark, sf_dir))
    return L.silver_layer(valid).select(*SILVER_COLUMNS)


# --- Bronze -------------------------------------------------------------


def q_bronze_minimal_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(B.minimal_validation(X.raw_fixture(spark, sf_dir)))


def q_bronze_dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = X.raw_fixture(spark, sf_dir)
    return B.dedupe(B.minimal_validation(raw)).select(*KEYS)


def q_bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(L.bronze_layer(X.raw_fixture(spark, sf_dir)))


# --- Data quality -------------------------------------------------------


def q_dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dq_results(X.raw_fixture(spark, sf_dir), with_timestamp=False)


def q_dq_results_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without one column, with one of another type and one more than the contract has."""
    raw = X.raw_fixture(spark, sf_dir).drop("timestampInfo")
    drifted = raw.withColumns({"eventDate": F.col("eventDate").cast("string"), "newField": F.lit(1)})
    return Q.dq_results(drifted, with_timestamp=False)


def q_dq_results_dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra columns whose names hold dots, beside a struct that holds a map: Bronze keeps them, rule 0 lists them."""
    raw = X.raw_fixture(spark, sf_dir).withColumns(
        {"player.extra": F.lit(1), "odd.struct": F.struct(F.create_map(F.lit("k"), F.col("timestampInfo.server")).alias("m"))})
    return Q.dq_results(B.dedupe_first(B.minimal_validation(raw), KEYS, L.FIRST_SEEN), with_timestamp=False)


def q_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.valid_rows(X.raw_fixture(spark, sf_dir)))


def q_dq_silent_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.silent_drops(X.raw_fixture(spark, sf_dir))


# --- End to end ---------------------------------------------------------


def q_viewer_qos_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.run_batch(X.raw_fixture(spark, sf_dir))
    return _round(out["viewer_qos"], GOLD_DOUBLES)


def q_content_qos_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.run_batch(X.raw_fixture(spark, sf_dir))
    return _round(out["content_qos"], GOLD_DOUBLES)


def q_dq_results_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = L.bronze_layer(X.raw_fixture(spark, sf_dir))
    return Q.dq_results(bronze, with_timestamp=False)


def _chained(spark: SparkSession, sf_dir: str) -> Layout:
    """The chain over new files, run twice on the whole table: up to the middle of its events, then the rest."""
    raw = X.raw_fixture(spark, sf_dir)
    clock = F.col("timestampInfo.server")
    ends = raw.agg(F.min(clock).alias("low"), F.max(clock).alias("high")).first()
    layout = Layout(scratch_dir(spark))
    ensure_dir(spark, layout.silver)
    middle = F.lit(None if ends.low is None else (ends.low + ends.high) // 2).cast("long")
    for part in (raw.filter(clock <= middle), raw.filter(clock > middle)):
        # files of a day are named in the order of the clock
        part.repartitionByRange(clock).write.mode("append").partitionBy("eventDate").parquet(layout.source_raw)
        I.run_incremental(spark, layout, tier_type=T.LongType(), chunk_days=None)
    return layout


def q_viewer_qos_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewer Gold read from the deltas of two runs."""
    layout = _chained(spark, sf_dir)
    return _round(I.read_gold(spark, layout, "customerId"), GOLD_DOUBLES)


def q_content_qos_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content Gold read after its deltas have been folded."""
    layout = _chained(spark, sf_dir)
    I.fold_gold(spark, layout)
    return _round(I.read_gold(spark, layout, "contentId"), GOLD_DOUBLES)


# --- Telemetry ----------------------------------------------------------


def q_telemetry_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.telemetry_json_from_events(X.events(spark, sf_dir))
    accepted, _ = TM.split_contract(lines)
    return TM.flatten_payloads(accepted)


def q_telemetry_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted lines of logs that grow between three runs of the stream job, each run from its checkpoint."""
    lines = X.telemetry_json_from_events(X.events(spark, sf_dir))
    ids = lines.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).first()
    layout = Layout(scratch_dir(spark))
    n_logs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [] if ids.low is None else [ids.low + (ids.high - ids.low) * k // 3 for k in (1, 2)]
    for upto in [*cuts, None]:
        X.grow_logs(lines, f"{layout.base}/incoming", n_logs, upto)
        J.await_all([J.stream_telemetry(spark, f"{layout.base}/incoming", layout, trigger="available_now")])
    ensure_dir(spark, layout.telemetry)  # of no line at all
    accepted = read_table(spark, layout.telemetry, schema=J.TELEMETRY_STORED)
    return TM.flatten_payloads(accepted.select(*TELEMETRY.fieldNames()))


def q_telemetry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.telemetry_json_from_events(X.events(spark, sf_dir))
    _, quarantined = TM.split_contract(lines)
    return quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_telemetry_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TM.flatten_payloads(X.telemetry_from_events(X.events(spark, sf_dir)))


def q_buffering_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tele = X.telemetry_from_events(X.events(spark, sf_dir))
    return TM.buffering_intervals(tele, order=("timestamp", "seq"))


def q_buffering_intervals_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to days, so that the second order column decides most neighbours."""
    tele = X.telemetry_from_events(X.events(spark, sf_dir))
    days = tele.withColumn("timestamp", F.expr("timestamp div 86400000 * 86400000"))
    return TM.buffering_intervals(days, order=("timestamp", "seq"))


def q_buffering_intervals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream job on events that arrive in random order, the bound of lateness being the table's time span."""
    tele = X.telemetry_from_events(X.events(spark, sf_dir))
    order = ("timestamp", "seq")
    span = tele.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    layout = Layout(scratch_dir(spark))
    days = 0 if span.low is None else (span.high - span.low) // 86_400_000 + 2
    tele.repartition(F.hash("seq")).write.parquet(layout.telemetry)

    def drain() -> None:
        J.await_all([J.stream_buffering_intervals(spark, layout, trigger="available_now", order=order, late=f"{days} days",
                                                  slot_ms=3_600_000, max_files_per_trigger=64)])

    drain()
    # one event of another session behind the bound lets the watermark pass all others
    far = tele.filter("seq IS NOT NULL").limit(1).withColumns(
        {"sessionId": F.lit("end of stream"), "event_type": F.lit("buffering_start"),
         "timestamp": F.lit(span.high).cast("long") + (days + 1) * 86_400_000})
    far.write.mode("append").parquet(layout.telemetry)
    drain()
    ensure_dir(spark, layout.buffering_intervals)
    return read_table(spark, layout.buffering_intervals, schema=INTERVALS)


QUERIES = {
    "viewer_qos": q_viewer_qos,
    "content_qos": q_content_qos,
    "qos_fields": q_qos_fields,
    "gold_both": q_gold_both,
    "qos_dominant_quality": q_qos_dominant_quality,
    "silver_clamp": q_silver_clamp,
    "silver_quality_tiers": q_silver_quality_tiers,
    "silver_flatten": q_silver_flatten,
    "silver_dedupe_first": q_silver_dedupe_first,
    "silver_dedupe_ties": q_silver_dedupe_ties,
    "silver_dedupe_keys": q_silver_dedupe_keys,
    "silver_layer": q_silver_layer,
    "bronze_minimal_validation": q_bronze_minimal_validation,
    "bronze_dedupe_keys": q_bronze_dedupe_keys,
    "bronze_layer": q_bronze_layer,
    "dq_results": q_dq_results,
    "dq_results_schema_drift": q_dq_results_schema_drift,
    "dq_results_dotted_names": q_dq_results_dotted_names,
    "valid_rows": q_valid_rows,
    "dq_silent_drops": q_dq_silent_drops,
    "viewer_qos_end_to_end": q_viewer_qos_end_to_end,
    "content_qos_end_to_end": q_content_qos_end_to_end,
    "dq_results_end_to_end": q_dq_results_end_to_end,
    "viewer_qos_incremental": q_viewer_qos_incremental,
    "content_qos_incremental": q_content_qos_incremental,
    "telemetry_contract": q_telemetry_contract,
    "telemetry_tail": q_telemetry_tail,
    "telemetry_quarantine": q_telemetry_quarantine,
    "telemetry_flat": q_telemetry_flat,
    "buffering_intervals": q_buffering_intervals,
    "buffering_intervals_ties": q_buffering_intervals_ties,
    "buffering_intervals_stream": q_buffering_intervals_stream,
}
