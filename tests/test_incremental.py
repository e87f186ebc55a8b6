"""The chain over new files: evolving schemas, snapshot in day order, key index, Gold deltas; restarts and replays."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import INT_TIER_RAW, raw_df, raw_row, traffic

from playback_qos.operators import bronze as B
from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.plans import layers as L
from playback_qos.schema import KEYS, raw_schema, silver_schema
from playback_qos.sources import evolving as E
from playback_qos.sources import fixtures as X
from playback_qos.streaming import incremental as I  # noqa: E741
from playback_qos.streaming import jobs
from playback_qos.streaming.layout import Layout

SF = "/root/testdata/sf0.001"
LONG = T.LongType()
MIDDLE = X.EPOCH_MS + 500_000


def plain(v):
    return round(v, 9) if isinstance(v, float) else tuple(sorted(v.items())) if isinstance(v, dict) else v


def rows_of(df):
    return Counter(tuple(map(plain, r)) for r in df.select(sorted(df.columns)).collect())


def day_files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def run(spark, layout, **options):
    I.run_incremental(spark, layout, tier_type=LONG, **{"chunk_days": None, **options})


@pytest.fixture(scope="module")
def raw(spark):
    return X.raw_fixture(spark, SF)


@pytest.fixture(scope="module")
def chained(spark, raw, tmp_path_factory):
    """Two runs, the second with a hot key that the first has seen and nulls in the day."""
    layout = Layout(str(tmp_path_factory.mktemp("chain")))
    clock = F.col("timestampInfo.server")
    first, second = raw.filter(clock < MIDDLE), raw.filter(clock >= MIDDLE)
    hot = first.filter(f"timestampInfo.server = {X.EPOCH_MS + 30_000}").drop("timestampInfo")
    hot = hot.crossJoin(spark.range(300).select(F.struct((F.col("id") + MIDDLE).alias("server"), F.col("id").alias("agent")).alias("timestampInfo")))
    second = second.unionByName(hot).withColumn("eventDate", F.when(F.col("timestampInfo.server") % 7 != 0, F.col("eventDate")))
    whole = first.unionByName(second)
    for part in (first, second):
        part.write.mode("append").partitionBy("eventDate").parquet(layout.source_raw)
        run(spark, layout)
    return layout, whole


def test_tables_equal_the_batch_chain(spark, chained):
    layout, whole = chained
    out = L.run_batch(whole)
    bronze = I.read_days(spark, layout.bronze, whole.schema)
    flat = lambda df: df.select(*KEYS, "timestampInfo.server")
    assert rows_of(flat(bronze)) == rows_of(flat(out["bronze"])) and bronze.filter("eventDate IS NULL").count() > 0
    silver = I.read_days(spark, layout.silver, silver_schema(LONG)).drop(*I.OWN)
    assert rows_of(silver) == rows_of(out["silver"])
    for level, name in (("customerId", "viewer_qos"), ("contentId", "content_qos")):
        assert rows_of(I.read_gold(spark, layout, level)) == rows_of(out[name])
    dq = spark.read.parquet(layout.dq_results).groupBy("rule_name").agg(F.sum("failed_count").alias("n")).collect()
    want = {r.rule_name: r.failed_count for r in Q.dq_results(out["bronze"]).collect()}
    assert {r.rule_name: r.n for r in dq} == want


def test_restart_and_replay_change_nothing(spark, raw, tmp_dir):
    layout = Layout(tmp_dir)
    raw.write.partitionBy("eventDate").parquet(layout.source_raw)
    run(spark, layout)
    tables = (layout.bronze, layout.validated, layout.silver, layout.gold_deltas, layout.bloom("bronze"))
    before = {t: rows_of(spark.read.parquet(t).drop(*I.OWN)) for t in tables}
    run(spark, layout)
    for stage in ("files_bronze", "files_validated", "files_silver", "files_gold"):
        # a crash after the chunk's tables were written and before it was marked
        at = layout.checkpoint(stage)
        for name in os.listdir(f"{at}/done"):
            os.unlink(f"{at}/done/{name}")
        for name in os.listdir(f"{at}/commits"):
            os.unlink(f"{at}/commits/{name}")
        options = {"trigger": "available_now", "tier_type": LONG, "chunk_days": None}
        jobs.await_all([getattr(I, {"files_validated": "validation_files"}.get(stage, f"{stage[6:]}_files"))(spark, layout, **options)])
    for t in tables:
        assert rows_of(spark.read.parquet(t).drop(*I.OWN)) == before[t], t
    assert not [n for n in os.listdir(tmp_dir) if "__staging" in n and os.listdir(f"{tmp_dir}/{n}")]
    assert open(f"{layout.checkpoint('files_bronze')}/boundary").read().startswith(f"files={len(day_files(layout.source_raw))} ")


def test_backlog_in_any_file_order_loses_no_row_to_a_watermark(spark, raw, tmp_dir):
    """File times are shuffled; Bronze comes out by day, so a late bound of one day downstream drops nothing."""
    layout = Layout(tmp_dir)
    raw.filter("eventDate < '2024-01-11'").coalesce(1).write.partitionBy("eventDate").parquet(layout.source_raw)
    files = day_files(layout.source_raw)
    r = random.Random(4)
    for f in files:
        t = r.randint(1_600_000_000, 1_700_000_000)
        os.utime(f, (t, t))
    jobs.await_all([I.bronze_files(spark, layout, "available_now", tier_type=LONG)])  # a chunk a day
    written = [f for _, f in sorted((os.path.getmtime(f), f) for f in day_files(layout.bronze))]
    assert [I.day_of(f) for f in written] == sorted(I.day_of(f) for f in files)
    fields = [f for f in raw_schema(LONG).fields if f.name != "eventDate"]
    owned = [T.StructField("eventDate", T.DateType()), T.StructField("query_id", T.StringType()),
             T.StructField("batch_id", T.IntegerType()), T.StructField("part", T.IntegerType())]
    stream = (spark.readStream.schema(T.StructType(fields + owned)).option("maxFilesPerTrigger", "1").parquet(layout.bronze))
    out = jobs.dedupe_stream(stream, KEYS, late_days=1)
    q = (out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/late"))
    q.awaitTermination()
    want = raw.filter("eventDate < '2024-01-11'").transform(B.minimal_validation).select(*KEYS).distinct()
    assert rows_of(spark.read.parquet(f"{tmp_dir}/late").select(*KEYS)) == rows_of(want)


def put(spark, layout, df, day=None):
    df.coalesce(1).write.mode("append").partitionBy("eventDate").parquet(layout.source_raw)


def test_schema_changes_while_the_query_runs(spark, tmp_dir):
    """Columns added, widened and retyped between triggers of one query; rule 0 of the next stage lists them."""
    layout, day = Layout(tmp_dir), dt.date(2024, 1, 2)
    one = lambda c, **k: raw_df(spark, [raw_row(customer=c, date=day, **k)], INT_TIER_RAW)
    put(spark, layout, one("a"))
    q = I.bronze_files(spark, layout, trigger="0 seconds", tier_type=T.IntegerType())
    try:
        q.processAllAvailable()
        put(spark, layout, one("b").withColumn("newField", F.lit(7)))
        q.processAllAvailable()
        put(spark, layout, one("c").withColumn("newField", F.lit(2**40)))
        q.processAllAvailable()
        wide = one("d").withColumn("player", F.struct(F.lit("n/a").alias("bufferings"), F.lit(3).alias("bufferingTime"), F.lit(1.5).alias("more")))
        put(spark, layout, wide.withColumn("newField", F.lit(True)))
        put(spark, layout, one("e").drop("timestampInfo").withColumn("x.y", F.create_map(F.lit("k"), F.lit(1))))
        q.processAllAvailable()
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    history = E.SchemaHistory(spark, f"{layout.checkpoint('files_bronze')}/schema").versions()
    types = [s["newField"].dataType.simpleString() if "newField" in s.names else None for s in history]
    assert list(dict.fromkeys(types)) == [None, "int", "bigint", "string"]
    assert history[-1]["player"].dataType.simpleString() == "struct<bufferings:string,bufferingTime:int,more:double>"
    bronze = E.read_files(spark, layout.bronze, day_files(layout.bronze), raw_schema(T.IntegerType()), drop=I.OWN)
    got = {r.customerId: r for r in bronze.collect()}
    assert {c: r.newField for c, r in got.items()} == {"a": None, "b": "7", "c": str(2**40), "d": "true", "e": None}
    assert {c: r.player.bufferings for c, r in got.items()} == {"a": "0", "b": "0", "c": "0", "d": "n/a", "e": "0"}
    assert got["e"]["x.y"] == {"k": 1} and got["e"].timestampInfo is None
    jobs.await_all([I.validation_files(spark, layout, trigger="available_now", tier_type=T.IntegerType())])
    dq = spark.read.parquet(layout.dq_results).filter("rule_name = 'schema_validation'").first()
    assert "newField" in dq.unexpected_cols and "x.y" in dq.unexpected_cols
    valid = I.read_days(spark, layout.validated, raw_schema(T.IntegerType()))
    assert {r.customerId: r.player.bufferings for r in valid.collect()} == {"a": 0, "b": 0, "c": 0, "e": 0}  # "n/a" is no count


def test_gold_deltas_fold_and_cost(spark, tmp_dir):
    """Equal to the aggregate over all rows after replay and folds; a trigger writes what its rows need, whatever the day holds."""
    layout = Layout(tmp_dir)
    silver = X.silver_fixture(spark, SF).withColumn("eventDate", F.lit("2024-01-02").cast("date"))
    parts = [silver.filter(F.pmod(F.hash("serverTimestamp"), F.lit(6)) == k) for k in range(5)] + [silver.limit(3)]
    sizes, total = [], None
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").partitionBy("eventDate").parquet(layout.silver)
        old = set(day_files(layout.gold_deltas))
        jobs.await_all([I.gold_files(spark, layout, "available_now", tier_type=LONG)])
        sizes.append(spark.read.parquet(*(set(day_files(layout.gold_deltas)) - old)).count())
        total = part if total is None else total.unionByName(part)
        if k in (1, 2, 4):
            I.fold_gold(spark, layout)
        if k == 3:
            for name in os.listdir(f"{layout.checkpoint('files_gold')}/done"):
                os.unlink(f"{layout.checkpoint('files_gold')}/done/{name}")
        total_rows = G.viewer_qos(total)
        assert rows_of(I.read_gold(spark, layout, "customerId")) == rows_of(total_rows), k
    assert rows_of(I.read_gold(spark, layout, "contentId")) == rows_of(G.content_qos(total))
    assert sizes[-1] <= 6 < min(sizes[:-1])  # three rows into a full day
    assert len([n for n in os.listdir(layout.gold_base) if n.startswith("fold=")]) == 2
    assert len(day_files(layout.gold_deltas)) < 6


def test_key_index_is_exact_with_a_filter_that_is_too_small(spark, tmp_dir):
    """A Bloom filter of two words says yes to nearly all keys; the table decides."""
    schema = "customerId string, contentId string, clientId string, eventDate date, n int"
    day = dt.date(2024, 1, 2)

    def frame(names, n):
        return spark.createDataFrame([(c, "v", None, d, n) for c in names for d in (day, None)], schema)

    for words in (2, 1 << 10):
        index = I.KeyIndex(spark, f"{tmp_dir}/t{words}", f"{tmp_dir}/b{words}", words=words)
        for k, names in enumerate((["a", "b", "a"], ["b", "c"], [str(i) for i in range(200)], ["a", "7", "new"], [])):
            I.append_new(frame(names, k), index, ["n"], I.Chunk("q", 0, k, ()))
            I.append_new(frame(names, k), index, ["n"], I.Chunk("q", 0, k, (), retry=True))
        got = Counter((r.customerId, r.eventDate, r.n) for r in spark.read.parquet(index.table).collect())
        firsts = {"a": 0, "b": 0, "c": 1} | {str(i): 2 for i in range(200)} | {"new": 3}
        assert got == Counter((c, d, n) for c, n in firsts.items() for d in (day, None))


def test_chunks_by_day_and_bytes():
    files = [(f"t/eventDate=2024-01-0{d}/f{i}.parquet", 10) for d in (3, 1, 2) for i in (1, 0)] + [("t/eventDate=__HIVE_DEFAULT_PARTITION__/x.parquet", 99)]
    one = I.chunks(files, 100, 1)
    assert [len(c) for c in one] == [1, 2, 2, 2] and one[1] == ["t/eventDate=2024-01-01/f0.parquet", "t/eventDate=2024-01-01/f1.parquet"]
    assert [len(c) for c in I.chunks(files, 40, None)] == [1, 4, 2]
    assert [len(c) for c in I.chunks(files, 1, 1)] == [1] * 7
    assert I.chunks([]) == []


# --- types ------------------------------------------------------------------------


def kind(text, spark):
    return spark.createDataFrame([], f"c {text}").schema["c"].dataType


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"), ("int", "string", "string"),
    ("boolean", "int", "string"), ("date", "timestamp", "timestamp"), ("date", "int", "string"),
    ("decimal(10,2)", "decimal(12,6)", "decimal(14,6)"),
    ("struct<a:int>", "struct<b:int,a:bigint>", "struct<a:bigint,b:int>"), ("struct<a:int>", "int", "string"),
    ("array<int>", "array<double>", "array<double>"), ("map<string,int>", "map<string,string>", "map<string,string>"),
    ("map<string,int>", "map<int,int>", "string"),
])
def test_widest(spark, a, b, want):
    x, y = kind(a, spark), kind(b, spark)
    assert E.widest(x, y).simpleString() == kind(want, spark).simpleString()
    assert E.widest(E.widest(x, y), x) == E.widest(x, y) == E.widest(E.widest(x, y), y)


def test_files_of_colliding_types_are_one_frame(spark, tmp_dir):
    for i, t in enumerate(("int", "string", "bigint", "struct<a:int>", "int", "string")):
        c = F.struct(F.lit(i).alias("a")) if t[0:6] == "struct" else F.lit(i).cast(t)
        spark.range(1).select(F.lit(i).alias("id"), c.alias("x")).coalesce(1).write.mode("append").parquet(tmp_dir)
    got = E.read_files(spark, tmp_dir, day_files(tmp_dir))
    assert {r.id: r.x for r in got.collect()} == {0: "0", 1: "1", 2: "2", 3: '{"a":3}', 4: "4", 5: "5"}


def test_null_only_day_has_the_contract_type(spark, tmp_dir):
    layout = Layout(tmp_dir)
    raw_df(spark, [raw_row(date=None)]).write.partitionBy("eventDate").parquet(layout.source_raw)
    found = E.read_files(spark, layout.source_raw, day_files(layout.source_raw), raw_schema())
    assert found.schema["eventDate"].dataType == T.DateType()
    assert Q.schema_report(found.schema, raw_schema(T.IntegerType())).failed == 0


def test_contract_values_that_do_not_fit_are_null(spark):
    df = spark.createDataFrame([("7", "x", None), ("7.9", "2024-01-02", "{}"), ("no", None, '{"server": 5}')], "n string, eventDate string, timestampInfo string")
    want = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("eventDate", T.DateType()), raw_schema()["timestampInfo"]])
    got = [tuple(r) for r in E.try_contract(df, want).collect()]
    assert got == [(7, None, None), (7, dt.date(2024, 1, 2), (None, None)), (None, None, (5, None))]


def test_dedupe_first_takes_any_type_and_orders_ties(spark):
    data = spark.sql("""
      SELECT k, 1 AS t, named_struct('m', map('b', 2, 'a', v), 'n', array(map('x', named_struct('y', map(v, 'z'))))) AS s,
        parse_json(concat('{"v":', v, '}')) AS j, v AS `dotted.name`
      FROM VALUES ('a', 3), ('a', 1), ('a', 2), ('b', 5), (null, 7), (null, 6) AS x(k, v)""")
    for n in (1, 4):
        df = data.repartition(n, "v") if n == 1 else data.repartition(n)
        for got in (B.dedupe_first(df, ["k"], ["t"]), B.dedupe_first(df.select("*", *B.row_digest(df.schema)), ["k"], ["t"], digest=["_digest0", "_digest1"])):
            assert got.schema.simpleString() == data.schema.simpleString()
            rows = {r.k: r for r in got.collect()}
            assert set(rows) == {"a", "b", None}
            for r in rows.values():  # a whole row, not a mixture
                v = r["dotted.name"]
                assert r.s.m == {"b": 2, "a": v} and r.s.n[0]["x"].y == {v: "z"} and r.j.toPython() == {"v": v}
    assert {r.k: r["dotted.name"] for r in B.dedupe_first(data, ["k"], ["t"]).collect()} == {"a": 1, "b": 5, None: 6}


def test_rebuild_reports_missing_columns(spark, tmp_dir):
    for name in ("qualityDistribution", "eventDate", "timestampInfo", "customerId"):
        layout = Layout(f"{tmp_dir}/{name}")
        df = raw_df(spark, [raw_row(), raw_row(customer="c2", src=traffic(responses=0.2))]).drop(name)
        L.write_layers(spark, df, layout)
        dq = {r.rule_name: r for r in spark.read.parquet(layout.dq_results).collect()}
        assert dq["schema_validation"].missing_cols == f"['{name}']" and dq["schema_validation"].failed_count == 1
        gold = spark.read.schema(L.run_batch(raw_df(spark, []))["viewer_qos"].schema).parquet(layout.gold_viewer).count()
        assert gold == (0 if name in ("customerId", "eventDate") else 2)


def test_failed_backfill_leaves_the_days_as_they_were(spark, raw, tmp_dir):
    layout = Layout(tmp_dir)
    L.write_layers(spark, raw, layout)
    before = rows_of(spark.read.parquet(layout.silver))
    broken = raw.withColumn("player", F.when(F.col("timestampInfo.server") % 501 == 0, F.raise_error("broken source").cast(raw.schema["player"].dataType)).otherwise(F.col("player")))
    with pytest.raises(Exception, match="broken source"):
        L.write_layers(spark, broken, layout, since="2024-01-15")
    for table in (layout.bronze, layout.validated, layout.silver, layout.gold_viewer):
        assert spark.read.parquet(table).filter("eventDate >= '2024-01-15'").count() > 0
    assert rows_of(spark.read.parquet(layout.silver)) == before


def test_end_to_end_shuffle_carries_no_map(spark, raw):
    plan = L.run_batch(raw)["viewer_qos"]._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "min_by" in line]
    assert first and not any("map" in line.lower() and "quality" in line for line in first)
    assert L.gold_leaves(raw).schema.simpleString().count("map") == 0
    assert rows_of(L.gold_leaves(raw).select(*KEYS, "timestampInfo.server")) == rows_of(L.bronze_layer(raw).select(*KEYS, "timestampInfo.server"))
