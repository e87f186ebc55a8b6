"""The layer chain as micro-batches of new files, without a state store.

The streams of ``jobs`` read rows under one schema and keep every key (or every
group) in state. Here a stream delivers the *names* of new files, exactly once
and with its progress in the checkpoint, and each micro-batch is planned anew
over these files:

* the files' own schemas are united, with a stored history (``sources.evolving``),
  so a column may be added, widened or retyped while the query runs;
* the first micro-batch is a snapshot of the table: all chunks of files are
  taken by event day, so tables downstream get their files in day order whatever
  the files' times are, and a watermark there drops nothing of the backlog;
* keys seen before are found in the output table itself, behind a Bloom filter a
  day, so no key stays in memory and no row is dropped for being late;
* Gold keeps mergeable sums of each micro-batch, folded when read.

Outputs are partitioned by day and, below it, by query, micro-batch and chunk. A
chunk that is done is marked beside the checkpoint and skipped in a replay; one
that was interrupted writes only the directories that are not there yet, so
what a reader has taken is never written twice. This rests on renames of
directories, as HDFS and mounted storage have them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playback_qos.functions.qos import quality_name, quality_rank, ratio_or_zero
from playback_qos.operators import bronze as B
from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.operators import silver as S
from playback_qos.plans.layers import FIRST_SEEN, FIRST_SEEN_FLAT
from playback_qos.schema import DISTRIBUTION, KEYS, raw_schema, silver_schema
from playback_qos.sources.evolving import SchemaHistory, conform, read_files, try_contract
from playback_qos.streaming.layout import Layout
from playback_qos.streaming.sinks import _fs, child_names, delete, ensure_dir, query_of, trigger_kwargs

DAY = "eventDate"
#: Directories below a day: the query, micro-batch and chunk that wrote them.
OWN = ("query_id", "batch_id", "part")
#: Input bytes of a chunk.
CHUNK_BYTES = 8 << 30
#: 64-bit words of a day's Bloom filter: 2**20 words are 8 MiB, and enough for some six million keys.
BLOOM_WORDS = 1 << 20
_BLOOM = T.StructType([T.StructField("word", T.IntegerType()), T.StructField("bits", T.LongType())])
_FILES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Chunk:
    """Some files of a micro-batch, and the identity of what is made from them."""

    query: str
    batch: int
    part: int
    paths: tuple
    retry: bool = False  #: an earlier attempt may have written some of it

    @property
    def own(self) -> dict:
        return {"query_id": self.query, "batch_id": self.batch, "part": self.part}

    @property
    def name(self) -> str:
        return f"{self.query}-{self.batch:09d}-{self.part:06d}"


def day_of(path: str) -> str:
    """Event day in a file's directory; '' for a table that has none, and for null days."""
    found = re.search(rf"/{DAY}=([^/]+)/", path)
    day = unquote(found[1]) if found else ""
    return "" if day.startswith("__HIVE") else day


def chunks(files: Sequence[tuple[str, int]], chunk_bytes: int = CHUNK_BYTES, chunk_days: int | None = 1) -> list[list[str]]:
    """Files (path, length) in order of event day and name, cut by bytes and days.

    A file of its own is never cut; ``chunk_days=None`` bounds bytes only. Rows
    without a day come first.
    """
    out: list[list[str]] = []
    size, days = 0, set()
    for path, length in sorted(files, key=lambda f: (day_of(f[0]), f[0])):
        over = chunk_days is not None and len(days | {day_of(path)}) > chunk_days
        if not out or over or size and size + length > chunk_bytes:
            out.append([])
            size, days = 0, set()
        out[-1].append(path)
        size += length
        days.add(day_of(path))
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _mark(spark: SparkSession, path: str, text: str = "") -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(text.encode())
    out.close()


def stream_files(
    spark: SparkSession,
    table: str,
    checkpoint: str,
    process: Callable[[Chunk], None],
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_days: int | None = 1,
    name: str | None = None,
) -> StreamingQuery:
    """Call ``process`` for each chunk of files that are new in a table of Parquet files.

    Spark's file source tracks the files (each once, on any storage that Spark
    reads), and only their names and lengths reach the driver: what a trigger
    lists anyway. Without ``max_files_per_trigger`` the first micro-batch is the
    whole table as it stands, its boundary and size noted in
    ``<checkpoint>/boundary``.
    """
    ensure_dir(spark, table)
    reader = (spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(table).select("path", "length", "modificationTime")

    def batch(new: DataFrame, batch_id: int) -> None:
        session = new.sparkSession
        found = new.collect()
        query = query_of(session) or "direct"
        if batch_id == 0 and found:
            newest = max(r.modificationTime for r in found)
            _mark(session, f"{checkpoint}/boundary", f"files={len(found)} bytes={sum(r.length for r in found)} newest={newest}")
        for part, paths in enumerate(chunks([(r.path, r.length) for r in found], chunk_bytes, chunk_days)):
            chunk = Chunk(query, batch_id, part, tuple(paths))
            begun, done = (f"{checkpoint}/{x}/{chunk.name}" for x in ("begun", "done"))
            if not _exists(session, done):
                chunk = replace(chunk, retry=_exists(session, begun))
                _mark(session, begun)
                process(chunk)
                _mark(session, done)

    w = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**trigger_kwargs(trigger)).start()


def write_days(df: DataFrame, path: str, chunk: Chunk, fmt: str = "parquet") -> None:
    """Write a chunk's rows by day, each day's as one directory that appears at once (by a rename).

    In a retry the days that an earlier attempt has written stay as they are,
    since readers may have taken them already; they hold the same rows. Rows of
    a day meet first (a few files a day, not one a task and day), and adaptive
    execution splits days that are too large for a task.
    """
    spark = df.sparkSession
    ensure_dir(spark, path)
    own = {k: F.lit(v) for k, v in chunk.own.items()}
    if chunk.retry:
        below = "/".join(f"{k}={v}" for k, v in chunk.own.items())
        there = [n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith(f"{DAY}=") and _exists(spark, f"{path}/{n}/{below}")]
        null = any(n.startswith("__HIVE") for n in there)
        days = [n for n in there if not n.startswith("__HIVE")]
        df = df.filter(F.when(F.col(DAY).isNull(), F.lit(not null)).otherwise(~F.col(DAY).cast("string").isin(days)))
    (df.hint("rebalance", DAY).withColumns(own).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").partitionBy(DAY, *OWN).save(path))


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Rows of a table made by :func:`write_days`, with the OWN columns; of some days only, listing no others."""
    full = T.StructType([f for f in schema.fields if f.name != DAY]
                        + [T.StructField(DAY, T.DateType()), T.StructField("query_id", T.StringType()),
                           T.StructField("batch_id", T.IntegerType()), T.StructField("part", T.IntegerType())])
    reader = spark.read.format(fmt).schema(full).option("basePath", path)
    if days is None:
        return reader.load(path)
    names = [f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if d is None else d.isoformat()}" for d in days]
    there = set(child_names(spark, path))
    found = [f"{path.rstrip('/')}/{n}" for n in names if n in there]
    return reader.load(found) if found else spark.createDataFrame([], full)


def _own(chunk: Chunk) -> Column:
    same = F.lit(True)
    for c, v in chunk.own.items():
        same = same & F.col(c).eqNullSafe(F.lit(v))
    return same


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_{k}"])
    return cond


@dataclass(frozen=True)
class KeyIndex:
    """Which keys a table of :func:`write_days` holds: a Bloom filter a day, and the table's own key columns.

    The filter has a row for each word and chunk (``bits`` of four keys' bits
    each); words of a day are united when read. It tells new keys apart without
    reading the table. Keys that it may hold are looked up in the table, in the
    days at hand only, so the answer is exact.
    """

    spark: SparkSession
    table: str
    bloom: str
    keys: tuple = tuple(KEYS)
    words: int = BLOOM_WORDS

    def _bits(self, df: DataFrame) -> DataFrame:
        names = ", ".join(f"`{k}`" for k in self.keys)
        marks = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(_h, {6 * i}) & 63 as int))" for i in range(4))
        return (df.withColumn("_h", F.expr(f"xxhash64({names}, 1)"))
                .withColumns({"_word": F.expr(f"cast(pmod(xxhash64({names}), {self.words}) as int)"), "_bits": F.expr(marks)}).drop("_h"))

    def add(self, rows: DataFrame, chunk: Chunk) -> None:
        """Note the keys of rows that the chunk has written to the table."""
        bits = self._bits(rows.select(*self.keys)).groupBy(DAY, F.col("_word").alias("word"))
        write_days(bits.agg(F.bit_or("_bits").alias("bits")), self.bloom, chunk)

    def known(self, rows: DataFrame, days: Sequence, chunk: Chunk) -> DataFrame | None:
        """Keys among ``rows`` (a written table) that other chunks have put into the table; None if the filter has none."""
        filters = read_days(self.spark, self.bloom, _BLOOM, days).filter(~_own(chunk))
        united = filters.groupBy(F.col(DAY).alias("_day"), "word").agg(F.bit_or("bits").alias("bits"))
        marked = self._bits(rows.select(*self.keys))
        may = marked.join(united, marked[DAY].eqNullSafe(united["_day"]) & (marked["_word"] == united["word"])).filter(
            "bits & _bits = _bits")
        may = may.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        staging = f"{self.bloom}__staging/{chunk.name}"
        may.write.mode("overwrite").parquet(staging)
        may = self.spark.read.schema(may.schema).parquet(staging)
        if not may.take(1):
            return None
        kinds = T.StructType([f for f in rows.schema.fields if f.name in self.keys])
        held = read_days(self.spark, self.table, kinds, days).filter(~_own(chunk)).select(*self.keys)
        return may.join(held, _same(held, may, self.keys), "left_semi")

    def forget_staging(self, chunk: Chunk) -> None:
        delete(self.spark, f"{self.bloom}__staging/{chunk.name}")


def append_new(rows: DataFrame, index: KeyIndex, order: Sequence[str], chunk: Chunk) -> None:
    """Append to the index's table one row for each key that it does not hold yet.

    Of a chunk's rows with one key the first by ``order`` stays; tasks reduce
    their own rows before anything moves, so a hot key costs a row a task. The
    reduced rows are written once to a staging folder and read from there. A
    retry gives the same rows: what the chunk wrote itself does not count as known.
    """
    spark = index.spark
    staging = f"{index.table.rstrip('/')}__staging/{chunk.name}"
    B.dedupe_first(rows, index.keys, order).write.mode("overwrite").parquet(staging)
    first = spark.read.schema(rows.schema).parquet(staging)
    days = [r[0] for r in first.select(DAY).distinct().collect()]
    known = index.known(first, days, chunk)
    new = first if known is None else first.join(known, _same(first, known, index.keys), "left_anti")
    write_days(new, index.table, chunk)
    keys = T.StructType([f for f in rows.schema.fields if f.name in index.keys])
    index.add(read_days(spark, index.table, keys, days).filter(_own(chunk)), chunk)
    index.forget_staging(chunk)
    delete(spark, staging)


# --- stages -----------------------------------------------------------------


def bronze_files(spark: SparkSession, layout: Layout, trigger: str | None = "30 seconds", max_files_per_trigger: int | None = None,
                 tier_type: T.DataType = DISTRIBUTION, **options) -> StreamingQuery:
    """Raw files -> required ids -> keys not in Bronze yet -> Bronze, of the widest schema so far."""
    index = KeyIndex(spark, layout.bronze, layout.bloom("bronze"))
    history = SchemaHistory(spark, f"{layout.checkpoint('files_bronze')}/schema")

    def process(chunk: Chunk) -> None:
        rows = read_files(spark, layout.source_raw, chunk.paths, raw_schema(tier_type))
        rows = conform(rows, history.extend(rows.schema))
        for f in raw_schema(tier_type).fields:  # keys are needed; other missing columns are left to the schema rule
            if f.name in KEYS and f.name not in rows.columns:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        keys = T.StructType([f for f in raw_schema(tier_type).fields if f.name in KEYS])
        append_new(B.minimal_validation(try_contract(rows, keys)), index, FIRST_SEEN, chunk)

    return stream_files(spark, layout.source_raw, layout.checkpoint("files_bronze"), process, trigger, max_files_per_trigger,
                        name="files_bronze", **options)


def validation_files(spark: SparkSession, layout: Layout, bounds: Q.Bounds = Q.DEFAULT_BOUNDS, trigger: str | None = None,
                     max_files_per_trigger: int | None = None, tier_type: T.DataType = DISTRIBUTION, **options) -> StreamingQuery:
    """Bronze files -> valid rows of the contract's types, and four DQ rows a chunk.

    Rule 0 sees the types that the files have; the other rules and the valid rows
    see values of the contract's types, null where a value does not fit.
    """
    declared = raw_schema(tier_type)

    def process(chunk: Chunk) -> None:
        found = read_files(spark, layout.bronze, chunk.paths, declared, drop=OWN)
        typed = try_contract(found, declared)
        write_days(Q.valid_rows(_with_day(typed), bounds), layout.validated, chunk)
        target = "/".join([layout.dq_results, *[f"{k}={v}" for k, v in chunk.own.items()]])
        Q.dq_results(typed, bounds, reported=found.schema).write.mode("overwrite").parquet(target)

    return stream_files(spark, layout.bronze, layout.checkpoint("files_validated"), process, trigger, max_files_per_trigger,
                        name="files_validated", **options)


def _with_day(df: DataFrame) -> DataFrame:
    return df if DAY in df.columns else df.withColumn(DAY, F.lit(None).cast("date"))


def silver_files(spark: SparkSession, layout: Layout, trigger: str | None = "30 seconds", max_files_per_trigger: int | None = None,
                 tier_type: T.DataType = DISTRIBUTION, **options) -> StreamingQuery:
    """Validated files -> clamp, tiers, flatten -> keys not in Silver yet -> Silver."""
    index = KeyIndex(spark, layout.silver, layout.bloom("silver"))

    def process(chunk: Chunk) -> None:
        valid = read_files(spark, layout.validated, chunk.paths, raw_schema(tier_type), drop=OWN)
        append_new(conform(S.silver_rows(valid), silver_schema(tier_type)), index, FIRST_SEEN_FLAT, chunk)

    return stream_files(spark, layout.validated, layout.checkpoint("files_silver"), process, trigger, max_files_per_trigger,
                        name="files_silver", **options)


# --- Gold as mergeable deltas -------------------------------------------------

LEVELS = ("customerId", "contentId")
_SUMS = {"buffering_time": T.LongType(), "bufferings": T.LongType(), "received": T.LongType(), "ratio_sum": T.DoubleType(),
         "ratio_n": T.LongType(), "p2p_sum": T.DoubleType(), "p2p_n": T.LongType(), "events": T.LongType()}
_DELTA = T.StructType([T.StructField(n, t) for n, t in (
    {"level": T.StringType(), "key": T.StringType(), DAY: T.DateType()} | _SUMS | {"max_rank": T.IntegerType()}).items()])


def gold_delta(silver: DataFrame, quality_order: str = "lexical") -> DataFrame:
    """Sums, counts and ranks of Silver rows a (level, key, day): what can be added up with those of other rows."""
    qos = G.add_qos_fields(silver, quality_order)
    sums = [
        F.sum("bufferingTime").cast("long").alias("buffering_time"),
        F.sum("bufferings").cast("long").alias("bufferings"),
        F.sum("total_received_data").alias("received"),
        F.sum("buffering_ratio").alias("ratio_sum"),
        F.count("buffering_ratio").alias("ratio_n"),
        F.sum("p2p_share").alias("p2p_sum"),
        F.count("p2p_share").alias("p2p_n"),
        F.count(F.lit(1)).alias("events"),
        F.max(quality_rank("dominant_quality", quality_order)).alias("max_rank"),
        F.grouping_id().alias("_gid"),
    ]
    both = qos.groupingSets([[k, DAY] for k in LEVELS], *LEVELS, DAY).agg(*sums)
    viewer = F.col("_gid") == 2  # the bit of contentId, which that set leaves out
    level = F.when(viewer, F.lit(LEVELS[0])).otherwise(F.lit(LEVELS[1]))
    key = F.when(viewer, F.col(LEVELS[0])).otherwise(F.col(LEVELS[1]))
    return both.select(level.alias("level"), key.alias("key"), DAY, *_SUMS, "max_rank")


def merged(deltas: DataFrame) -> DataFrame:
    """One row a (level, key, day) from any number of deltas."""
    return deltas.groupBy("level", "key", DAY).agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("max_rank").alias("max_rank"))


def gold_files(spark: SparkSession, layout: Layout, trigger: str | None = None, quality_order: str = "lexical",
               max_files_per_trigger: int | None = None, tier_type: T.DataType = DISTRIBUTION, **options) -> StreamingQuery:
    """Silver files -> a delta of both Gold levels a chunk; a trigger reads and writes what is new and nothing else."""

    def process(chunk: Chunk) -> None:
        rows = read_files(spark, layout.silver, chunk.paths, silver_schema(tier_type), drop=OWN)
        write_days(gold_delta(rows, quality_order), layout.gold_deltas, chunk)

    return stream_files(spark, layout.silver, layout.checkpoint("files_gold"), process, trigger, max_files_per_trigger,
                        name="files_gold", **options)


def _folds(spark: SparkSession, layout: Layout) -> list[str]:
    """Finished folds, the oldest first."""
    names = sorted(n for n in child_names(spark, layout.gold_base) if n.startswith("fold="))
    return [n for n in names if _exists(spark, f"{layout.gold_base}/{n}/done")]


def _deltas(spark: SparkSession, layout: Layout, only: DataFrame | None = None) -> DataFrame:
    """The last fold's rows and all deltas that are not in it (of the chunks listed in ``only``, if given)."""
    columns = [f.name for f in _DELTA.fields]
    ensure_dir(spark, layout.gold_deltas)
    new = read_days(spark, layout.gold_deltas, _DELTA)

    def listed(chunks: DataFrame) -> Column:
        cond = new[DAY].eqNullSafe(chunks[DAY])
        for c in OWN:
            cond = cond & (new[c] == chunks[c])
        return cond

    folds = _folds(spark, layout)
    if only is not None:
        new = new.join(only, listed(only), "left_semi")
    if not folds:
        return new.select(*columns)
    at = f"{layout.gold_base}/{folds[-1]}"
    inside = spark.read.parquet(f"{at}/chunks")
    base = spark.read.schema(_DELTA).parquet(f"{at}/rows")
    return base.select(*columns).unionByName(new.join(inside, listed(inside), "left_anti").select(*columns))


def read_gold(spark: SparkSession, layout: Layout, level: str, quality_order: str = "lexical") -> DataFrame:
    """The Gold table of a level (``customerId`` or ``contentId``): its last fold and the deltas since, added up."""
    whole = merged(_deltas(spark, layout).filter(F.col("level") == level))
    named = whole.select(
        F.col("key").alias(level), DAY,
        F.col("buffering_time").alias("total_buffering_time"),
        F.col("bufferings").alias("total_bufferings"),
        F.col("received").alias("total_received_data"),
        F.when(F.col("ratio_n") > 0, F.col("ratio_sum") / F.col("ratio_n")).alias("avg_buffering_ratio"),
        F.when(F.col("p2p_n") > 0, F.col("p2p_sum") / F.col("p2p_n")).alias("avg_p2p_share"),
        F.col("events").alias("event_count"),
        quality_name("max_rank", quality_order).alias("max_quality"))
    return named.withColumn("buffering_ratio", ratio_or_zero("total_buffering_time", "total_received_data"))


def fold_gold(spark: SparkSession, layout: Layout, keep: int = 2) -> str:
    """Add up all deltas there are into a new base; returns its folder.

    Run it now and then, beside the stream, one at a time: deltas that arrive
    meanwhile are not on its list and stay. A fold that did not finish has no
    mark and is not read. Of the last ``keep`` folds all is kept, for readers
    that began with one of them; older ones go, and with them the deltas that
    the oldest kept fold holds.
    """
    ensure_dir(spark, layout.gold_base)
    before = _folds(spark, layout)
    number = int(before[-1].split("=")[1]) + 1 if before else 0
    at = f"{layout.gold_base}/fold={number:09d}"
    ensure_dir(spark, layout.gold_deltas)
    # the list is written first: other deltas may come while this one runs
    there = read_days(spark, layout.gold_deltas, _DELTA).select(DAY, *OWN).distinct()
    there.write.mode("overwrite").parquet(f"{at}/chunks")
    merged(_deltas(spark, layout, spark.read.parquet(f"{at}/chunks"))).write.mode("overwrite").parquet(f"{at}/rows")
    _mark(spark, f"{at}/done")
    kept = [*before, at.rsplit("/", 1)[1]]
    if len(kept) > keep:
        for r in spark.read.parquet(f"{layout.gold_base}/{kept[-keep]}/chunks").toLocalIterator():
            day = "__HIVE_DEFAULT_PARTITION__" if r[DAY] is None else r[DAY].isoformat()
            delete(spark, "/".join([layout.gold_deltas, f"{DAY}={day}", *[f"{c}={r[c]}" for c in OWN]]))
        for name in kept[:-keep]:
            delete(spark, f"{layout.gold_base}/{name}")
    return at


def run_incremental(spark: SparkSession, layout: Layout, bounds: Q.Bounds = Q.DEFAULT_BOUNDS, quality_order: str = "lexical",
                    tier_type: T.DataType = DISTRIBUTION, max_files_per_trigger: int | None = None,
                    chunk_bytes: int = CHUNK_BYTES, chunk_days: int | None = 1) -> None:
    """All four stages in order, each over the files that are new since its last run."""
    from playback_qos.streaming.jobs import await_all

    common = {"trigger": "available_now", "max_files_per_trigger": max_files_per_trigger, "tier_type": tier_type,
              "chunk_bytes": chunk_bytes, "chunk_days": chunk_days}
    await_all([bronze_files(spark, layout, **common)])
    await_all([validation_files(spark, layout, bounds, **common)])
    await_all([silver_files(spark, layout, **common)])
    await_all([gold_files(spark, layout, quality_order=quality_order, **common)])
