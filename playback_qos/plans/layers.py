"""The layer chain as pure DataFrame functions (batch and stream alike)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.functions.paths import col_or_null
from playback_qos.operators import bronze as B
from playback_qos.operators import gold as G
from playback_qos.operators import quality as Q
from playback_qos.operators import silver as S
from playback_qos.schema import DISTRIBUTION, KEYS

# Order used wherever a deterministic dedupe survivor is wanted.
FIRST_SEEN = ("timestampInfo.server", "timestampInfo.agent")
FIRST_SEEN_FLAT = ("serverTimestamp", "agentTimestamp")


def bronze_layer(raw: DataFrame, keys: Sequence[str] = KEYS, deterministic: bool = True) -> DataFrame:
    """Raw -> Bronze (id filter + dedupe)."""
    return B.bronze(raw, keys, FIRST_SEEN if deterministic else None)


def silver_layer(
    validated: DataFrame,
    keys: Sequence[str] = KEYS,
    deterministic: bool = True,
    dedupe: bool = True,
) -> DataFrame:
    """Validated nested rows -> deduplicated flat Silver rows.

    ``dedupe=False`` is for a batch chain whose Bronze was already deduped on
    the same ``keys``: validation only filters and the Silver transforms are
    one-to-one and pass the key columns through, so a second dedupe would be
    the identity (it is kept in the streaming chain, where the stages run
    independently).
    """
    flat = S.silver_rows(validated)
    if not dedupe:
        return flat
    if deterministic:
        return B.dedupe_first(flat, keys, FIRST_SEEN_FLAT)
    return B.dedupe(flat, keys)


def gold_layer(silver: DataFrame, key: str, quality_order: str = "lexical") -> DataFrame:
    """Silver -> daily QoS per ``key`` (``customerId`` or ``contentId``)."""
    return G.qos_by(G.add_qos_fields(silver, quality_order), key, quality_order=quality_order)


def gold_leaves(raw: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Bronze rows with only the nested fields that rules and Gold read; tiers as flags.

    The same rows as :func:`bronze_layer`: ties go by a digest of the whole raw
    row, taken before it is cut down. So no map and no unread field is shuffled.
    """
    sch = raw.schema
    leaf = lambda path: col_or_null(sch, path).alias(path.rsplit(".", 1)[1])
    traffic = "totalDistribution"
    rows = B.minimal_validation(raw).select(
        *[col_or_null(sch, k).alias(k) for k in keys],
        F.struct(*[leaf(p) for p in FIRST_SEEN]).alias("timestampInfo"),
        F.struct(leaf("player.bufferings"), leaf("player.bufferingTime")).alias("player"),
        F.struct(
            F.struct(leaf(f"{traffic}.sourceTraffic.responses"), leaf(f"{traffic}.sourceTraffic.receivedData")).alias("sourceTraffic"),
            F.struct(leaf(f"{traffic}.p2pTraffic.receivedData")).alias("p2pTraffic"),
        ).alias(traffic),
        *[F.when(c.isNotNull(), F.lit(True)).alias(name) for name, c in S.tier_values(raw).items()],
        *B.row_digest(sch),
    )
    return B.dedupe_first(rows, keys, FIRST_SEEN, digest=("_digest0", "_digest1"))


class BatchChain:
    """The whole chain over one bounded input, built lazily per layer.

    Each property builds its plan on first use only, so asking for one Gold
    table does not construct (or analyse) the others.
    """

    def __init__(
        self,
        raw: DataFrame,
        bounds: Q.Bounds = Q.DEFAULT_BOUNDS,
        deterministic: bool = True,
        quality_order: str = "lexical",
    ):
        self.raw = raw
        self.bounds = bounds
        self.deterministic = deterministic
        self.quality_order = quality_order
        self._cache: dict = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def bronze(self) -> DataFrame:
        return self._get("bronze", lambda: bronze_layer(self.raw, deterministic=self.deterministic))

    @property
    def validated(self) -> DataFrame:
        return self._get("validated", lambda: Q.valid_rows(self.bronze, self.bounds))

    @property
    def _leaves(self) -> DataFrame:
        """Bronze with the leaves that rules and Gold read and nothing else: what the dedupe's shuffle carries."""
        return self._get("_leaves", lambda: gold_leaves(self.raw) if self.deterministic else self.bronze)

    @property
    def dq_results(self) -> DataFrame:
        return self._get("dq_results", lambda: Q.dq_results(self._leaves, self.bounds, reported=self.raw.schema))

    @property
    def _gold_rows(self) -> DataFrame:
        def build() -> DataFrame:
            if not self.deterministic:
                return self.silver
            return S.flatten(S.clamp_player(Q.valid_rows(self._leaves, self.bounds)))

        return self._get("_gold_rows", build)

    @property
    def silver(self) -> DataFrame:
        return self._get(
            "silver",
            lambda: silver_layer(self.validated, deterministic=self.deterministic, dedupe=False),
        )

    @property
    def viewer_qos(self) -> DataFrame:
        return self._get("viewer_qos", lambda: gold_layer(self._gold_rows, "customerId", self.quality_order))

    @property
    def content_qos(self) -> DataFrame:
        return self._get("content_qos", lambda: gold_layer(self._gold_rows, "contentId", self.quality_order))

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def run_batch(
    raw: DataFrame,
    bounds: Q.Bounds = Q.DEFAULT_BOUNDS,
    deterministic: bool = True,
    quality_order: str = "lexical",
) -> BatchChain:
    """Whole chain over a bounded input; index it by layer name
    (``bronze``, ``validated``, ``dq_results``, ``silver``, ``viewer_qos``,
    ``content_qos``). Nothing runs until an action on a layer."""
    return BatchChain(raw, bounds, deterministic, quality_order)


def write_layers(
    spark,
    raw: DataFrame,
    layout,
    fmt: str = "parquet",
    bounds: Q.Bounds = Q.DEFAULT_BOUNDS,
    deterministic: bool = True,
    quality_order: str = "lexical",
    since: str | None = None,
) -> None:
    """Batch (re)build of every layer table under ``layout``, each computed once.

    Without ``since`` every layer table is replaced as a whole. With it only
    the days from then on are rebuilt: each layer's new days are written beside
    the table first, then put in the place of the old ones, and days that have
    no row any more go last, so a failure while they are computed leaves the
    table as it was. All reads and the DQ counts are limited to these days, and
    earlier days (and rows without a date) stay as they are. Missing contract
    columns are null (and reported by rule 0). A base that streams have
    written to is refused before anything is written, as their commit logs
    and directories do not go with a batch rebuild.

    Every layer is written and the next one reads the written table, which
    cuts the lineage there: a lost executor only recomputes the layer in
    progress, and Bronze's dedupe shuffle is not repeated for each output.
    The rule counts are observed while the validated rows are written (one
    pass) and appended to the DQ audit table. Both Gold tables come from one
    grouping-sets aggregate over one Silver scan.
    """
    from pyspark import StorageLevel

    from playback_qos.schema import raw_schema, silver_schema
    from playback_qos.streaming.sinks import child_names, delete, remove_days

    tables = (layout.bronze, layout.validated, layout.silver, layout.gold_viewer, layout.gold_content)
    streamed = [t for t in tables if any(n == "_spark_metadata" or n.startswith(("query_id=", "batch_id="))
                                         for n in child_names(spark, t))]
    if streamed:
        raise ValueError(f"written by streams, not to be rebuilt in place: {streamed}")

    def write(df: DataFrame, path: str, partitioned: bool = True, mode: str = "overwrite") -> None:
        if not partitioned:
            df.write.mode(mode).format(fmt).save(path)
            return
        # rows of a day meet before they are written: few files a day, and
        # adaptive execution splits a day that is too large for one task
        w = df.hint("rebalance", "eventDate").write.mode(mode).format(fmt).partitionBy("eventDate")
        if since is None:
            w.option("partitionOverwriteMode", "static").save(path)
            return
        beside = f"{path.rstrip('/')}__rebuild"
        w.save(beside)
        days = {n for n in child_names(spark, beside) if n.startswith("eventDate=")}
        staged = spark.read.format(fmt).schema(df.schema).load(beside).select(*df.columns)
        (staged.hint("rebalance", "eventDate").write.mode("overwrite").format(fmt).partitionBy("eventDate")
         .option("partitionOverwriteMode", "dynamic").save(path))
        remove_days(spark, path, "eventDate", since, keep=days)
        delete(spark, beside)

    def read(path: str, schema) -> DataFrame:
        df = spark.read.format(fmt).schema(schema).load(path)
        return df if since is None else df.filter(F.col("eventDate") >= F.lit(since).cast("date"))

    found = raw.schema
    for f in raw_schema().fields:  # keys, and the day of the directories; rule 0 sees what the source has
        if f.name in KEYS and f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit(None).cast(f.dataType))
    if since is not None:
        raw = raw.filter(F.col("eventDate") >= F.lit(since).cast("date"))
    write(bronze_layer(raw, deterministic=deterministic), layout.bronze)
    bronze = read(layout.bronze, raw.schema)

    valid, obs = Q.observed_valid_rows(bronze, bounds)
    write(valid, layout.validated)
    # DQ rows are an audit log: each run appends its four rows (run_timestamp)
    dq = Q.dq_from_observation(spark, obs, found)
    if dq is None:
        dq = Q.dq_results(bronze, bounds, reported=found)
    write(dq, layout.dq_results, partitioned=False, mode="append")

    validated = read(layout.validated, raw.schema)
    write(silver_layer(validated, deterministic=deterministic, dedupe=False), layout.silver)

    tiers = raw.schema["qualityDistribution"].dataType if "qualityDistribution" in raw.columns else None
    tier_type = tiers.valueType if isinstance(tiers, T.MapType) else DISTRIBUTION
    silver = read(layout.silver, silver_schema(tier_type))
    # both Gold tables from one scan and one shuffle (grouping sets); the
    # combined result is Gold-sized and kept for the two writes (recomputed
    # from lineage if an executor holding it is lost)
    views, combined = G.qos_by_both(
        G.add_qos_fields(silver, quality_order), quality_order=quality_order
    )
    combined.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for key, path in (("customerId", layout.gold_viewer), ("contentId", layout.gold_content)):
            gold = views[key]
            write(gold.select(*[c for c in gold.columns if c != "eventDate"], F.col("eventDate")),
                  path)
    finally:
        combined.unpersist()
