"""Rendezvous (highest random weight) hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playback_qos.llm.common import written

#: Hex digits of the key's digest that cut a shard into numbering buckets.
BUCKET_DIGITS = 2
#: Equal rows that are dealt out together.
RUN = 10_000


def _digest(key: Column, shard: Column) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), shard.cast("string")))


def _best(key: Column, shards: Column, weights: Sequence[float] | None) -> Column:
    """The (score, shard) of the shard that wins the key.

    Equal weights compare the digests themselves. Otherwise the first 52 bits
    are read as a uniform number u, and the score is ``-weight / ln(u)``, under
    which a shard wins in proportion to its weight.
    """
    if weights is None:
        return F.array_max(F.transform(shards, lambda s: F.struct(_digest(key, s).alias("score"), s.alias("shard"))))
    share = F.array(*[F.lit(float(w)) for w in weights])

    def scored(s: Column) -> Column:
        u = (F.conv(F.substring(_digest(key, s), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
        return F.struct((-F.get(share, s) / F.log(u)).alias("score"), s.alias("shard"))

    return F.array_max(F.transform(shards, scored))


def rendezvous(key: Column, shards: int | Sequence[float]) -> Column:
    """Shard of ``key``: an int of equal shards, or a weight for each shard.

    Only the key and the shards decide. A shard added at the end, or a greater
    weight, takes keys into that shard and moves no other.
    A null key counts as one key of its own.
    """
    weights = None if isinstance(shards, int) else list(shards)
    n = shards if weights is None else len(weights)
    if n < 1 or (weights and min(weights) <= 0):
        raise ValueError("shards need a positive count and positive weights")
    return _best(key, F.sequence(F.lit(0), F.lit(n - 1)), weights)["shard"]


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, gapless slot within the shard, and the shard after growth by one.

    Returns (key, size, text_crc32, shard, slot, grown_shard); no text moves.
    Slots follow (digest bucket of the key, key, size, crc), so rows that are
    equal in all of these may swap slots, with the same result. They are one
    row with a count until the slots are dealt out.
    A null text has the size of its 16 bytes of overhead and the crc of no
    bytes; a null key is a key; extra columns of ``docs`` are not read. The
    different rows are cut into ranges of that order, as many as the session
    has shuffle partitions; each is numbered by a task of its own, so a hot
    key is spread by its sizes and crcs, and a hot row is one row.
    """
    old = _best(F.col(key), F.sequence(F.lit(0), F.lit(shards - 1)), None)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        old.alias("old"),
        _digest(F.col(key), F.lit(shards)).alias("extra"),
        F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, BUCKET_DIGITS).alias("bucket"),
    ).select(
        "key",
        "size",
        "text_crc32",
        F.col("old.shard").alias("shard"),
        F.when(F.col("extra") > F.col("old.score"), F.lit(shards)).otherwise(F.col("old.shard")).alias("grown_shard"),
        "bucket",
    )
    order = ["shard", "bucket", "key", "size", "text_crc32"]
    different = rows.groupBy(*order, "grown_shard").agg(F.count("*").alias("n"))
    ranged = written(different.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("shard", "part").agg(F.sum("n").alias("n"))  # a row a range, and one more a shard
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce("own", F.lit(0))
    runs = (
        ranged.withColumn("own", F.sum("n").over(within))
        .join(F.broadcast(offsets), ["shard", "part"])
        .withColumn("last", start + F.col("n") - 1)
        .withColumn("slot", F.explode(F.sequence(start, "last", F.lit(RUN).cast("long"))))
    )
    runs = runs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "slot")  # a count: not coalesced
    slots = F.explode(F.sequence(F.col("slot"), F.least(F.col("slot") + RUN - 1, "last")))
    return runs.withColumn("slot", slots).select(
        F.col("key").alias(key), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
