"""Near duplicates by SimHash: covering locality-sensitive hashing and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import TO_LOWER, written
from playback_qos.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
#: Fingerprints of a bucket that are compared in one piece; larger buckets are cut into blocks of so many, compared in pairs.
BLOCK = 2048
#: Shingles hashed at once.
PIECE = 1 << 16
#: Buckets up to this size are compared together, those above one by one.
SMALL = 32

_LOWER = TO_LOWER.tobytes()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the words of ``text``: a bit is 1 if set in over half the shingles' XXH64 (0 without a word)."""
    words = (text or "").encode().translate(_LOWER).split()  # of bytes, split() takes ASCII white space only
    n = max(1, len(words) - shingle + 1) if words else 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, PIECE):
        m = min(PIECE, n - i)
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[j : j + shingle]), SEED) for j in range(i, i + m)), np.uint64, m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fingerprint as a signed long) of every row. A null or blank text has fingerprint 0.

    Memory: one batch of texts, and about ten times the longest text for its words.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column("text")), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(found)], ["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(told, f"key {kind}, fingerprint long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """``2**(radius + 1) - 1`` masks; any two values with at most ``radius`` differing bits agree under one of them.

    Bit position i has a non-zero vector m(i) of ``radius + 1`` bits, and the
    mask of v keeps the positions where m(i) and v have an odd number of common
    bits. For any ``radius`` positions some v != 0 is even with all their m(i)
    (fewer equations than unknowns), and its mask leaves all of them out. Every
    mask keeps about half of the positions.
    """
    size = 2 ** (radius + 1)
    vectors = [i % (size - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` that connect all of ``values`` that such links connect: at most ``len - 1``.

    From a start, the values not yet reached are compared with each reached one
    in turn; who is reached once is never compared as a target again.
    """
    a, b = [], []
    left = values
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = _distance(left, at) <= radius
            if near.any():
                a.append(np.full(int(near.sum()), at, np.int64))
                b.append(left[near])
                todo.extend(left[near])
                left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of buckets whose rows follow one another; holds one bucket (two blocks at most) and one batch."""

    def links(bucket: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(bucket)))
        a, b = [], []
        small = np.repeat(size <= SMALL, size)
        v, g = value[small], bucket[small]
        for step in range(1, min(SMALL, len(v))):  # pairs of rows ``step`` apart in the same bucket
            same = g[step:] == g[:-step]
            if not same.any():
                break
            near = same & (_distance(v[step:], v[:-step]) <= radius)
            a.append(v[:-step][near])
            b.append(v[step:][near])
        for i in np.flatnonzero(size > SMALL):
            x, y = spanning_links(value[first[i] : first[i] + size[i]], radius)
            a.append(x)
            b.append(y)
        a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held_bucket, held_value = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        bucket, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "fingerprint"))
        bucket, value = np.concatenate((held_bucket, bucket)), np.concatenate((held_value, value))
        if not len(bucket):
            continue
        cut = int(np.searchsorted(bucket == bucket[-1], True))  # the last bucket may go on; its rows are together
        yield links(bucket[:cut], value[:cut])
        held_bucket, held_value = bucket[cut:], value[cut:]
    yield links(held_bucket, held_value)


def links(values: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) of distinct values in column ``fingerprint``, within ``radius``, that connect whatever such links connect.

    Every value goes into a bucket of each covering mask, so each pair within
    the radius meets in some bucket, where it is compared exactly. Buckets of
    one value end at the count. A bucket beyond ``block`` values is cut into
    blocks by hash, and each pair of blocks is a bucket of its own, so no task
    holds more than two blocks. No pair is left out; pairs that other links
    already connect may be.
    """
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("part")) for t, m in enumerate(masks)])
    rows = values.select("fingerprint", F.explode(tables).alias("at")).select("fingerprint", "at.t", "at.part")
    full = written(rows.groupBy("t", "part").agg(F.count("*").alias("n")).filter("n > 1"))
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("blocks")).cast("int")
    met = (
        rows.join(full, ["t", "part"])
        .withColumn("blocks", n_blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("t", "part", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "fingerprint")
    )
    sorted_ = met.repartition("bucket").sortWithinPartitions("bucket", "fingerprint")
    return sorted_.mapInArrow(lambda batches: _bucket_links(batches, radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """(key, fingerprint, component_id) of every row: 16 hex digits, and the least key that links of ``radius`` bits reach.

    Copies are one value before any bucket is made, and a hot fingerprint is met
    by partial aggregates and a join that adaptive execution can split.
    A null or blank text has fingerprint zero and is linked like any other; a
    null key has a row and a component, but is no component's id unless the
    component has only null keys (then it is null); repeated rows stay; an empty
    table gives no rows. Other columns are not read.
    """
    rows = written(fingerprints(docs, key, text, shingle))
    values = written(rows.groupBy("fingerprint").agg(F.min("key").alias("least")))
    joined = components(links(values.select("fingerprint"), radius, block))
    told = written(values.join(joined, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    roots = written(told.groupBy("root").agg(F.min("least").alias("component_id")))
    named = written(told.join(roots, "root").select("fingerprint", "component_id"))
    return rows.join(named, "fingerprint").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
