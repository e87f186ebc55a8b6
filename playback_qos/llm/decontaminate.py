"""Benchmark decontamination on a positional inverted index of the training texts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import (
    ALNUM_LOWER,
    TO_LOWER,
    from_planes,
    hash_words,
    lean,
    planes,
    scan_words,
    text_bytes,
    written,
)

WIDTH = 13
#: Unused positions between the documents of a shard; a match, with its slop, cannot bridge them.
GAP = 64
#: Text of a shard of the index.
SHARD_BYTES = 4 << 20
#: Test text that is searched (and broadcast) at once; more is searched in several rounds.
QUERY_BYTES = 8 << 20


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the lower-cased texts, and the first word of each row."""
    data, offsets = text_bytes(column)
    data = TO_LOWER[data]
    words = scan_words(data, offsets, ALNUM_LOWER)
    return hash_words(data, words), words.first


# --- the index ----------------------------------------------------------------------------


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", terms: np.ndarray | None = None) -> DataFrame:
    """Positional postings of the texts, sharded by document.

    Rows (shard, term, n, postings, keys, sizes): for each term of a shard its
    ascending positions (differences, in byte planes); and one row without a
    term that lists the shard's documents and their numbers of words. Words
    are numbered through the shard, with GAP unused positions after each
    document. ``terms`` (sorted hashes) keeps the postings of these only.
    Nothing is shuffled: a shard is made of rows that are read together.
    """
    schema = pa.schema(
        [("shard", pa.int64()), ("term", pa.int64()), ("n", pa.int64()), ("postings", pa.binary())]
    )
    wanted = docs.sparkSession.sparkContext.broadcast(terms) if terms is not None else None

    def shard_rows(shard: int, batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
        hashes, first = _words(batch.column("text"))
        sizes = np.diff(first)
        position = (np.arange(len(hashes)) + GAP * np.repeat(np.arange(len(sizes)), sizes)).astype(np.uint32)
        if wanted is not None:
            keep = _member(wanted.value, hashes)
            hashes, position = hashes[keep], position[keep]
        order = np.argsort(hashes, kind="stable")
        hashes, position = hashes[order], position[order]
        at = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, int)
        ends = np.append(at, len(hashes))[1:]
        step = np.diff(position, prepend=np.uint32(0))
        step[at] = position[at]
        postings = [planes(step[a:b], np.uint32) for a, b in zip(at, ends, strict=True)]
        n = len(at)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, shard)),
                pa.array([None, *hashes[at].view(np.int64).tolist()], pa.int64()),
                pa.array([batch.num_rows, *(ends - at).tolist()], pa.int64()),
                pa.array([None, *postings], pa.binary()),
                pa.array([batch.column("key").to_pylist(), *[None] * n], schema.field("keys").type),
                pa.array([sizes.tolist(), *[None] * n], schema.field("sizes").type),
            ],
            schema=schema,
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for whole in batches:
            full = schema.append(pa.field("keys", pa.list_(whole.column("key").type)))
            full = full.append(pa.field("sizes", pa.list_(pa.int64())))
            for part in _parts(whole):
                yield shard_rows(shard, part, full)
                shard += 1

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        lean(index), f"shard long, term long, n long, postings binary, keys array<{kind}>, sizes array<long>"
    )


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about SHARD_BYTES of text; a longer text is a slice of its own."""
    _, offsets = text_bytes(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _member(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return table[at] == keys


# --- phrases ------------------------------------------------------------------------------


class Phrases(NamedTuple):
    terms: np.ndarray  #: sorted hashes of all terms
    word: np.ndarray  #: a row for each different phrase: places in ``terms``, -1 beyond its end
    length: np.ndarray
    items: list[list[str]]  #: of each phrase


def phrases(items: pa.Table, width: int = WIDTH) -> Phrases:
    """All windows of ``width`` words of the items (id, text); a shorter item is one phrase."""
    hashes, first = _words(items.column("text"))
    found: dict[tuple[int, ...], set[str]] = {}
    for k, name in enumerate(items.column("id").to_pylist()):
        words = tuple(hashes[first[k] : first[k + 1]].tolist())
        for i in range(max(1, len(words) - width + 1) if words else 0):
            found.setdefault(words[i : i + width], set()).add(str(name))
    terms = np.unique(hashes)
    word = np.full((len(found), width), -1, np.int64)
    for k, x in enumerate(found):
        word[k, : len(x)] = np.searchsorted(terms, np.array(x, np.uint64))
    return Phrases(terms, word, (word >= 0).sum(axis=1), [sorted(x) for x in found.values()])


def _intersect(starts: np.ndarray, positions: np.ndarray, offset: int, slop: int) -> np.ndarray:
    """The starts that have a position within ``slop`` of ``offset`` words further."""
    want = starts + offset
    at = np.searchsorted(positions, want - slop)
    inside = at < len(positions)
    near = positions[np.minimum(at, len(positions) - 1)]
    return starts[inside & (near <= want + slop)]


def _search(table: pa.Table, query: Phrases, rank: np.ndarray, slop: int) -> pa.Table:
    """Matches in one shard: for each document, its number of words, hit words and items."""
    term = table.column("term").to_pylist()
    postings = {}
    for k, t in enumerate(term):
        if t is None:
            keys = table.column("keys")[k].values
            sizes = np.array(table.column("sizes")[k].as_py(), np.int64)
        else:
            postings[t & (2**64 - 1)] = k
    starts = np.cumsum(sizes + GAP) - sizes - GAP
    column = table.column("postings")
    have = np.array([t in postings for t in query.terms.tolist()] + [True], bool)  # the last for the -1s
    lists: dict[int, np.ndarray] = {}

    def positions(place: int) -> np.ndarray:
        if place not in lists:
            raw = column[postings[int(query.terms[place])]].as_py()
            lists[place] = np.cumsum(from_planes(raw, np.uint32), dtype=np.int64)
        return lists[place]

    cover = np.zeros(int(starts[-1] + sizes[-1]) + GAP + 1 if len(sizes) else 1, np.int32)
    found: list[set[str]] = [set() for _ in sizes]
    hits: list[list[dict]] = [[] for _ in sizes]
    for p in np.flatnonzero(have[query.word].all(axis=1)):
        places = query.word[p, : query.length[p]]
        order = np.argsort(rank[places], kind="stable")  # the rarest term first
        at = positions(places[order[0]]) - order[0]
        for o in order[1:]:
            if not len(at):
                break
            at = _intersect(at, positions(places[o]), int(o), slop)
        if slop and len(at):  # the anchor may stand so near an end that the phrase begins outside
            at = np.unique(np.maximum(at, 0))
        if len(at):
            np.add.at(cover, at, 1)
            np.add.at(cover, np.minimum(at + len(places), len(cover) - 1), -1)
            for d, s in zip(np.searchsorted(starts, at, "right") - 1, at, strict=True):
                found[d].update(query.items[p])
    inside = np.cumsum(cover) > 0
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for d, a, b in zip(np.searchsorted(starts, begin, "right") - 1, begin, end, strict=True):
        hits[d].append({"start": int(a - starts[d]), "end": int(min(b - starts[d], sizes[d]))})
    n = len(sizes)
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()] * n, pa.int64()),
            "place": pa.array(range(n), pa.int64()),
            "key": keys,
            "n_words": pa.array(sizes, pa.int64()),
            "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "items": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
        }
    )


def search(docs: DataFrame, query: Phrases, key: str = "doc_id", text: str = "text", slop: int = 0) -> DataFrame:
    """Exact phrase matches (``slop`` 0), or proximity matches, in every text of ``docs``.

    The postings of the query's terms are stored first. Then each shard
    intersects the offset-adjusted lists of a phrase's terms, from the term
    that is rarest in the whole corpus on; with ``slop`` each further term may
    stand that many words from its place. Returns (shard, place, key, n_words,
    hits, items) for each document, hits being maximal intervals of words.
    """
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be less than {GAP // 2}")
    index = written(build_index(docs, key, text, query.terms))
    counts = index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(query.terms), np.int64)  # a count for each term of the query
    at = np.searchsorted(query.terms, counts.column("term").to_numpy().view(np.uint64))
    total[at] = counts.column("n").to_numpy()
    held = docs.sparkSession.sparkContext.broadcast((query, total))
    kind = docs.schema[key].dataType.simpleString()
    return index.groupBy("shard").applyInArrow(
        lambda table: _search(table, *held.value, slop),
        f"shard long, place long, key {kind}, n_words long, hits array<struct<start: long, end: long>>, items array<string>",
    )


def _covered(hits: Column) -> Column:
    """Words in the union of [start, end) intervals."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        F.array_sort(hits),
        zero,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["reach"], x["start"]))).cast("long").alias("n"),
            F.greatest(a["reach"], x["end"]).alias("reach"),
        ),
        lambda a: a["n"],
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """How far each text of ``docs`` consists of passages of the benchmark.

    Returns (key, n_words, n_hit, hits, items, contaminated) for each row:
    the words that lie in an occurrence of a window of an item, the intervals
    they form, and the ids of these items as sorted strings. A document is
    contaminated if a twentieth of its words or more are hit. A null or empty
    text has no words; items without words are never found; repeated rows, of
    either table, give repeated results and count as one item. Extra columns
    are not read. The benchmark is searched ``query_bytes`` of text at a time,
    so what is broadcast is bounded; all rounds see all documents.
    """
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.col(item_text).alias("text"))
    items = items.filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-int(size) // query_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(rounds))
    results = [search(docs, phrases(items.filter(part == i).toArrow(), width), key, text) for i in range(rounds)]
    rows = results[0]
    if rounds > 1:
        for other in results[1:]:
            rows = rows.unionByName(other)
        # the shards of each round hold the same rows, as all read the same splits
        rows = rows.groupBy("shard", "place").agg(
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return rows.withColumn("n_hit", _covered(F.col("hits"))).select(
        F.col("key").alias(key),
        "n_words",
        "n_hit",
        "hits",
        "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
