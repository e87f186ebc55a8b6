"""Exact substring dedup: Rabin-Karp hashes of every fixed-length word window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import (
    NOT_BLANK,
    from_planes,
    hash_words,
    pack,
    planes,
    scan_words,
    text_bytes,
    unpack,
    window_hashes,
)

WIDTH = 13
#: Text of a block, the unit that is hashed at once, and of a hash range.
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20
#: Stands for a null id: after all others.
LAST = np.iinfo(np.int64).max


class _Block:
    """Words and windows of a block's documents, in the order of their ids."""

    def __init__(self, rows: pa.Table, width: int):
        ids = rows.column("id").combine_chunks().fill_null(LAST).to_numpy()
        order = np.argsort(ids, kind="stable")
        rows, self.ids = rows.take(pa.array(order)), ids[order]
        self.key = rows.column("id")
        self.data, self.offsets = text_bytes(rows.column("body"))
        self.words = scan_words(self.data, self.offsets, NOT_BLANK)
        hashes = window_hashes(hash_words(self.data, self.words), width)
        first = self.words.first
        n_windows = np.maximum(np.diff(first) - width + 1, 0)
        self.doc = np.repeat(np.arange(len(n_windows)), n_windows)  # of each window
        ahead = np.cumsum(n_windows) - n_windows
        self.at = first[:-1][self.doc] + np.arange(len(self.doc)) - ahead[self.doc]  # its first word
        self.hash = hashes[self.at] if len(self.at) else np.zeros(0, np.uint64)


def _range_of(hashes: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n_ranges)) >> np.uint64(32)


def _emit(width: int, n_ranges: int):
    def emit(key: tuple, rows: pa.Table) -> pa.Table:
        b = _Block(rows, width)
        distinct, at = np.unique(b.hash, return_index=True)  # stable: the first is of the smallest id
        doc = b.doc[at]
        cuts = np.searchsorted(_range_of(distinct, n_ranges), np.arange(n_ranges + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cuts))
        out = []
        for r in used:
            part = slice(cuts[r], cuts[r + 1])
            some, index = np.unique(doc[part], return_inverse=True)
            out.append((int(r), pack(distinct[part]), planes(index, np.uint32), b.ids[some].astype("<i8").tobytes()))
        ranges, hashes, index, ids = zip(*out) if out else ((), (), (), ())
        return pa.table(
            {
                "range": pa.array(ranges, pa.int32()),
                "block": pa.array([key[0].as_py()] * len(out), pa.int64()),
                "hashes": pa.array(hashes, pa.binary()),
                "doc": pa.array(index, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    return emit


def _repeated(rows: pa.Table) -> pa.Table:
    """For each block, the hashes of this range that start in a smaller id of another block."""
    hashes = [unpack(x) for x in rows.column("hashes").to_pylist()]
    n = np.array([len(x) for x in hashes])
    ids = [
        np.frombuffer(i, "<i8")[from_planes(d, np.uint32)]
        for d, i in zip(rows.column("doc").to_pylist(), rows.column("ids").to_pylist(), strict=True)
    ]
    h, ids = np.concatenate(hashes), np.concatenate(ids)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    del hashes
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    h, order = h[twice], order[twice]
    ids, row = ids[order], row[order]
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(h)))) if len(h) else ids
    late = ids > least
    h, row = h[late], row[late]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    cuts = np.searchsorted(row, np.arange(len(n) + 1))
    hit = np.flatnonzero(np.diff(cuts))
    blocks = rows.column("block").to_pylist()
    return pa.table(
        {
            "block": pa.array([blocks[i] for i in hit], pa.int64()),
            "repeated": pa.array([pack(h[cuts[i] : cuts[i + 1]]) for i in hit], pa.binary()),
        }
    )


def _cut(width: int):
    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block(rows, width)
        n_docs = len(b.ids)
        known = [unpack(x) for x in found.column("repeated").to_pylist()]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        # a window repeats if another block has it with a smaller id, or this one has
        distinct, at, inverse = np.unique(b.hash, return_index=True, return_inverse=True)
        where = np.searchsorted(known, distinct)
        outside = np.zeros(len(distinct), bool)
        ok = where < len(known)
        outside[ok] = known[where[ok]] == distinct[ok]
        flag = outside[inverse] | (b.ids[b.doc] > b.ids[b.doc[at]][inverse])
        step = np.zeros(len(b.words.start) + width + 1, np.int32)
        np.add.at(step, b.at[flag], 1)
        np.add.at(step, b.at[flag] + width, -1)
        gone = np.cumsum(step)[: len(b.words.start)] > 0
        counted = np.concatenate(([0], np.cumsum(gone)))
        first = b.words.first
        # maximal runs of removed words; windows do not cross documents, runs are cut there
        edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
        begin, end = edge[:-1] == 1, edge[1:] == -1
        inner = first[(first > 0) & (first < len(gone))]
        begin[inner] |= gone[inner]
        end[inner - 1] |= gone[inner - 1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        spans = np.searchsorted(begin, first)
        own = np.repeat(first[:-1], np.diff(spans))
        # the kept words, each with one space in place of the byte after it
        keep = ~gone
        kept = np.zeros(len(b.data) + 2, np.int8)
        kept[b.words.start[keep]] += 1
        np.add.at(kept, b.words.end[keep] + 1, -1)
        limit = np.repeat(b.offsets[1:], np.diff(first))
        at_end = keep & (b.words.end == limit)  # no byte after it in this document
        np.add.at(kept, b.words.end[at_end], -1)
        np.add.at(kept, b.words.end[at_end] + 1, 1)
        mask = np.cumsum(kept, dtype=np.int8)[: len(b.data)] > 0
        spaced = b.data.copy()
        spaced[b.words.end[keep & ~at_end]] = 32
        size = np.concatenate(([0], np.cumsum(mask)))[b.offsets]
        flat = spaced[mask].tobytes()
        texts = [flat[size[i] : size[i + 1]].rstrip(b" ") for i in range(n_docs)]
        pairs = pa.StructArray.from_arrays(
            [pa.array(begin - own, pa.int64()), pa.array(end - own, pa.int64())], names=["start", "end"]
        )
        return pa.table(
            {
                "id": b.key.cast(pa.int64()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(counted[first[1:]] - counted[first[:-1]], pa.int64()),
                "removed": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pairs),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    return cut


def remove_repeated_windows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Cut every word that lies in a window of ``width`` words found in a document of smaller key.

    Returns (key, n_words, n_removed, removed, kept_text): ``removed`` lists the
    maximal removed word intervals [start, end), ``kept_text`` the other words
    joined by one space. Windows are judged on the input.

    Texts move once, into blocks of about ``block_bytes``. Each block sends the
    distinct window hashes it holds, packed by hash range; a range answers each
    block with those that a smaller key of another block has. So a window in
    very many documents costs an entry a block, not a document, and no key or
    group meets in one task. ``block_bytes`` and ``range_bytes`` bound a task's
    memory; on large executors larger blocks give fewer, fuller rows.

    Windows are told apart by 64-bit hashes: of n windows, one is taken for
    another with a probability of about n / 2**64.

    A null text has no words. A null key comes after all others. Rows of equal
    key do not cut each other. Fewer than ``width`` words: nothing is cut.
    Extra columns are not read; an empty table gives an empty result.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_blocks, n_ranges = (max(1, -(-int(total) // size)) for size in (block_bytes, range_bytes))
    blocks = docs.select(
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(n_blocks)).alias("block"),
        F.col(key).cast("long").alias("id"),
        F.col(text).alias("body"),
    )
    found = (
        blocks.groupBy("block")
        .applyInArrow(_emit(width, n_ranges), "range int, block long, hashes binary, doc binary, ids binary")
        .groupBy("range")
        .applyInArrow(_repeated, "block long, repeated binary")
    )
    kind = docs.schema[key].dataType
    return (
        blocks.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(
            _cut(width),
            "id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept_text string",
        )
        .select(F.col("id").cast(kind).alias(key), "n_words", "n_removed", "removed", "kept_text")
    )
