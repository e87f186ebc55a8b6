"""Helpers shared by the training-data operators: scratch tables and byte-level word scans."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; lets Python workers find this package where it lies."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the one all executors share.

    Only a local session (tests) may do without that setting; it then gets a
    temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a scratch table and return the table.

    Cuts the lineage at a place that survives lost executors, and gives the
    planner the true size, on which it decides about broadcasts.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _give_back() -> None:
    """Return memory that is free in this process to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` with free memory given back before and after each task.

    Python workers outlive their tasks, and an executor has one a core: what
    earlier tasks and dropped broadcasts leave would add to the next one's peak.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def grid(vec: Column, scale: int, limit: int) -> Column:
    """``floor(scale * x)`` of each component as an int, within ``limit`` either way.

    Null for a null vector and for one with a null, NaN or infinite component.
    """
    x = F.transform(vec, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = F.transform(x, lambda c: F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), F.floor(c * scale).cast("double"))).cast("int"))
    return F.when(good, held)


def int_rows(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` integers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(members, dtype=np.uint8)] = True
    return out


#: Bytes of words between ASCII white space, ``[^\x20\x09-\x0D]+``.
NOT_BLANK = ~byte_set(b" \t\n\x0b\x0c\r")
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all beyond ASCII.
ALNUM_LOWER = byte_set(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
#: Lower-cases A-Z and nothing else.
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[0x41:0x5B] += 32


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, and the offset of each row (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.string())
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Words(NamedTuple):
    start: np.ndarray  #: byte position of each word
    end: np.ndarray
    first: np.ndarray  #: rows + 1 entries: index of each row's first word


def scan_words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> Words:
    """Maximal runs of ``members`` bytes; no run crosses a row."""
    if not len(data):
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    inside = members[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    begins = edge[:-1] & inside
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:-1] = edge[1:-1] & inside[:-1]
    ends[-1] = inside[-1]
    cut = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[cut] = inside[cut]
    inner = cut[cut > 0]
    ends[inner] |= inside[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Words(start, end, np.searchsorted(start, offsets))


_RNG = np.random.Generator(np.random.PCG64(20240607))
_LETTER = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C17  # odd, 3 modulo 4
_PIECE = 1 << 18
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64, for i < n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = tuple(
                np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, b, np.uint64))))
                for b in (np.uint64(base), np.uint64(pow(base, -1, 2**64)))
            )
        _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """64-bit hash of each word: differences of a running polynomial sum, piece by piece."""
    out = np.empty(len(words.start), np.uint64)
    i = 0
    while i < len(out):
        begin = words.start[i]
        j = max(i + 1, int(np.searchsorted(words.end, begin + _PIECE, "right")))
        size = int(words.end[j - 1] - begin)
        up, down = powers(_BASE, size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_LETTER[data[begin : begin + size]] * up[:size], out=total[1:])
        a, b = words.start[i:j] - begin, words.end[i:j] - begin
        out[i:j] = (total[b] - total[a]) * down[a]
        i = j
    return mix(out)


def window_hashes(hashes: np.ndarray, width: int, base: int = 0xD6E8FEB86659FD97) -> np.ndarray:
    """Rabin-Karp hash of each run of ``width`` entries (``len - width + 1`` of them).

    The rolling step is taken for all runs at once: the hash of a run is the
    difference of two prefix sums, divided by the base's power at its start.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for i in range(0, n, _PIECE):
        m = min(_PIECE, n - i)
        up, down = powers(base, m + width)
        total = np.zeros(m + width, np.uint64)
        np.cumsum(hashes[i : i + m + width - 1] * up[: m + width - 1], out=total[1:])
        out[i : i + m] = (total[width:] - total[:m]) * down[:m]
    return mix(out)


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as the byte planes of their differences.

    High planes are almost all zero, which Spark's shuffle compression removes.
    """
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def planes(values: np.ndarray, dtype) -> bytes:
    """Integers of any order as byte planes."""
    values = np.ascontiguousarray(values, dtype)
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()
