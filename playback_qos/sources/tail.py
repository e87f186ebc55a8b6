"""Streaming source over growing line files (a Python Data Source).

Spark's file stream reads every file once, so lines appended to a log that it
has seen are lost. Here the offset is a byte position per file: each trigger
reads on from the last full line, in files that grow, are renamed (rotated) or
are replaced by a new file of the same name.
"""

from __future__ import annotations

import fnmatch
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "tail_lines"
#: A log is known again by so many of its first bytes, whatever its name is by then.
HEAD = 256
#: Bytes of one file that a task reads.
SPLIT_BYTES = 64 << 20
_BLOCK = 1 << 20
_SCHEMA = pa.schema([("value", pa.string()), ("log_file", pa.string()), ("log_split", pa.int64()), ("log_line", pa.int64())])


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path below it; a path without a scheme is local."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    """Lines that start in [start, end) of a log; ``limit`` is where its full lines end."""

    name: str
    head: str
    start: int
    end: int
    limit: int
    first: bool  #: ``start`` is known to be the start of a line


class TailReader(DataSourceStreamReader):
    """Offsets are ``{"files": {name: {"at": bytes read, "head": first bytes}}}``.

    What was read of a log is found again by name and first bytes, or, if the
    name has another file now, by the first bytes alone. So an offset depends on
    nothing but the folder and the offset before it, and a replayed batch reads
    the same bytes after a rename too.
    """

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.max_bytes = int(options["maxbytespertrigger"]) if options.get("maxbytespertrigger") else None
        self.fail_on_loss = str(options.get("failondataloss", "true")).lower() != "false"
        self.known: dict = {}

    # --- the folder ---

    def _listed(self) -> dict[str, int]:
        """Names and sizes of the logs (of one log, if the path is a file)."""
        fs, root = open_path(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return {"": info.size}
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return {f.base_name: f.size for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"
                and fnmatch.fnmatch(f.base_name, self.pattern)}

    def _open(self, name: str):
        fs, root = open_path(self.path)
        return fs.open_input_file(f"{root}/{name}" if name else root)

    def _head(self, name: str, size: int) -> str:
        with self._open(name) as f:
            return f.read_at(min(HEAD, size), 0).decode("latin-1")

    def _line_end(self, name: str, low: int, high: int) -> int:
        """End of the last full line in [low, high); ``low`` if there is none."""
        with self._open(name) as f:
            while high > low:
                begin = max(low, high - _BLOCK)
                at = f.read_at(high - begin, begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                high = begin
        return low

    def _next_line_end(self, name: str, low: int, size: int) -> int:
        """End of the first full line from ``low`` on; ``low`` if there is none yet."""
        with self._open(name) as f:
            at = low
            while at < size:
                found = f.read_at(min(_BLOCK, size - at), at).find(b"\n")
                if found >= 0:
                    return at + found + 1
                at += _BLOCK
        return low

    @staticmethod
    def _read_before(name: str, head: str, at: int, before: dict, present: dict) -> int:
        """Bytes of a log (by name and first bytes; ``at`` long) that ``before`` has read.

        ``present`` has the first bytes of every log there is: a log under
        another name is the old one only if its old name does not hold it.
        """

        def same(old: dict) -> bool:
            return old["at"] <= at and head.startswith(old["head"]) and bool(old["head"])

        if name in before and same(before[name]):
            return before[name]["at"]
        moved = [old["at"] for other, old in before.items() if same(old) and not (other in present and present[other].startswith(old["head"]))]
        return max(moved, default=0)

    # --- the interface ---

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        sizes = self._listed()
        heads = {n: self._head(n, s) for n, s in sizes.items()}
        left, files = self.max_bytes, {}
        for name in sorted(sizes):
            size = sizes[name]
            start = self._read_before(name, heads[name], size, self.known, heads)
            end = size if left is None else min(size, start + max(left, 0))
            at = self._line_end(name, start, end)
            if at == start and left is not None and left > 0 and end < size:  # a line longer than what is left
                at = self._next_line_end(name, start, size)
            if left is not None:
                left -= at - start
            if at:
                files[name] = {"at": at, "head": heads[name][:at]}
        self.known = files
        return {"files": files}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, after = start["files"], end["files"]
        self.known = after
        if start == end:
            return []
        heads = {n: f["head"] for n, f in after.items()}
        now = {n: self._head(n, s) for n, s in self._listed().items()}
        out = []
        for name, f in after.items():
            begin = self._read_before(name, f["head"], f["at"], before, heads)
            if begin == f["at"]:
                continue
            here = self._find(name, f["head"], now)
            if here is None:
                if self.fail_on_loss:
                    raise FileNotFoundError(f"log {name!r} below {self.path} is gone before its lines were read")
                continue
            cuts = [*range(begin, f["at"], self.split_bytes), f["at"]]
            out += [Range(here, f["head"], a, b, f["at"], a == begin) for a, b in zip(cuts, cuts[1:])]
        return out

    @staticmethod
    def _find(name: str, head: str, now: dict[str, str]) -> str | None:
        """Where a log with these first bytes is, by its name if it is there still."""
        if name in now and now[name].startswith(head):
            return name
        return next((n for n in sorted(now) if now[n].startswith(head)), None)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """Lines that start in the range; the last one may end beyond it. Holds one block and one line."""
        p = partition
        log = f"{zlib.crc32(p.head.split(chr(10))[0].encode('latin-1')):08x}"
        if self._head(p.name, len(p.head)) != p.head:  # renamed since the batch was planned
            here = self._find("", p.head, {n: self._head(n, s) for n, s in self._listed().items()})
            if here is None:
                raise FileNotFoundError(f"log {p.name!r} below {self.path} has been replaced")
            p = Range(here, p.head, p.start, p.end, p.limit, p.first)
        with self._open(p.name) as f:
            # a range inside a line starts after that line's end
            at = p.start if p.first or f.read_at(1, p.start - 1) == b"\n" else self._skip(f, p)
            kept = b""
            while at < p.end:
                block = f.read_at(min(_BLOCK, p.limit - at - len(kept)), at + len(kept))
                lines = (kept + block).split(b"\n")
                kept = lines.pop()
                starts = []
                for line in lines:
                    starts.append(at)
                    at += len(line) + 1
                n = sum(s < p.end for s in starts)
                if n:
                    value = pa.array([line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines[:n]], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [value, pa.array([log] * n), pa.array([0] * n, pa.int64()), pa.array(starts[:n], pa.int64())], schema=_SCHEMA)
                if not block:
                    break

    @staticmethod
    def _skip(f, p: Range) -> int:
        at = p.start
        while at < p.limit:
            found = f.read_at(min(_BLOCK, p.limit - at), at).find(b"\n")
            if found >= 0:
                return at + found + 1
            at += _BLOCK
        return p.limit


class TailSource(DataSource):
    """``spark.readStream.format("tail_lines").load(folder or file)``.

    Options: ``pattern`` (of names; default ``*``), ``maxBytesPerTrigger`` (new
    bytes of a micro-batch, rounded to full lines), ``splitBytes`` (of a task),
    ``failOnDataLoss`` (default true: a log that went before its lines were read
    ends the query).
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, log_file string, log_split long, log_line long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailReader({k.lower(): v for k, v in self.options.items()})


def tail_lines(
    spark: SparkSession,
    path: str,
    max_bytes_per_trigger: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    pattern: str = "*",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Stream of the full lines of all logs in a folder (or of one log): ``value`` and LOG_POSITION.

    Every line comes once: over triggers, restarts, a last line without its end
    (read when it is complete), renames, and a new log under an old name. A log
    shorter than what was read of it is a new one. ``log_file`` names a log by
    its first line, so it stays the same over renames, and ``log_line`` is the
    byte where the line starts. Names that start with ``.`` or ``_`` are passed
    over. Compressed or copied logs are logs like any other, so name them
    outside ``pattern``. Two logs with the same first 256 bytes are told apart
    by name only, so one of them should not be renamed.

    The driver lists the folder and reads a block or so of each log a trigger;
    lines are read by tasks, ``split_bytes`` of a log each. The offset holds an
    entry a log, so move old logs away. Paths are those that pyarrow opens
    (local or mounted, ``hdfs://``, ``s3://``, ``gs://``). A draining run
    (``available_now``) is one micro-batch whatever ``max_bytes_per_trigger``
    says, so leave that unset there.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format(NAME).option("pattern", pattern).option("splitBytes", str(split_bytes))
    reader = reader.option("failOnDataLoss", str(fail_on_data_loss).lower())
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.load(path)
