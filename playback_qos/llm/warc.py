"""WARC archives in Zstandard: one frame a record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import scratch_dir, written

# Fixed values of the public formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: An archive ends after so many compressed bytes.
ARCHIVE_BYTES = 8 << 20
#: The dictionary of an archive, and the payload bytes at its start that it is trained on.
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20
#: Bytes given to the decoder at once; at most so many are read beyond a frame's end.
READ_BYTES = 16 << 10


class WarcError(ValueError):
    """A record or archive that breaks the format."""


# --- writing -------------------------------------------------------------------------------


def _header_safe(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """The bytes of one record; a revisit has the HTTP header of its page, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_safe(url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary trained on the first payloads, or none if they are too few to train on."""
    sample, size = [], 0
    for x in payloads:
        if size >= SAMPLE_BYTES:
            break
        sample.append(x[: SAMPLE_BYTES // 8])
        size += len(sample[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [x for x in sample if len(x) >= 8], k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class _Archive:
    def __init__(self, folder: str, name: str, payloads: list[bytes]):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        self.path, self.n, self.size = f"{folder}/{name}", 0, 0
        self.out = fs.open_output_stream(f"{root}/{name}", compression=None)
        raw = _dictionary(payloads)
        self.frames = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_checksum=True
        )
        if raw:
            self._write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.size += len(raw)

    def add(self, raw: bytes) -> None:
        self._write(self.frames.compress(raw))
        self.n += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.n, self.size


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for each row to ``folder``/*.warc.zst; returns (path, n_records, n_bytes) of the archives.

    Among records of equal payload (of 100 bytes or more) that with the least
    key is a response, the others are revisits of it; shorter ones are all
    responses. A null payload is empty. A null key gets a record without a
    number, which no other refers to. Rows that repeat the least key are
    responses too. Extra columns are not read.

    Each task writes its own archives, named by its attempt; the returned table
    lists those of the attempts that Spark accepted, and only these are read.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"), F.sha2(body, 256).alias("digest"))
    firsts = written(
        rows.filter(F.octet_length("body") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    marked = rows.join(firsts, "digest", "left").select(
        F.col("key").cast("string"),
        "url",
        "body",
        "digest",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, done = TaskContext.get(), None, []
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "body", "digest", "refers_to")]
            for i in range(batch.num_rows):
                k, u, b, d, r = (c[i].as_py() for c in columns)
                if archive is None:
                    ahead = columns[2].slice(i, 256)
                    archive = _Archive(folder, f"{stem}-{len(done):05d}.warc.zst", [x.as_py() for x in ahead])
                archive.add(record(k, u, b, d, r, date))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "n_records": n, "n_bytes": s} for p, n, s in done],
            pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]),
        )

    return written(marked.mapInArrow(write, "path string, n_records long, n_bytes long"))


# --- reading -------------------------------------------------------------------------------


def frames(stream) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time, read forward only."""
    buffer = stream.read(READ_BYTES)
    dictionary = None
    first = True
    while buffer:
        while len(buffer) < 8 and (more := stream.read(READ_BYTES)):
            buffer += more
        if len(buffer) < 8:
            raise WarcError("the archive ends within a frame's header")
        magic, size = struct.unpack_from("<II", buffer)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            while len(buffer) < 8 + size:
                if not (more := stream.read(max(READ_BYTES, 8 + size - len(buffer)))):
                    raise WarcError("the archive ends within a skippable frame")
                buffer += more
            raw, buffer = buffer[8 : 8 + size], buffer[8 + size :]
            if magic == DICTIONARY_FRAME and first:
                if raw[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
                    raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
                dictionary = zstandard.ZstdCompressionDict(raw)
        elif magic == FRAME:
            decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            out = []
            try:
                while not decoder.eof:
                    if not buffer and not (buffer := stream.read(READ_BYTES)):
                        raise WarcError("the archive ends within a frame")
                    out.append(decoder.decompress(buffer))
                    buffer = decoder.unused_data if decoder.eof else b""
            except zstandard.ZstdError as e:
                raise WarcError(f"a damaged frame: {e}") from e
            yield b"".join(out)
        else:
            raise WarcError(f"no frame begins with {magic:#x}")
        first = False
        if not buffer:
            buffer = stream.read(READ_BYTES)


def _fields(head: bytes, what: str) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "strict").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"a bad {what} header line: {line[:80]!r}")
        fields[name.lower()] = value.strip()
    return first, fields


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"a bad {what} Content-Length: {value[:40]!r}")
    return int(value)


def _number(value: str, what: str) -> int | None:
    if not (value.startswith(f"<{ID_PREFIX}") and value.endswith(">")):
        raise WarcError(f"a bad {what}: {value[:80]!r}")
    digits = value[len(ID_PREFIX) + 1 : -1]
    return int(digits) if digits else None


def parse(raw: bytes) -> dict:
    """One record's fields, with headers, lengths and the payload's digest checked."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    if not blank:
        raise WarcError("a record without the end of its header")
    version, fields = _fields(head, "WARC")
    if version.encode() != VERSION:
        raise WarcError(f"no WARC version line: {version[:40]!r}")
    if missing := [x for x in MANDATORY if x not in fields]:
        raise WarcError(f"missing headers: {missing}")
    size = _length(fields, "record")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"the block has {len(rest) - 4} bytes, its header says {size}")
    http_head, blank, payload = rest[:size].partition(b"\r\n\r\n")
    if not blank:
        raise WarcError("an HTTP block without the end of its header")
    _, http = _fields(http_head, "HTTP")
    length = _length(http, "HTTP")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    if not digest.startswith("sha256:"):
        raise WarcError(f"no SHA-256 payload digest: {digest[:80]!r}")
    out = {"page_id": _number(fields["warc-record-id"], "record id"), "url": fields.get("warc-target-uri"),
           "record_type": kind, "payload_bytes": length, "payload_digest": digest[7:], "refers_to": None, "payload": None}
    if kind == "response":
        if len(payload) != length:
            raise WarcError(f"the payload has {len(payload)} bytes, its header says {length}")
        if hashlib.sha256(payload).hexdigest() != digest[7:]:
            raise WarcError("the payload does not match its digest")
        out["payload"] = payload
    elif kind == "revisit":
        if payload:
            raise WarcError("a revisit with a payload")
        out["refers_to"] = _number(fields.get("warc-refers-to", ""), "WARC-Refers-To")
    else:
        raise WarcError(f"an unknown record type: {kind[:40]!r}")
    return out


RECORD_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary, error string"
)


def read_archives(archives: DataFrame, on_error: str = "raise") -> DataFrame:
    """The records of the archives in column ``path``, streamed frame by frame.

    A record that breaks the format raises; with ``on_error='keep'`` it becomes
    a row with only ``error``, and after a damaged frame the rest of that
    archive is one such row. An archive without frames has no rows.
    """
    if on_error not in ("raise", "keep"):
        raise ValueError("on_error is 'raise' or 'keep'")
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD_SCHEMA.split(", ")])

    def rows_of(path: str) -> Iterator[dict]:
        fs, inner = pafs.FileSystem.from_uri(path)
        with fs.open_input_stream(inner, compression=None, buffer_size=1 << 20) as stream:
            try:
                for raw in frames(stream):
                    try:
                        yield parse(raw)
                    except (WarcError, UnicodeDecodeError) as e:
                        if on_error == "raise":
                            raise
                        yield {"error": str(e)}
            except WarcError as e:
                if on_error == "raise":
                    raise WarcError(f"{path}: {e}") from e
                yield {"error": str(e)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 500
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)

    n = archives.count()
    return archives.select("path").repartition(max(1, min(n, 10_000)), "path").mapInArrow(read, RECORD_SCHEMA)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in a scratch folder and read the records back."""
    return read_archives(write_archives(pages, scratch_dir(pages.sparkSession)))
