"""WARC archives compressed with Zstandard: a dictionary in the leading skippable frame, then a frame for each record.

Writing: a task streams its rows into archives of about ``archive_bytes`` of payload in the shared folder; a file gets
its name only when complete, and only files named in the stored manifest are read.  The dictionary is trained on a
bounded number of the archive's first payloads.  Of records with equal payloads of at least ``least`` bytes, that with the
smallest id is a response and the others revisit it without a body; equal ids of equal payloads are all responses.

Reading: the dictionary is loaded from the skippable frame (plain or itself compressed), each further frame is decoded
by itself, its record's version line, named fields and lengths are checked, a response's body must have the digest that
its header states, and what a revisit refers to must be a response with its digest.  A broken archive raises ArchiveError
(a revisit of nothing an error of the job); nothing is skipped.

A null payload is empty.  Payloads of any length are one frame.  Tables without rows give no archives.  Ids are numbers or
strings; a null id is written as ``none`` and read back as null.  Rows that are repeated give a record each; where their
payload is one that others revisit, all of them are responses.  Other columns, also those named like the ones made here,
are not looked at.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import files, new_folder, put, stored

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
ARCHIVE_BYTES = 32 << 20
ARCHIVE_RECORDS = 20_000
DICTIONARY_BYTES = 64 << 10
#: Payloads, and bytes of each, that a dictionary is trained on.
SAMPLES, SAMPLE_BYTES = 256, 4096

_INDEX = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string"
#: Fields that a head has once.
_SINGLE = frozenset("warc-type warc-record-id warc-date content-length warc-payload-digest warc-refers-to warc-target-uri".split())
_NUMBER = re.compile("[0-9]{1,18}")


class ArchiveError(ValueError):
    """The bytes aren't the archive that they should be."""


def _urn(page_id: int | str | None) -> str:
    """Numbers as they are; strings quoted, behind ``s-``."""
    return f"<urn:page:{'none' if page_id is None else page_id if isinstance(page_id, int) else 's-' + quote(page_id, safe='')}>"


def record(page_id: int | str | None, url: str | None, kind: str, payload: bytes, digest: str, n_bytes: int, refers_to: int | str | None) -> bytes:
    """A response or revisit record; the block is an HTTP head, with the payload in a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", " ").replace("\n", " "))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a head, names in lower case; values of a repeated name are joined by commas."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip() or not name.isascii():
            raise ArchiveError(f"not a named field: {line[:80]!r}")
        key = name.decode("ascii").lower()
        if key in out and key in _SINGLE:
            raise ArchiveError(f"{key} is repeated")
        try:
            text = value.strip().decode()
        except UnicodeDecodeError as e:
            raise ArchiveError(f"{key} isn't UTF-8") from e
        out[key] = f"{out[key]}, {text}" if key in out else text
    return out


def _length(named: dict[str, str]) -> int:
    value = named.get("content-length", "")
    if not _NUMBER.fullmatch(value):
        raise ArchiveError(f"not a length: {value!r}")
    return int(value)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record that fills a whole frame."""
    version, eol, rest = data.partition(b"\r\n")
    if not eol or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ArchiveError(f"not a version line: {version[:40]!r}")
    head, end, body = rest.partition(b"\r\n\r\n")
    if not end:
        raise ArchiveError("the head has no end")
    named = fields(head)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in named:
            raise ArchiveError(f"no {name}")
    n = _length(named)
    if len(body) != n + 4 or body[n:] != b"\r\n\r\n":
        raise ArchiveError(f"the block has {len(body) - 4} bytes, its head says {n}")
    return named, body[:n]


def make_dictionary(samples: list[bytes]) -> bytes:
    """Trained where there are enough samples, else the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1"


class ArchiveWriter:
    def __init__(self, out, dictionary: bytes, level: int = 3):
        packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        self.out = out
        self.packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)

    def add(self, data: bytes) -> None:
        self.out.write(self.packer.compress(data))


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ArchiveError("the archive ends within a frame's head")
    return data


def records(stream, piece: int = 64 << 10) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time."""
    first = stream.read(4)
    if not first:
        return
    (magic,) = struct.unpack("<I", first.ljust(4, b"\0"))
    dictionary, rest = None, first
    if magic == DICTIONARY_MAGIC:
        (size,) = struct.unpack("<I", _exactly(stream, 4))
        content = _exactly(stream, size)
        if content[:4] == struct.pack("<I", ZSTD_MAGIC):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary, rest = zstandard.ZstdCompressionDict(content), b""
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while rest := rest or stream.read(piece):
        while len(rest) < 8 and (more := stream.read(piece)):
            rest += more
        (magic,) = struct.unpack("<I", rest[:4].ljust(4, b"\0"))
        if 0x184D2A50 <= magic <= 0x184D2A5F:  # another skippable frame
            (size,) = struct.unpack("<I", rest[4:8].ljust(4, b"\0"))
            rest = rest[8:] if len(rest) >= 8 + size else rest[8:] + _exactly(stream, 8 + size - len(rest))
            rest = rest[size:]
            continue
        if magic != ZSTD_MAGIC:
            raise ArchiveError(f"not a frame: {rest[:4]!r}")
        frame, parts = unpacker.decompressobj(), []
        try:
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    break
                rest = stream.read(piece)
                if not rest:
                    raise ArchiveError("the archive ends within a frame")
        except zstandard.ZstdError as e:
            raise ArchiveError(str(e)) from e
        rest = frame.unused_data
        yield b"".join(parts)


def _id(urn: str | None) -> int | str | None:
    if urn is None or urn == "<urn:page:none>":
        return None
    name = urn[10:-1]
    if not (urn.startswith("<urn:page:") and urn.endswith(">")) or not (name.startswith("s-") or re.fullmatch("-?[0-9]+", name)):
        raise ArchiveError(f"not a record id of ours: {urn}")
    return unquote(name[2:]) if name.startswith("s-") else int(name)


def read_record(data: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of a record, after all checks."""
    named, block = parse_record(data)
    kind, digest = named["warc-type"], named.get("warc-payload-digest", "")
    http, end, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if kind not in ("response", "revisit") or not end or not status.startswith(b"HTTP/1.") or not digest.startswith("sha256:"):
        raise ArchiveError(f"not a response or revisit: {kind}")
    n = _length(fields(lines))
    if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest[7:]):
        raise ArchiveError("the payload isn't the one that the head describes")
    if kind == "revisit" and (payload or "warc-refers-to" not in named):
        raise ArchiveError("a revisit has a payload, or refers to nothing")
    return _id(named["warc-record-id"]), n, digest[7:], kind, _id(named.get("warc-refers-to")), named.get("warc-target-uri")


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, held, size = TaskContext.get(), 0, [], 0

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst"

            def write(out) -> None:
                # The first payloads stand for the rest, whatever their order.
                dictionary = make_dictionary([r[3][:SAMPLE_BYTES] for r in held[:SAMPLES] if r[3]])
                archive = ArchiveWriter(out, dictionary)
                for r in held:
                    archive.add(record(*r))

            put(uri, write)
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(held)], pa.int64())], names=["uri", "n_records"])

        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in ("page_id", "url", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to")], strict=True):
                row = (*row[:3], row[3] if row[2] == "response" else b"", *row[4:])
                held.append(row)
                size += len(row[3])
                if size >= archive_bytes or len(held) >= ARCHIVE_RECORDS:
                    yield flush()
                    made, held, size = made + 1, [], 0
        if held:
            yield flush()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    name = lambda x: None if x is None else str(x)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for uri, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, path = files(uri)
            rows, seen = [], 0
            with fs.open_input_stream(path, compression=None) as stream:
                for data in records(stream):
                    page, *rest, refers_to, url = read_record(data)
                    rows.append((name(page), *rest, name(refers_to), url))
                    seen += 1
                    if len(rows) == 2000:
                        yield batch_of(rows)
                        rows = []
            if seen != n:
                raise ArchiveError(f"{uri} has {seen} records, {n} were written")
            if rows:
                yield batch_of(rows)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 100, archive_bytes: int = ARCHIVE_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record per page; the manifest: uri and n_records of each archive."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    first = first.where("n > 1").drop("n")
    marked = rows.join(first, "payload_digest", "left")
    revisit = F.coalesce(F.col("page_id") > F.col("first_id"), F.col("page_id").isNull() & F.col("first_id").isNotNull())
    marked = marked.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first_id"))})
    return stored(marked.drop("first_id").mapInArrow(_write(folder, archive_bytes), "uri string, n_records bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record of the archives that the manifest names; ids as the type that they had."""
    tasks = max(1, 2 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = stored(manifest.select("uri", "n_records").repartition(tasks).mapInArrow(_read, _INDEX), "warc-index")
    known = index.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.lit(True).alias("_known")).where("refers_to is not null").distinct()
    revisits = index.where("record_type = 'revisit'").join(known, ["refers_to", "payload_digest"], "left")
    checked = F.when(F.col("_known"), F.col("refers_to")).otherwise(F.raise_error(F.concat(F.lit("no response with the digest of the revisit "), F.coalesce("page_id", F.lit("none")))).cast("string"))
    out = index.where("record_type <> 'revisit'").unionByName(revisits.withColumn("refers_to", checked).drop("_known"))
    return out.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_bytes_of(rows: list[tuple]) -> bytes:
    """An archive in memory, for tests and small tables."""
    out = io.BytesIO()
    archive = ArchiveWriter(out, make_dictionary([r[3][:SAMPLE_BYTES] for r in rows[:SAMPLES] if r[3]]))
    for r in rows:
        archive.add(record(*r))
    return out.getvalue()
