"""WARC archives in Zstandard frames, one for each record, after a dictionary in a skippable frame.

Writing: equal payloads are one ``response``, that of the largest id; the others are ``revisit`` records that refer to
it. Digests are taken first, so only ids and digests meet by payload, with counts pre-aggregated; the payloads are then
joined by id, and each task writes one archive: under a name of its own, moved into place when complete, so a task that
runs again does no harm. Archives lie in the shared folder, reached by its URI.

Reading: the dictionary is taken from the leading skippable frame, frames are decoded one by one from a stream, and each
must hold exactly one record with a right version line, the mandatory headers, the stated length and, for responses, the
stated digest. A task holds one record at a time.

Nulls: a null payload is empty, a null url is left out, a null id is written as ``null`` and revisits any equal payload
that has an id. Rows with equal id and payload are alike: both responses or both revisits. An empty table gives no
records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import need, shared_folder, written

#: Fixed values of the formats.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
RECORDS = (
    "archive string, frame long, record_type string, page_id long, url string, date string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long, error string"
)


@dataclass(frozen=True)
class Archive:
    """dictionary_samples: payloads, of at most sample_bytes, that the dictionary is trained on; a bounded sample."""

    least_bytes: int = 0
    level: int = 3
    dictionary_bytes: int = 32_768
    dictionary_samples: int = 400
    sample_bytes: int = 65_536
    date: str = "2020-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column."""
    digits = F.sha1(payload)
    out = []
    for block in range(4):
        word = F.conv(F.substring(digits, 10 * block + 1, 10), 16, 10).cast("long")
        for i in range(8):
            at = F.shiftright(word, 35 - 5 * i).bitwiseAND(31).cast("int") + 1
            out.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*out)


def record_types(pages: DataFrame, settings: Archive = Archive()) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each distinct id and payload."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = written(
        pages.select("page_id", F.octet_length(body).cast("long").alias("payload_bytes"), sha1_base32(body).alias("payload_digest"))
    )
    large = digested.where(F.col("payload_bytes") >= settings.least_bytes)
    kept = large.groupBy("payload_digest").agg(F.max("page_id").alias("first"))
    df = digested.distinct().join(kept, "payload_digest", "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return df.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.when(again & (F.col("payload_bytes") >= settings.least_bytes), "revisit").otherwise("response").alias("record_type"),
        F.when(again & (F.col("payload_bytes") >= settings.least_bytes), F.col("first")).alias("refers_to"),
    )


def train_dictionary(pages: DataFrame, settings: Archive = Archive()) -> bytes:
    """A dictionary from a bounded sample of payloads; empty if they are too few."""
    import zstandard

    some = pages.where(F.octet_length("html").between(1, settings.sample_bytes)).select("html")
    samples = [r["html"].encode() for r in some.limit(settings.dictionary_samples).toLocalIterator()]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)


def _record(page, url, payload, kind, size, digest, refers, date) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = lambda x: f"<urn:x-page:{'null' if x is None else x}>"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", name(page)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(refers))]
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, settings: Archive = Archive()) -> DataFrame:
    """Writes all ``pages`` (page_id, url, html) under the URI ``folder``; returns (path, records, bytes) of each archive."""
    need(pages, "page_id", "url", "html")
    types = record_types(pages, settings)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"), sha1_base32(body).alias("payload_digest")).alias("p")
    same = F.col("p.page_id").eqNullSafe(F.col("t.page_id")) & (F.col("p.payload_digest") == F.col("t.payload_digest"))
    typed = rows.join(types.alias("t"), same).select(
        "p.page_id", "p.url", "p.payload", "t.record_type", "t.payload_bytes", "t.payload_digest", "t.refers_to"
    )
    dictionary = train_dictionary(pages, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        fs, root = _file_system(folder)
        task = TaskContext.get()
        fs.create_dir(root, recursive=True)
        path = f"{root}/pages-{task.partitionId():06d}.warc.zst"
        words = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=settings.level, dict_data=words, write_checksum=True)
        done = size = 0
        with fs.open_output_stream(f"{path}.{task.taskAttemptId()}", compression=None) as out:
            if dictionary:
                out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            while first is not None:
                for row in zip(*first.columns, strict=True):
                    page, url, payload, kind, n, digest, refers = (x.as_py() for x in row)
                    frame = press.compress(_record(page, url, payload, kind, n, digest, refers, settings.date))
                    out.write(frame)
                    done, size = done + 1, size + len(frame)
                first = next(batches, None)
        fs.move(f"{path}.{task.taskAttemptId()}", path)
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([done]), pa.array([size])], ["path", "records", "bytes"])

    return written(typed.mapInArrow(run, "path string, records long, bytes long"))


def frames(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time."""
    import zstandard

    head = stream.read(8)
    words = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", head[4:])[0]
        raw = stream.read(size)
        if len(raw) != size:
            raise ValueError("the dictionary frame is cut short")
        if raw[:4] == ZSTD_FRAME:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        words, head = zstandard.ZstdCompressionDict(raw), b""
    unpack = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    rest = head
    while True:
        rest = rest or stream.read(chunk)
        if not rest:
            return
        one, out = unpack.decompressobj(), io.BytesIO()
        while not one.eof:
            if not rest and not (rest := stream.read(chunk)):
                raise ValueError("the last frame is cut short")
            try:
                out.write(one.decompress(rest))
            except zstandard.ZstdError as e:
                raise ValueError(f"a frame can't be decoded: {e}") from e
            rest = one.unused_data if one.eof else b""
        yield out.getvalue()


def parse(frame: bytes) -> dict:
    """The one record of a frame; ValueError says what is wrong with it."""
    head, gap, rest = frame.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if missing := [k for k in MANDATORY if k.lower() not in headers]:
        raise ValueError(f"missing headers: {', '.join(missing)}")
    if not headers["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {size}, but the frame has {len(rest) - 4} bytes of it and the end")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    stated = re.search(rb"(?mi)^content-length: *(\d+)\r?$", http)
    if not gap or not stated:
        raise ValueError("no HTTP header with a length")
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(stated[1]):
            raise ValueError("the payload hasn't the stated length")
        if digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
            raise ValueError("the payload hasn't the stated digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers:
        raise ValueError(f"no response and no right revisit: {kind}")
    page = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", x or "")) else None
    return {
        "record_type": kind,
        "page_id": page(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "date": headers["warc-date"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(stated[1]),
        "payload_digest": digest,
        "refers_to": page(headers.get("warc-refers-to")),
    }


def read_archives(archives: DataFrame, strict: bool = True, payloads: bool = True) -> DataFrame:
    """The records of the archives in the column path; a bad record or frame raises, or is a row with its error."""
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def row(path: str, i: int, frame: bytes) -> dict:
        try:
            found = parse(frame)
        except ValueError as e:
            if strict:
                raise ValueError(f"{path}, frame {i}: {e}") from e
            found = {"error": str(e)}
        return {"archive": path, "frame": i} | found | ({} if payloads else {"payload": None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, where = _file_system(path)
                held, size = [], 0
                with fs.open_input_stream(where, compression=None) as stream:
                    try:
                        for i, frame in enumerate(frames(stream)):
                            held.append(row(path, i, frame))
                            size += len(frame)
                            if size > 8 << 20 or len(held) >= 5000:
                                yield pa.RecordBatch.from_pylist(held, schema)
                                held, size = [], 0
                    except ValueError as e:
                        if strict:
                            raise
                        held.append({"archive": path, "error": str(e)})
                yield pa.RecordBatch.from_pylist(held, schema)

    some = archives.select("path")
    return some.repartition(max(1, some.count())).mapInArrow(run, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, settings: Archive = Archive()) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads their records back, without payloads."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder, settings), payloads=False)


#: The expected records in DuckDB's SQL.
_LETTERS = " || ".join(
    f"substr('{BASE32}', (((instr('0123456789abcdef', substr(d, {5 * i // 4 + 1}, 1)) - 1) * 16"
    f" + greatest(0, instr('0123456789abcdef', substr(d || '0', {5 * i // 4 + 2}, 1)) - 1)) >> {3 - 5 * i % 4}) % 32 + 1, 1)"
    for i in range(32)
)
WARC_SQL = f"""
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS d
  FROM pages
), digested AS (
  SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest FROM hashed
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM digested
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM kept
"""
