"""WARC archives whose records share a Zstandard dictionary, and their reader.

Each task writes one archive: a skippable frame that holds a dictionary built from the
archive's first records, then one frame per record, so that any record can be read alone. Of
records with equal payloads one is a response and the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import as_bytes, lookup, stored
from tillstar.sinks.warehouse import scratch

#: Bytes of records that a dictionary is built from at most, and of the dictionary.
TRAINED_ON, DICTIONARY = 2 << 20, 64 << 10
LEVEL = 6
CHUNK = 1 << 20

# The formats of the archive.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page:{}>"

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "record_id string, record_type string, url string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary"
)


def _open(uri: str):
    found, path = fs.FileSystem.from_uri(uri)
    return found, path


def _record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record, header and block. A revisit has no payload; its header has the full one's
    digest and length."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {RECORD_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
        block = http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from these records, or None where they are too few to build one."""
    size = min(DICTIONARY, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples) if size >= 256 else None
    except zstandard.ZstdError:
        return None


class _Archive:
    def __init__(self, uri: str, level: int):
        self.level, self.uri = level, uri
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.records = self.written = 0
        self.compressor = self.out = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.compressor:
            self._put(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= TRAINED_ON:
            self._begin()

    def _begin(self) -> None:
        found, path = _open(self.uri)
        self.out = found.open_output_stream(path, compression=None)
        shared = _dictionary([r[: TRAINED_ON // 8] for r in self.waiting])
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=shared)
        if shared:
            packed = zstandard.ZstdCompressor(level=19).compress(shared.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        for record in self.waiting:
            self._put(self.compressor.compress(record))
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def close(self) -> None:
        if not self.compressor:
            self._begin()
        self.out.close()


def write_archives(
    records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = LEVEL
) -> DataFrame:
    """Write records (page_id, url, html, refers_to) as one archive a task; the stored manifest.

    An archive has a new name in each attempt, so one that a lost task left behind is in no
    manifest and is never read.
    """
    spark = records.sparkSession

    def write(batches):
        archive = None
        for batch in batches:
            if batch.num_rows and archive is None:
                archive = _Archive(f"{folder}/{uuid.uuid4().hex}.warc.zst", level)
            ids, urls, refers = (batch[c].to_pylist() for c in ("page_id", "url", "refers_to"))
            for row in zip(ids, urls, as_bytes(batch["html"]), refers):
                page_id, url, payload, refers_to = row
                archive.add(_record(page_id, url, payload or b"", refers_to, date))
        if archive:
            archive.close()
            row = {"path": archive.uri, "records": archive.records, "bytes": archive.written}
            yield pa.RecordBatch.from_pylist([row])

    found, path = _open(folder)
    found.create_dir(path, recursive=True)
    columns = records.select("page_id", "url", "html", "refers_to")
    return stored(spark, columns.mapInArrow(write, MANIFEST), "manifest")


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, each decompressed by the dictionary that leads the archive."""
    data = stream.read(8)
    shared = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
        packed = stream.read(struct.unpack("<I", data[4:])[0])
        if packed.startswith(ZSTD_FRAME):
            packed = zstandard.ZstdDecompressor().decompress(packed)
        shared, data = zstandard.ZstdCompressionDict(packed), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    frame, parts = decompressor.decompressobj(), []
    while data or (data := stream.read(CHUNK)):
        parts.append(frame.decompress(data))
        data = b""
        if frame.eof:
            yield b"".join(parts)
            data, parts, frame = frame.unused_data, [], decompressor.decompressobj()
    if any(parts):
        raise ValueError("an archive ends inside a record")


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)", re.I)


def parse(record: bytes) -> dict:
    """The fields of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "record_id": fields["WARC-Record-ID"],
        "record_type": fields["WARC-Type"],
        "url": fields.get("WARC-Target-URI"),
        "payload_digest": digest,
        "payload_bytes": int(_LENGTH.search(http)[1]),
        "refers_to": fields.get("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives of a manifest; checks payloads against their digests."""

    def read(batches):
        schema = pa.schema(
            [(c, pa.string()) for c in ("record_id", "record_type", "url", "payload_digest")]
            + [("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                found, path = _open(uri)
                rows, size = [], 0
                with found.open_input_stream(path, compression=None) as stream:
                    for frame in frames(io.BufferedReader(stream, CHUNK)):
                        row = parse(frame)
                        payload = row["payload"]
                        if payload is not None and hashlib.sha1(payload).hexdigest() != row["payload_digest"]:
                            raise ValueError(f"{row['record_id']} in {uri} is damaged")
                        rows.append(row)
                        size += len(frame)
                        if size > 16 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(n, "path").mapInArrow(read, RECORDS)


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """pages with refers_to: the largest page_id of an equal payload of at least `least` bytes."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"))
    large = F.octet_length("html") >= least
    keyed = base.filter(large).withColumn("payload", F.sha2("html", 256))
    groups = (
        keyed.groupBy("payload")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    groups = stored(pages.sparkSession, groups, "groups")
    refers: Column = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    found = lookup(keyed, groups, "payload", "copies")
    columns = ["page_id", "url", "html", refers.alias("refers_to")]
    return found.select(*columns).unionByName(
        base.filter(~large).withColumn("refers_to", F.lit(None).cast(groups.schema["kept"].dataType))
    )


def archive(pages: DataFrame, folder: str | None = None, least: int = 1000) -> DataFrame:
    """Archive pages (page_id, url, html) and return the stored manifest of the archives.

    A null html is an empty payload, a null url is left out. Payloads of under `least` bytes are
    all responses. Of equal larger ones that with the largest page_id is the response (each of
    them, if repeated rows share it), others revisit it, also those with a null page_id. If all
    have a null page_id, all are responses. Other columns are ignored.
    """
    folder = folder or f"{scratch(pages.sparkSession).root}/archives"
    return write_archives(with_revisits(pages, least), folder)


def page_id(column: str) -> Column:
    """The page id inside a record id; null where the page had none."""
    text = F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(text != "", text.cast("long"))
