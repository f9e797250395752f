"""WARC archives packed in ZIP files: writing, and reading by ranges without extraction.

Each archive is a ZIP with two stored members: the WARC data, one gzip member per record, and an
index with one JSON line per record. Readers take the end-of-directory records (plain and ZIP64)
from the tail of the file, the central directory by range, then the local header of a stored
member, the index, and at last the records of any stretch of the data.

Equal payloads of at least ``min_revisit`` bytes are written once, by the record with the largest
id; the others become revisit records that name it. Files are reached by URI through Arrow's file
systems, so they may lie in any shared store. A task writes under a new name, and only the archives
named by successful tasks are read. On reading, length and SHA-1 of each response payload are compared
with its record, and a damaged one raises an error; a revisit has no payload to compare.

Nulls: a null payload is empty; a null url leaves out the target; a null id is written as such,
never names a response and, where all equal payloads lack ids, every one is a response. Repeated
rows that share the largest id are all responses. Without rows there are no archives.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATA_NAME = "archive/data.warc.gz"
INDEX_NAME = "indexes/index.cdxj"
MIN_REVISIT = 1_000
ARCHIVE_BYTES = 256 << 20
CHUNK_BYTES = 4 << 20
WARC_DATE = "1970-01-01T00:00:00Z"
_CRLF = b"\r\n"

# Fixed values of the ZIP format: signatures and sizes of its records.
_END, _END_SIZE = b"PK\x05\x06", 22
_END64, _END64_SIZE = b"PK\x06\x06", 56
_LOCATOR, _LOCATOR_SIZE = b"PK\x06\x07", 20
_ENTRY, _ENTRY_SIZE = b"PK\x01\x02", 46
_LOCAL, _LOCAL_SIZE = b"PK\x03\x04", 30
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF
_STORED = 0


# --- ZIP --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """An entry of the central directory."""

    name: str
    method: int
    header: int
    packed: int
    size: int


def _directory_place(source) -> tuple[int, int, int]:
    """Offset, size and number of entries of the central directory."""
    total = source.size()
    tail_size = min(total, _END_SIZE + _MAX16 + _LOCATOR_SIZE)
    tail = source.read_at(tail_size, total - tail_size)
    at = tail.rfind(_END)
    while at >= 0:  # the comment ends the file; a signature inside a comment does not fit
        if at + _END_SIZE <= len(tail):
            fields = struct.unpack_from("<4H2LH", tail, at + 4)
            if at + _END_SIZE + fields[6] == len(tail):
                break
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    entries, size, offset = fields[3], fields[4], fields[5]
    if entries == _MAX16 or _MAX32 in (size, offset):
        before = at - _LOCATOR_SIZE
        if before >= 0 and tail[before : before + 4] == _LOCATOR:
            (place,) = struct.unpack_from("<Q", tail, before + 8)
            record = source.read_at(_END64_SIZE, place)
            if record[:4] != _END64:
                raise ValueError("the ZIP64 directory end is missing")
            entries, size, offset = struct.unpack_from("<3Q", record, 32)
    return offset, size, entries


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """Replace fields that are all ones by those of the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<2H", extra, at)
        if tag == 1:
            place = at + 4
            for i, value in enumerate(fields):
                if value == _MAX32:
                    (fields[i],) = struct.unpack_from("<Q", extra, place)
                    place += 8
        at += 4 + size
    return fields


def members(source) -> list[Member]:
    """The central directory of an open file."""
    offset, size, entries = _directory_place(source)
    data = source.read_at(size, offset)
    found, at = [], 0
    for _ in range(entries):
        if data[at : at + 4] != _ENTRY:
            raise ValueError("a directory entry is damaged")
        flags, method = struct.unpack_from("<2H", data, at + 8)
        packed, plain, name_size, extra_size, note_size = struct.unpack_from("<2L3H", data, at + 20)
        (header,) = struct.unpack_from("<L", data, at + 42)
        name = data[at + _ENTRY_SIZE : at + _ENTRY_SIZE + name_size]
        extra = data[at + _ENTRY_SIZE + name_size :][:extra_size]
        plain, packed, header = _wide(extra, [plain, packed, header])
        text = name.decode("utf-8" if flags & 0x800 else "cp437")
        found.append(Member(text, method, header, packed, plain))
        at += _ENTRY_SIZE + name_size + extra_size + note_size
    return found


def data_offset(source, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != _STORED:
        raise ValueError(f"{member.name} is compressed; only stored members are read by range")
    header = source.read_at(_LOCAL_SIZE, member.header)
    if header[:4] != _LOCAL:
        raise ValueError(f"the local header of {member.name} is damaged")
    name_size, extra_size = struct.unpack_from("<2H", header, 26)
    return member.header + _LOCAL_SIZE + name_size + extra_size


# --- WARC records -----------------------------------------------------------------------------


def _record_id(value) -> str:
    return f"<urn:page:{'' if value is None else value}>"


def _id_of(text: str | None) -> str | None:
    return text.removeprefix("<urn:page:").removesuffix(">") or None if text else None


def pack_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head, which says the length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    plain = _CRLF.join([*(h.encode() for h in head), b"", block]) + _CRLF * 2
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def unpack_record(data: bytes) -> tuple[dict, dict, bytes]:
    """WARC fields, HTTP fields and payload of one gzip member."""
    plain = zlib.decompress(data, 31)
    head, _, block = plain.partition(_CRLF * 2)
    fields = _fields(head.split(_CRLF)[1:])
    http, _, payload = block[: int(fields["content-length"])].partition(_CRLF * 2)
    return fields, _fields(http.split(_CRLF)[1:]), payload


# --- writing ----------------------------------------------------------------------------------


class ArchiveWriter:
    """Writes one archive; the index follows the data."""

    def __init__(self, uri: str, name: str = DATA_NAME):
        files, path = pyarrow.fs.FileSystem.from_uri(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self._stream = files.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(zipfile.ZipInfo(name), "w", force_zip64=True)
        self._index = io.BytesIO()
        self.written = self.records = 0

    def add(self, record: bytes, page_id, url, digest: str) -> None:
        self._data.write(record)
        entry = {"url": url, "digest": f"sha1:{digest}", "offset": self.written,
                 "length": len(record), "id": page_id}
        self._index.write(json.dumps(entry).encode() + b"\n")
        self.written += len(record)
        self.records += 1

    def close(self) -> None:
        self._data.close()
        self._zip.writestr(zipfile.ZipInfo(INDEX_NAME), self._index.getbuffer())
        self._zip.close()
        self._stream.close()


_MANIFEST = pa.schema([("uri", pa.string()), ("records", pa.int64())])


def _writer(folder: str, archive_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, uri, done = None, None, []
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
            for values in zip(*columns):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in values)
                if archive is None:
                    uri = f"{folder}/{uuid4().hex}.zip"
                    archive = ArchiveWriter(uri)
                record = pack_record(page_id, url, payload, digest, refers_to, date)
                archive.add(record, page_id, url, digest)
                if archive.written >= archive_bytes:
                    archive.close()
                    done.append((uri, archive.records))
                    archive = None
        if archive is not None:
            archive.close()
            done.append((uri, archive.records))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate(_MANIFEST.types)], schema=_MANIFEST
        )

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    min_revisit: int = MIN_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = WARC_DATE,
) -> DataFrame:
    """Write (page_id, url, html) to archives in a shared folder; uri and records of each."""
    payload = F.coalesce(F.col("html").cast("binary"), F.unhex(F.lit("")))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    digest = F.sha1("payload").alias("digest")
    rows = rows.select("*", digest)
    large = F.octet_length("payload") >= min_revisit
    # Small pages, whatever share of them is empty, are written where they are read.
    small = rows.filter(~large).withColumn("refers_to", F.lit(None).cast(dict(pages.dtypes)["page_id"]))
    rows = rows.filter(large)
    groups = (
        rows.groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "keeper")
    )
    points = ~F.col("page_id").eqNullSafe(F.col("keeper"))
    marked = rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(points, F.col("keeper")).alias("refers_to")
    )
    return marked.unionByName(small).mapInArrow(_writer(folder, archive_bytes, date), "uri string, records long")


# --- reading ----------------------------------------------------------------------------------


def _open(uri: str):
    files, path = pyarrow.fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


_STRETCH = pa.schema(
    [("uri", pa.string()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))]
)


def stretches(entries: list[dict], chunk_bytes: int) -> Iterator[tuple[int, list[int]]]:
    """Runs of neighbouring records of at most ``chunk_bytes``, or of one record."""
    start, lengths = 0, []
    for entry in entries:
        if lengths and entry["offset"] + entry["length"] - start > chunk_bytes:
            yield start, lengths
            start, lengths = entry["offset"], []
        lengths.append(entry["length"])
    if lengths:
        yield start, lengths


def _locate(chunk_bytes: int):
    """Of each archive: stretches of whole records, as file offsets taken from its index."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("uri").to_pylist():
                with _open(uri) as source:
                    named = {m.name: m for m in members(source)}
                    base = data_offset(source, named[DATA_NAME])
                    index = named[INDEX_NAME]
                    lines = source.read_at(index.size, data_offset(source, index))
                entries = [json.loads(line) for line in lines.splitlines()]
                found += [(uri, base + o, n) for o, n in stretches(entries, chunk_bytes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in enumerate(_STRETCH.types)],
                schema=_STRETCH,
            )

    return locate


_RECORD = pa.schema(
    [
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def checked(fields: dict, http: dict, payload: bytes) -> tuple[str, int]:
    """Digest and length of a record's payload; those of a response are taken from its bytes."""
    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
    if fields["warc-type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return digest, size


def _read(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["uri"]) as source:
                    data = source.read_at(sum(row["lengths"]), row["offset"])
                rows, at = [], 0
                for length in row["lengths"]:
                    fields, http, payload = unpack_record(data[at : at + length])
                    at += length
                    kind = fields["warc-type"]
                    digest, size = checked(fields, http, payload)
                    rows.append(
                        (
                            _id_of(fields["warc-record-id"]),
                            fields.get("warc-target-uri"),
                            kind,
                            _id_of(fields.get("warc-refers-to")),
                            digest,
                            size,
                            payload if with_payload and kind == "response" else None,
                        )
                    )
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _RECORD.types)], schema=_RECORD
                )

    return read


def read_archives(
    manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = True
) -> DataFrame:
    """Records of the archives named in column ``uri``. Revisits have no payload of their own."""
    spark = manifest.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = manifest.select("uri").mapInArrow(_locate(chunk_bytes), "uri string, offset long, lengths array<long>")
    schema = (
        "page_id string, url string, record_type string, refers_to string,"
        " payload_digest string, payload_bytes long, payload binary"
    )
    return places.repartition(width).mapInArrow(_read(with_payload), schema)
