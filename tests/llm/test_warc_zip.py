import hashlib
import io
import zipfile

import pytest

from stratiscore.llm import warc_zip

SCHEMA = "page_id long, url string, html string"
BIG = "<p>ä</p>" * 200


def expected(rows):
    keeper = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            keeper[data] = max(page_id, keeper.get(data, page_id))
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        first = keeper.get(data)
        target = None if first is None or first == page_id else first
        kind = "response" if target is None else "revisit"
        out.append((page_id, url, kind, target, hashlib.sha1(data).hexdigest(), len(data)))
    return out


ROWS = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (9, None, BIG),
    (9, None, BIG),
    (3, "http://a/3", "small"),
    (4, "http://a/4", "small"),
    (5, "http://a/5\r\nWARC-Type: x", None),
    (6, "", ""),
    (None, "http://a/7", BIG),
    (None, "http://a/8", "x" * 1000),
    (None, "http://a/9", "x" * 1000),
    (7, "http://a/10", "\r\n\r\n long " * 40_000),
    (8, "http://a/ü", "\x00 \U0001f600 字" * 300),
]


@pytest.mark.parametrize("archive_bytes, chunk_bytes", [(256 << 20, 4 << 20), (300, 100)])
def test_round_trip(workspace, table, archive_bytes, chunk_bytes):
    pages = table(f"{SCHEMA}, digest string, keeper long", *((*r, "d", -1) for r in ROWS))
    written = warc_zip.write_archives(pages, workspace.path("zip"), archive_bytes=archive_bytes)
    manifest = workspace.stage(written, "manifest")
    found = warc_zip.read_archives(manifest, chunk_bytes).collect()
    assert sum(r["records"] for r in manifest.collect()) == len(found) == len(ROWS)

    def key(r):
        return tuple("" if v is None else str(v) for v in r)

    names = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes")
    got = sorted((tuple(r[n] for n in names) for r in found), key=key)
    want = [(r[0], r[1] and r[1].replace("\r\n", "%0D%0A"), *r[2:]) for r in expected(ROWS)]
    assert list(map(key, got)) == sorted(map(key, (tuple(x or None if i == 1 else x for i, x in enumerate(r)) for r in want)))
    for row in found:
        if row["record_type"] == "response":
            assert hashlib.sha1(row["payload"]).hexdigest() == row["payload_digest"]


def test_empty_table(workspace, table):
    pages = table(SCHEMA)
    manifest = workspace.stage(warc_zip.write_archives(pages, workspace.path("zip")), "manifest")
    assert warc_zip.read_archives(manifest).count() == 0



class Source:
    """Reads ranges only, as the file systems do."""

    def __init__(self, data):
        self._data = data

    def size(self):
        return len(self._data)

    def read_at(self, n, offset):
        return self._data[offset : offset + n]


def test_zip64_directory_and_members():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for i in range(65_600):  # more entries than the plain record can count
            archive.writestr(zipfile.ZipInfo(f"m{i}"), b"")
        with archive.open(zipfile.ZipInfo("wide/ü"), "w", force_zip64=True) as member:
            member.write(b"stored bytes")
        archive.comment = b"PK\x05\x06 a signature inside the comment"
    source = Source(buffer.getvalue())
    found = warc_zip.members(source)
    assert len(found) == 65_601 and found[-1].name == "wide/ü"
    at = warc_zip.data_offset(source, found[-1])
    assert source.read_at(found[-1].size, at) == b"stored bytes"


def test_wide_fields_come_from_the_extra_field():
    extra = b"\x99\x00\x02\x00ab" + b"\x01\x00\x10\x00" + (5 << 32).to_bytes(8, "little") + (7 << 33).to_bytes(8, "little")
    assert warc_zip._wide(extra, [0xFFFFFFFF, 12, 0xFFFFFFFF]) == [5 << 32, 12, 7 << 33]


def test_damaged_payloads_are_refused():
    def record(payload, digest):
        return warc_zip.unpack_record(warc_zip.pack_record(1, "http://a", payload, digest, None, warc_zip.WARC_DATE))

    right = hashlib.sha1(b"as it was").hexdigest()
    fields, http, payload = record(b"as it was", right)
    assert warc_zip.checked(fields, http, payload) == (right, 9)
    for changed in (b"as it is!", b"as it", b""):
        with pytest.raises(ValueError, match="damaged"):
            warc_zip.checked(fields, http, changed)
    with pytest.raises(ValueError, match="damaged"):
        warc_zip.checked(*record(b"other", right))


def test_small_pages_are_not_shuffled(workspace, table, plan_of):
    pages = table(SCHEMA, *((i, f"http://a/{i}", None if i % 2 else "") for i in range(40)))
    pages = workspace.stage(pages, "pages")
    written = warc_zip.write_archives(pages, workspace.path("zip"))
    assert "Union" in plan_of(written)
    found = warc_zip.read_archives(workspace.stage(written, "manifest")).collect()
    assert sorted(int(r["page_id"]) for r in found) == list(range(40))
    assert {r["record_type"] for r in found} == {"response"}


def test_damaged_and_packed_files_are_refused():
    with pytest.raises(ValueError):
        warc_zip.members(Source(b"no archive at all"))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("packed", b"x" * 1000)
    source = Source(buffer.getvalue())
    with pytest.raises(ValueError):
        warc_zip.data_offset(source, warc_zip.members(source)[0])
