"""Web archives: exact round trips, ZIP directories against the standard library, equal payloads."""

from __future__ import annotations

import hashlib
import io
import struct
import zipfile

import pytest

from rebasket.llm import warc, zip_ranges
from rebasket.llm.warc import archived_pages, make_record, parse_record, read_archives, restored_pages, write_archives
from rebasket.llm.zip_ranges import DamagedArchive, data_start, members

BIG = "<html>" + "é" * 600  # 1,206 bytes
ROWS = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (3, None, BIG),
    (4, "http://a/4\r\nx y", "small"),
    (5, "http://a/5", "small"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (None, "http://a/8", BIG),
    (None, "http://a/9", "z" * 1000),
    (None, "http://a/9", "z" * 1000),
    (8, "http://a/10", "y" * 999),
    (9, "http://a/11", "y" * 999),
    (10, "http://a/12", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n" * 9000),
    (11, "http://a/13", "\x00漢字"),
    (12, "http://a/14", "t" * 2000),
    (12, "http://a/14", "t" * 2000),
]
PAGES = "page_id long, url string, html string"


def expected(rows):
    found = []
    for k, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        same = [(r[0] is not None, r[0] or 0, i) for i, r in enumerate(rows) if (r[2] or "").encode() == data]
        head = max(same)
        response = len(data) < 1000 or head[2] == k
        found.append(
            (page, len(data), hashlib.sha1(data).hexdigest(), "response" if response else "revisit")
            + ((None,) if response or not head[0] else (head[1],))
        )
    return sorted(found, key=repr)


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 300])
def test_records_of_equal_payloads(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    monkeypatch.setattr(warc, "RUN_BYTES", 700)
    pages = spark.createDataFrame([(*r, "n", 1) for r in ROWS], PAGES + ", row string, size int").coalesce(1)
    got = archived_pages(pages)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ROWS)


def test_pages_come_back_as_they_were(spark):
    records = read_archives(write_archives(spark.createDataFrame(ROWS, PAGES)))
    back = [(int(r.page_id) if r.page_id else None, r.html) for r in restored_pages(records).collect()]
    assert sorted(back, key=repr) == sorted([(r[0], r[2] or "") for r in ROWS], key=repr)
    urls = {r.url for r in records.collect()}
    assert "http://a/4%0D%0Ax%20y" in urls and None in urls


def test_text_ids(spark):
    rows = [("a:b+c %d/é", "u", BIG), ("", "u", BIG), ("z", "u", "s")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r.refers_to for r in archived_pages(pages).collect()}
    assert got == {"a:b+c %d/é": None, "": "a:b+c %d/é", "z": None}


def test_no_pages(spark):
    assert archived_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_records():
    digest = hashlib.sha1(b"body\r\n\r\n").hexdigest()
    found = parse_record(make_record("urn:x-page:3:7", "http://x", digest, b"body\r\n\r\n"))
    assert (found["payload"], found["payload_bytes"], found["record_type"]) == (b"body\r\n\r\n", 8, "response")
    again = parse_record(make_record("urn:x-page:4:8", None, digest, b"body\r\n\r\n", "urn:x-page:3:7"))
    assert (again["payload"], again["payload_bytes"], again["refers_to"]) == (None, 8, "urn:x-page:3:7")
    assert again["payload_digest"] == digest and again["url"] is None
    with pytest.raises(DamagedArchive):
        parse_record(make_record("urn:x-page:3:7", "http://x", digest, b"other"))
    with pytest.raises(DamagedArchive):
        parse_record(b"something else")


# ZIP directories


def reader(data: bytes, log: list | None = None):
    def read(start: int, size: int) -> bytes:
        if log is not None:
            log.append(size)
        return data[start : start + size]

    return read


def packed(names: list[str], comment: bytes = b"", before: bytes = b"") -> bytes:
    out = io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a" if before else "w") as file:
        for name in names:
            file.writestr(name, f"content of {name}")
        file.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"about PK\x05\x06 and more " * 3])
@pytest.mark.parametrize("before", [b"", b"#!/bin/sh\n" * 5])
@pytest.mark.parametrize("count", [0, 1, 300, 66_000])
def test_members_are_those_of_the_standard_library(monkeypatch, comment, before, count):
    monkeypatch.setattr(zip_ranges, "BLOCK", 1000)
    names = [f"folder/é{k}.txt" for k in range(count)]
    data = packed(names, comment, before)
    read = reader(data)
    found = list(members(read, len(data)))
    assert [m.name for m in found] == names  # 66,000 members need the ZIP64 form
    for m in found[:: max(1, count // 50)]:
        start = data_start(read, m)
        assert m.stored and data[start : start + m.size].decode() == f"content of {m.name}"


def test_far_offsets_and_large_sizes():
    """An entry whose sizes and offset lie beyond 4 GB, in a file that is mostly a hole."""
    far, size = 5 << 30, 6 << 30
    name = b"archive/data.warc.gz"
    extra = struct.pack("<2H", 0x9999, 3) + b"abc" + struct.pack("<2H3Q", 1, 24, size, size, far)
    entry = zip_ranges.ENTRY.pack(
        b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF
    )
    directory, start = entry + name + extra, far + size + 100
    record = zip_ranges.END64.pack(b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(directory), start)
    locator = zip_ranges.LOCATOR.pack(b"PK\x06\x07", 0, start + len(directory), 1)
    end = zip_ranges.END.pack(b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    tail = directory + record + locator + end
    local = zip_ranges.LOCAL.pack(b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0, 0, len(name), 20)

    def read(at: int, n: int) -> bytes:
        out = bytearray(n)
        for place, data in ((far, local), (start, tail)):
            for k in range(max(at, place), min(at + n, place + len(data))):
                out[k - at] = data[k - place]
        return bytes(out)

    (found,) = members(read, start + len(tail))
    assert (found.name, found.size, found.header) == (name.decode(), size, far)
    assert data_start(read, found) == far + zip_ranges.LOCAL.size + len(name) + 20


def test_damaged_files():
    data = packed(["a", "b"])
    for broken in (b"", b"PK", data[:-5], data.replace(b"PK\x01\x02", b"PKxx")):
        with pytest.raises(DamagedArchive):
            list(members(reader(broken), len(broken)))


def test_members_are_found_without_reading_the_others():
    data, log = packed(["a"]) + b"", []
    big = io.BytesIO()
    with zipfile.ZipFile(big, "w") as file:
        file.writestr("big", b"x" * 5_000_000)
        file.writestr("small", b"y")
    read = reader(big.getvalue(), log)
    found = {m.name: m for m in members(read, len(big.getvalue()))}
    data_start(read, found["small"])
    assert sum(log) < 200_000


def test_compressed_members_are_refused(spark, tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as file:
        file.writestr(warc.DATA, b"x" * 100)
        file.writestr(warc.INDEX, b"")
    with pytest.raises(Exception, match="no stored member"):
        read_archives(spark.createDataFrame([(str(path),)], "path string")).collect()
