"""Web pages as WARC records in ZIP-packaged archives, written and read back (operator 12).

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` with one
gzip member per record, ``indexes/index.cdxj`` with a line per record, and
``datapackage.json``.  Tasks write archives and report those they finished; the
reader finds members and index by the central directory, deals runs of records
over tasks, and each task reads the range of its run and nothing else.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.llm.text import slices
from rebasket.llm.zip_ranges import DamagedArchive, data_start, members
from rebasket.session import hand_over, new_path, spread_rows

LEAST_SHARED = 1000
"""Payloads of fewer bytes are always stored, also where they are equal."""
ARCHIVE_BYTES = 256 << 20
"""An archive is closed at the first record beyond."""
RUN_BYTES = 4 << 20
"""Bytes of records that one range read covers; a longer record stands alone."""
BATCH_BYTES = 16 << 20
RECORD_DATE = "2020-01-01T00:00:00Z"

# Names and texts of the formats.
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile("[\\x00-\\x20\\x7f]")
_RECORD_ID = "urn:x-page:"


# --- records ---


def record_id(row: int, page_id: object) -> str:
    """A name of the row's record that tells its page, if it has one."""
    return f"{_RECORD_ID}{row}" + ("" if page_id is None else f":{quote(str(page_id), safe='')}")


def page_of(name: str | None) -> str | None:
    """The page that a record's name tells."""
    parts = (name or "").strip("<>").removeprefix(_RECORD_ID).split(":")
    return unquote(parts[1]) if len(parts) == 2 else None


def make_record(name: str, url: str | None, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which has the HTTP head but no payload."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if refers_to else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {RECORD_DATE}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: quote(m[0]), url))
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(record: bytes) -> dict[str, object]:
    """The parts of one WARC record; the payload of a revisit is None, its size that of the original."""
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise DamagedArchive("no WARC record at a place of the index")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != stated:
        raise DamagedArchive(f"another payload than the digest of {fields['warc-record-id']} tells")
    return {
        "record_id": fields["warc-record-id"].strip("<>"),
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": int(_fields(http)["content-length"]) if kind == "revisit" else len(payload),
        "payload_digest": stated,
        "payload": None if kind == "revisit" else payload,
    }


# --- files ---


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Hadoop writes it."""
    for ours, theirs in (("s3a://", "s3://"), ("file:///", "/"), ("file:/", "/")):
        if path.startswith(ours):
            path = theirs + path[len(ours) :]
            break
    return fs.FileSystem.from_uri(path)


class _Archive:
    """One archive being written, front to back."""

    def __init__(self, path: str):
        system, place = _file_system(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.path, self.size, self.index = path, 0, []
        self.file = system.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, name: str, url: str | None, digest: str, payload: bytes, refers_to: str | None) -> None:
        packed = gzip.compress(make_record(name, url, digest, payload, refers_to), 6, mtime=0)
        self.data.write(packed)
        entry = {
            "url": url,
            "mime": "warc/revisit" if refers_to else "text/html",
            "digest": f"sha1:{digest}",
            "length": str(len(packed)),
            "offset": str(self.size),
            "filename": DATA.rsplit("/", 1)[1],
        }
        key = _CONTROL.sub(lambda m: quote(m[0]), url or "-")
        self.index.append(f"{key} {re.sub('[^0-9]', '', RECORD_DATE)} {json.dumps(entry)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        lines = "".join(sorted(self.index))
        self.zip.writestr(zipfile.ZipInfo(INDEX), lines)
        resources = [{"path": DATA, "bytes": self.size}, {"path": INDEX, "bytes": len(lines.encode())}]
        self.zip.writestr(
            zipfile.ZipInfo(PACKAGE), json.dumps({"profile": "data-package", "resources": resources})
        )
        self.zip.close()
        self.file.close()
        return self.path, len(self.index)


# --- writing ---


def write_archives(
    pages: DataFrame, folder: str | None = None, page_id: str = "page_id", least_shared: int = LEAST_SHARED
) -> DataFrame:
    """Archives of all ``pages`` (``page_id``, url, html); returns path and records of each.

    Every row becomes one record with its html in UTF-8 as payload, a null html
    an empty one.  Of rows with equal payloads (SHA-1 and size) of at least
    ``least_shared`` bytes, the one of the largest page_id is the response, the
    others are revisits of it; nulls are below all ids, and among repeated ids the
    row written last counts.  A null url gives a record without one.

    ``folder`` (by default a new one in the shared folder) has to be reachable
    from all executors by pyarrow.  The pages are stored once, so that a row keeps
    its number when a task is repeated; a repeated task writes archives of its
    own, and only those of finished tasks are reported.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    numbered = spread_rows(pages.select(F.col(page_id).alias("page_id"), "url", payload.alias("text")))
    stored = hand_over(
        numbered.select(
            F.monotonically_increasing_id().alias("row"),
            "page_id",
            "url",
            F.sha1("text").alias("digest"),
            F.octet_length("text").alias("size"),
            "text",
        ),
        "pages",
    ).read(spark)
    heads = (
        stored.filter(F.col("size") >= least_shared)
        .groupBy("digest", "size")
        .agg(F.max(F.struct("page_id", "row")).alias("head"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("digest", "size", F.col("head.row").alias("head"), F.col("head.page_id").alias("head_id"))
    )
    # Stored, so that its size is known before the pages would be shuffled.
    heads = hand_over(heads, "heads").read(spark)
    joined = stored.join(heads, ["digest", "size"], "left").select(
        "row",
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "digest",
        "text",
        F.when(F.col("head") != F.col("row"), F.col("head")).alias("head"),
        F.col("head_id").cast("string").alias("head_id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for part in slices(batches):
            for r in part.to_pylist():
                archive = archive or _Archive(f"{folder}/{uuid.uuid4().hex}.zip")
                refers_to = None if r["head"] is None else record_id(r["head"], r["head_id"])
                archive.add(record_id(r["row"], r["page_id"]), r["url"], r["digest"], r["text"], refers_to)
                if archive.size >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        paths, records = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array(paths, pa.string()), "records": pa.array(records, pa.int64())}
        )

    return hand_over(joined.mapInArrow(run, "path string, records long"), "archives").read(spark)


# --- reading ---


def _runs_of(path: str) -> Iterator[tuple[int, list[int]]]:
    """Start and lengths of runs of records that lie side by side in an archive."""
    system, place = _file_system(path)
    with system.open_input_file(place) as file:

        def read(start: int, size: int) -> bytes:
            return file.read_at(size, start)

        found = {m.name: m for m in members(read, file.size())}
        absent = {DATA, INDEX} - found.keys()
        if absent or not (found[DATA].stored and found[INDEX].stored):
            raise DamagedArchive(f"{path}: no stored member {', '.join(sorted(absent)) or DATA}")
        base = data_start(read, found[DATA])
        lines = read(data_start(read, found[INDEX]), found[INDEX].size).decode().splitlines()
    entries = (json.loads(line.split(" ", 2)[2]) for line in lines)
    places = sorted((int(e["offset"]), int(e["length"])) for e in entries)
    start, lengths, size = 0, [], 0
    for offset, length in places:
        if lengths and (size + length > RUN_BYTES or offset != start + size):
            yield base + start, lengths
            lengths = []
        if not lengths:
            start, size = offset, 0
        lengths.append(length)
        size += length
    if lengths:
        yield base + start, lengths


_RECORDS = (
    "record_id string, refers_to string, url string, record_type string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives in the column ``path``; payloads only if asked for.

    A task reads the directories of an archive, then runs of records are dealt
    over all tasks, so an archive of any size is read by many of them.  Records
    whose payload differs from its digest and files without the expected members
    are an error.  No archives give no records.
    """
    columns = _RECORDS if payloads else _RECORDS.removesuffix(", payload binary")

    def directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                runs = list(_runs_of(path))
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([path] * len(runs), pa.string()),
                        "start": pa.array([s for s, _ in runs], pa.int64()),
                        "lengths": pa.array([n for _, n in runs], pa.list_(pa.int64())),
                    }
                )

    def batch_of(rows: list[dict[str, object]]) -> pa.RecordBatch:
        names = [c.split()[0] for c in columns.split(", ")]
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_pydict(
            {n: pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names}
        )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in (r for b in batches for r in b.to_pylist()):
            system, place = _file_system(run["path"])
            with system.open_input_file(place) as file:
                data = file.read_at(sum(run["lengths"]), run["start"])
            rows, size, at = [], 0, 0
            for length in run["lengths"]:
                rows.append(parse_record(gzip.decompress(data[at : at + length])))
                at += length
                size += rows[-1]["payload_bytes"] if payloads else 0
                if size > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)

    found = archives.select("path").mapInArrow(directories, "path string, start long, lengths array<long>")
    # A number of its own: the rows of a run are small, what they stand for is not.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(tasks, "path", "start").mapInArrow(records, columns)


def restored_pages(records: DataFrame) -> DataFrame:
    """page_id (text), url and html of every record, revisits with the payload of their original."""
    pages = F.udf(page_of, "string", useArrow=True)
    own = records.select("record_id", "refers_to", "url", "payload")
    originals = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload").alias("original")
    )
    joined = own.join(originals, "refers_to", "left")
    html = F.decode(F.coalesce("payload", "original"), "UTF-8")
    return joined.select(pages("record_id").alias("page_id"), "url", html.alias("html"))


def archived_pages(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Writes the archives of ``pages``, reads them back and tells the record of every page.

    page_id and refers_to have the type they have in ``pages``; see
    ``write_archives`` for equal payloads, nulls and repeated rows.
    """
    records = read_archives(write_archives(pages, page_id=page_id), payloads=False)
    kind = pages.schema[page_id].dataType

    def page(column: str):
        # The third part of a record's name, if there is one.
        part = F.get(F.split(F.regexp_replace(column, f"^{_RECORD_ID}", ""), ":"), F.lit(1))
        return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))).cast(kind)

    return records.select(
        page("record_id").alias(page_id),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
