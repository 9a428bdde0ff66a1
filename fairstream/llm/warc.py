"""WARC archives inside ZIP packages.

Writing: each task streams its records, one gzip member each, into WARC files
of bounded size; these and their index are stored (not compressed) members of
one ZIP file per task, written under a name of its own. A manifest table, which
Spark commits, says which files count, so a repeated task leaves no double.

Reading, without extraction: the end of the file gives the central directory
(the ZIP64 one where sizes need it), the directory gives the place of each
stored member, the index member gives the place of each record, and records are
fetched by range. The members are dealt over as many tasks as their bytes ask for.

Defined results: a null payload is empty; of equal payloads (by SHA-1) of
``min_bytes`` or more, every row with the largest id is a response and the
others revisit it; rows without an id come before all others; a null or odd url
is percent-encoded (null: left out); extra columns are ignored; an empty table
gives an empty manifest and no records.
"""

from __future__ import annotations

import base64
import hashlib
import io
import itertools
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.shared import materialize
from fairstream.session import scratch_path

MEMBER_BYTES = 8 << 20
#: A payload that more than one in so many rows have is joined by broadcast.
HOT_SHARE = 1000
#: Records closer than this are fetched with one read.
GAP_BYTES = 1 << 16
READ_BYTES = 4 << 20
INDEX = "indexes/index.cdxj"

MANIFEST = "path string, n_records long, n_bytes long"
PLACES = "path string, member string, data_start long, offsets array<long>, lengths array<long>"
RECORDS = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, payload binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("/"):
        path = "file://" + path
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    scheme = urlsplit(path).scheme
    if scheme == "file":
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


# --- records -----------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~-._")))
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of ``RECORDS`` from one record."""
    from urllib.parse import unquote

    top, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = top.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[:int(head["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    name = lambda v: int(v[10:-1]) if v and v != "<urn:page:>" else None
    revisit = head["WARC-Type"] == "revisit"
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (payload_digest(payload) != digest or len(payload) != size):
        raise ValueError("the payload does not match its digest")
    url = head.get("WARC-Target-URI")
    return {"page_id": name(head["WARC-Record-ID"]), "url": None if url is None else unquote(url),
            "record_type": head["WARC-Type"], "payload_digest": digest, "payload_bytes": size,
            "refers_to": name(head.get("WARC-Refers-To")), "payload": None if revisit else payload}


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# --- ZIP directories ---------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def _zip64(extra: bytes, fields: list[int]) -> list[int]:
    """Replace the fields that are all ones by those of the ZIP64 extra block."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(wide) if v == 0xFFFFFFFF else v for v in fields]
        at += 4 + size
    return fields


def directory(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """The members by the central directory; ``read(offset, length)`` fetches a range."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator = at - 20
    if locator >= 0 and tail[locator:locator + 4] == b"PK\x06\x07":
        end64 = read(struct.unpack_from("<Q", tail, locator + 8)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        n, length, start = struct.unpack_from("<QQQ", end64, 32)
    data, at, out = read(start, length), 0, []
    for _ in range(n):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + names]
        plain, packed, header = _zip64(data[at + 46 + names:at + 46 + names + extras], [plain, packed, header])
        out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, plain, header))
        at += 46 + names + extras + comments
    return out


def data_start(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where the bytes of a stored member begin, by its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; records can't be read by range")
    local = read(member.header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", local, 26))


# --- writing -----------------------------------------------------------------

def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_bytes: int = 0, member_bytes: int = MEMBER_BYTES) -> DataFrame:
    """Write the pages as ZIP packages of WARC files; returns the manifest."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        body.alias("payload"), F.unhex(F.sha1(body)).alias("sha1"))
    long_enough = F.octet_length("payload") >= min_bytes
    total = pages.count()
    newest = rows.filter(long_enough).groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    copies = newest.filter("n > 1").select("sha1", "newest", "n", F.lit(True).alias("copied"))
    # A payload with more than one in HOT_SHARE rows stays where it is; only rows of the
    # others travel to their digest.
    hot = F.broadcast(copies.filter(F.col("n") * HOT_SHARE > total).drop("n"))     # fewer than HOT_SHARE rows
    cold = copies.filter(F.col("n") * HOT_SHARE <= total).drop("n")
    flagged = rows.join(hot, "sha1").unionByName(
        rows.join(hot.select("sha1"), "sha1", "left_anti").join(cold, "sha1", "left"))
    revisit = F.coalesce(F.col("copied") & long_enough & ~F.col("page_id").eqNullSafe(F.col("newest")), F.lit(False))
    records = flagged.select("page_id", "url", "payload", "sha1", "newest", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(
            zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "newest", "revisit")),
                strict=True) for b in batches)
        if (first := next(rows, None)) is not None:
            yield _write_package(itertools.chain([first], rows), folder, member_bytes)

    return materialize(records.mapInArrow(run, MANIFEST), "warc-manifest")


def _write_package(rows: Iterator[tuple], folder: str, member_bytes: int) -> pa.RecordBatch:
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    name, n = f"{uuid.uuid4().hex}.wacz", 0
    index: list[str] = []
    with system.open_output_stream(f"{root}/{name}") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
        part, member = io.BytesIO(), 0

        def close() -> None:
            nonlocal part, member
            package.writestr(f"archive/data-{member:06}.warc.gz", part.getvalue())
            part, member = io.BytesIO(), member + 1

        for page_id, url, payload, sha1, newest, revisit in rows:
            digest = base64.b32encode(sha1).decode()
            packed = _gzip(record(page_id, url, payload, digest, newest, revisit))
            index.append(json.dumps({"member": f"archive/data-{member:06}.warc.gz", "offset": part.tell(),
                                     "length": len(packed)}))
            part.write(packed)
            n += 1
            if part.tell() >= member_bytes:
                close()
        if part.tell():
            close()
        package.writestr(INDEX, "\n".join(index))
    size = system.get_file_info(f"{root}/{name}").size
    return pa.RecordBatch.from_pylist([{"path": f"{folder.rstrip('/')}/{name}", "n_records": n, "n_bytes": size}],
                                      schema=pa.schema([("path", pa.string()), ("n_records", pa.int64()),
                                                        ("n_bytes", pa.int64())]))


# --- reading -----------------------------------------------------------------

def places(manifest: DataFrame) -> DataFrame:
    """One row per WARC member: where its records are, from directory and index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("data_start", pa.int64()),
                            ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist(list(package_places(path)), schema=schema)
    return manifest.select("path").mapInArrow(run, PLACES)


def package_places(path: str) -> Iterator[dict]:
    system, name = _open(path)
    with system.open_input_file(name) as file:
        read = lambda at, n: file.read_at(n, at)
        members = {m.name: m for m in directory(read, file.size())}
        index = members[INDEX]
        entries = map(json.loads, read(data_start(read, index), index.size).splitlines())
        for member, group in itertools.groupby(entries, key=lambda e: e["member"]):
            found = list(group)
            yield {"path": path, "member": member, "data_start": data_start(read, members[member]),
                   "offsets": [e["offset"] for e in found], "lengths": [e["length"] for e in found]}


def ranges(offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Reads (start, end) with the records inside: near ones share a read of bounded size."""
    todo = sorted(zip(offsets, lengths, strict=True))
    while todo:
        start, end, n = todo[0][0], sum(todo[0]), 1
        while n < len(todo) and todo[n][0] - end <= GAP_BYTES and sum(todo[n]) - start <= READ_BYTES:
            end, n = max(end, sum(todo[n])), n + 1
        yield start, end, todo[:n]
        todo = todo[n:]


def read(manifest: DataFrame, task_bytes: int = MEMBER_BYTES) -> DataFrame:
    """Every record of the packages, read by range, in as many tasks as the packages'
    bytes ask for: ``task_bytes`` each."""
    size = manifest.agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")).first()
    tasks = max(1, -(-(size["bytes"] or 0) // task_bytes), size["n"])
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for place in batch.to_pylist():
                system, name = _open(place["path"])
                with system.open_input_file(name) as file:
                    for start, end, inside in ranges(place["offsets"], place["lengths"]):
                        data = file.read_at(end - start, place["data_start"] + start)
                        found = [parse_record(zlib.decompress(data[a - start:a - start + n], 31)) for a, n in inside]
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
    return places(manifest).repartition(tasks).mapInArrow(run, RECORDS)
