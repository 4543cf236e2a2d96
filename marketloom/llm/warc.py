"""WARC records in ZIP packages: writing them, and reading them by byte ranges.

A package is a ZIP file whose members are stored, not compressed: `archive/*.warc.gz`, of which
each record is compressed by itself, and `indexes/*.cdxj`, which says where each record lies.
Reading never extracts a package. The end of the file leads to the central directory, through
the ZIP64 records where the file has them; the directory leads to the members; an index gives
each record's range; and tasks read only the ranges of the records they are dealt.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch, table_join

#: Payload bytes after which a task closes a package and begins another.
PACKAGE_BYTES = 32 << 20
#: Bytes of a package that one task reads, and of one read, at most about so many.
RANGE_BYTES = 16 << 20
READ_BYTES = 4 << 20
#: Bytes of records for which there is one reading task.
TASK_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
COMPRESSION = 6

RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, "
    "date string, refers_to string, payload binary, payload_bytes long, payload_digest string, "
    "intact boolean"
)
RANGES = "path string, offset long, length long"

# Signatures and fixed sizes of the ZIP format. Fixed values.
END, END_BYTES = b"PK\x05\x06", 22
END64, END64_BYTES = b"PK\x06\x06", 56
LOCATOR64, LOCATOR64_BYTES = b"PK\x06\x07", 20
CENTRAL, CENTRAL_BYTES = b"PK\x01\x02", 46
LOCAL, LOCAL_BYTES = b"PK\x03\x04", 30
COMMENT_MOST = 0xFFFF
STORED, DEFLATED = 0, 8
BIG16, BIG32 = 0xFFFF, 0xFFFFFFFF
EXTRA64 = 1


class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int  # where its local header begins


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute local path, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


@contextmanager
def opened(path: str) -> Iterator[pa.NativeFile]:
    system, inner = file_system(path)
    with system.open_input_file(inner) as source:
        yield source


def read_range(source: pa.NativeFile, offset: int, length: int) -> bytes:
    source.seek(offset)
    found = source.read(length)
    if len(found) != length:
        raise ValueError(f"{length} bytes wanted at {offset}, {len(found)} there")
    return found


def directory(source: pa.NativeFile) -> list[Member]:
    """The members of a ZIP file, from its central directory."""
    whole = source.size()
    tail_at = max(0, whole - COMMENT_MOST - END_BYTES - LOCATOR64_BYTES)
    tail = read_range(source, tail_at, whole - tail_at)
    end = _end_of_directory(tail)
    number, size, offset = struct.unpack_from("<HLL", tail, end + 10)
    locator = end - LOCATOR64_BYTES
    if locator >= 0 and tail[locator : locator + 4] == LOCATOR64:
        (at,) = struct.unpack_from("<Q", tail, locator + 8)
        end64 = read_range(source, at, END64_BYTES)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of directory where its locator points")
        number, size, offset = struct.unpack_from("<QQQ", end64, 32)
    return list(_members(read_range(source, offset, size), number))


def _end_of_directory(tail: bytes) -> int:
    """Where the end record begins: the last one whose comment ends with the file."""
    at = tail.rfind(END)
    while at >= 0:
        if len(tail) - at >= END_BYTES:
            (comment,) = struct.unpack_from("<H", tail, at + 20)
            if at + END_BYTES + comment == len(tail):
                return at
        at = tail.rfind(END, 0, at)
    raise ValueError("no ZIP end of directory")


def _members(central: bytes, number: int) -> Iterator[Member]:
    at = 0
    for _ in range(number):
        if central[at : at + 4] != CENTRAL:
            raise ValueError("broken ZIP central directory")
        flags, method = struct.unpack_from("<HH", central, at + 8)
        packed, size, name_n, extra_n, comment_n = struct.unpack_from("<LLHHH", central, at + 20)
        (header,) = struct.unpack_from("<L", central, at + 42)
        name_at = at + CENTRAL_BYTES
        name = central[name_at : name_at + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = central[name_at + name_n : name_at + name_n + extra_n]
        size, packed, header = _extended(extra, [size, packed, header])
        yield Member(name, method, packed, size, header)
        at = name_at + name_n + extra_n + comment_n


def _extended(extra: bytes, values: list[int]) -> list[int]:
    """Size, packed size and header offset; those too large for 32 bits from the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if value == BIG32 else value for value in values]
        at += 4 + length
    return values


def data_offset(source: pa.NativeFile, member: Member) -> int:
    """Where a member's data begin: behind its local header, which is as long as it says."""
    header = read_range(source, member.header, LOCAL_BYTES)
    if header[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    name_n, extra_n = struct.unpack_from("<HH", header, 26)
    return member.header + LOCAL_BYTES + name_n + extra_n


def ranges(source: pa.NativeFile) -> Iterator[tuple[int, int]]:
    """(offset, length) in the package of each record, from its indexes.

    Archives are told apart by their whole path in the package. What no index mentions of an
    archive, all of it or the gaps between its records, is walked through, record by record. A
    record that is mentioned more than once is one record. An index that names an archive which is
    not there, or which two could be, and records that overlap or leave their archive are errors.
    """
    members = directory(source)
    archives = {
        member.name: member for member in members if re.search(r"\.warc(\.gz)?$", member.name)
    }
    for name, member in archives.items():
        if member.method != STORED:
            raise ValueError(f"{name} is compressed: its records have no ranges")
    indexed: dict[str, set[tuple[int, int]]] = {name: set() for name in archives}
    for member in members:
        if re.search(r"^indexes/.*\.cdxj?(\.gz)?$", member.name):
            for line in _index_lines(source, member):
                if "{" not in line:
                    continue
                entry = json.loads(line[line.index("{") :])
                name = _named(archives, entry["filename"])
                indexed[name].add((int(entry["offset"]), int(entry["length"])))
    for name, member in archives.items():
        start, at = data_offset(source, member), 0
        for offset, length in sorted(indexed[name]):
            if offset < at or offset + length > member.size:
                raise ValueError(f"an index puts a record of {name} where none can be: {offset}")
            yield from _walk(source, start + at, offset - at, name.endswith(".gz"))
            yield start + offset, length
            at = offset + length
        yield from _walk(source, start + at, member.size - at, name.endswith(".gz"))


def _named(archives: dict[str, Member], name: str) -> str:
    """The archive that an index means: by its path, that below archive/, or the end of it."""
    for whole in (name, f"archive/{name}"):
        if whole in archives:
            return whole
    found = [archive for archive in archives if archive.endswith(f"/{name}")]
    if len(found) != 1:
        raise ValueError(f"{len(found)} archives could be the {name} of an index")
    return found[0]


def _index_lines(source: pa.NativeFile, member: Member) -> Iterator[str]:
    data = read_range(source, data_offset(source, member), member.packed)
    if member.method == DEFLATED:
        data = zlib.decompress(data, -zlib.MAX_WBITS)
    elif member.method != STORED:
        raise ValueError(f"unknown compression of {member.name}")
    if member.name.endswith(".gz"):
        data = gzip.decompress(data)
    yield from io.TextIOWrapper(io.BytesIO(data), encoding="utf-8")


def _walk(
    source: pa.NativeFile, start: int, size: int, zipped: bool
) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record in a part of the package, without keeping what is read."""
    if not zipped:
        yield from _walk_plain(source, start, size)
        return
    at, begun, unzip, left = 0, 0, zlib.decompressobj(zlib.MAX_WBITS | 16), b""
    while at < size or left:
        if not left:
            left = read_range(source, start + at, min(READ_BYTES, size - at))
            at += len(left)
        unzip.decompress(left)
        left = unzip.unused_data
        if unzip.eof:
            end = at - len(left)
            yield start + begun, end - begun
            begun, unzip = end, zlib.decompressobj(zlib.MAX_WBITS | 16)
    if begun < size:
        raise ValueError(f"a record at {start + begun} is cut off")


def _walk_plain(source: pa.NativeFile, start: int, size: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < size:
        head = read_range(source, start + at, min(READ_BYTES, size - at))
        if not head.strip(b"\r\n"):  # an index may leave the line ends behind a record out
            at += len(head)
            continue
        lead = len(head) - len(head.lstrip(b"\r\n"))
        end = head.index(b"\r\n\r\n", lead) + 4
        length = end - lead + int(_fields(head[lead:end])["content-length"]) + 4
        yield start + at + lead, length
        at += lead + length


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_record(data: bytes) -> tuple:
    """The columns of RECORD behind path and offset.

    payload is null for records that have none. Where the payload is there, payload_bytes and
    payload_digest are its own, and `intact` says whether the header names the same digest;
    otherwise they are those the record states.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    end = data.index(b"\r\n\r\n") + 4
    fields = _fields(data[:end])
    block = data[end : end + int(fields["content-length"])]
    kind = fields.get("warc-type")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload, size, found = None, None, stated
    if fields.get("content-type", "").startswith("application/http"):
        http, split, body = block.partition(b"\r\n\r\n")
        if kind == "revisit":
            length = _fields(http).get("content-length")
            size = int(length) if length else None
        else:
            payload = body
    elif kind != "revisit":
        payload = block
    if payload is not None:
        size, found = len(payload), digest(payload)
    return (
        kind,
        fields.get("warc-record-id"),
        fields.get("warc-target-uri"),
        fields.get("warc-date"),
        fields.get("warc-refers-to"),
        payload,
        size,
        found,
        stated is None or found == stated,
    )


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    payload_digest: str,
    revisit: bool,
    refers_to: int | None,
    date: str = DATE,
) -> bytes:
    """One compressed WARC record; a revisit has the HTTP header, but not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{page_urn(page_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', _escaped, url)}")
    if revisit:
        head.append(f"WARC-Refers-To: <{page_urn(refers_to)}>")
        head.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, COMPRESSION, mtime=0)


def _escaped(found: re.Match) -> str:
    return f"%{ord(found[0]):02X}"


def page_urn(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid4()}" if page_id is None else f"urn:page:{page_id}"


def package(records: list[bytes], name: str) -> bytes:
    """A ZIP package of records, its members stored and with ZIP64 fields."""
    archive, at, index = f"{name}.warc.gz", 0, []
    for data in records:
        entry = {"filename": archive, "offset": str(at), "length": str(len(data))}
        index.append(f"{len(index):012d} {json.dumps(entry)}\n")
        at += len(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as target:
        members = (
            (f"archive/{archive}", records),
            (f"indexes/{name}.cdxj", [line.encode() for line in index]),
        )
        for member, parts in members:
            info = zipfile.ZipInfo(member)
            info.file_size = sum(map(len, parts))
            with target.open(info, "w", force_zip64=True) as stored:
                for part in parts:
                    stored.write(part)
    return out.getvalue()


def write(scratch: Scratch, typed: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Write packages of `typed` pages into `folder`; their paths, in a table.

    Each attempt of a task names its files anew, and the table has those of the attempts that
    counted. Files of lost attempts stay unread.
    """

    def flush(records: list[bytes]) -> str:
        name = uuid.uuid4().hex
        system, inner = file_system(folder)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{name}.zip") as target:
            target.write(package(records, name))
        return f"{folder}/{name}.zip"

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, records, held = [], [], 0
        for batch in batches:
            for page_id, url, html, found, revisit, refers_to in zip(*batch.columns):
                payload = (html.as_py() or "").encode("utf-8")
                sha = base64.b32encode(found.as_py()).decode()
                records.append(
                    record(
                        page_id.as_py(), url.as_py(), payload, sha,
                        revisit.as_py(), refers_to.as_py(), date,
                    )
                )
                held += len(records[-1])
                if held >= PACKAGE_BYTES:
                    paths.append(flush(records))
                    records, held = [], 0
        if records:
            paths.append(flush(records))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    columns = typed.select("page_id", "url", "html", "digest", "revisit", "refers_to")
    return scratch.table(columns.mapInArrow(store, "path string"))


def with_types(scratch: Scratch, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with digest (binary), revisit and refers_to.

    Of pages with equal payloads of at least `least_bytes` bytes, those with the largest page_id
    are responses, and the others revisit it; a null page_id is the smallest. Only digests that
    occur more than once are looked up.
    """
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.withColumns(
        {"digest": F.unhex(F.sha1(payload)), "payload_bytes": F.octet_length(payload)}
    )
    repeated = scratch.table(
        keyed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "response_id", F.lit(True).alias("found"))
    )
    joined = table_join(keyed, repeated, ["digest"], ["page_id", "url"], "left")
    revisit = (
        F.coalesce("found", F.lit(False))
        & (F.col("payload_bytes") >= least_bytes)
        & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    )
    return joined.withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("response_id"))
    )


def records(packages: DataFrame) -> DataFrame:
    """All records (RECORD) of the packages whose URIs are in the column `path`.

    The packages' indexes become rows, one per record, in a written table. They are dealt out by
    stretches of RANGE_BYTES to tasks whose number follows from the bytes that are to be read, as
    the rows themselves are small, and a task reads neighbours in one go.
    """
    scratch = Scratch(packages.sparkSession)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as source:
                    found = list(ranges(source))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(found), pa.string()),
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([x[1] for x in found], pa.int64()),
                    ],
                    ["path", "offset", "length"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("offset", pa.int64())]
            + [(n, pa.string()) for n in ("record_type", "record_id", "target_uri", "date")]
            + [("refers_to", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
            + [("payload_digest", pa.string()), ("intact", pa.bool_())]
        )
        for batch in batches:
            wanted = sorted(zip(*(column.to_pylist() for column in batch.columns)))
            for path, stretch in _stretches(wanted):
                begin = stretch[0][0]
                with opened(path) as source:
                    data = read_range(source, begin, sum(stretch[-1]) - begin)
                rows = [
                    (path, offset, *parse_record(data[offset - begin : offset - begin + length]))
                    for offset, length in stretch
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)],
                    schema=schema,
                )

    located = packages.select("path").repartition("path").mapInArrow(locate, RANGES)
    located = scratch.table(located)
    stretch = F.floor(F.col("offset") / RANGE_BYTES)
    return located.repartition(_tasks(located), "path", stretch).mapInArrow(read, RECORD)


def _tasks(located: DataFrame) -> int:
    """Tasks that read about TASK_BYTES each."""
    total = located.agg(F.sum("length")).first()[0] or 0
    return max(1, -(-total // TASK_BYTES))


def _stretches(wanted: list[tuple]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Records that lie side by side, up to READ_BYTES of them."""
    held: list[tuple[int, int]] = []
    last = ""
    for path, offset, length in wanted:
        beside = held and last == path and sum(held[-1]) == offset
        if held and (not beside or offset + length - held[0][0] > READ_BYTES):
            yield last, held
            held = []
        held.append((offset, length))
        last = path
    if held:
        yield last, held


def page_number(urn: str) -> Column:
    """The page_id in a record's name; null for other names."""
    return F.expr(f"try_cast(regexp_extract({urn}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a record of each page into packages, read them back, and return what was read.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of each row. The
    payload is the html in UTF-8, empty for null. A page whose page_id is null gets a name of
    its own and reads null. Repeated rows are records of their own: those with the largest
    page_id of their payload are all responses. Urls may be null; control characters and spaces
    in them are escaped. Other columns are not read. An empty table gives an empty result.

    Very long payloads are written and read whole, one at a time in a task.
    """
    scratch = Scratch(pages.sparkSession)
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html")
    )
    paths = write(scratch, with_types(scratch, narrow, least_bytes), scratch.path())
    return records(paths).select(
        page_number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number("refers_to").alias("refers_to"),
        "intact",
    )
