import base64
import gzip
import hashlib
import io
import json
import random
import zipfile

import pyarrow as pa
import pytest

from marketloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, row string, n string"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "x", "x") for row in rows], SCHEMA)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    best = {}
    for page_id, _, html in rows:
        key = html or ""
        if page_id is not None and (key not in best or best[key] is None or page_id > best[key]):
            best[key] = page_id
        best.setdefault(key, None)
    for page_id, _, html in rows:
        size = len((html or "").encode())
        other = best[html or ""]
        again = size >= least and page_id != other
        yield page_id, size, sha(html), "revisit" if again else "response", other if again else None


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, monkeypatch, least):
    rng = random.Random(least)
    rows = [(i, f"http://h/{i}", rng.choice(["a", "bb", "é漢\r\n\r\nx", "x" * 500])) for i in range(60)]
    rows += [(100, None, None), (101, "a b\r\nWARC-Type: x", ""), (None, "u", "a"), (None, "u", "own")]
    rows += [(7, "u", rows[7][2]), (200, "u", "big" * 400_000), (-5, "u", "negative")]
    found = warc.archived(pages(spark, rows), least).collect()
    assert all(row["intact"] for row in found)
    assert sorted(map(repr, (tuple(r)[:5] for r in found))) == sorted(
        map(repr, expected(rows, least))
    )


def test_records_keep_payloads_and_urls(spark, tmp_path):
    rows = [(1, "http://h/ä b", "<p>\r\n\r\nx</p>"), (2, None, ""), (3, "u", None)]
    scratch = warc.Scratch(spark)
    typed = warc.with_types(scratch, pages(spark, rows).select("page_id", "url", "html"))
    paths = warc.write(scratch, typed, f"file://{tmp_path}/packages")
    found = {r["record_id"]: r for r in warc.records(paths).collect()}
    assert bytes(found["<urn:page:1>"]["payload"]) == b"<p>\r\n\r\nx</p>"
    assert found["<urn:page:1>"]["target_uri"] == "http://h/ä%20b"
    assert found["<urn:page:2>"]["refers_to"] == "<urn:page:3>"
    assert found["<urn:page:2>"]["payload"] is None and found["<urn:page:2>"]["target_uri"] is None


def members(data):
    return warc.directory(pa.BufferReader(data))


def archive(names, comment=b"", **limits):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as target:
        for name, data in names:
            target.writestr(name, data)
        target.comment = comment
    return out.getvalue()


def test_directory_with_a_comment_that_looks_like_an_end():
    data = archive([("a", b"1"), ("dir/é", b"22")], comment=b"PK\x05\x06" + b"\0" * 30)
    found = members(data)
    assert [(m.name, m.size) for m in found] == [("a", 1), ("dir/é", 2)]
    source = pa.BufferReader(data)
    assert warc.read_range(source, warc.data_offset(source, found[1]), 2) == b"22"


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 3)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = archive([("a", b"12345"), ("b", b"1"), ("c", b"123456789")])
    assert warc.LOCATOR64 in data and warc.END64 in data
    found = members(data)
    assert [(m.name, m.size) for m in found] == [("a", 5), ("b", 1), ("c", 9)]
    source = pa.BufferReader(data)
    assert [warc.read_range(source, warc.data_offset(source, m), m.size) for m in found] == [
        b"12345", b"1", b"123456789",
    ]


def test_not_a_zip_file():
    with pytest.raises(ValueError):
        members(b"no zip file at all, but long enough to be one of a kind")


def records():
    return [warc.record(i, f"u{i}", b"p" * i, warc.digest(b"p" * i), False, None) for i in range(5)]


@pytest.mark.parametrize("kind", ["compressed index", "no index", "plain, no index"])
def test_ranges(kind):
    parts = records()
    if kind == "plain, no index":
        parts = [gzip.decompress(p) for p in parts]
    name = "x.warc" if kind == "plain, no index" else "x.warc.gz"
    out, at, lines = io.BytesIO(), 0, []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as target:
        target.writestr(f"archive/{name}", b"".join(parts))
        for n, part in enumerate(parts):
            entry = json.dumps({"filename": name, "offset": at, "length": len(part)})
            lines.append(f"com,u{n})/ 2020 {entry}\n")
            at += len(part)
        if kind == "compressed index":
            index = gzip.compress("".join(["!meta\n", *lines]).encode())
            target.writestr("indexes/i.cdxj.gz", index, zipfile.ZIP_DEFLATED)
    source = pa.BufferReader(out.getvalue())
    found = sorted(warc.ranges(source))
    assert [warc.read_range(source, *r) for r in found] == parts
    payloads = [warc.parse_record(warc.read_range(source, *r))[5] for r in found]
    assert payloads == [b"p" * i for i in range(5)]


def packed(archives, lines):
    """A package of archives and one index with (archive, offset, length) lines."""
    index = "".join(
        "com,u)/ 2020 " + json.dumps({"filename": f, "offset": o, "length": n}) + "\n"
        for f, o, n in lines
    )
    members = [(name, b"".join(parts)) for name, parts in archives.items()]
    return pa.BufferReader(archive([*members, ("indexes/i.cdxj", index.encode())]))


def read_all(source):
    return sorted(warc.read_range(source, *found) for found in warc.ranges(source))


@pytest.mark.parametrize("named", ["", "a/x.warc.gz", "archive/a/x.warc.gz"])
def test_archives_of_one_name_in_two_folders(named):
    parts = records()
    archives = {"archive/a/x.warc.gz": parts[:2], "archive/b/x.warc.gz": parts[2:]}
    lines = [(named, 0, len(parts[0]))] if named else []
    assert read_all(packed(archives, lines)) == sorted(parts)


@pytest.mark.parametrize("name", ["x.warc.gz", "y.warc.gz"])
def test_an_index_that_names_no_one_archive_is_an_error(name):
    parts = records()
    archives = {"archive/a/x.warc.gz": parts[:2], "archive/b/x.warc.gz": parts[2:]}
    with pytest.raises(ValueError, match="archives could be"):
        list(warc.ranges(packed(archives, [(name, 0, len(parts[0]))])))


@pytest.mark.parametrize("kept", [[], [0], [2], [4], [1, 3], [0, 1, 2, 3, 4]])
@pytest.mark.parametrize("suffix", [".gz", ""])
def test_records_that_an_index_leaves_out_are_walked(kept, suffix):
    parts = records() if suffix else [gzip.decompress(part) for part in records()]
    lines, at = [], 0
    for n, part in enumerate(parts):
        # a plain record may be indexed without the line ends behind it
        short = 0 if suffix or n % 2 else 4
        lines += [(f"x.warc{suffix}", at, len(part) - short)] * (2 if n in kept else 0)
        at += len(part)
    source = packed({f"archive/x.warc{suffix}": parts}, lines)
    found = [part.rstrip(b"\r\n") if not suffix else part for part in read_all(source)]
    assert found == sorted(part.rstrip(b"\r\n") if not suffix else part for part in parts)


def test_records_that_overlap_or_leave_their_archive_are_errors():
    parts = records()
    for lines in ([(0, 10), (5, 10)], [(0, 10**6)]):
        with pytest.raises(ValueError, match="where none can be"):
            list(warc.ranges(packed({"archive/x.warc.gz": parts}, [("x.warc.gz", *x) for x in lines])))


def test_an_archive_cut_off_is_an_error():
    with pytest.raises(ValueError, match="cut off"):
        list(warc.ranges(packed({"archive/x.warc.gz": [records()[0][:-5]]}, [])))


def test_reading_tasks_follow_the_bytes(spark, monkeypatch):
    schema = "path string, offset long, length long"
    located = spark.createDataFrame([("p", n << 20, 1 << 20) for n in range(40)], schema)
    assert warc._tasks(located) == 5
    assert warc._tasks(located.limit(0)) == 1


def test_compressed_archive_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        target.writestr("archive/x.warc.gz", b"".join(records()))
    with pytest.raises(ValueError):
        list(warc.ranges(pa.BufferReader(out.getvalue())))


def test_damage_is_noticed():
    data = gzip.decompress(warc.record(1, "u", b"payload", warc.digest(b"payload"), False, None))
    assert warc.parse_record(data)[-1] is True
    assert warc.parse_record(data.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"))[-1] is False


def test_empty_table(spark):
    assert warc.archived(pages(spark, [])).collect() == []
