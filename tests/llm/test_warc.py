"""Archives: exact round trips, revisits, and broken records that are reported."""

import base64
import hashlib
import struct

import pytest
from cases import SF_DIR, rows_of
from docflow.llm import queries, warc
from pyspark.errors import PythonException
from pyspark.sql import functions as F

PAGES = [
    (1, "http://a/ b%\n", "<p>é</p>"), (2, None, None), (3, "http://c", ""), (4, "http://d", "<p>é</p>"), (4, "http://d", "<p>é</p>"),
    (None, "http://n", "<p>é</p>"), (None, "x", "only without id"), (None, "y", "only without id"), (-5, "u", "WARC/1.1\r\n\r\n"),
    (7, "l", "long " * 400_000), (8, "日本", "\x00﻿"),
]


@pytest.fixture(scope="module")
def pages(ready):
    rows = [(*p, b"x", "y") for p in PAGES]
    return ready.createDataFrame(rows, "page_id bigint, url string, html string, payload binary, sha1 string").repartition(3)


def expected(smallest=0):
    latest = {}
    for i, _, h in PAGES:
        if i is not None:
            latest[h or ""] = max(i, latest.get(h or "", i))
    out = []
    for i, u, h in PAGES:
        body = (h or "").encode()
        revisit = len(body) >= smallest and (h or "") in latest and i != latest[h or ""]
        out.append((f"urn:x-page:{'' if i is None else i}", u, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", f"urn:x-page:{latest[h or '']}" if revisit else None,
                    None if revisit else body))
    return sorted(out, key=str)


@pytest.mark.parametrize("smallest", [0, 5])
def test_round_trip(pages, smallest):
    found = warc.round_trip(pages, smallest)
    names = ("record_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    assert found.where("error is not null").count() == 0
    got = sorted(((*r[:-1], None if r[-1] is None else bytes(r[-1])) for r in found.select(*names).collect()), key=str)
    assert got == expected(smallest)


def test_many_copied_payloads(pages):
    """Without a broadcast the records are the same."""
    key = lambda r: str(tuple(r))
    for smallest in (0, 5):
        short, long = (sorted(warc.page_records(pages, smallest, listed=n).collect(), key=key) for n in (100, 0))
        assert short == long and sum(r.refers_to is not None for r in long) > 1
        assert all((r.payload is None) == (r.refers_to is not None) for r in long)


def test_archives_are_files(pages, tmp_path):
    """Archives lie below their names alone, each with as many frames as records, and no staging is left."""
    found = warc.write_archives(warc.page_records(pages), str(tmp_path / "out"), archive_bytes=100).collect()
    files = {f.name: f.read_bytes() for f in (tmp_path / "out").iterdir() if not f.name.endswith(".crc")}
    assert {r.path: r.bytes for r in found} == {k: len(v) for k, v in files.items()}
    made = [x for data in files.values() for x in warc.frames(data)]
    assert len(made) == len(PAGES) and all(warc.parse(x) for x in made)


def test_a_failed_task_leaves_nothing(pages, tmp_path):
    bad = warc.page_records(pages).withColumn("sha1", F.when(F.col("record_id") == "urn:x-page:8", "no digest").otherwise(F.col("sha1")))
    with pytest.raises(PythonException):
        warc.write_archives(bad, str(tmp_path / "out"), archive_bytes=100)
    assert list((tmp_path / "out").iterdir()) == []


def test_empty(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_query_equals_sql(ready, sf_dir):
    from sql_check import compare

    assert compare(ready, SF_DIR, "op5_warc")


def records(n=40):
    body = [f"<html>{i} the same words again {i * i}</html>".encode() for i in range(n)]
    return body, [warc.record("response", f"urn:x-page:{i}", "u", warc.digest32(hashlib.sha1(b).hexdigest()), b, None) for i, b in enumerate(body)]


def test_dictionary_comes_first_and_frames_are_records():
    body, made = records()
    data = warc.archive(made)
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_FRAME
    assert list(warc.frames(data)) == made
    # a dictionary that is itself compressed
    import zstandard

    size = struct.unpack_from("<I", data, 4)[0]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    assert list(warc.frames(struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + data[8 + size :])) == made
    assert list(warc.frames(warc.archive(made[:2]))) == made[:2]  # too few records for a dictionary
    assert list(warc.frames(b"")) == []


def test_broken_archives(ready, tmp_path):
    body, made = records(3)
    wrong = made[1].replace(b"again 1", b"again 2")
    short = made[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    cut = warc.archive(made)[:-5]
    for name, data in (("good", warc.archive(made)), ("wrong", warc.archive([made[0], wrong, made[2]])),
                       ("short", warc.archive([short, made[2]])), ("cut", cut), ("noise", b"\x00" * 50), ("head", warc.archive([b"no header"]))):
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
    found = warc.read_archives(ready.read.format("binaryFile").load(str(tmp_path))).collect()
    by = {}
    for r in found:
        by.setdefault(r.path.split("/")[-1].split(".")[0], []).append(r.error)
    assert by["good"] == [None] * 3
    assert [bool(x) for x in by["wrong"]] == [False, True, False] and "digest" in by["wrong"][1]
    assert [bool(x) for x in by["short"]] == [True, False]
    assert by["cut"][:2] == [None, None] and by["cut"][2]
    assert len(by["noise"]) == 1 and by["noise"][0] and by["head"][0]


def test_rows_may_lack_content(ready):
    assert warc.read_archives(ready.createDataFrame([("a", None), ("b", b"")], "path string, content binary")).count() == 0


def test_query(ready, sf_dir):
    found = queries.QUERIES["op5_warc"](ready, sf_dir)
    assert rows_of(found, "page_id")[0] is not None and found.count() == ready.read.parquet(f"{sf_dir}/pages.parquet").count()
