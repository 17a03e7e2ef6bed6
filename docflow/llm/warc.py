"""Zstandard-compressed WARC archives, written and read back.

An archive is a ``.warc.zst`` file that starts with a skippable frame that holds
its dictionary; then each record is one frame. An archive of fewer than 16
records, or of records from which no dictionary can be trained, has none. Tasks
write archives to a staging folder; the list of what finished tasks wrote is a
table, and a second job moves those to their names, so a task that fails or runs
twice leaves nothing. Spark's ``binaryFile`` source reads them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import BROADCAST_ROWS, written
from docflow.session import scratch_dir

# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
ID = "urn:x-page:"

ARCHIVE_BYTES = 4_000_000
DICTIONARY_BYTES = 16_384
SAMPLE_BYTES = 1_000_000
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "path string, number bigint, record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, error string"
)


def digest32(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def record(
    kind: str, record_id: str, uri: str | None, digest: str, payload: bytes | None, refers_to: str | None, size: int | None = None,
) -> bytes:
    """One record; a revisit keeps the headers of the exchange, with the payload's ``size``, and leaves the payload out."""
    block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    if uri is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20%]", lambda m: f"%{ord(m[0]):02X}", uri)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], level: int = 3) -> bytes:
    """The records as frames after the frame of a dictionary trained on some of them."""
    samples, size = [], 0
    for x in records:
        if size >= SAMPLE_BYTES:
            break
        samples.append(x[:65536])
        size += len(samples[-1])
    dictionary = None
    if len(samples) >= 16:
        try:
            dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 4 + 256), samples, k=256, d=8)
        except zstandard.ZstdError:  # too little or too uniform to train on: an archive without dictionary
            dictionary = None
    out = b""
    if dictionary:
        data = dictionary.as_bytes()
        out = struct.pack("<II", DICTIONARY_FRAME, len(data)) + data
    press = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    return out + b"".join(map(press.compress, records))


def frames(content: bytes):
    """The decoded records of an archive, one frame at a time; raises ``ValueError`` where a frame is broken."""
    view, at, dictionary = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_FRAME:
        at = 8 + struct.unpack_from("<I", view, 4)[0]
        if at > len(view):
            raise ValueError("dictionary cut short")
        data = bytes(view[8:at])
        if data[:4] == struct.pack("<I", FRAME):
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        dictionary = zstandard.ZstdCompressionDict(data)
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        one, parts, step = unpack.decompressobj(), [], 8192
        while not one.eof:
            if at >= len(view):
                raise ValueError("frame cut short")
            piece = bytes(view[at : at + step])
            try:
                parts.append(one.decompress(piece))
            except zstandard.ZstdError as e:
                raise ValueError(f"bad frame: {e}") from e
            at += len(piece) - len(one.unused_data)
            step = min(2 * step, 1 << 20)
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """Fields and payload of a record; raises ``ValueError`` where headers or lengths are wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:40]!r}")
        fields[name.strip()] = value.strip()
    if missing := [x for x in REQUIRED if x not in fields]:
        raise ValueError(f"missing {', '.join(missing)}")
    if not fields["Content-Length"].isdigit() or len(rest) != int(fields["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("block length differs from Content-Length")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: (\d+)", http + b"\r\n")
    if not found or not length:
        raise ValueError("no length of the payload")
    kind, digest = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(length[1]):
            raise ValueError("payload length differs from its header")
        if digest and digest != digest32(hashlib.sha1(payload).hexdigest()):
            raise ValueError("payload differs from its digest")
    elif kind == "revisit" and (payload or "WARC-Refers-To" not in fields):
        raise ValueError("bad revisit")
    uri = fields.get("WARC-Target-URI")
    return {
        "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": kind,
        "target_uri": uri and re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), uri),
        "refers_to": fields["WARC-Refers-To"].strip("<>") if kind == "revisit" else None,
        "payload_digest": digest or None, "payload_bytes": int(length[1]),
        "payload": payload if kind == "response" else None, "error": None,
    }


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``(record_id, uri, payload, size, sha1, refers_to)`` as archives of about ``archive_bytes`` below ``folder``.

    Returns ``(path, bytes)`` of each file. A record with ``refers_to`` becomes a
    revisit, whose payload is not used. A record larger than ``archive_bytes`` ends
    its archive. All executors must reach the folder.
    """
    folder = folder.rstrip("/")
    staging = f"{folder}/.staging-{uuid.uuid4().hex}"

    def stage(batches):
        files, inside = _folder(staging)
        task, attempt, number, waiting, size = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, [], 0

        def done():
            name, data = f"part-{task:05d}-{number:05d}.warc.zst", archive(waiting)
            with files.open_output_stream(f"{inside}/{attempt}-{name}", compression=None) as out:  # it is compressed already
                out.write(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([f"{attempt}-{name}"]), pa.array([len(data)], pa.int64())], ["path", "staged", "bytes"])

        for batch in batches:
            for key, uri, payload, n, sha1, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(record("revisit" if refers else "response", key, uri, digest32(sha1), payload, refers, n))
                size += len(waiting[-1])
                if size >= archive_bytes:
                    yield done()
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield done()

    def move(batches):
        files, outside = _folder(folder)
        _, inside = _folder(staging)
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # a task that runs again finds its earlier moves done
                if files.get_file_info(f"{inside}/{name}").type != pafs.FileType.NotFound:
                    files.move(f"{inside}/{name}", f"{outside}/{path}")
            yield batch.select(["path", "bytes"])

    files, inside = _folder(staging)
    files.create_dir(inside, recursive=True)
    try:
        rows = records.select("record_id", "uri", "payload", "size", "sha1", "refers_to")
        listed = written(rows.mapInArrow(stage, "path string, staged string, bytes bigint"), "staged-archives")
        return written(listed.repartition("path").mapInArrow(move, "path string, bytes bigint"), "archives")
    finally:
        files.delete_dir(inside)


def load_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, content)`` of the archives below ``folder``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of ``(path, content)`` rows, with ``error`` where a record or the rest of an archive is bad.

    Null and empty contents have no records.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    text, number, binary = pa.string(), pa.int64(), pa.binary()
    types = [text, number, text, text, text, text, text, number, binary, text]

    def rows(path, content):
        n, source = 0, frames(content)
        while True:
            try:
                data = next(source)
            except StopIteration:
                return
            except ValueError as e:
                yield {"path": path, "number": n, "error": str(e)}
                return
            try:
                yield {"path": path, "number": n} | parse(data)
            except ValueError as e:
                yield {"path": path, "number": n, "error": str(e)}
            n += 1

    def run(batches):
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting, size = [], 0
                for row in rows(path, content or b""):
                    waiting.append(row)
                    size += len(row.get("payload") or b"")
                    if size > ARCHIVE_BYTES:
                        yield made(waiting)
                        waiting, size = [], 0
                yield made(waiting)

    def made(found):
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in found], t) for n, t in zip(names, types, strict=True)], names)

    return archives.select("path", "content").mapInArrow(run, RECORD)


def page_records(
    pages: DataFrame, smallest: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    listed: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(record_id, uri, payload, size, sha1, refers_to)`` of all rows of ``pages``; revisits have no payload.

    Of records with equal payloads of at least ``smallest`` bytes the one with
    the largest id is a response and the others are revisits of it; all smaller
    ones are responses. Null payloads are empty ones. Repeated rows that have the
    largest id are all responses; a null id is smaller than any other, and where
    a payload has null ids only, all are responses. Other columns are ignored.
    An empty table gives no records.

    Digests that occur more than once are counted first. Up to ``listed`` of them
    are broadcast and no payload is shuffled. Beyond that the revisits are told from
    digests and ids alone and joined by both, so copies of one payload are spread by their ids.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")})
    large = rows.where(F.col("size") >= smallest).select("sha1", "id")
    copied = written(
        large.groupBy("sha1").agg(F.max("id").alias("latest"), F.count("*").alias("n")).where("n > 1 and latest is not null")
        .select("sha1", "latest"), "copied-payloads")
    if copied.count() <= listed:
        known = rows.join(F.broadcast(copied), "sha1", "left")
    else:
        revisits = large.join(copied, "sha1").where(~F.col("id").eqNullSafe(F.col("latest"))).distinct().select(
            F.col("sha1").alias("of"), F.col("id").alias("by"), "latest")
        known = rows.join(revisits, (F.col("sha1") == F.col("of")) & F.col("id").eqNullSafe(F.col("by")), "left")
    revisit = F.col("latest").isNotNull() & ~F.col("id").eqNullSafe(F.col("latest"))
    name = F.concat(F.lit(ID), F.coalesce(F.col("id").cast("string"), F.lit("")))
    return known.select(
        name.alias("record_id"), "uri", F.when(~revisit, F.col("payload")).alias("payload"), "size", "sha1",
        F.when(revisit, F.concat(F.lit(ID), F.col("latest").cast("string"))).alias("refers_to"))


def page_of(urn):
    """The page id in a record's name, null where the page had none."""
    return F.nullif(F.replace(urn, F.lit(ID), F.lit("")), F.lit("")).cast("bigint")


def round_trip(pages: DataFrame, smallest: int = 0, folder: str | None = None) -> DataFrame:
    """Write all pages as archives below ``folder`` (a fresh one in the shared folder by default) and read the records back."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    write_archives(page_records(pages, smallest), folder)
    return read_archives(load_archives(pages.sparkSession, folder))
