r"""Web archives: WARC records as one zstd frame each, with a dictionary in front, and their reader.

A file begins with a skippable frame that holds the compression dictionary (magic 0x184D2A5D). Every record is
one frame and can be decompressed alone. Files are written through Spark's text writer, whose separator is an
empty skippable frame, so any store that Spark can write to will do and any zstd reader passes over it.

Of records with the same payload the one with the smallest page_id is a response, others are revisits that
refer to it. Payloads count as the same when SHA-1 and length agree, as the format has it.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm.common import scratch_path, stored, table, text_of

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: What Spark writes between records: an empty skippable frame.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: Bytes of payload that one file holds before the next is begun.
FILE_BYTES = 64 << 20
DICTIONARY_BYTES = 16 << 10
LEVEL = 3


class ArchiveError(ValueError):
    """A record that is not what its headers say."""


def raw_dictionary(samples: list[bytes]) -> bytes:
    """A raw-content dictionary: beginnings of some payloads, the first record's last (nearest is cheapest)."""
    share = DICTIONARY_BYTES // max(1, len(samples))
    return HTTP + b"".join(s[:share] for s in reversed(samples))


def record(page_id, url, kind: str, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    """One WARC record. A revisit has HTTP headers only; its digest and size are those of the payload it spares."""
    block = HTTP + b"Content-Length: %d\r\n\r\n" % size + (payload if kind == "response" else b"")
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and payload of one record; raises ArchiveError where lengths or digests do not agree."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ArchiveError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon:
            raise ArchiveError(f"header line without a value: {line[:80]!r}")
        fields[name.lower()] = value
    if not fields.get("content-length", "").isdigit():
        raise ArchiveError("Content-Length is absent or no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length {size} in a record with {len(rest) - 4} bytes")
    block = rest[:size]
    if _sha1(block) != fields.get("warc-block-digest"):
        raise ArchiveError("block digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    stated = [line for line in http.split(b"\r\n") if line.startswith(b"Content-Length: ")]
    if not found or len(stated) != 1:
        raise ArchiveError("no HTTP header")
    fields["payload-bytes"] = int(stated[0][16:])
    if fields.get("warc-type") == "response":
        if len(payload) != fields["payload-bytes"] or _sha1(payload) != fields.get("warc-payload-digest"):
            raise ArchiveError("payload length or digest differs")
    elif fields.get("warc-type") != "revisit" or payload or "warc-refers-to" not in fields:
        raise ArchiveError("neither a response nor a revisit")
    return fields | {"payload": payload}


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def frames(data: memoryview):
    """(magic, frame) of each frame of a file, in order; skippable ones too."""
    import zstandard

    at = 0
    while at < len(data):
        if len(data) - at < 8:
            raise ArchiveError("a frame is cut off")
        magic, size = struct.unpack("<II", data[at : at + 8])
        if magic in SKIPPABLE:
            end = at + 8 + size
        elif magic == 0xFD2FB528:
            end = at + _frame_size(data[at:], zstandard)
        else:
            raise ArchiveError(f"unknown magic {magic:#x}")
        if end > len(data):
            raise ArchiveError("a frame is cut off")
        yield magic, data[at:end]
        at = end


def _frame_size(data: memoryview, zstandard) -> int:
    """Length of the frame that begins ``data``: its header, then blocks that each state their size."""
    header = zstandard.frame_header_size(data)
    checksum = zstandard.get_frame_parameters(data).has_checksum
    at = header
    while True:
        if len(data) - at < 3:
            raise ArchiveError("a frame is cut off")
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
        if last:
            return at + (4 if checksum else 0)


def read_archive(data: memoryview):
    """The records of one file; an empty file has none."""
    import zstandard

    unpack = None
    for magic, frame in frames(data):
        if magic == DICTIONARY_MAGIC:
            if unpack is not None:
                raise ArchiveError("the dictionary does not lead the file")
            content = zstandard.ZstdCompressionDict(bytes(frame[8:]), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            unpack = zstandard.ZstdDecompressor(dict_data=content)
        elif magic not in SKIPPABLE:
            if unpack is None:
                unpack = zstandard.ZstdDecompressor()
            try:
                yield parse(unpack.decompress(frame))
            except zstandard.ZstdError as e:
                raise ArchiveError(str(e)) from None


def _write(file_bytes: int):
    """Function for mapInArrow: pages to the frames of files; one row is the content of one file."""

    def run(batches):
        import zstandard

        frames_, size, pack = [], 0, None

        def close():
            nonlocal size, pack
            whole = b"".join(frames_)
            frames_.clear()
            size, pack = 0, None
            return pa.RecordBatch.from_pydict({"content": [whole]}, schema=pa.schema([("content", pa.binary())]))

        for rows in (batch.slice(i, 256).to_pylist() for batch in batches for i in range(0, batch.num_rows, 256)):
            for i, r in enumerate(rows):
                if pack is None:
                    content = raw_dictionary([x["payload"] for x in rows[i : i + 8]])
                    frames_.append(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
                    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
                digest = base64.b32encode(r["sha1"]).decode()
                kind = "revisit" if r["revisit"] else "response"
                made = record(r["page_id"], r["url"], kind, digest, r["size"], r["first_id"], r["payload"])
                frames_.append(pack.compress(made))
                size += len(made)
                if size >= file_bytes:
                    yield close()
        if frames_:
            yield close()

    return run


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``.

    Null html counts as empty, a null url too. Payloads smaller than ``least_bytes`` are never revisits. A row
    with a null page_id is a response unless some other row has its payload and an id; rows that share the
    smallest page_id of a payload are each a response. An empty table writes no record.
    """
    payload = text_of("html").cast("binary")
    marks = pages.select("page_id", F.unhex(F.sha1(payload)).alias("sha1"), F.length(payload).alias("size"))
    groups = (
        marks.where(F.col("size") >= least_bytes).groupBy("sha1", "size")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
    )
    first = stored(groups.select("sha1", "size", "first_id"), "first-pages")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.unhex(F.sha1("payload")), "size": F.length("payload")})
    # Plain shuffles on both sides: adaptive execution splits a payload that fills a partition.
    decided = rows.join(first.hint("merge"), ["sha1", "size"], "left").withColumn(
        "revisit", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    files = decided.mapInArrow(_write(file_bytes), "content binary")
    (
        files.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record below ``path``, and
    the payload where asked for (null for revisits). Fails on a record that does not keep to its headers."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
    schema = pa.schema(list(zip(names, kinds)))

    def number(value: str | None) -> int | None:
        return int(value[10:-1]) if value and value[10:-1] else None

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for r in read_archive(memoryview(content.as_buffer())):
                    row = [
                        number(r["warc-record-id"]),
                        r["warc-target-uri"],
                        r["payload-bytes"],
                        r["warc-payload-digest"].removeprefix("sha1:"),
                        r["warc-type"],
                        number(r.get("warc-refers-to")),
                    ]
                    rows.append(row + [r["payload"] if r["warc-type"] == "response" else None] * payloads)
                    if len(rows) == 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    shape = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.mapInArrow(run, shape + ", payload binary" * payloads)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("url")
