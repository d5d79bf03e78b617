"""Archives: what was written comes back, odd pages have defined results, damage is noticed."""

from __future__ import annotations

import base64
import hashlib
import struct

import pytest
import zstandard

from obsframe.llm import warc
from tests.conftest import SMALL


def expected(pages, least=0):
    """Brute force of the contract."""
    first = {}
    for page_id, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        head = first.get(html or "")
        again = len(data) >= least and head is not None and page_id != head
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert found(warc.op7_warc(spark, SMALL)) == expected(pages)


ODD = [(5, "a\r\n\r\nb"), (3, "a\r\n\r\nb"), (3, "a\r\n\r\nb"), (None, "a\r\n\r\nb"), (None, "alone"), (1, None), (2, ""), (9, "é" * 100_000), (10, "x\x00\n")]


@pytest.mark.parametrize("least", [0, 3])
def test_odd_pages_in_small_files(spark, tmp_path, least):
    rows = [(i, h, "http://x/\r\n é" if i == 9 else None, "w") for i, h in ODD]
    df = spark.createDataFrame(rows, "page_id long, html string, url string, sha1 string")
    warc.write_archives(df, f"{tmp_path}/w", least_bytes=least, file_bytes=10)
    back = warc.read_archives(spark, f"{tmp_path}/w", payloads=True)
    assert found(back) == expected(ODD, least)
    kept = {r.page_id: (r.payload, r.url) for r in back.collect() if r.record_type == "response" and r.page_id}
    assert bytes(kept[9][0]) == ("é" * 100_000).encode() and kept[9][1] == "http://x/ é"


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").collect() == []


def archive(records):
    content = b"some common words of pages"
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    pack = zstandard.ZstdCompressor(dict_data=d, write_checksum=True).compress
    return struct.pack("<II", warc.DICTIONARY_MAGIC, len(content)) + content + b"".join(map(pack, records)) + warc.SEPARATOR.encode()


def test_damage_is_noticed():
    digest = warc._sha1(b"payload")[5:]
    good = warc.record(1, "u", "response", digest, 7, None, b"payload")
    assert [r["payload"] for r in warc.read_archive(memoryview(archive([good, good])))] == [b"payload"] * 2
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/0.9"),
        good.replace(b"payload\r\n\r\n", b"payloads\r\n\r\n"),
        good.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"),
        good[:-2],
        good.replace(b"WARC-Date: ", b"WARC-Date"),
        warc.record(1, "u", "response", digest, 8, None, b"payload"),
    ):
        with pytest.raises(warc.ArchiveError):
            list(warc.read_archive(memoryview(archive([bad]))))
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(memoryview(archive([good])[:-20])))
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(memoryview(b"not an archive")))
