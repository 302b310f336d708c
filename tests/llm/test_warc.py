import base64
import hashlib
import io
from collections import Counter

import pytest
import zstandard

from tallyworks.llm import queries, warc
from tallyworks.session import new_folder

PAGES = "page_id long, url string, html string, first long, digest string, record_id string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "r") for r in rows], PAGES)


ROWS = [
    (3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, "http://a/2", None), (5, None, ""), (4, "http://a/4", "é\r\n\r\nWARC/1.1\r\n"),
    (6, "http://a/6", "x" * 300_000), (7, "http://a/7\r\nWARC-Type: warcinfo", "line"), (8, "http://a/8", "same"), (None, "http://a/n", "same"),
    (9, "http://a/9", "again"), (9, "http://a/9", "again"), (10, "u", "again"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    first = {}
    for i, _, html in ROWS:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    for i, _, html in ROWS:
        again = i is None or i > first[html or ""]
        want["" if i is None else str(i), "revisit" if again else "response", str(first[html or ""]) if again else None, digest(html), len((html or "").encode())] += 1
    got = warc.archive_round_trip(pages(spark, ROWS), frame_bytes=2000).collect()
    assert Counter((r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in got) == want


def test_small_payloads_are_all_responses(spark):
    got = warc.archive_round_trip(pages(spark, ROWS), revisit_bytes=5).collect()
    assert sorted(r.record_id for r in got if r.record_type == "revisit") == ["10"]


def test_random_access_and_frames(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i % 40)) for i in range(500)]
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(pages(spark, rows).repartition(3), folder, frame_bytes=4000, archive_bytes=1000)
    assert index.select("archive").distinct().count() > 3
    wanted = index.where("record_id IN ('17', '18', '333')")
    got = {r.record_id: bytes(r.payload).decode() for r in warc.read_records(wanted).collect() if r.payload is not None}
    assert set(got) <= {"17", "18", "333"} and all(text == f"page {i} " * (int(i) % 40) for i, text in got.items())
    # frames decompress on their own, and the whole file is one Zstandard stream for other readers
    path = index.first().archive.removeprefix("file:")
    data = open(path, "rb").read()
    table = warc.frames(index.where(index.archive == index.first().archive)).orderBy("frame").collect()
    parts = [zstandard.ZstdDecompressor().decompress(data[t.frame_offset : t.frame_offset + t.frame_bytes]) for t in table]
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert b"".join(parts) == whole and len(parts) > 2
    one = index.where("record_id = '18'").first()
    start = parts if one.archive == index.first().archive else None
    if start:
        assert start[one.frame][one.offset : one.offset + 8] == b"WARC/1.1"


def test_files_out_of_the_index_are_not_read(spark):
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(pages(spark, ROWS[:2]), folder)
    stray = warc.Bundle(f"{folder}/part-000000-99-0.warc.zst", 1000, "1970-01-01T00:00:00Z")
    stray.add("99", warc.record_bytes("99", "u", b"lost", hashlib.sha1(b"lost").digest(), None, "d"))
    stray.close()
    assert sorted(r.record_id for r in warc.read_archives(index).collect()) == ["1", "3"]


def test_damage_is_found(spark):
    folder = new_folder(spark, "warc-test")
    spark.range(1).write.parquet(folder)
    bundle = warc.Bundle(f"{folder}/a.warc.zst", 1000, "d")
    bundle.add("1", warc.record_bytes("1", "u", b"text", hashlib.sha1(b"other").digest(), None, "d"))
    bundle.close()
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archives(spark.createDataFrame([(bundle.path,)], "archive string")).collect()


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_query_with_null_ids(spark):
    folder = new_folder(spark, "warc-pages")
    pages(spark, ROWS).write.parquet(f"{folder}/pages.parquet")
    got = queries.QUERIES["op1_warc_round_trip"](spark, folder).collect()
    assert Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in got)[None, digest("same"), "revisit", 1] == 1
    assert len(got) == len(ROWS)


def test_reading_back_takes_as_many_tasks_as_the_bytes_ask_for(spark):
    rows = [(i, f"http://h/{i}", f"{i * 7919 % 10007} " * 40) for i in range(600)]
    index = warc.write_archives(pages(spark, rows), new_folder(spark, "warc-test"), frame_bytes=2000)
    total = warc.frames(index).agg({"frame_bytes": "sum"}).first()[0]
    read = warc.read_archives(index, read_bytes=total // 10)
    assert read.rdd.getNumPartitions() >= 10 and read.count() == 600
