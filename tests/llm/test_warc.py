import hashlib
import zlib

from pyspark.sql import functions as F

from lexirank.llm.warc import parse_record, payload_facts, read_records, write_archives

BIG = "x" * 150


def pages(spark):
    rows = [(1, "http://a/é?q=1\r\nX: y", BIG, 0), (2, None, BIG, 0), (2, None, BIG, 0), (3, "u", "tiny", 0), (4, "u", "tiny", 0), (5, "u", None, 0), (None, "u", BIG, 0), (6, "u", "é" * 60, 0), (7, "u", "L" * 3_000_000, 0)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)


def test_round_trip(spark):
    index = write_archives(pages(spark))
    facts = payload_facts(read_records(index)).collect()
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in facts))
    assert got == sorted([(0, "revisit", 1, 150), (1, "response", None, 150), (2, "revisit", 1, 150), (2, "revisit", 1, 150), (3, "response", None, 4), (4, "response", None, 4), (5, "response", None, 0), (6, "response", None, 120), (7, "response", None, 3_000_000)])
    assert {r.payload_digest for r in facts if r.page_id == 2} == {hashlib.sha256(BIG.encode()).hexdigest()}


def test_index_names_members_of_plain_gzip_files(spark):
    index = write_archives(pages(spark)).collect()
    for r in index:
        with open(r.path.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            headers, payload = parse_record(f.read(r.length))
        assert headers["warc-type"] == r.record_type
        assert len(payload) == (r.payload_bytes if r.record_type == "response" else 0)
    by_file = {}
    for r in index:
        by_file.setdefault(r.path, []).append(r)
    for path, rows in by_file.items():
        data = open(path.removeprefix("file://"), "rb").read()
        assert sum(r.length for r in rows) == len(data)
        text = b""
        while data:
            d = zlib.decompressobj(31)
            text += d.decompress(data)
            data = d.unused_data
        assert text.count(b"WARC/1.1\r\n") == len(rows)


def test_some_records_and_none(spark):
    index = write_archives(pages(spark))
    assert sorted(r.page_id for r in read_records(index.where("page_id in (3, 6)")).collect()) == [3, 6]
    assert read_records(index.where("false")).count() == 0
    assert write_archives(pages(spark).limit(0)).count() == 0
    assert index.where(F.col("page_id") == 1).first().url == "http://a/é?q=1\r\nX: y"
