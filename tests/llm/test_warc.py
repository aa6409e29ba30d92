import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from plumbline.llm import warc


def expected(rows):
    first = {}
    for page, html in sorted(rows):
        first.setdefault((html or "").encode(), page)
    out = {}
    for page, html in rows:
        raw = (html or "").encode()
        origin = first[raw]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[page] = (len(raw), digest, "response" if origin == page else "revisit", None if origin == page else origin)
    return out


def by_page(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


def test_query_equals_brute_force(spark, folder):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert by_page(warc.op1_warc(spark, folder)) == expected(rows)


def test_odd_pages_round_trip(spark):
    rows = [(1, None, None), (2, "u é", ""), (3, "http://x/?q=ü", "<p>ß</p>"), (9, "x", "<p>ß</p>"), (7, "x\r\ny", "\r\n\r\nWARC/1.1"), (8, "z", "a" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("first", F.lit(1)).withColumn("payload", F.lit(2))
    read = warc.round_trip(spark, pages.repartition(3), payload=True)
    assert by_page(read) == expected([(a, c) for a, _, c in rows])
    payloads = {r["page_id"]: r["payload"] for r in read.collect()}
    assert payloads[8] == bytearray(b"a" * 3_000_000) and payloads[9] is None and payloads[7] == b"\r\n\r\nWARC/1.1"


def test_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    found = by_page(warc.round_trip(spark, pages, min_bytes=3))
    assert [found[i][3] for i in (1, 2, 3, 4)] == [None, None, None, 3]


def test_repeated_id_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (1, "u", "ab"), (2, "u", "ab")], "page_id bigint, url string, html string")
    assert sorted((r["page_id"], r["record_type"]) for r in warc.round_trip(spark, pages).collect()) == [(1, "response"), (1, "response"), (2, "revisit")]
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_null_id_is_an_error(spark):
    pages = spark.createDataFrame([(None, "u", "ab")], "page_id bigint, url string, html string")
    with pytest.raises(Exception, match="no id"):
        warc.round_trip(spark, pages).collect()


def test_each_record_is_a_gzip_member_and_faults_are_found():
    members = [warc.page_record(i, "u", b"x" * i, None, "2026-01-01T00:00:00Z") for i in range(3)]
    for m in members:
        assert gzip.decompress(m).startswith(b"WARC/1.1\r\n")
    whole = b"".join(members)
    assert [len(r["payload"]) for r in warc.read_records(io.BytesIO(whole))] == [0, 1, 2]
    plain = gzip.decompress(members[2])
    for broken in (plain.replace(b"xx\r\n", b"xy\r\n"), plain[:-4], plain + b"z", plain.replace(b"WARC/1.1", b"nope")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(gzip.compress(broken))))
    for broken in (whole[:-5], b"junk" + whole):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))
