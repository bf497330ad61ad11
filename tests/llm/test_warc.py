import pytest
from pyspark.sql import functions as F

from gridpulse.llm import warc
from gridpulse.sources.scratch import scratch_path
from tests.llm import brute

SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    odd = [(None, "x", None), (-1, None, None), (-5, "http://é x\n", "é" * 90_000), (-5, "http://é x\n", "é" * 90_000), (-6, "u", "é" * 90_000 + "!"),
           (-2, "u", "\r\n\r\nWARC/1.1 \\ 0\r\n"), (-3, "u", "\r\n\r\nWARC/1.1 \\ 0\r\n"), (-4, "", ""), (-7, "u", "0\r\n\r\n")]
    real = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    return real.unionAll(spark.createDataFrame(odd, SCHEMA)).withColumn("text", F.lit("clash")).withColumn("name", F.lit(1))


@pytest.mark.parametrize("segment", [warc.SEGMENT, 500])
def test_round_trip(pages, segment):
    rows = [(r.page_id, r.html) for r in pages.select("page_id", "html").collect()]
    got = warc.archive_and_read(pages, segment=segment).collect()
    facts = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert brute.by_none(facts) == brute.by_none(brute.warc(rows))
    texts = {(p or 0, h or "") for p, h in rows}
    assert all((r.page_id or 0, r.payload.decode()) in texts for r in got if r.record_type == "response")
    assert not any(r.problem for r in got)


def test_small_payloads_are_never_revisits(pages):
    got = warc.archive_and_read(pages, revisit_from=1000).where("record_type = 'revisit'").collect()
    assert all(r.payload_bytes >= 1000 for r in got)


def test_damage_is_reported(spark):
    records = warc.page_records(1, "u", b"x" * 1000, None, segment=400)
    path = scratch_path(spark, "warc")
    kept = [r.decode() for r in records if b"Segment-Number: 2" not in r]
    spark.createDataFrame([(r,) for r in kept], "value string").coalesce(1).write.option(
        "lineSep", warc.RECORD_END).option("compression", "gzip").text(path)
    assert [r.problem for r in warc.read_archives(spark, path).collect()] == ["segments missing or total length wrong"]
    assert warc._decoded(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab\r\n0\r\n\r\n", "", True)[3] == "broken transfer framing"


def test_framing():
    for payload in (b"", b"a", b"x" * 10_000, b"\r\n0\r\n\r\n"):
        assert warc.dechunked(warc.chunked(payload, 7)) == payload
    headers = [h for h, _ in warc.parse(warc.RECORD_END.encode().join([*warc.page_records(5, "u", b"y" * 900, None, 300), b""]))]
    assert [h["warc-type"] for h in headers] == ["response"] + ["continuation"] * (len(headers) - 1)
    assert [int(h["warc-segment-number"]) for h in headers] == list(range(1, len(headers) + 1))


def test_empty(spark):
    assert warc.archive_and_read(spark.createDataFrame([], SCHEMA)).count() == 0
