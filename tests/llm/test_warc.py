import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stopwise.llm import warc

PAGES = "page_id long, url string, html string"
BIG = "<p>" + "payload " * 30
EVIL = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n\r\n\r\n" + "y\n" * 100


def _round(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    warc.write(spark.createDataFrame(rows, PAGES), path)
    return path, warc.resolved_headers(spark, path).collect()


def test_round_trip(spark, tmp_path):
    rows = [(5, "http://a/", BIG), (3, "http://b/\r\nX: y", BIG), (9, None, BIG), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", EVIL), (8, "u", EVIL), (10, "é", "日本語😀\u0000" * 40)]
    path, got = _round(spark, tmp_path, rows)
    by = {int(r.row_id): r for r in got}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (by[i].payload_bytes, by[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {i: r.refers_to for i, r in by.items() if r.record_type == "revisit"} == {5: "3", 9: "3", 8: "7"}
    records = {int(r.row_id): r for r in warc.read(spark, path).collect()}
    assert bytes(records[7].payload) == EVIL.encode() and bytes(records[8].payload) == b"" and records[3].url == "http://b/%0D%0AX: y"


def test_files_are_plain_warc(spark, tmp_path):
    path, _ = _round(spark, tmp_path, [(1, "http://a/", BIG), (2, "http://a/", BIG)])
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "out").glob("*.gz")))
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(BIG.encode()) == 1 and text.endswith(b"\r\n\r\n")
    assert b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n" in text
    assert path


def test_repeated_rows_null_ids_and_empty(spark, tmp_path):
    rows = [(1, "u", BIG), (1, "u", BIG), (None, "u", BIG), (None, None, None)]
    kinds = sorted((r.row_id or "", r.record_type) for r in _round(spark, tmp_path / "a", rows)[1])
    assert kinds == [("", "response"), ("", "revisit"), ("1", "response"), ("1", "response")]
    warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "b"))
    assert warc.resolved_headers(spark, str(tmp_path / "b")).count() == 0


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, "u", BIG)], PAGES).withColumns({"payload": F.lit("old"), "record_type": F.lit("old"), "mine": F.lit(1)})
    row = warc.resolve(df).first()
    assert row.payload == BIG and row.record_type == "response" and row.mine == 1


def test_parser_waits_for_whole_records():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nH: a\r\n\r\nx\r\n\r\n"
    for cut in range(len(record)):
        got, rest, need = warc.parse(record[:cut])
        assert not got and rest == record[:cut] and cut < need <= len(record)
    assert warc.parse(record + record[:5])[0][0][-1] == b"x"
    with pytest.raises(ValueError, match="no record"):
        warc.parse(b"junk\r\n\r\n")


def test_repeated_ids_with_different_payloads(spark, tmp_path):
    other = "<p>" + "another payload " * 20
    rows = [(1, "u", BIG), (1, "u", other), (2, "u", BIG), (3, "u", other), (1, "u", other)]
    got = sorted((r.row_id, r.record_type, r.refers_to or "", r.payload_bytes, r.payload_digest) for r in _round(spark, tmp_path, rows)[1])
    sha = lambda t: (len(t), hashlib.sha256(t.encode()).hexdigest())
    want = [("1", "response", "", *sha(BIG)), ("1", "response", "", *sha(other)), ("1", "response", "", *sha(other)), ("2", "revisit", "1", *sha(BIG)), ("3", "revisit", "1", *sha(other))]
    assert got == sorted(want)


def test_long_payloads_dates_and_many_repeats(spark, tmp_path):
    long = "line of a long payload\n" * 200_000
    rows = [(i, "u", long if i in (3, 9) else BIG) for i in range(40)]
    df = spark.createDataFrame(rows, PAGES).withColumn("at", F.expr("make_timestamp(2024, 1, 1, 0, 0, page_id)"))
    path = str(tmp_path / "out")
    warc.write(df, path, date=F.col("at"))
    by = {int(r.row_id): r for r in warc.resolved_headers(spark, path).collect()}
    assert len(by) == 40 and by[9].payload_bytes == by[3].payload_bytes == len(long) and by[9].refers_to == "3" and by[39].refers_to == "0"
    assert {r.row_id: r.date for r in warc.read(spark, path).collect()}["5"] == "2024-01-01T00:00:05Z"


def test_payloads_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, "u", BIG), (2, "u", BIG)], PAGES)
    plan = warc.records(warc.resolve(df))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    salted = warc.resolve(df, small=0)  # the join without broadcast gives the same
    assert {(r.page_id, r.record_type, r.refers_to_id) for r in salted.collect()} == {(1, "response", None), (2, "revisit", 1)}
