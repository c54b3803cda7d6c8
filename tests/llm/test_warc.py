import gzip
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from waybill.llm import warc

BIG, OTHER = "<p>" + "é" * 90, "<b>" + "x" * 5000 + "</b>"
ROWS = [(5, "http://a/x?y=1", BIG), (3, "http://b\r\nWARC-Type: evil", BIG), (3, None, BIG), (9, "http://c", "short"), (2, "http://d", "short"), (7, "", None), (8, "u", ""), (None, "n", BIG), (None, "n", "<i>" + "q" * 200), (None, "n", "<i>" + "q" * 200), (11, "http://b/z", OTHER), (-4, "http://b/zz", OTHER)]


def archives(spark, tmp_path, rows=ROWS):
    url = f"file://{tmp_path}/w"
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string")
    warc.write_warc(spark, df.repartition(3), url)
    return url


@pytest.mark.parametrize("limit", [200_000, -1])
def test_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "MAX_BROADCAST_DIGESTS", limit)
    out = warc.read_warc(spark, archives(spark, tmp_path)).collect()
    assert len(out) == len(ROWS)
    firsts = {}
    for i, _, h in ROWS:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            firsts[b] = min(firsts.get(b, i), i)
    want = []
    for i, _, h in ROWS:
        b = (h or "").encode()
        first = firsts.get(b)
        same = first is not None and i != first
        want.append((i, "revisit" if same else "response", "sha256:" + hashlib.sha256(b).hexdigest(), first if same else None, len(b), None if same else b))
    got = [(r["page_id"], r["record_type"], r["payload_digest"], r["refers_to_page"], r["payload_bytes"], None if r["payload"] is None else bytes(r["payload"])) for r in out]
    assert sorted(map(str, got)) == sorted(map(str, want))
    ids = [r["record_id"] for r in out]
    assert len(set(ids)) == len(ROWS) and all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", x) for x in ids)
    named = {r["record_id"]: r for r in out}
    revisits = [r for r in out if r["record_type"] == "revisit"]
    assert {r["refers_to"] is None for r in revisits if r["refers_to_page"] == 3} == {True}  # two records have page id 3
    for r in revisits:
        if r["refers_to"]:
            assert (named[r["refers_to"]]["page_id"], named[r["refers_to"]]["payload_digest"]) == (r["refers_to_page"], r["payload_digest"])
    assert any(r["refers_to"] for r in revisits)


@pytest.fixture
def pushdown(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_filters_are_pushed_into_the_reader(spark, tmp_path, capsys, pushdown):
    df = warc.read_warc(spark, archives(spark, tmp_path)).where(F.col("record_type") == "revisit").where(F.col("target_uri").startswith("http://")).where("payload_bytes > 200")
    assert sorted(r["page_id"] for r in df.collect()) == [11]
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "Filter" in plan and "record_type" not in plan.split("Filter", 2)[-1].split("Condition")[-1].split("\n")[0]


def test_filters_without_the_setting(spark, tmp_path):
    url = archives(spark, tmp_path)
    df = warc.read_warc(spark, url).where(F.col("record_type") == "revisit").where("payload_bytes > 200")
    assert sorted(r["page_id"] for r in df.collect()) == [11]
    only = warc.read_warc(spark, url, types=["revisit"]).collect()
    assert only and all(r["record_type"] == "revisit" for r in only)


def test_reader_skips_blocks_that_fail(tmp_path):
    reader = warc.WarcReader("x", True)
    kept = list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("payload_bytes",), 5)]))
    assert len(kept) == 1
    good = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>", "X-Payload-Length": 2}, warc.http_block(b"ok"))
    bad = warc.record({"WARC-Type": "warcinfo"}, b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot gzip")
    (tmp_path / "f.warc").write_bytes(bad + good + bad)
    reader.path = f"file://{tmp_path}"
    batches = list(reader.read(warc.Range(f"{tmp_path}/f.warc", 0, len(bad + good + bad))))
    assert [b.to_pylist() for b in batches][0][0]["payload"] == b"ok"


def test_any_folder_of_archives(spark, tmp_path):
    """Archives of others: no list, whole files or records compressed, chunks, other record types and foreign headers."""
    http = lambda head, body: b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body
    records = [
        warc.record({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:0>"}, b"software: x"),
        warc.record({"WARC-Type": "request", "WARC-Record-ID": "<urn:uuid:1>"}, b"GET / HTTP/1.1\r\n\r\n"),
        warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:2>", "Content-Type": "application/http; msgtype=response"}, http(b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip", b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in (gzip.compress(b"chunked body")[:9], gzip.compress(b"chunked body")[9:])) + b"0\r\n\r\n")),
        warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:3>", "Content-Type": "application/http"}, http(b"Content-Encoding: deflate", zlib.compress(b"flat"))),
        warc.record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:uuid:4>", "Content-Type": "text/plain", "WARC-Payload-Digest": "sha1:ABC"}, b"as it is"),
        warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:5>"}, http(b"Content-Length: 0", b"")),
    ]
    (tmp_path / "deep").mkdir()
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "deep" / "each.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "notes.txt").write_text("no archive")
    out = warc.read_warc(spark, f"file://{tmp_path}").collect()
    want = {"2": b"chunked body", "3": b"flat", "4": b"as it is", "5": b""}
    assert sorted((r["record_id"], bytes(r["payload"])) for r in out if r["payload"] is not None) == sorted((f"<urn:uuid:{k}>", v) for k, v in want.items() for _ in range(3))
    assert len(out) == 18 and all(r["page_id"] is None and r["payload_bytes"] is None for r in out)
    one = warc.read_warc(spark, f"file://{tmp_path}/plain.warc", types=["response"]).collect()
    assert [r["record_id"] for r in one] == ["<urn:uuid:2>", "<urn:uuid:3>", "<urn:uuid:5>"]


def test_the_query_hashes_what_is_stored(spark, tmp_path, monkeypatch):
    """A stored payload that is not the page's shows in the query's digest, whatever the headers say."""
    monkeypatch.setattr(warc, "http_block", lambda payload: b"HTTP/1.1 200 OK\r\n\r\n" + payload + b"!")
    rows = warc.op9_warc(spark, "/root/testdata/sf0.001").collect()
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    stored = [r for r in rows if r["record_type"] == "response"]
    assert stored and all(r["payload_digest"] == hashlib.sha256(pages[r["page_id"]] + b"!").hexdigest() for r in stored)


def test_truncated_archives_are_refused(tmp_path):
    data = warc.record({"WARC-Type": "response"}, warc.http_block(b"x" * 500))
    (tmp_path / "f.warc").write_bytes(data[:-100])
    with pytest.raises(warc.CorruptArchive):
        list(warc.WarcScan(f"file://{tmp_path}", True).read(warc.Range(f"{tmp_path}/f.warc")))


def test_splits_cover_each_record_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 1)
    out = warc.read_warc(spark, archives(spark, tmp_path), payload=False).collect()
    assert len(out) == len(ROWS) and all(r["payload"] is None for r in out)


def test_damage_and_empty(spark, tmp_path):
    import io

    with pytest.raises(warc.CorruptArchive):
        warc.read_headers(io.BytesIO(b"junk\r\n"))
    assert warc.read_warc(spark, archives(spark, tmp_path, [])).collect() == []
