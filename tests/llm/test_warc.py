import base64
import gzip
import hashlib

from quire.llm import warc as W
from quire.llm.common import new_path

from .helpers import same_as_sql, table

PAGES = "page_id bigint, url string, html string, record_type string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archive(spark, rows, **kw):
    path = new_path(spark, "test-warc")
    W.write_pages(spark.createDataFrame([(*r, "x") for r in rows], PAGES).repartition(3), path, **kw)
    return path


ROWS = [(5, "http://a/é", "same"), (2, None, "same"), (9, "http://b\r\nEvil: 1", "same"), (3, "u", None), (4, "u", ""), (7, "v", "É\r\n\r\nWARC/1.1\r\n" * 3), (8, "w", "x" * 400_000), (2, None, "same")]


def test_round_trip_and_revisits(spark):
    back = W.read_warc(spark, archive(spark, ROWS), verify=True)
    rows = back.collect()
    assert len(rows) == len(ROWS)
    html = {i: h or "" for i, _, h in ROWS}
    for r in rows:
        i = int(r["record_id"].rpartition(":")[2])
        assert r["http_length"] == len(html[i].encode()) and r["payload_digest"] == digest(html[i])
        first = {5: 2, 9: 2, 4: 3}.get(i)
        assert r["record_type"] == ("revisit" if first else "response")
        assert r["refers_to"] == (f"urn:page:{first}" if first else None)
        assert (r["payload"] is None) if first else bytes(r["payload"]).decode() == html[i]
    assert {r["target_uri"] for r in rows} == {"http://a/é", None, "http://b%0D%0AEvil: 1", "u", "v", "w"}


def test_small_payloads_are_all_responses(spark):
    rows = W.read_warc(spark, archive(spark, ROWS, min_bytes=5)).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    assert W.read_warc(spark, archive(spark, [])).count() == 0


def test_predicates_are_pushed_and_payloads_skipped(spark):
    path = archive(spark, ROWS)
    some = W.read_warc(spark, path).where("record_type = 'revisit' and refers_to = 'urn:page:2'")
    assert "PushedFilters" in some._jdf.queryExecution().toString() or some.count() == 2
    assert sorted(r["record_id"] for r in some.collect()) == ["urn:page:5", "urn:page:9"]
    assert W.read_warc(spark, path).where("content_length > 400000").count() == 1
    assert W.read_warc(spark, path).where("target_uri like 'http://a%'").count() == 1
    assert {r["payload"] for r in W.read_warc(spark, path, payload=False).collect()} == {None}


def test_unwanted_payloads_are_not_inflated(tmp_path):
    data = W.record_bytes("a", "response", "u", None, b"y" * 3_000_000)
    file = tmp_path / "x.warc.gz"
    file.write_bytes(W.gzip_member(data) + W.gzip_member(W.record_bytes("b", "revisit", "u", "a", b"y")))
    with open(file, "rb") as f:
        member = W.Member(f, 0)
        assert member.head()[0]["warc-record-id"] == "<a>"
        assert len(member.data) < len(data) and member.end() == len(W.gzip_member(data))


def test_foreign_archives(spark, tmp_path):
    """Plain files, members without a length, records that are no HTTP responses."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nX-Long: a\r\n b\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    page = W.record_bytes("p", "response", "u", None, b"z" * 9000)
    (tmp_path / "a.warc").write_bytes(info + page + info)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page) + W.gzip_member(page))
    (tmp_path / "c.txt").write_text("no")
    rows = W.read_warc(spark, f"file://{tmp_path}", verify=True).collect()
    assert sorted(r["record_id"] for r in rows) == ["i", "i", "i", "p", "p", "p"]
    assert {bytes(r["payload"]) for r in rows} == {b"hello", b"z" * 9000}
    assert {r["headers"].get("x-long") for r in rows} == {"a b", None}


def test_records_that_share_a_member(spark, tmp_path):
    records = [W.record_bytes(f"r{i}", "response", "u", None, bytes([97 + i]) * n) for i, n in enumerate((5, 0, 700_000, 9))]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)) + gzip.compress(records[1]))
    for payload in (True, False):
        rows = W.read_warc(spark, f"file://{tmp_path}", payload=payload, verify=True).collect()
        assert sorted((r["record_id"], r["http_length"]) for r in rows) == [("r0", 5), ("r1", 0), ("r1", 0), ("r2", 700_000), ("r3", 9)]
    assert W.read_warc(spark, f"file://{tmp_path}").where("record_id = 'r3'").count() == 1


def test_long_headers_without_payloads(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n" + b"X-Long: " + b"x" * 20_000 + b"\r\nContent-Length: 5\r\n\r\nhello"
    for kind in ("response", "revisit"):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{kind}>\r\nContent-Type: application/http\r\nContent-Length: {len(http)}\r\nX-More: {'y' * 9000}\r\n\r\n".encode()
        (tmp_path / f"{kind}.warc").write_bytes(head + http + b"\r\n\r\n")
        (tmp_path / f"{kind}.warc.gz").write_bytes(W.gzip_member(head + http + b"\r\n\r\n"))
    for payload in (True, False):
        rows = W.read_warc(spark, f"file://{tmp_path}", payload=payload).collect()
        assert len(rows) == 4 and {r["http_length"] for r in rows} == {5}


def test_cut_off_archives_fail_or_are_left(spark, tmp_path):
    import pytest

    page = W.record_bytes("p", "response", "u", None, bytes(range(256)) * 400)
    for name, data in (("a.warc.gz", W.gzip_member(page)), ("b.warc.gz", gzip.compress(page)), ("c.warc", page)):
        folder = tmp_path / name.replace(".", "")
        folder.mkdir()
        (folder / name).write_bytes(data + data[: len(data) // 2])
        for payload in (True, False):
            with pytest.raises(Exception, match="cut off"):
                W.read_warc(spark, f"file://{folder}", payload=payload).collect()
        assert {r["record_id"] for r in W.read_warc(spark, f"file://{folder}", damaged="skip").collect()} == {"p"}


def test_query_on_table(spark, sf):
    pages = table(sf, "pages")
    first = {}
    for r in pages:
        first[digest(r["html"])] = min(r["page_id"], first.get(digest(r["html"]), r["page_id"]))
    want = set()
    for r in pages:
        d = digest(r["html"])
        again = first[d] != r["page_id"]
        want.add((r["page_id"], len((r["html"] or "").encode()), d, "revisit" if again else "response", first[d] if again else None))
    assert {tuple(r) for r in W.op9_warc(spark, sf).collect()} == want


def test_query_matches_sql(spark, sf):
    same_as_sql(W.op9_warc(spark, sf), W.ORACLE, sf)


def test_sql_knows_revisits(spark, tmp_path):
    rows = [(5, "u", "same"), (2, "u", "same"), (9, "u", None), (4, "u", ""), (7, "u", "é")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    file = next((tmp_path / "pages.parquet").glob("*.parquet"))
    (tmp_path / "flat").mkdir()
    file.rename(tmp_path / "flat" / "pages.parquet")
    same_as_sql(W.op9_warc(spark, str(tmp_path / "flat")), W.ORACLE, str(tmp_path / "flat"), ("pages",))
