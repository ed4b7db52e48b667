import gzip
import hashlib
import io

from pyspark.sql import types as T

from stratamart.llm import warc

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_round_trip(spark, tmp_path):
    long, same, short = "x" * 300_000 + "é\r\n\r\nWARC/1.1", "y" * 120, "z" * 99
    rows = [(1, "http://a/", same), (2, "http://b/\r\nX: 1", same), (3, None, same), (4, "u", short), (5, "u", short), (6, "u", None), (7, "u", ""), (8, "u", long), (9, "u", long), (None, "u", same), (1, "u", same)]
    records = warc.read_archives(warc.write_archives(pages(spark, rows), str(tmp_path)), str(tmp_path)).collect()
    assert {bytes(r["payload"]).decode() for r in records if r["record_type"] == "response"} == {same, short, "", long}
    assert all(r["url"] is None or "\n" not in r["url"] for r in records)
    got = {r["page_id"]: r for r in warc.archive_and_read(spark, pages(spark, rows), str(tmp_path / "b")).collect()}
    assert all(r["digest_ok"] for r in got.values())
    for page, _, html in rows:
        body = (html or "").encode()
        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
    assert {k: r["refers_to"] for k, r in got.items()} == {1: None, 2: 1, 3: 1, 4: None, 5: None, 6: None, 7: None, 8: None, 9: 8, None: 1}
    assert warc.archive_and_read(spark, pages(spark, []), str(tmp_path / "c")).count() == 0


def archive(*payloads):
    return b"".join(warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{k}>"), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(p).hexdigest())], p) for k, p in enumerate(payloads))


def test_reader_frames_checks_and_stops():
    data = archive(b"one", b"\r\n\r\n" * 9, b"q" * 200_000)
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(data))] == [3, 36, 200_000]
    assert [r["digest_ok"] for r in warc.read_records(io.BytesIO(data[:-5]))] == [True, True, False]
    members = gzip.decompress(archive(b"one")).replace(b"\r\n\r\none", b"\r\n\r\nONE")
    assert [r["digest_ok"] for r in warc.read_records(io.BytesIO(gzip.compress(members) + archive(b"two")))] == [False, True]
    assert not list(warc.read_records(io.BytesIO(b"")))
    assert [r["digest_ok"] for r in warc.read_records(io.BytesIO(data + b"garbage"))][:3] == [True, True, True]


def test_reader_goes_on_after_a_broken_member():
    data = bytearray(archive(b"one", b"two" * 5_000, b"three", b"four"))
    starts = [r["offset"] for r in warc.read_records(io.BytesIO(bytes(data)))]
    data[starts[1] + 60] ^= 0xFF
    data[starts[1] + 61] ^= 0xFF
    got = [(r["page_id"], r["digest_ok"]) for r in warc.read_records(io.BytesIO(bytes(data)))]
    assert [p for p, ok in got if ok] == ["0", "2", "3"] and sum(not ok for _, ok in got) == 1
    assert b"WARC-Date" not in archive(b"x")  # the writer adds it, record_bytes writes what it is given
