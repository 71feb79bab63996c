import gzip
import io
import json
import os

from skriftverk.sources import files, warc
from skriftverk.streaming import dedup


def response(url, body, kind="text/html; charset=utf-8"):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\n".encode() + body
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{url}>\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def test_warc(spark, tmp_path):
    req = b"WARC/1.0\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nGET\r\n\r\n"
    data = b"".join(gzip.compress(x) for x in (req, response("a", "<p>å".encode()), response("b", b"<p>\xe5", "text/html; charset=iso-8859-1")))
    (tmp_path / "x.warc.gz").write_bytes(data)
    (tmp_path / "cut.warc.gz").write_bytes(data[:-20])
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    full = [r for r in rows if r["file"].endswith("x.warc.gz")]
    assert [(r["url"], r["html"]) for r in full] == [("a", "<p>å"), ("b", "<p>å")]
    cut = [r for r in rows if r["file"].endswith("cut.warc.gz")]
    assert [(r["url"], r["html"], r["error"]) for r in cut] == [("a", "<p>å", None), ("b", None, "file ends inside a member")]
    assert warc.read_warc(spark, warc.list_files(spark, str(tmp_path)).filter("path like '%x.warc.gz'")).count() == 2


def test_warc_damage():
    good = [response(str(i), b"<p>" + os.urandom(40).hex().encode() * 50) for i in range(4)]
    packed = [gzip.compress(x) for x in good]
    broken = bytearray(packed[1])
    broken[40:60] = b"\x00" * 20
    got = list(warc.records(io.BytesIO(packed[0] + bytes(broken) + packed[2] + packed[3])))
    assert [(r[1], r[5] is None) for r in got if r[5] is None] == [("0", True), ("2", True), ("3", True)] and sum(r[5] is not None for r in got) == 1
    http = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n\x1f\x8bno gzip"
    bad = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: z\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
    got = list(warc.records(io.BytesIO(good[0] + bad + good[1] + good[2][:-9])))
    assert [(r[1], (r[5] or "").split(":")[0]) for r in got] == [("0", ""), ("z", "broken body"), ("1", ""), ("2", "file ends inside a record")]
    assert list(warc.records(io.BytesIO(b""))) == []


def test_jsonl_and_manifest(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write(json.dumps({"id": "1", "text": "x", "metadata": {"url": "u"}}) + "\nnot json\n")
    good, bad = files.read_jsonl(spark, str(tmp_path))
    assert [r["metadata"]["url"] for r in good.collect()] == ["u"] and bad.count() == 1
    assert files.settled(good, 300).count() == 0
    paths = files.path_list(spark.createDataFrame([(" a ",), ("a",), ("",), (None,), ("b",)], "value string"))
    files.mark_finished(paths.filter("path = 'a'"), str(tmp_path / "manifest"))
    left = files.unfinished(paths, files.read_manifest(spark, str(tmp_path / "manifest")))
    assert [r[0] for r in left.collect()] == ["b"]
    assert files.read_manifest(spark, str(tmp_path / "none")).count() == 0
    files.write_jsonl(good.select("id", "text"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda n, rows: (tmp_path / "in" / n).write_text("".join(json.dumps(r) + "\n" for r in rows))
    put("a.json", [{"id": "1", "text": "x"}, {"id": "2", "text": " x"}])
    schema = "id string, text string"
    for _ in range(2):
        s = dedup.unique_stream(dedup.stream_jsonl(spark, str(tmp_path / "in"), schema))
        dedup.write_once(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        dedup.dedup_into(dedup.stream_jsonl(spark, str(tmp_path / "in"), schema), str(tmp_path / "seen"), str(tmp_path / "out2"), str(tmp_path / "cp2")).awaitTermination()
        put("b.json", [{"id": "3", "text": "x"}, {"id": "4", "text": "y"}])
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    assert sorted(r["id"] for r in spark.read.json(str(tmp_path / "out2")).collect()) == ["1", "4"]
