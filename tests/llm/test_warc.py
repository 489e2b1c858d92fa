"""WARC archives: roles against plain Python, records as the format says, captures of odd links."""
import base64
import gzip
import hashlib
import os

import pytest

from abono.llm import warc

TRAP = "hi\r\n\r\nWARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\n"
ROWS = [
    (1, "http://a.b/c?d=1#x", TRAP), (2, None, None), (3, "x\r\ny", ""), (4, "u", "é" * 10), (5, "u", "é" * 10), (5, "u", "é" * 10),
    (5, "a", "é" * 10), (7, "http://q", "one"), (8, "u", "long " * 300_000), (9, "w", "long " * 300_000),
    (None, "u", "none"), (None, "u", "none"), (None, "v", "none")]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archives")
    pages = spark.createDataFrame([(*r, "x", 0) for r in ROWS], "page_id long, url string, html string, digest string, salt int")
    warc.write_warc(pages, path)
    return path


def expected(rows):
    out = []
    for payload in {h or "" for _, _, h in rows}:
        own = sorted(((i is not None, i or 0, u is not None, u or "", i) for i, u, h in rows if (h or "") == payload))
        for k, x in enumerate(own):
            last = k == len(own) - 1
            digest = base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()
            out.append((x[4], len(payload.encode()), digest, "response" if last else "revisit", None if last else own[-1][4]))
    return sorted(out, key=str)


def test_pages_come_back(spark, written):
    got = warc.pages_digest(spark, written).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(ROWS)


def test_payloads_come_back(spark, written):
    rows = warc.captures(warc.read_warc(spark, written, with_payload=True)).collect()
    assert len(rows) == len(ROWS)
    bodies = {r.response.payload.decode() for r in rows if r.response.warc_type == "response"}
    assert bodies == {h or "" for _, _, h in ROWS}
    assert all(r.response.payload is None and r.response.profile == warc.SAME_PAYLOAD for r in rows if r.response.warc_type == "revisit")
    assert {r.response.target_uri for r in rows} == {u and u.replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in ROWS}
    assert all(len(r.metadata) == 1 and r.request for r in rows)
    lines = {r.response.target_uri: r.request.request_line for r in rows}
    assert lines["http://a.b/c?d=1#x"] == "GET /c?d=1 HTTP/1.1" and lines["http://q"] == "GET / HTTP/1.1"


def test_archives_follow_the_format(written):
    """Read by a plain loop: lengths are bytes, each record ends with two line ends."""
    records = 0
    for name in os.listdir(written):
        if not name.endswith(".gz"):
            continue
        data = gzip.open(f"{written}/{name}").read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            size = int(head.split(b"Content-Length: ")[1])
            assert rest[size:size + 4] == b"\r\n\r\n"
            data, records = rest[size + 4:], records + 1
    assert records == 3 * len(ROWS)


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(i, "u", h) for i, h in enumerate(["ab", "ab", "abc", "abc", "", ""])]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"), least=3)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.pages_digest(spark, str(tmp_path / "a")).collect()}
    assert got == {0: ("response", None), 1: ("response", None), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None)}


def test_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(none, str(tmp_path / "a"))
    assert warc.pages_digest(spark, str(tmp_path / "a")).count() == 0


def record(kind, name, to=(), block=b"", more=()):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *[f"WARC-Concurrent-To: <{t}>" for t in to], *more]
    return "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def test_links_in_any_direction(spark, tmp_path):
    """Archives of other writers: a gzip member per record, or plain; links either way."""
    http = ["Content-Type: application/http; msgtype=response"]
    body = b"HTTP/1.1 404 Not Found\r\nX: y\r\n\r\nbody"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in [
        record("warcinfo", "i", block=b"software: x\r\n"),
        record("request", "q1"), record("response", "r1", ["q1"], body, http), record("metadata", "m1", ["q1"], b"a: 1\r\nb: 2", ["Content-Type: application/warc-fields"]),
        record("response", "r2"), record("metadata", "m2", ["r2"]), record("metadata", "m3", ["r2", "gone"]), record("request", "q2", ["r2"])]))
    (tmp_path / "in" / "b.warc").write_bytes(
        record("request", "q3", ["gone"]) + record("metadata", "m4") + record("resource", "s") + record("revisit", "r3", more=["WARC-Payload-Digest: sha1:ABC", "X-Long: 1\r\n  2"]))
    rows = warc.captures(warc.read_warc(spark, str(tmp_path / "in"))).collect()
    name = lambda r: r and r.record_id
    got = {(name(r.response), name(r.request), tuple(sorted(name(m) for m in r.metadata))) for r in rows}
    assert len(rows) == 5 and got == {
        ("<r1>", "<q1>", ("<m1>",)), ("<r2>", "<q2>", ("<m2>", "<m3>")), ("<r3>", None, ()), (None, "<q3>", ()), (None, None, ("<m4>",))}
    one = next(r for r in rows if name(r.response) == "<r1>")
    assert one.response.http_status == 404 and one.response.payload_bytes == 4 and one.metadata[0].fields == {"a": "1", "b": "2"}


@pytest.mark.parametrize("content", [b"no archive", record("response", "r", block=b"abc")[:-6], gzip.compress(record("response", "r"))[:-9], b"WARC/1.0\r\nWARC-Type: response\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"])
def test_broken_archives_say_so(content):
    with pytest.raises(warc.Broken):
        list(warc.read_records(content))
