import hashlib
import io
import struct

import pytest
import zstandard

from provena.llm.queries import op4_warc
from provena.llm.warc import (DICT_MAGIC, SKIP_MAGIC, WarcError, archive_from_bytes, dictionary_of, parse_record, read_archives,
                              read_frames, record_bytes, write_archives)
from provena.llm.tokenfile import store_of
from provena.session import scratch_path

from ..conftest import SF_SMALL


def page(i, html, refers_to=None):
    payload = html.encode()
    return {"page_id": i, "url": f"http://x/{i} y", "payload": payload, "refers_to": refers_to, "row": 0, "digest": hashlib.sha1(payload).hexdigest()}


def test_dictionary_frames_and_validation():
    records = [record_bytes(page(i, f"<html><body>page {i} " + "lorem ipsum dolor " * 40)) for i in range(300)]
    d = dictionary_of(records)
    assert d and struct.unpack("<I", d[:4])[0] == DICT_MAGIC
    frames = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    body = b"".join(frames.compress(r) for r in records)
    for kept in (d, zstandard.ZstdCompressor().compress(d)):  # a raw and a compressed dictionary
        archive = struct.pack("<II", SKIP_MAGIC, len(kept)) + kept + body
        assert [r for _, r in read_frames(io.BytesIO(archive))] == records
        assert [r["page-id"] for r in archive_from_bytes(archive)] == [str(i) for i in range(300)]
    with pytest.raises(WarcError):
        list(read_frames(io.BytesIO(archive[:-3])))
    with pytest.raises(WarcError):
        list(read_frames(io.BytesIO(struct.pack("<II", SKIP_MAGIC, 9) + b"not a dict")))
    with pytest.raises(WarcError):
        list(read_frames(io.BytesIO(b"plain bytes, no frame")))


@pytest.mark.parametrize("change", [(b"WARC/1.1", b"WORK/1.1"), (b"WARC-Type: response\r\n", b""), (b"Content-Length: ", b"Content-Length: 1"),
                                    (b"WARC-Date: ", b"WARC-Date "), (b"hello", b"hullo"),
                                    (b"WARC-Date", b"WARC-Type: response\r\nWARC-Date")])
def test_broken_records(change):
    good = record_bytes(page(1, "<p>hello</p>"))
    assert parse_record(good, "x")["payload"] == b"<p>hello</p>"
    with pytest.raises(WarcError):
        parse_record(good.replace(*change), "x")


def test_revisit_and_odd_rows(spark):
    long = "é" * 700  # 1400 bytes
    rows = [(1, "u", long), (2, None, long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
            (8, "a b\nc", "x" * 999), (9, "u", "x" * 999), (10, "u", "x" * 1000), (11, "u", "x" * 1000), (None, "u", long), (4, "u", "short"),
            (12, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, size string")
    folder = scratch_path(spark, "warc-test")
    got = read_archives(write_archives(pages, folder, archives=3), folder).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([r.page_id for r in got if r.page_id], key=int) == sorted(r[0] for r in rows if r[0])
    by = {r.page_id: r for r in got}
    assert {i: by[i].refers_to for i in (1, 2, 3, 8, 9, 10, 11, None)} == {1: 3, 2: 3, 3: None, 8: None, 9: None, 10: 11, 11: None, None: None}
    for i, _, html in sorted(rows, key=key):
        payload = (html or "").encode()
        assert by[i].payload_bytes == len(payload) and by[i].payload_digest == hashlib.sha1(payload).hexdigest()
        assert by[i].payload == (None if by[i].refers_to else payload) and (by[i].record_type == "revisit") == (by[i].refers_to is not None)
    empty = scratch_path(spark, "warc-test")
    assert read_archives(write_archives(pages.limit(0), empty), empty).count() == 0


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = op4_warc(spark, SF_SMALL).collect()
    assert {r.page_id: r.payload_digest for r in got} == {i: hashlib.sha1(h.encode()).hexdigest() for i, h in pages.items()}


def test_one_id_with_two_long_payloads(spark, monkeypatch):
    """A page crawled again: each payload is decided by itself, and a record is written for each row."""
    a, b, c = "a" * 1500, "b" * 1500, "c" * 1500
    rows = [(1, "u", a), (1, "u", b), (2, "u", a), (3, "u", c), (3, "u", a), (4, "u", c), (5, "u", a), (1, "u", a),
            (None, "u", a), (None, "v", a), (7, None, "short"), (7, None, "short")]
    want = sorted((str(i), hashlib.sha1(h.encode()).hexdigest(), {(1, a): 5, (2, a): 5, (3, a): 5, (3, c): 4}.get((i, h))) for i, _, h in rows)
    want = sorted(map(str, want))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for often in (1000, 2):  # rows that repeat are spread over the archives, with the same result
        monkeypatch.setattr("provena.llm.warc.OFTEN", often)
        folder = scratch_path(spark, "warc-test")
        files = write_archives(pages, folder, archives=5)
        got = read_archives(files, folder).collect()
        assert sorted(str((str(r.page_id), r.payload_digest, r.refers_to)) for r in got) == want
        assert {bytes(r.payload).decode() for r in got if r.payload is not None} >= {a, b, c}
        ids = [x["warc-record-id"] for f in files.collect() for x in archive_from_bytes(_bytes(folder, f.file))]
        assert len(set(ids)) == len(rows)


def _bytes(folder, name):
    fs, base = store_of(folder)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
        return stream.read()


def test_records_of_other_writers():
    """Records without the fields that this writer adds, of any type, are read; lengths that don't fit are found."""
    def record(kind, block, *more, content="application/http; msgtype=response"):
        head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", "WARC-Date: 2024-01-01T00:00:00Z", f"Content-Type: {content}",
                f"Content-Length: {len(block)}", *more]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n"
    assert parse_record(record("warcinfo", b"software: x\r\n", content="application/warc-fields"), "x")["payload"] == b"software: x\r\n"
    assert parse_record(record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", content="application/http; msgtype=request"), "x")["payload-bytes"] == 0
    assert parse_record(record("metadata", b"", content="text/plain"), "x")["payload-bytes"] == 0
    assert parse_record(record("resource", b"raw", content="image/png"), "x")["payload"] == b"raw"
    assert parse_record(record("response", http + b"body"), "x")["payload-bytes"] == 4
    again = parse_record(record("revisit", http, "WARC-Refers-To: <urn:uuid:9>", "WARC-Payload-Digest: sha1:" + "A" * 32), "x")
    assert again["payload-bytes"] == 4 and "payload" not in again and again["warc-refers-to"] == "<urn:uuid:9>"
    assert parse_record(record("response", http + b"body", "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"body").hexdigest()), "x")["payload"] == b"body"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 9\r\n\r\n4\r\nbody\r\n"
    assert parse_record(record("response", chunked), "x")["payload-bytes"] == 9
    for bad in (record("response", http + b"longer body"), record("response", http + b"body", "Payload-Length: 999"), record("response", b"no headers"),
                record("response", http + b"body", "WARC-Payload-Digest: sha1:" + "A" * 32)):
        with pytest.raises(WarcError):
            parse_record(bad, "x")


def test_archive_of_another_writer_is_read(spark):
    folder = scratch_path(spark, "warc-foreign")
    info = (b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            b"Content-Type: application/warc-fields\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n")
    fs, base = store_of(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/x.warc.zst", compression=None) as out:
        for r in (info, record_bytes(page(3, "<p>hello</p>")), record_bytes(page(2, "<p>hello</p>", 3))):
            out.write(zstandard.ZstdCompressor().compress(r))
    got = {r.record_type: r for r in read_archives(spark.createDataFrame([("x.warc.zst",)], "file string"), folder).collect()}
    assert got["warcinfo"].page_id is None and bytes(got["warcinfo"].payload) == b"a:b" and got["warcinfo"].payload_digest
    assert (got["response"].page_id, got["revisit"].refers_to, got["revisit"].payload_bytes) == (3, 3, 12)
    assert got["revisit"].payload_digest == got["response"].payload_digest and got["revisit"].payload is None
