import base64
import gzip
import hashlib
import io
import os

import pytest
from compare import compare, connect

from wattlake.llm import queries, warc

PAGES = "page_id long, url string, html string"


def _sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def _rows(spark, rows, tmp_path, least_bytes=0, chunk=7, archive_bytes=200, columns=PAGES):
    folder = str(tmp_path / "archives")
    archives = warc.write_archives(spark.createDataFrame(rows, columns).repartition(2), folder, least_bytes, archive_bytes)
    return archives, warc.read_chunks(archives, chunk)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    ok, note = compare(spark, connect(folder), folder, "op1_warc", queries.QUERIES, queries.EQUIVALENT_SQL)
    assert ok, note


def test_chunks_spell_the_payload_and_carry_digests(spark, tmp_path):
    texts = {i: ("ä€" * i + "\r\n\r\nWARC/1.1 x") for i in range(1, 30)}
    archives, chunks = _rows(spark, [(i, f"http://h/{i}", t) for i, t in texts.items()], tmp_path)
    assert archives.count() > 2 and sum(r.records for r in archives.collect()) == 29
    parts = {}
    for r in chunks.collect():
        parts.setdefault(int(r.record_id.split(":")[2]), []).append(r)
        assert len(r.data) <= 7
    for i, text in texts.items():
        own = sorted(parts[i], key=lambda r: r.chunk)
        assert [r.chunk for r in own] == list(range(len(own)))
        so_far = b""
        for r in own:
            so_far += bytes(r.data)
            assert r.payload_bytes == len(so_far) and r.payload_digest == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
            assert r.last == (so_far == text.encode()) and r.target_uri == f"http://h/{i}"
        assert so_far == text.encode()


def test_repeated_payloads_are_revisits(spark, tmp_path):
    rows = [(1, "u", "same"), (7, "u", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""), (6, "u", "lone"), (None, "u", "lone"), (7, "u", "same")]
    _, chunks = _rows(spark, rows, tmp_path)
    got = sorted((tuple(r) for r in warc.summaries(chunks).collect()), key=repr)
    same, lone, empty = _sha("same"), _sha("lone"), _sha("")
    assert got == sorted([
        (1, 4, same, "revisit", 7), (3, 4, same, "revisit", 7), (7, 4, same, "revisit", 7), (7, 4, same, "response", None),
        (4, 0, empty, "revisit", 5), (5, 0, empty, "response", None),
        (6, 4, lone, "response", None), (None, 4, lone, "revisit", 6),
    ], key=repr)


def test_payloads_below_the_least_size_are_all_responses(spark, tmp_path):
    _, chunks = _rows(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], tmp_path, least_bytes=4)
    assert {(r.page_id, r.record_type, r.refers_to) for r in warc.summaries(chunks).collect()} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)
    }


def test_extra_columns_and_empty_table(spark, tmp_path):
    rows = [(1, "http://a b\r\nX: y", "html", "x", "y")]
    archives, chunks = _rows(spark, rows, tmp_path, columns=PAGES + ", record_id string, sha string")
    assert [r.target_uri for r in chunks.collect()] == ["http://a b X: y"]
    archives, chunks = _rows(spark, [], tmp_path)
    assert archives.count() == 0 and chunks.count() == 0


def test_archives_are_members_of_plain_records(spark, tmp_path):
    archives, _ = _rows(spark, [(1, "http://h/", "hello"), (2, "http://h/", "hello")], tmp_path, archive_bytes=1 << 20)
    text = b"".join(gzip.open(r.path).read() for r in archives.collect())
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"hello") == 1
    assert b"WARC-Refers-To: <urn:x-page:2:" in text


def test_damage_is_noticed(spark, tmp_path):
    archives, _ = _rows(spark, [(1, "http://h/", "hello world")], tmp_path, archive_bytes=1 << 20)
    path = [r.path for r in archives.collect()][0]
    raw = gzip.open(path).read()
    assert [r[7] for r in warc.read_records(io.BytesIO(gzip.compress(raw)))] == [_sha("hello world")]
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(gzip.compress(raw.replace(b"hello", b"jello")))))
    with pytest.raises(ValueError, match="ends"):
        list(warc.read_records(io.BytesIO(gzip.compress(raw[:-6]))))


def test_reading_holds_no_whole_record():
    payload = os.urandom(1 << 16) * 160
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:1:0>\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    sha, size = hashlib.sha1(), 0
    for row in warc.read_records(io.BytesIO(gzip.compress(head + payload + b"\r\n\r\n", 1)), 1 << 16):
        assert len(row[5]) <= 1 << 16
        sha.update(row[5])
        size += len(row[5])
    assert size == len(payload) and row[8] and row[7] == base64.b32encode(sha.digest()).decode()


def test_records_keep_their_names_however_files_are_split(spark, tmp_path):
    rows = [(i % 40, f"u{i}", f"payload {i % 20}", i % 16) for i in range(160)]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, PAGES + ", part int").repartition(16, "part").write.parquet(path)
    settings = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    one = sorted(map(tuple, warc.mark_revisits(spark.read.parquet(path)).select("url", "record_id", "refers_to").collect()), key=str)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        two = sorted(map(tuple, warc.mark_revisits(spark.read.parquet(path)).select("url", "record_id", "refers_to").collect()), key=str)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert one == two and len({record for _, record, _ in one}) == 160
    kept = {record for _, record, refers in one if refers is None}
    assert len(kept) == 20 and all(refers in kept for _, _, refers in one if refers is not None)
