"""WARC archives: what is read back against a brute force over the pages."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from quayside.llm import warc
from quayside.llm.store import file_system, fresh_path

LONG = "é<p>" * 5000
ROWS = [
    (5, "http://a/ü x\n?q=%20", LONG), (3, "http://b", LONG), (9, None, LONG), (1, "u", None), (2, "u", ""), (4, "u", "x" * 99), (6, "u", "x" * 99),
    (7, "u", "x" * 100), (8, "u", "x" * 100), (8, "u", "x" * 100), (8, "v", "x" * 100), (8, None, "x" * 100), (10, "u", "\U0001f600 WARC/1.1\r\n\r\n" * 40),
    (4, "u", "x" * 99), (None, "u", "y" * 200), (None, "v", "y" * 200), (11, "u", "y" * 200), (None, "w", "z" * 150), (None, "x", "z" * 150),
]


def brute(rows):
    """(page, bytes, digest, type, refers) of every row."""
    out = []
    seen = set()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    first = {}
    for i in order:
        first.setdefault(rows[i][2] or "", rows[i][0])
    for i in order:
        page, _, html = rows[i]
        html = html or ""
        raw = html.encode()
        again = len(raw) >= 100 and html in seen
        seen.add(html)
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=str)


def pages(sp, rows=ROWS):
    return sp.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'d' as digest", "1 as id", "2 as chunk", "3 as copies", "4 as data")


def read_whole(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows if r.last), key=str)


@pytest.mark.parametrize(("chunk", "size"), [(7, 1), (64, 3000), (1 << 18, 1 << 30)])
def test_round_trip(sp, chunk, size):
    path = fresh_path(sp, "warc-test")
    manifest = warc.write_archives(pages(sp).repartition(3), path, chunk=chunk, archive_bytes=size)
    rows = warc.read_archives(manifest, chunk=chunk).collect()
    assert read_whole(rows) == brute(ROWS)
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(ROWS)
    if size == 1:
        assert manifest.count() >= 10
    assert len({r.record_id for r in rows if r.last}) == len(ROWS)
    bodies = {}
    for r in sorted(rows, key=lambda r: r.chunk):
        if r.record_type == "response":
            assert len(r.data) <= chunk
            bodies[r.record_id] = bodies.get(r.record_id, b"") + r.data
            assert r.payload_bytes == len(bodies[r.record_id]) and r.payload_digest == hashlib.sha256(bodies[r.record_id]).hexdigest()
    whole = {(t or "").encode() for _, _, t in ROWS}
    assert set(bodies.values()) == whole
    assert [c for c in warc.read_archives(manifest, contents=False).columns if c == "data"] == []
    assert {r.target_uri for r in rows if r.page_id == 5} == {"http://a/%C3%BC%20x%0A?q=%20"}


def test_the_archive_is_plain_warc(sp):
    path = fresh_path(sp, "warc-test")
    manifest = warc.write_archives(pages(sp, ROWS[:3]), path, date="2024-01-01T00:00:00Z")
    kinds = []
    for r in manifest.collect():
        store, at = file_system(r.archive)
        with store.open_input_stream(at) as f:
            raw = gzip.decompress(f.read())
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and raw.endswith(b"\r\n\r\n")
        kinds += [line.split(b" ")[1].strip() for line in raw.split(b"\r\n") if line.startswith(b"WARC-Type:")]
    assert sorted(k for k in kinds if k != b"warcinfo") == [b"response", b"revisit", b"revisit"]


def test_a_changed_payload_is_refused(sp):
    path = fresh_path(sp, "warc-test")
    manifest = warc.write_archives(pages(sp, [(1, "u", "q" * 500)]), path)
    store, at = file_system(manifest.first().archive)
    with store.open_input_stream(at) as f:
        raw = gzip.decompress(f.read())
    with store.open_output_stream(at) as f:
        f.write(gzip.compress(raw.replace(b"qqqq", b"qqqp", 1)))
    with pytest.raises(Exception, match="has changed"):
        warc.read_archives(manifest).collect()


def test_lost_and_doubled_chunks(monkeypatch):
    from types import SimpleNamespace

    monkeypatch.setattr(warc, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    body = b"abc" * 100
    parts = [body[i : i + 100] for i in range(0, 300, 100)]
    upto = [hashlib.sha256(b"".join(parts[: i + 1])).digest() for i in range(3)]
    digest = hashlib.sha256(body).digest()
    import tempfile

    def write(order):
        w = warc._Writer(tempfile.mkdtemp(prefix="quayside-test-"), "d", 1 << 30)
        w.record({"id": "1", "uri": None, "digest": digest, "n_bytes": 300, "copies": 1, "record_type": "response", "refers_to": "1", "refers_uri": None})
        for i in order:
            w.chunk(("1", None, digest), i, parts[i], upto[i])
        w.close()

    write([0, 0, 1, 1, 2])
    for order in ([0, 2], [0, 1], []):
        with pytest.raises(ValueError, match="lost|whole"):
            write(order)


def test_empty_table_and_paths(sp):
    manifest = warc.write_archives(pages(sp, []), fresh_path(sp, "warc-test"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        warc.write_archives(pages(sp), "nosuch://x/y")
