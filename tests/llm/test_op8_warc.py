import hashlib

from llm_rows import *  # noqa: F403
import zstandard

from gateflow.llm import warc
from gateflow.session import scratch_path

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as first", "2 as n", "3 as k", "'d' as digest")


def expected(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same, default=None)
        old = len(data) >= 100 and i is not None and first is not None and i > first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if old else "response", first if old else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark):
    long = "<p>é</p>" * 20
    rows = [(i, f"http://x/{i}", long + str(i // 3)) for i in range(60)]
    rows += [(100, "u", "short"), (101, "u", "short"), (None, None, None), (None, "u", long + "0"), (5, "http://x/5", long + "1"),
             (3, "again", long + "1"), (200, "a\r\nb", ""), (201, "u", "\r\n\r\nWARC/1.1 " * 40_000)]
    assert rows_of(warc.archive(spark, pages(spark, rows).repartition(3))) == expected(rows)


def test_hot_payload_is_settled_by_broadcast(spark, monkeypatch):
    rows = [(i, "u", "<p>hot</p>" * 20) for i in range(300)] + [(1000 + i, "u", "<p>cold</p>" * 20 + str(i // 2)) for i in range(100)]
    for share in (1000, 10):
        monkeypatch.setattr(warc, "HOT_SHARE", share)
        assert rows_of(warc.archive(spark, pages(spark, rows))) == expected(rows)


def test_files_are_seekable_bundles(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 12_000)
    rows = [(i, f"http://x/{i}", f"page {i} " * 150) for i in range(40)]
    path = scratch_path(spark, "test", "warc")
    warc.write(pages(spark, rows).coalesce(1), path)
    files = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/bundles").collect()}
    assert len(files) > 3
    for data in files.values():
        inside = warc.frames(data)[:-1]
        whole = b"".join(zstandard.ZstdDecompressor().decompress(data[a:a + n], size) for a, n, size in inside)
        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as f:  # any reader of .zst
            assert f.read() == whole
        assert len(inside) > 1
    found = warc.index(spark, path).collect()
    assert len({r.record_id for r in found}) == len(found) == 40
    for r in found:
        text = warc.Bundle(files[r.bundle]).fetch(r.frame, r.offset, r.length)
        assert text.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {r.record_id}\r\n".encode() in text
        assert text.endswith(f"page {warc.page_of(r.record_id)} ".encode() * 150 + b"\r\n\r\n")
    wanted = [r.record_id for r in found if warc.page_of(r.record_id) in (3, 17, 39)] + ["<urn:page:3:none>"]
    got = warc.lookup(spark, path, spark.createDataFrame([(w,) for w in wanted], "record_id string")).collect()
    assert {r.record_id for r in got} == set(wanted[:3])
    assert all(f"WARC-Record-ID: {r.record_id}\r\n".encode() in bytes(r.record) for r in got)


def test_identifiers_and_urls(spark):
    page = "<p>some payload</p>" * 20
    rows = [(None, "u", "x"), (None, "u", "x"), (None, "v", page), (1, "a\u2028b\x85c\r\nd", page), (2, None, page),
            (1, "again", "other")]
    df = warc.archive(spark, pages(spark, rows).repartition(4))
    got = df.collect()
    assert len({r.record_id for r in got}) == len(rows)
    assert {r.url for r in got if r.page_id == 1} == {"a\u2028b\x85cd", "again"}
    by = {r.record_id: r for r in got}
    second = next(r for r in got if r.page_id == 2)
    assert second.refers_to == 1 and by[warc.record_id(1, second.payload_digest)].record_type == "response"


def test_empty_table(spark):
    assert warc.archive(spark, pages(spark, [(1, "u", "x")]).limit(0)).count() == 0
