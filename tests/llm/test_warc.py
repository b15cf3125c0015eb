import hashlib
import struct

import pytest
import zstandard

from mentionkit.llm import warc

BIG = "<p>é</p>" * 200
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (7, "http://a/3\r\nX: y", BIG), (4, None, "short"), (5, "http://a/5", "short"), (6, "u", None), (8, "u", ""),
    (9, "u", "x" * 999), (10, "u", "x" * 999), (11, "u", "y" * 1000), (12, "u", "y" * 1000), (12, "u", "y" * 1000), (None, "u", "z" * 2000), (13, "u", "z" * 2000),
    (None, "u", "q" * 3000), (None, "u", "q" * 3000), (14, "u", "v" * 2_000_000),
]
COLUMNS = "page_id long, url string, html string"


def plain(pages):
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == raw and p is not None]
        kept = max(same, default=None)
        again = len(raw) >= 1000 and kept is not None and kept != page
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", kept if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = warc.archive_report(spark.createDataFrame([(*p, 1) for p in PAGES], COLUMNS + ", sha1 int"))
    assert sorted(map(tuple, rows.collect()), key=str) == plain(PAGES)


def test_payloads_and_urls_come_back(spark):
    pages = [(i, f"http://a/{i}", f"<p>page {i}</p>" * (i + 1)) for i in range(300)]
    archives = warc.write_archives(spark.createDataFrame(pages, COLUMNS).repartition(2)).cache()
    got = sorted((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in warc.read_archives(archives).collect())
    assert got == pages
    for content in [bytes(r["content"]) for r in archives.collect()]:
        assert struct.unpack_from("<I", content)[0] == warc.SKIPPABLE


def test_archives_end_at_their_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    raw = [warc.record(i, "u", b"x" * 500, 500, hashlib.sha1(b"x" * 500).hexdigest(), None) for i in range(40)]
    assert [warc.page_of(warc.parse(r))["page_id"] for r in warc.frames(warc.archive(raw))] == list(range(40))


def test_plain_and_packed_dictionaries_and_none():
    raw = [warc.record(i, f"http://a/{i}", b"abc" * i, 3 * i, hashlib.sha1(b"abc" * i).hexdigest(), None) for i in range(50)]
    trained = zstandard.train_dictionary(4096, raw * 4).as_bytes()
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    body = b"".join(pack.compress(r) for r in raw)
    for stored in (trained, zstandard.ZstdCompressor().compress(trained)):
        assert list(warc.frames(struct.pack("<II", warc.SKIPPABLE, len(stored)) + stored + body)) == raw
    assert list(warc.frames(b"".join(zstandard.ZstdCompressor().compress(r) for r in raw))) == raw
    assert list(warc.frames(b"")) == []


def test_bad_archives_are_refused(spark):
    good = warc.record(1, "u", b"hello", 5, hashlib.sha1(b"hello").hexdigest(), None)
    pack = lambda *rs: b"".join(zstandard.ZstdCompressor(write_checksum=True).compress(r) for r in rs)
    whole = pack(good, good)
    bad = {
        "cut": whole[:-7], "flip": whole[:-12] + bytes([whole[-12] ^ 255]) + whole[-11:], "length": pack(good.replace(b"Content-Length: 72", b"Content-Length: 71")),
        "version": pack(good.replace(b"WARC/1.1", b"WARC/9.9")), "field": pack(good.replace(b"WARC-Date", b"X-Date")), "digest": pack(good.replace(b"hello", b"hallo")),
        "end": pack(good[:-2]), "type": pack(good.replace(b"response\r\nWARC-R", b"metadata\r\nWARC-R")), "dictionary": struct.pack("<II", warc.SKIPPABLE, 99) + b"x",
    }
    assert good.count(b"hello") == 1
    rows = warc.read_archives(spark.createDataFrame([(k, bytearray(v)) for k, v in bad.items()], "name string, content binary"), strict=False)
    problems = {r["archive"] for r in rows.collect() if r["problem"]}
    assert problems >= set(bad) - {"length"}
    with pytest.raises(Exception, match="flip"):
        warc.read_archives(spark.createDataFrame([("flip", bytearray(bad["flip"]))], "name string, content binary")).collect()


def test_files(spark, tmp_path):
    archives = warc.write_archives(spark.createDataFrame(PAGES, COLUMNS)).cache()
    warc.save(archives, tmp_path.as_uri())
    files = warc.load(spark, tmp_path.as_uri())
    assert files.count() == archives.count()
    got = warc.read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == plain(PAGES)


def test_no_pages(spark):
    assert warc.archive_report(spark.createDataFrame([], COLUMNS)).count() == 0


def test_ids_stay_whole_beside_null(spark):
    big, small = "x" * 2000, "y"
    rows = [(2**60 + 1, "u", big), (2**60 + 3, "u", big), (None, "u", small), (2**60 + 5, None, None)]
    out = warc.archive_report(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in out}
    assert got == {
        2**60 + 1: ("revisit", 2**60 + 3), 2**60 + 3: ("response", None), None: ("response", None), 2**60 + 5: ("response", None),
    }
