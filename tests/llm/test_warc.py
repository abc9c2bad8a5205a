"""Archives: round trips, frames and damaged bytes."""

import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerloom.llm import warc
from ledgerloom.llm.warc import BadArchive, archive_files, build_archive, decode_record, encode_record, frames, read_archives, write_archives

DATE = "2026-01-01T00:00:00Z"
PAGES = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>two</p>"),
    (5, "http://c/", "<p>one</p>"),
    (3, None, None),
    (4, "http://d/\r\nX: y", ""),
    (9, "http://e/", "ü" * 300_000),
    (None, "http://f/", "<p>two</p>"),
    (7, "http://g/", "alone"),
    (5, "http://c/", "<p>one</p>"),
]


def records(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("records", F.lit(1))
    return read_archives(write_archives(df, **options)).collect()


def test_round_trip(spark):
    out = records(spark, PAGES)
    assert not [r.error for r in out if r.error]
    largest = {}
    for i, _, h in PAGES:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        first = largest[h or ""]
        revisit = i != first and first >= 0
        url = None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")
        want.append((i, url, len(raw), warc.sha1_base32(raw), "revisit" if revisit else "response", first if revisit else None, None if revisit else raw))
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_least_bytes_and_empty_table(spark):
    assert {r.record_type for r in records(spark, [(1, "u", "x"), (2, "u", "x")], least_bytes=2)} == {"response"}
    assert records(spark, [(1, "u", "x")])[0].record_type == "response"
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert read_archives(write_archives(df)).count() == 0


def many(n=200):
    return [encode_record(i, f"http://x/{i}", f"<p>text {i} {hashlib.sha1(str(i).encode()).hexdigest()}</p>".encode(), "response", None, DATE) for i in range(n)]


def test_archive_has_a_dictionary_and_one_frame_per_record(monkeypatch):
    archive = build_archive(many())
    magic, size = struct.unpack_from("<II", archive)
    assert magic == warc.DICTIONARY and struct.unpack_from("<I", archive, 8)[0] == warc.TRAINED and size <= warc.DICTIONARY_BYTES
    assert list(frames(archive)) == many()
    small = build_archive(many(1))
    assert list(frames(small)) == many(1)


def test_compressed_dictionary_and_other_skippable_frames():
    archive = build_archive(many())
    size = struct.unpack_from("<I", archive, 4)[0]
    dictionary = zstandard.ZstdCompressor().compress(archive[8 : 8 + size])
    packed = struct.pack("<II", warc.DICTIONARY, len(dictionary)) + dictionary
    extra = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    assert list(frames(packed + extra + archive[8 + size :] + extra)) == many()
    assert list(frames(b"")) == []


@pytest.mark.parametrize("cut", [3, 9, 60, -1, -5])
def test_cut_archives_are_refused(cut):
    archive = build_archive(many(20))
    with pytest.raises(BadArchive):
        list(frames(archive[:cut]))


def test_damaged_frame_and_unknown_magic():
    archive = bytearray(build_archive(many(20)))
    archive[-30] ^= 0xFF
    with pytest.raises(BadArchive):
        list(frames(bytes(archive)))
    with pytest.raises(BadArchive):
        list(frames(b"WARC/1.1 plain text"))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WARC/9.9"),
        (b"WARC-Type: response", b"WARC-Type: conversion"),
        (b"WARC-Date", b"X-Date"),
        (b"hello", b"hellp"),
        (b"hello", b"hello!"),
        (b"<urn:page:1>", b"<urn:uuid:1>"),
        (b"\r\n\r\nhello\r\n\r\n", b"\r\n\r\nhello\r\n"),
        (b"Content-Type: application", b"Content-Type application"),
    ],
)
def test_invalid_records(old, new):
    record = encode_record(1, "http://a/", b"hello", "response", None, DATE)
    assert decode_record(record).payload == b"hello"
    with pytest.raises(ValueError):
        decode_record(record.replace(old, new))


def test_bad_records_are_error_rows_and_files_are_read(spark, tmp_path):
    good = many(3)
    bad = good[1].replace(b"WARC-Date", b"X-Date")
    (tmp_path / "a.warc.zst").write_bytes(build_archive([good[0], bad, good[2]]))
    (tmp_path / "b.warc.zst").write_bytes(build_archive(good)[:-2])
    out = read_archives(archive_files(spark, str(tmp_path))).collect()
    first = sorted((r for r in out if r.archive.endswith("a.warc.zst")), key=lambda r: r.frame)
    assert [r.error is None for r in first] == [True, False, True]
    second = sorted((r for r in out if r.archive.endswith("b.warc.zst")), key=lambda r: r.frame)
    assert [r.page_id for r in second] == [0, 1, None] and "cut off" in second[2].error
