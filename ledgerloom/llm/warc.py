"""WARC archives compressed with Zstandard, one frame per record and a dictionary in the leading skippable frame.

Writing: records of a partition are packed into archives of bounded size. Each archive trains its dictionary on its
own first records, so no driver-side sample is needed. An archive is one row (name and bytes) of a stored table: the
bytes are a complete ``.warc.zst`` file. Reading walks the frames of an archive one at a time and validates every
record before it is returned.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import durable, lookup_side

# Frame magics of the Zstandard format, and profile and version of the WARC format (fixed values).
FRAME, DICTIONARY, TRAINED = 0xFD2FB528, 0x184D2A5D, 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"

# An archive is closed at this many payload bytes; the dictionary learns from at most this many of them.
ARCHIVE_BYTES = 4 * 1024 * 1024
SAMPLE_BYTES = 256 * 1024
DICTIONARY_BYTES = 8 * 1024

WRITTEN = "archive string, records int, content binary"
READ = (
    "archive string, frame int, page_id bigint, url string, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint, payload binary, error string"
)


class BadArchive(ValueError):
    """The bytes break the frame format."""


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None
    payload: bytes | None


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(number: int | None) -> str:
    return f"<{ID}{'' if number is None else number}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit carries the HTTP head with the payload's length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(value: str) -> int | None:
    found = re.fullmatch(rf"<{ID}(-?\d*)>", value)
    if not found:
        raise ValueError(f"record id {value!r}")
    return int(found[1]) if found[1] else None


def _fields(lines: list[bytes]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise ValueError(f"header line {line[:60]!r}")
        fields[name.strip().lower()] = value.strip()
    return fields


def decode_record(data: bytes) -> Record:
    """Parses and validates one record: version, fields, lengths, closing lines and payload digest."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC header")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"):
        if name not in fields:
            raise ValueError(f"field {name} is missing")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind!r}")
    if not fields["content-length"].isdecimal() or len(rest) != int(fields["content-length"]) + 4:
        raise ValueError("content length differs from the block")
    if not rest.endswith(b"\r\n\r\n"):
        raise ValueError("the record is not closed by two line ends")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no HTTP header")
    length = _fields(http.split(b"\r\n")[1:]).get("content-length", "")
    if not length.isdecimal():
        raise ValueError("no HTTP content length")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(length) or sha1_base32(payload) != digest):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit holds a payload")
    refers = fields.get("warc-refers-to")
    return Record(
        _number(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        int(length),
        digest,
        kind,
        _number(refers) if refers else None,
        payload if kind == "response" else None,
    )


def build_archive(records: list[bytes]) -> bytes:
    """A whole archive. Too few records to train on give a dictionary of plain content."""
    sample, size = [], 0
    for record in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(record[: SAMPLE_BYTES // 8])
        size += len(sample[-1])
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        dictionary = b"".join(sample)[:DICTIONARY_BYTES] or VERSION.encode()
    compressor = zstandard.ZstdCompressor(
        level=3, dict_data=_dictionary(dictionary), write_checksum=True, write_content_size=True
    )
    frames = [compressor.compress(record) for record in records]
    return b"".join([struct.pack("<II", DICTIONARY, len(dictionary)), dictionary, *frames])


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    trained = len(data) >= 4 and struct.unpack_from("<I", data)[0] == TRAINED
    return zstandard.ZstdCompressionDict(
        data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    )


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and block sizes."""
    try:
        (flags,) = struct.unpack_from("<B", data, at + 4)
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            low, high = struct.unpack_from("<HB", data, at)
            block = low | high << 16
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            at += 3 + (1 if kind == 1 else size)
    except struct.error as error:
        raise BadArchive("the last frame is cut off") from error
    at += 4 * (flags >> 2 & 1)
    if at > len(data):
        raise BadArchive("the last frame is cut off")
    return at


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each data frame, decoded one at a time."""
    decompressor, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        if at + 8 > len(data):
            raise BadArchive("trailing bytes")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            content = data[at + 8 : at + 8 + size]
            if len(content) != size:
                raise BadArchive("a skippable frame is cut off")
            if at == 0 and magic == DICTIONARY:
                if len(content) >= 4 and struct.unpack_from("<I", content)[0] == FRAME:
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
            at += 8 + size
        elif magic == FRAME:
            end = frame_end(data, at)
            try:
                yield decompressor.decompressobj().decompress(data[at:end])
            except zstandard.ZstdError as error:
                raise BadArchive(str(error)) from error
            at = end
        else:
            raise BadArchive(f"unknown frame magic {magic:#x}")


def _write(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        size = 0

        def archive() -> pa.RecordBatch:
            content = build_archive(records)
            name = hashlib.sha1(content).hexdigest()[:20] + ".warc.zst"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(records)], pa.int32()), pa.array([content], pa.binary())],
                names=["archive", "records", "content"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for row in zip(*[column.to_pylist() for column in part.columns]):
                    page_id, url, payload, kind, refers_to = row
                    records.append(encode_record(page_id, url, payload, kind, refers_to, date))
                    size += len(payload)
                    if size >= ARCHIVE_BYTES:
                        yield archive()
                        records.clear()
                        size = 0
        if records:
            yield archive()

    return write


def _read(with_payload: bool):
    names = [part.split()[0] for part in READ.split(", ")]
    schema = pa.schema(
        list(
            zip(
                names,
                [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()],
            )
        )
    )

    def rows(archive: str, content: bytes) -> Iterator[tuple]:
        number, found = -1, iter(frames(content))
        while True:
            number += 1
            try:
                record = decode_record(next(found))
            except StopIteration:
                return
            except (BadArchive, ValueError) as error:
                yield (archive, number, *[None] * 7, str(error))
                if isinstance(error, BadArchive):
                    return
                continue
            yield (
                archive, number, record.page_id, record.url, record.payload_bytes, record.payload_digest,
                record.record_type, record.refers_to, record.payload if with_payload else None, None,
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out: list[tuple] = []
                for row in rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or b""):
                    out.append(row)
                    if len(out) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return read


def write_archives(pages: DataFrame, least_bytes: int = 0, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Stores ``pages`` (``page_id, url, html``) as archives; returns the table ``archive, records, content``.

    Among pages of equal payload of at least ``least_bytes`` bytes, the one with the largest ``page_id`` is the response
    and the others revisit it. Pages that share that largest id are all responses; a null id is never the largest
    beside another. Null html is the empty payload. Extra columns are left out, an empty table gives no archive.
    Groups of equal payloads are counted by digest, so a payload shared by a third of the pages stays one small row.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .where("n > 1")
        .select("digest", "first", F.lit(True).alias("shared"))
    )
    joined = rows.join(lookup_side(shared), "digest", "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )
    return durable(arrow_map(records, _write(date), WRITTEN))


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of archives given as ``archive, content``. A record that fails a check is a row with only ``error``;
    after a broken frame the rest of that archive cannot be read and the error row is its last."""
    return arrow_map(archives.select("archive", "content"), _read(with_payload), READ)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """Archives from ``.warc.zst`` files on any storage that Spark reads. A file is one row, so it must fit a task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select(F.col("path").alias("archive"), "content")
