"""Zstandard WARC archives: a dictionary in the leading skippable frame, one frame per record.

Spark's text writer writes the frames: its line separator is an empty skippable
frame, so each file is a valid Zstandard stream that any WARC tool can read, and
the files of a task are committed as a whole or not at all.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.llm.stages import Stages
from varspark.session import stored

# Fixed values of the formats: frame marks, record head, profile of revisits.
DICTIONARY_MARK, FRAME_MARK = 0x184D2A5D, 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

#: Payloads from which the dictionary is trained, the bytes read of each, and the size of the dictionary.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16 << 10, 64 << 10
#: Compressed bytes at which an archive is closed.
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
READ_BYTES = 4 << 10


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items())
    return VERSION + b"\r\n" + head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A response, or a revisit of page ``first`` that holds the HTTP head only."""
    head = HTTP_HEAD % len(payload)
    block = head if first is not None else head + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",  # pages carry no time
        "Content-Type": "application/http;msgtype=response",
        "WARC-Block-Digest": f"sha1:{digest_of(block)}",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if uri:
        fields["WARC-Target-URI"] = uri
    if first is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{first}>"}
    return record(fields, block)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields, names in lower case, and block; raises where the head or the length is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", VERSION):
        raise ValueError("no WARC head")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"no field: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"fields missing: {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, head says {size}")
    return fields, rest[:size]


def page_of(fields: dict[str, str], block: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes | None]:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload; raises where a digest or length is wrong."""
    named = lambda key: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(key, ""))) else None
    head, gap, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)", head)
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if not gap or not length or fields.get("warc-block-digest") != f"sha1:{digest_of(block)}":
        raise ValueError(f"damaged block in {fields['warc-record-id']}")
    if kind == "response" and (len(payload) != int(length[1]) or digest_of(payload) != digest):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    if kind == "revisit" and (payload or named("warc-refers-to") is None):
        raise ValueError(f"damaged revisit in {fields['warc-record-id']}")
    return named("warc-record-id"), fields.get("warc-target-uri"), int(length[1]), digest, kind, named("warc-refers-to"), payload if kind == "response" else None


# ---- frames


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MARK, len(dictionary)) + dictionary


def records_of(archive: bytes) -> Iterator[bytes]:
    """Records of an archive, decoded frame by frame with the dictionary of its leading skippable frame.

    The dictionary may itself be compressed. Other skippable frames are passed over. Raises at a broken frame.
    """
    at, whole, opener = 0, memoryview(archive), zstandard.ZstdDecompressor()
    while at < len(archive):
        if len(archive) - at < 8:
            raise ValueError(f"broken frame at byte {at}")
        mark, size = struct.unpack_from("<II", archive, at)
        if mark in SKIPPABLE:
            if at + 8 + size > len(archive):
                raise ValueError(f"broken frame at byte {at}")
            if mark == DICTIONARY_MARK and at == 0:
                found = archive[8 : 8 + size]
                if found[:4] == struct.pack("<I", FRAME_MARK):
                    found = zstandard.ZstdDecompressor().decompress(found)
                opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(found))
            at += 8 + size
        elif mark == FRAME_MARK:
            decoder = opener.decompressobj()
            begin, data = at, []
            while not decoder.eof:  # by small parts, as what follows the frame is copied
                if at >= len(archive):
                    raise ValueError(f"broken frame at byte {begin}")
                data.append(decoder.decompress(whole[at : at + READ_BYTES]))
                at = min(at + READ_BYTES, len(archive))
            at -= len(decoder.unused_data)
            yield b"".join(data)
        else:
            raise ValueError(f"no frame at byte {at}")


# ---- tables


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the first bytes of a bounded sample of payloads, by hash of page_id; empty if there is too little."""
    begins = pages.where("length(html) > 0").select("page_id", F.substring("html", 1, SAMPLE_BYTES).alias("begin"))
    texts = [r.begin.encode() for r in begins.orderBy(F.xxhash64("page_id"), "page_id", "begin").limit(SAMPLE_PAGES).collect()]
    if len(texts) < 16 or sum(map(len, texts)) < 4 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, [HTTP_HEAD % len(t) + t for t in texts]).as_bytes()


def write_archives(pages: DataFrame, path: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A record per page. Of pages with equal payloads of at least ``least`` bytes the smallest page_id is the response, the others revisit it.

    Equal means equal SHA-1 and length. Null html is an empty payload. Rows without page_id are always responses and are not referred to;
    rows that repeat the smallest page_id are responses too.
    """
    html = F.coalesce("html", F.lit(""))
    known = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("size"))
    first = known.where(F.col("page_id").isNotNull() & (F.col("size") >= least)).groupBy(F.col("sha").alias("_sha"), F.col("size").alias("_size"))
    first = first.agg(F.min("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1").drop("pages")
    rows = known.join(first, (F.col("sha") == F.col("_sha")) & (F.col("size") == F.col("_size")), "left")
    rows = rows.select("page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("first"))
    dictionary = train_dictionary(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        archive, size, piece = -1, archive_bytes, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                numbers, pieces, frames = [], [], []
                for page_id, url, text, first in zip(*[c.to_pylist() for c in batch.slice(lo, 64).columns], strict=True):
                    payload = text.encode()
                    made = [compressor.compress(page_record(page_id, url, payload, digest_of(payload), first))]
                    if size >= archive_bytes:
                        archive, size, piece = archive + 1, 0, 0
                        made = [dictionary_frame(dictionary), *made]
                    for frame in made:
                        numbers.append(archive), pieces.append(piece), frames.append(frame)
                        piece, size = piece + 1, size + len(frame)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(pieces, pa.int32()), pa.array(frames, pa.binary())], ["n", "piece", "frame"])

    frames = rows.mapInArrow(write, "n int, piece int, frame binary")
    # An archive is one file: the writer opens a file per task and archive number.
    frames = frames.sortWithinPartitions("n", "piece").select("n", F.col("frame").cast("string").alias("value"))
    frames.write.partitionBy("n").option("lineSep", SEPARATOR.decode("ascii")).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits) of all records; raises at damaged ones."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for data in records_of(content.as_buffer().to_pybytes()):
                    rows.append(page_of(*parse_record(data)))
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archived_pages(pages: DataFrame, **options) -> DataFrame:
    """Write all pages to archives and read them back: the columns of ``read_archives`` without the payload.

    Each input row gives one row; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    stages = Stages(spark)
    path = stages.path("warc")
    write_archives(pages, path, **options)
    records = stored(read_archives(spark, path).drop("payload"), "warc-records")
    stages.drop()
    return records
