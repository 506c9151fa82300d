"""Dictionary-compressed WARC archives (operator 6).

An archive is a sequence of Zstandard frames: first a skippable frame that
holds a dictionary built from the archive's own records, then a ``warcinfo``
record and one record per frame, each compressed with that dictionary.

Spark's text writer writes the files (so their commit survives lost tasks and
works in any store): each row is a frame, and the "line separator" is an empty
skippable frame, which every Zstandard reader passes over.

The first of the records with equal payloads (smallest page id) is a
``response``, the others are ``revisit`` records that refer to it.

Edge cases: null html is an empty payload; a null url becomes an URN; equal
rows with the smallest id are all responses; a null id counts as larger than
all others.  Extra columns are ignored.  An empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches
from tabstack.session import scratch_path

#: Fixed values of the formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SKIP_MAGIC = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_BYTES = 4 << 20       # records of an archive that its dictionary is built from
DICTIONARY_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: str | None, url: str | None, payload: bytes, sha: str, refers: str | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    name = "" if page is None else page
    uri = f"urn:page:{name}" if url is None else "".join(url.split())
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_record(date: str = DATE) -> bytes:
    block = b"software: tabstack\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:warcinfo>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples' own bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_frames(records: Iterator[bytes], sample_bytes: int = SAMPLE_BYTES) -> Iterator[bytes]:
    """The frames of one archive; nothing for no record."""
    samples, size = [], 0
    for r in records:
        samples.append(r)
        size += len(r)
        if size >= sample_bytes:
            break
    if not samples:
        return
    raw = build_dictionary(samples)
    yield DICTIONARY_MAGIC + struct.pack("<I", len(raw)) + raw
    packer = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    yield packer.compress(info_record())
    for r in samples:
        yield packer.compress(r)
    for r in records:
        yield packer.compress(r)


def read_frames(raw: bytes) -> Iterator[bytes]:
    """The contents of all data frames of an archive."""
    at, reader, view = 0, zstandard.ZstdDecompressor(), memoryview(raw)
    while at < len(raw):
        magic = int.from_bytes(view[at: at + 4], "little")
        if magic in SKIP_MAGIC:
            size = int.from_bytes(view[at + 4: at + 8], "little")
            if at == 0 and bytes(view[:4]) == DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8: 8 + size])))
            at += 8 + size
            continue
        frame, parts, step = reader.decompressobj(), [], 1 << 14
        while not frame.eof:
            if at >= len(raw):
                raise ValueError("an archive ends inside a frame")
            piece = view[at: at + step]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def with_first(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page, url, html, first``: ``first`` is the smallest id with the row's payload where that is another row's.

    Only payloads that occur more than once take part in the join; rows of a
    very frequent one are split by the adaptive skew join.
    """
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    keyed = src.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    shared = (keyed.select("page_id", "sha").groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("sha", "first_id"))
    again = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return keyed.join(shared, "sha", "left").select(F.col("page_id").cast("string").alias("page"), "url", "html",
                                                    F.when(again, F.col("first_id")).cast("string").alias("first"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   sample_bytes: int = SAMPLE_BYTES) -> None:
    """Write a record per row of ``pages`` to archives under ``path``, one per task."""
    rows = with_first(pages, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for b in batches:
                for k in range(b.num_rows):
                    page, url, html, first = (b.column(j)[k].as_py() for j in range(4))
                    payload = html.encode("utf-8", "replace")
                    yield record("response" if first is None else "revisit", page, url, payload, digest(payload), first)

        out, size = [], 0
        for frame in write_frames(records(), sample_bytes):
            out.append(frame)
            size += len(frame)
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    frames = map_batches(rows, run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """A row per record of the archives under ``path``; lengths and digests are those of the stored payload,
    for revisits what their header says."""
    src = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(fields: dict[str, str], block: bytes) -> tuple:
            head, _, payload = block.partition(b"\r\n\r\n")
            page, sha = fields["WARC-Record-ID"][len("<urn:page:"):-1] or None, fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response":
                if digest(payload) != sha:
                    raise ValueError(f"record of page {page}: the payload does not have its digest")
                return page, fields["WARC-Target-URI"], len(payload), sha, "response", None
            size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
            return page, fields["WARC-Target-URI"], size, sha, "revisit", fields["WARC-Refers-To"][len("<urn:page:"):-1] or None

        names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for b in batches:
            for content in b.column(0):
                found = [row(*x) for x in map(parse_record, read_frames(content.as_py())) if x[0]["WARC-Type"] != "warcinfo"]
                cols = list(zip(*found)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    out = map_batches(src, run, "page string, url string, payload_bytes bigint, payload_digest string, record_type string, refers string")
    return out.select(F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers").cast(id_type).alias("refers_to"), "url")


def round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id") -> DataFrame:
    """Write archives (under the shared folder unless ``path`` is given) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, id_col)
    return read_archives(spark, path, pages.schema[id_col].dataType.simpleString())
