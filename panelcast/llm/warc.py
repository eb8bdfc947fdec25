"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame that holds the dictionary; then every record is one Zstandard
frame.  Archives are written by Spark's text writer, so that any file system Spark knows will do and
its commit protocol drops the files of lost tasks: a row is one frame, and the line separator is an empty skippable frame.

The reader loads the dictionary from the leading frame, decodes one frame per record, and checks the
version, the mandatory headers, Content-Length, the block's end, and the payload's length and digest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import join_same, materialize, scratch, ship, small

# fixed values of the formats
DICT_MAGIC, FIRST_SKIP, LAST_SKIP, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0x184D2A5F, 0xFD2FB528
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEPARATOR = struct.pack("<II", FIRST_SKIP, 0)  # an empty skippable frame; plain ASCII, so it can be a line separator
#: Pages sampled for the dictionary, bytes taken of each, size of the dictionary, payload bytes per archive, level.
SAMPLE_PAGES, SAMPLE_BYTES, DICT_BYTES, ARCHIVE_BYTES, LEVEL = 400, 8192, 32_768, 16_000_000, 3
STAMP = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record or archive that breaks the format."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload: bytes, refers_to=None) -> bytes:
    """One record; ``refers_to`` makes it a revisit, which keeps the HTTP head and leaves out the payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
              ("WARC-Date", STAMP), ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
              ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    return b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"", b""]) + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, block and payload of one record, checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION or not gap:
        raise WarcError(f"not a {VERSION.decode()} record: {lines[0][:40]!r}")
    h = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise WarcError(f"a header without a colon: {line[:40]!r}")
        h[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in h:
            raise WarcError(f"no {name} header")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4:
        raise WarcError(f"Content-Length is {h['content-length']}, the block has {len(rest) - 4} bytes")
    if rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block does not end in two line ends")
    block = rest[:-4]
    if h.get("warc-block-digest") not in (None, f"sha1:{sha1_base32(block)}"):
        raise WarcError("the block's digest is wrong")
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = next((v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"), b"")
    if not gap or not size.isdigit():
        raise WarcError("the HTTP head has no length")
    if h["warc-type"] == "response":
        if len(payload) != int(size) or h["warc-payload-digest"] != f"sha1:{sha1_base32(payload)}":
            raise WarcError("the payload's length or digest is wrong")
    elif h["warc-type"] != "revisit" or payload or h.get("warc-profile") != PROFILE or "warc-refers-to" not in h:
        raise WarcError(f"a broken {h['warc-type']} record")
    return {"headers": h, "payload": payload, "payload_bytes": int(size)}


def write_frame(data: bytes, compressor) -> bytes:
    return compressor.compress(data)


def read_frames(stream, step: int = 1 << 16):
    """The decoded frames of an archive, each as bytes; the leading dictionary frame is loaded, other skippable frames are skipped."""
    buffer, dictionary, at_start = b"", None, True

    def need(n):
        nonlocal buffer
        while len(buffer) < n and (more := stream.read(max(step, n - len(buffer)))):
            buffer += more
        return len(buffer) >= n

    while need(4) or buffer:
        if len(buffer) < 4:
            raise WarcError("the archive ends inside a frame")
        magic = struct.unpack_from("<I", buffer)[0]
        if FIRST_SKIP <= magic <= LAST_SKIP:
            if not need(8) or not need(8 + struct.unpack_from("<I", buffer, 4)[0]):
                raise WarcError("the archive ends inside a skippable frame")
            end = 8 + struct.unpack_from("<I", buffer, 4)[0]
            if magic == DICT_MAGIC:
                if not at_start:
                    raise WarcError("the dictionary is not the first frame")
                body = buffer[8:end]
                if body[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
            buffer, at_start = buffer[end:], False
            continue
        if magic != FRAME_MAGIC:
            raise WarcError(f"no frame starts with {magic:#x}")
        at_start = False
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts = []
        try:
            while not one.eof:
                if not buffer and not need(1):
                    raise WarcError("the archive ends inside a frame")
                parts.append(one.decompress(buffer))
                buffer = one.unused_data if one.eof else b""
        except zstandard.ZstdError as e:
            raise WarcError(f"a frame can't be decoded: {e}") from e
        yield b"".join(parts)


def train_dictionary(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, size: int = DICT_BYTES) -> bytes:
    """A dictionary from the first bytes of at most ``sample_pages`` pages, chosen by hash; empty if they are too few."""
    rows = (pages.where(F.length("html") > 0).select(F.xxhash64("page_id", F.lit("dict")).alias("h"),
                                                     F.substring(F.encode("html", "UTF-8"), 1, SAMPLE_BYTES).alias("x"))
            .orderBy("h", "x").limit(sample_pages).collect())
    samples = [bytes(r["x"]) for r in rows]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html; others are ignored) into archives below ``path``.

    The payload is the html in UTF-8, null as empty.  Of records with equal payloads of at least ``min_bytes`` bytes
    the one with the smallest page_id is a response and the others revisit it; repeated rows of that
    page_id are all responses; a null page_id is written as ``None`` and comes last.  An empty table makes archives without records."""
    ship(pages.sparkSession)
    p = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("_sha", F.unhex(F.sha2("payload", 256)))
    sized = p.where(F.octet_length("payload") >= min_bytes)
    # null page_ids come last: min() skips them
    repeated = materialize(sized.groupBy("_sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                           .where("n > 1 AND first IS NOT NULL").select("_sha", "first"))
    total = p.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    p = join_same(p, small(repeated), ["_sha"], "left")
    revisits = (F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    p = p.select("page_id", "url", "payload", F.when(revisits, F.col("first")).alias("refers_to"))
    p = p.repartition(max(1, -(-total // archive_bytes)), F.xxhash64("page_id", "url"))
    dictionary = train_dictionary(pages)

    def frames(batches):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        if dictionary:
            yield pa.record_batch([pa.array([struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary], pa.binary())], ["frame"])
        for b in batches:
            for part in (b.slice(i, 64) for i in range(0, b.num_rows, 64)):
                yield pa.record_batch([pa.array(
                    [write_frame(record(i, u, x, r), compressor) for i, u, x, r in zip(
                        *(part.column(k).to_pylist() for k in range(4)), strict=True)], pa.binary())], ["frame"])

    # the bytes go through a string column unchanged: the text writer copies them
    p.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR.decode()).option("maxRecordsPerFile", 0).option("compression", "none").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(archive, record_id, record_type, url, refers_to, payload_bytes, payload_digest, payload) of every record below ``path``.
    A record or archive that breaks the format raises ``WarcError``."""

    ship(spark)

    def records(batches):
        for b in batches:
            for k in range(b.num_rows):
                name, rows = b.column(0)[k].as_py(), []
                for data in read_frames(io.BytesIO(b.column(1)[k].as_buffer())):
                    r = parse_record(data)
                    h = r["headers"]
                    rows.append((name, h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h.get("warc-refers-to"),
                                 r["payload_bytes"], h["warc-payload-digest"], r["payload"] if h["warc-type"] == "response" else None))
                    if len(rows) == 64:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    names = ["archive", "record_id", "record_type", "url", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]

    def batch(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(records, "archive string, record_id string, record_type string, url string, refers_to string, "
                                     "payload_bytes bigint, payload_digest string, payload binary")


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).cast("bigint")
    return read(spark, path).select(
        page(F.when(F.col("record_id") != "<urn:page:None>", F.col("record_id"))).alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        page(F.col("refers_to")).alias("refers_to"))
