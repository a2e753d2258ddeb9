"""Zstandard WARC archives: writer, reader with validation, and the round trip (op 1).

Layout. An archive is a legal ``.warc.zst`` stream: a leading skippable frame (magic
0x184D2A5D) that holds the archive's dictionary, then one Zstandard frame per record.
Spark's text writer puts the bytes on any Hadoop store; its line separator is an empty
skippable frame (8 ASCII bytes), which every Zstandard reader skips, so the separator
is part of the format and not a foreign byte. An archive is rolled at ``archive_bytes``
of compressed data (one record may exceed it), which bounds what a reader holds.

Payload de-duplication: of the rows with equal payloads the smallest page_id becomes the
``response`` record, rows with other ids become ``revisit`` records that name it. Only
(id, SHA-1) pairs are shuffled for that; a payload shared by a third of the rows is
pre-aggregated per task, and the join back is one the adaptive planner splits.

Defined cases: NULL html is an empty payload; NULL url leaves the target header out; NULL
page_id takes part with an empty id and never becomes the referred page; rows repeated
with the smallest id are all responses; an empty table gives no archive and no rows;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from clinark.llm.common import read_table
from clinark.session import run_dir

#: Fixed values of the two formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SKIP_LOW, SKIP_HIGH = 0x184D2A50, 0x184D2A5F
SEPARATOR = struct.pack("<II", SKIP_LOW, 0).decode("ascii")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 16 << 10
DICTIONARY_SAMPLES = 64
READ_BATCH_BYTES = 8 << 20
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("target_uri", pa.string()), ("payload", pa.binary())])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id, url, payload: bytes, refers_to) -> bytes:
    """One uncompressed record: version line, headers, blank line, block, two line ends."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", EPOCH),
            ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if refers_to is not None:
        head += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Check one record's version, required headers, lengths and digests; give its fields."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"malformed WARC header {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"WARC header {name} is missing")
    length = int(fields["content-length"])
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record of {len(rest)} bytes does not fit its Content-Length {length}")
    block = rest[:length]
    if fields.get("warc-block-digest", digest := f"sha1:{base32_sha1(block)}") != digest:
        raise ValueError("block digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not http.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP response")
    size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (size != len(payload) or digest != base32_sha1(payload)):
        raise ValueError("payload length or digest differs")
    if kind == "revisit" and (payload or size is None or "warc-refers-to" not in fields):
        raise ValueError("malformed revisit record")
    return {"page_id": _page(fields["warc-record-id"]), "record_type": kind,
            "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": digest, "target_uri": fields.get("warc-target-uri"),
            "payload": payload if kind == "response" else None}


def make_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; raw content where there are too few samples to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n",
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def read_archive(data: bytes) -> Iterator[dict]:
    """Every record of one archive, in order. Raises ValueError on anything malformed."""
    view, at, dictionary = memoryview(data), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError("truncated frame header")
        magic, size = struct.unpack_from("<II", view, at)
        if SKIP_LOW <= magic <= SKIP_HIGH:
            if at + 8 + size > len(view):
                raise ValueError("truncated skippable frame")
            if at == 0 and magic == DICTIONARY_MAGIC:
                content = bytes(view[8:8 + size])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):     # the dictionary may itself be compressed
                    content = zstandard.ZstdDecompressor().decompress(content, max_output_size=64 << 20)
                dictionary = zstandard.ZstdCompressionDict(content)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no Zstandard frame at byte {at}")
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        pieces = []
        step = at
        while not decoder.eof and step < len(view):
            pieces.append(decoder.decompress(view[step:step + (1 << 16)]))
            step = min(step + (1 << 16), len(view))
        if not decoder.eof:
            raise ValueError("truncated frame")
        at = step - len(decoder.unused_data)
        yield parse_record(b"".join(pieces))


def _plan_revisits(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """pages with ``refers_to``: the smallest page_id of its payload group, or NULL."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.unhex(F.sha1(payload)).alias("sha"),
                        F.octet_length(payload).alias("size"))
    keys = rows.where(F.col("size") >= min_revisit_bytes).select("page_id", "sha")
    first = (keys.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first is not null").drop("n"))
    again = (keys.join(first, "sha").where(~F.col("page_id").eqNullSafe(F.col("first")))
             .select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), F.col("first").alias("refers_to"))
             .distinct())
    hit = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha") == F.col("r_sha"))
    return rows.join(again, hit, "left").select("page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``."""
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, archive, used, coder = TaskContext.get().partitionId(), -1, archive_bytes, None
        for batch in batches:
            for lo in range(0, len(batch), DICTIONARY_SAMPLES):
                rows = zip(*(batch.column(c).slice(lo, DICTIONARY_SAMPLES).to_pylist()
                             for c in ("page_id", "url", "html", "refers_to")), strict=True)
                block = [record_bytes(i, u, (h or "").encode(), r) for i, u, h, r in rows]
                numbers, out = [], []
                for data in block:
                    if used >= archive_bytes:
                        archive, used = archive + 1, 0
                        dictionary = make_dictionary(block)
                        coder = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
                        body = dictionary.as_bytes()
                        numbers.append(archive)
                        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
                    out.append(coder.compress(data))
                    numbers.append(archive)
                    used += len(out[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(out), pa.int32()), pa.array(numbers, pa.int32()), pa.array(out, pa.binary())],
                    names=["part", "archive", "frame"])

    rows = _plan_revisits(pages, min_revisit_bytes)
    made = rows.mapInArrow(frames, "part int, archive int, frame binary")
    # A task's rows are already in the order of (part, archive); naming the order keeps Spark from sorting frames anew.
    (made.withColumn("seq", F.monotonically_increasing_id())
     .sortWithinPartitions("part", "archive", "seq").select("part", "archive", F.col("frame").cast("string").alias("value"))
     .write.partitionBy("part", "archive").option("lineSep", SEPARATOR).text(path))


def read_archives(spark, path: str) -> DataFrame:
    """The records of every archive below ``path``; a malformed one fails the read."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for record in read_archive(content.as_py()):
                    out.append(record)
                    size += len(record["payload"] or b"") + 256
                    if size > READ_BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, RECORD_SCHEMA)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, RECORD_SCHEMA)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "part-*").load(path).select("content"))
    return files.mapInArrow(records, from_arrow_schema(RECORD_SCHEMA))


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    spark = pages.sparkSession
    path = f"{run_dir(spark, 'warc')}/archives"
    write_archives(pages, path, min_revisit_bytes)
    return read_archives(spark, path)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back: ids, payload size and digest, record type."""
    return round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
