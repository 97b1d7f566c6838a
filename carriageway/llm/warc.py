"""Web archives of one Zstandard frame per record, with a shared dictionary.

File layout: a skippable frame 0x184D2A5D that holds the dictionary, then one
frame per record. Records are made in Arrow batches; Spark's own text writer
commits the files, with an empty skippable frame as its line separator, so any
file system that Spark can write to serves, and a retried task leaves no
partial file. Each file holds at most ``RECORDS_PER_FILE`` records and starts
with the dictionary again.

Of pages with one payload the largest page id is the response; the others
become revisit records that name it. Groups of copies meet as counts only:
one digest per page is aggregated (partially before the shuffle) and joined
back, so that adaptive execution can split a digest that many pages share.

Defined results: null html is an empty payload; a null url gives no target
header and reads back as null; pages without id take part, and are responses
only if no page of the group has an id; of repeated rows with the largest id
every one is a response, and rows without id refer to it; an empty table gives
no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.session import shared_dir

RECORDS_PER_FILE = 4000
DICTIONARY_BYTES = 64 * 1024
SAMPLE_PAGES, SAMPLE_CHARS = 256, 16 * 1024
RECORD_DATE = "2024-01-01T00:00:00Z"
LEVEL = 3

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
#: An empty skippable frame; every byte of it is below 0x80.
SEPARATOR = struct.pack("<II", SKIPPABLE_FIRST, 0).decode("ascii")

READ_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
               "payload binary, file string, frame_at long")


class BadArchive(ValueError):
    """A frame, header or length that does not hold."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def dictionary_for(pages: DataFrame) -> bytes:
    """Dictionary from at most ``SAMPLE_PAGES`` page starts; any sample gives the same records back, only other sizes."""
    rows = pages.select(F.substring(whole_text("html"), 1, SAMPLE_CHARS).alias("s")).limit(SAMPLE_PAGES).collect()
    samples = [r["s"].encode() for r in rows if r["s"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too uniform samples to train on: their bytes serve as they are
        return b"".join(samples)[:DICTIONARY_BYTES] or b"<!DOCTYPE html>"


def roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as (page_id, url, payload, refers_to): null for responses, else the id of the response."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(whole_text("html"), "UTF-8").alias("payload")).withColumn("key", F.sha1("payload"))
    copies = (rows.where(F.octet_length("payload") >= least_bytes).groupBy(F.col("key").alias("copy_key"))
              .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"))
    both = rows.join(copies, F.col("key") == F.col("copy_key"), "left")
    return both.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One archive record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    name = lambda i: "<urn:page:%s>" % ("none" if i is None else i)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='!#$&()*+,/:;=?@[]~')}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the archive of a page table under ``path``."""
    words = dictionary_for(pages)
    leading = struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
        done = 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if done % (RECORDS_PER_FILE + 1) == 0:
                    out.append(leading)
                    done += 1
                out.append(squeeze.compress(record(*row)))
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    (roles(pages, least_bytes).mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", RECORDS_PER_FILE + 1).option("compression", "none").text(path))


def frames_of(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each record frame; the dictionary comes from the leading skippable frame."""
    view, at, unpack = memoryview(data), 0, None
    while at < len(data):
        if len(data) - at < 8:
            raise BadArchive(f"{len(data) - at} stray bytes at {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if at + 8 + size > len(data):
                raise BadArchive(f"skippable frame at {at} is cut off")
            if magic == DICTIONARY_MAGIC and at == 0:
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8:8 + size])))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive(f"no frame starts at {at}")
        if unpack is None:
            raise BadArchive("no dictionary in the leading frame")
        one, parts, fed, step = unpack.decompressobj(), [], at, 4096
        while not one.eof:
            if fed >= len(data):
                raise BadArchive(f"frame at {at} is cut off")
            parts.append(one.decompress(view[fed:fed + step]))
            fed = min(fed + step, len(data))
            step = min(2 * step, 1 << 20)
        yield at, b"".join(parts)
        at = fed - len(one.unused_data)


def parsed(content: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload bytes, digest, payload) of a record whose headers and lengths hold."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise BadArchive("no version line")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if missing := [k for k in REQUIRED if k not in fields]:
        raise BadArchive(f"headers missing: {missing}")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive(f"block of {len(rest) - 4} bytes, header says {length}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    stated = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("utf-8").split("\r\n")[1:])}
    kind, digest = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    n = int(stated["content-length"])
    if kind == "response" and (len(payload) != n or digest_of(payload) != digest) or kind == "revisit" and payload:
        raise BadArchive(f"payload of {fields['WARC-Record-ID']} does not fit its length or digest")
    number = lambda k: None if (v := fields.get(k, "<urn:page:none>")[10:-1]) == "none" else int(v)
    url = fields.get("WARC-Target-URI")
    return number("WARC-Record-ID"), url if url is None else unquote(url), kind, number("WARC-Refers-To"), n, digest, payload


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archive files under ``path``; an archive that does not hold ends the job with ``BadArchive``.

    ``payloads=False`` checks the payloads as well and leaves them out of the rows.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for at, content in frames_of(data.as_py()):
                    row = parsed(content)
                    rows.append((*row[:6], row[6] if payloads else None, file, at))
                    held += len(content) if payloads else 100
                    if held > 16 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(records, READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """The query's rows: the archive is written to the shared folder and read back."""
    path = shared_dir(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
