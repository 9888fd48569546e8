"""WARC archives: written as whole-file gzip streams, normalised to one member per record.

``write_monolithic`` writes pages as WARC records into ordinary gzip files, one
stream per file. ``normalise`` inflates each such file once, as a stream, writes
every record again as a gzip member of its own, and puts a sidecar offset index
beside the new archive: with it, one record is read by its offset and length.
Files are written and read by Spark, so they may lie in any store that Spark reaches.

Layout after ``normalise``: ``archive=<name>/kind=warc`` holds the archive (gzip
members, then one zero byte, which gzip readers take as padding);
``archive=<name>/kind=index`` holds its index, one JSON object per record, each
followed by a zero byte: offset, length, record id and type.

Pages of equal payload: that with the largest page_id is a response, the others
are revisits that refer to it. Defined cases: null html is an empty payload
(equal to other empty ones); a null page_id counts as the smallest, and where a
group has no other, all its records are responses; rows repeated with the largest
page_id are all responses; a null url is written empty; an empty table gives
archives without records; very long pages are written whole, few or one to a file; extra
columns are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.session import scratch_path

from .common import written

RECORDS_PER_FILE = 2_000
FILE_BYTES = 128 << 20            # inflated payloads of a file, unless one record alone is larger
SEGMENT_BYTES = 8 << 20           # a normalised archive is closed when it is this large
MAX_BROADCAST_GROUPS = 200_000
CRLF = "\r\n"
RECORD_ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four 40-bit pieces of eight digits each."""
    digest = F.sha1(payload)
    pieces = [F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*pieces), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _roles(pages: DataFrame) -> DataFrame:
    """Pages with ``digest`` and, where a page with an equal payload and a larger id exists, its id."""
    keyed = pages.withColumn("digest", base32_sha1(F.col("html")))
    groups = (keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last"))
              .where((F.col("n") > 1) & F.col("last").isNotNull()).select(F.col("digest").alias("g_digest"), "last"))
    groups = written(groups, "warc-groups")
    if groups.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    return keyed.join(groups, F.col("digest") == F.col("g_digest"), "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))


def size_class(size: Column, file_bytes: int = FILE_BYTES) -> Column:
    """0 for records of which ``RECORDS_PER_FILE`` fill a file at most, then one more for each 16 times."""
    limit, found = file_bytes // RECORDS_PER_FILE, F.lit(0)
    for k in range(1, 4):
        found = F.when(size > limit * 16 ** (k - 1), k).otherwise(found)
    return found


def records_per_file(k: int, file_bytes: int = FILE_BYTES) -> int:
    """Records of a size class that a file may hold; of the last class, one."""
    return 1 if k == 3 else max(1, file_bytes // (file_bytes // RECORDS_PER_FILE * 16 ** k))


def write_monolithic(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write (page_id, url, html) as WARC records, each file one gzip stream.

    Records are written by size class, so that a file's records have ``file_bytes`` at most, or
    are one: readers take whole files, and no file may grow with the pages in it.
    """
    rows = _roles(pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", " ").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html")))
    revisit = F.col("refers_to").isNotNull()
    name = F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("html").cast("string"), F.lit(CRLF * 2))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), name, F.lit(f"{CRLF}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{CRLF}WARC-Date: 1970-01-01T00:00:00Z{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <{RECORD_ID}"),
                                 F.col("refers_to").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(CRLF * 2))
    kind = size_class(F.coalesce(F.octet_length("html"), F.lit(0))
                      + F.coalesce(F.octet_length("url"), F.lit(0)), file_bytes)
    classes = sorted(r[0] for r in pages.select(kind.alias("k")).distinct().collect()) or [0]   # four at most
    for k in classes:
        some = rows if len(classes) == 1 else rows.where(kind == k)
        (some.select(F.concat(header, http, body).alias("record")).write.mode("append")
         .option("lineSep", CRLF * 2).option("compression", "gzip")
         .option("maxRecordsPerFile", records_per_file(k, file_bytes))
         .option("zlib.compress.level", "BEST_SPEED").text(path))


# ---------------------------------------------------------------- records

def inflate(content: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """A gzip file's bytes in pieces; members follow each other, zero bytes are padding."""
    at, size = 0, len(content)
    while at < size:
        if content[at] == 0:
            at += 1
            continue
        stream = zlib.decompressobj(31)
        while at < size and not stream.eof:
            piece = content[at: at + step]
            out = stream.decompress(piece)
            at += len(piece) - len(stream.unused_data)
            if out:
                yield out
        if not stream.eof:
            raise ValueError("gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole WARC records, with their closing blank lines, from a stream of bytes."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(field(bytes(held[:end]), b"content-length")) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("record ends early")


def members(content: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, inflated bytes) of each gzip member of an archive."""
    at = 0
    while at < len(content) and content[at]:
        stream, end, parts = zlib.decompressobj(31), at, []
        while not stream.eof:
            piece = content[end: end + step]
            if not piece:
                raise ValueError("gzip member ends early")
            parts.append(stream.decompress(piece))
            end += len(piece) - len(stream.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def field(header: bytes, name: bytes) -> bytes | None:
    """Value of a header line (names in any case)."""
    for line in header.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip()
    return None


def read_record(record: bytes) -> dict:
    """What a record says about its page; a response's digest is taken from its payload."""
    header, _, block = record.partition(b"\r\n\r\n")
    http, _, payload = block[:-4].partition(b"\r\n\r\n")
    kind = field(header, b"warc-type").decode()
    told = field(header, b"warc-payload-digest").decode().removeprefix("sha1:")
    size = int(field(http, b"content-length"))
    if kind == "response":
        digest = b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != told or size != len(payload):
            raise ValueError("payload does not match its record")
    refers = field(header, b"warc-refers-to")
    return {"page_id": _page(field(header, b"warc-record-id")), "payload_bytes": size, "payload_digest": told,
            "record_type": kind, "refers_to": _page(refers) if refers else None}


def _page(record_id: bytes) -> int | None:
    value = record_id.decode().strip("<>").removeprefix(RECORD_ID)
    return None if value == "null" else int(value)


# ---------------------------------------------------------------- normalise

def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Whole-file gzip WARC files to archives of one member per record, with their indexes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(stem: str, k: int, members: list[bytes], index: list[bytes]) -> pa.RecordBatch:
            name = f"{stem}-{k:05d}"
            return pa.RecordBatch.from_arrays(
                [pa.array([name, name]), pa.array(["warc", "index"]),
                 pa.array([b"".join(members), b"\0".join(index)], pa.binary())],
                names=["archive", "kind", "body"])

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                stem = path.rsplit("/", 1)[-1].split(".")[0]
                members, index, offset, k = [], [], 0, 0
                for record in records(inflate(content.as_py())):
                    member = gzip.compress(record, 6, mtime=0)
                    header = record[: record.find(b"\r\n\r\n")]
                    index.append(json.dumps({
                        "offset": offset, "length": len(member), "id": field(header, b"warc-record-id").decode(),
                        "type": field(header, b"warc-type").decode()}).encode())
                    members.append(member)
                    offset += len(member)
                    if offset >= SEGMENT_BYTES:
                        yield close(stem, k, members, index)
                        members, index, offset, k = [], [], 0, k + 1
                if members:
                    yield close(stem, k, members, index)

    archives = files.mapInArrow(run, "archive string, kind string, body binary")
    (archives.withColumn("body", F.col("body").cast("string")).write.partitionBy("archive", "kind")
     .option("lineSep", "\0").option("compression", "none").text(target))


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(archive, content) of one kind of file; none where no archive was written."""
    files = spark.read.format("binaryFile").load(path)
    if "kind" not in files.columns:                  # no folder to find the columns in
        return spark.createDataFrame([], "archive string, content binary")
    return files.where(F.col("kind") == kind).select("archive", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, length, id, type) of every record."""
    lines = _files(spark, path, "index").select("archive", F.explode(F.split(F.col("content").cast("string"), "\0")).alias("line"))
    entry = F.from_json("line", "offset bigint, length bigint, id string, type string")
    return lines.where("line <> ''").select("archive", entry.alias("e")).select("archive", "e.*")


READ_DDL = ("archive string, offset bigint, length bigint, page_id bigint, payload_bytes bigint, "
            "payload_digest string, record_type string, refers_to bigint")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the normalised archives, with the place of its member."""
    files = _files(spark, path, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [{"archive": archive, "offset": at, "length": size} | read_record(record)
                        for at, size, record in members(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    return files.mapInArrow(run, READ_DDL)


_READ = pa.schema([(n, pa.string() if t == "string" else pa.int64())
                   for n, t in (c.split() for c in READ_DDL.split(", "))])


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Write the pages, normalise the files, and read every indexed record back."""
    spark = pages.sparkSession
    first, second = scratch_path(spark, "warc-monolithic"), scratch_path(spark, "warc")
    write_monolithic(pages, first)
    normalise(spark, first, second)
    found = read_archives(spark, second)
    index = read_index(spark, second).select(F.col("archive").alias("i_archive"), F.col("offset").alias("i_offset"),
                                             F.col("length").alias("i_length"))
    on = ((F.col("archive") == F.col("i_archive")) & (F.col("offset") == F.col("i_offset"))
          & (F.col("length") == F.col("i_length")))
    return index.join(found, on, "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length")
