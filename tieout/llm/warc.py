"""WARC archives: written with one gzip member per record, read sequentially.

Writing. Pages are grouped by the SHA-1 of their payload with one narrow
aggregate; of equal payloads, the one with the largest page id (ties: the row
read last) becomes a response record, the others revisit records that name it
and carry no payload. Payloads below a size limit are always responses. Digests
that repeat form a table, which rows meet in a join whose strategy follows its
size; a payload shared by many pages is split by adaptive execution. Archives are
plain byte files, written by Spark, and end with an empty gzip member.

Reading. Each archive is inflated member by member in small steps with
incremental zlib. A member must hold one record: headers, as many bytes as
Content-Length says, and the closing empty lines. The digest of every payload is
computed again and compared. A record that breaks these rules raises.

Defined cases: NULL html is an empty payload; a NULL page id counts as smaller
than all others and is left out of the record; a NULL url leaves out the target
URI; control characters and blanks in it are escaped. Repeated pages each get a
record. An empty table writes no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.llm.bytefiles import read_files, write_files
from tieout.llm.common import scratch_of, table

BYTES_PER_FILE = 16 << 20
STEP = 1 << 16
DATE = "1970-01-01T00:00:00Z"
GZIP = 31  # zlib's window bits for a gzip member
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = (
    "record_id string, record_type string, url string, page_id bigint, payload_bytes bigint,"
    " payload_digest string, refers_to bigint, payload binary"
)
ARROW_FIELDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


class BrokenArchive(ValueError):
    """An archive that breaks the format or whose payload is not what it claims."""


# --- records --------------------------------------------------------------------------


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


END_MARK = gzip_member(b"")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def escaped(url: str) -> str:
    """Without characters that would end a header line."""
    return "".join(c if c > " " and c != "\x7f" else quote(c) for c in url)


def record_id(page_id: int | None, row: int, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{row}:{digest}"


def record(
    page_id: int | None,
    url: str | None,
    row: int,
    payload: bytes | None,
    size: int,
    digest: str,
    revisit: bool,
    response_row: int | None,
    refers_to: int | None,
) -> bytes:
    """A response record, or a record that revisits the response of another row."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, row, digest)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append(f"WARC-Target-URI: {escaped(url)}")
    if page_id is not None:
        headers.append(f"X-Page-ID: {page_id}")
    if revisit:
        headers.append(f"WARC-Profile: {PROFILE}")
        headers.append(f"WARC-Refers-To: <{record_id(refers_to, response_row, digest)}>")
        if refers_to is not None:
            headers.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(content: bytes, step: int = STEP) -> Iterator[bytes]:
    """What each gzip member inflates to, reading `step` bytes at a time."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(GZIP), []
        while not unpacker.eof:
            if at >= len(view):
                raise BrokenArchive("cut off inside a gzip member")
            try:
                parts.append(unpacker.decompress(view[at : at + step]))
            except zlib.error as error:
                raise BrokenArchive(str(error)) from error
            at = min(at + step, len(view)) - len(unpacker.unused_data)
        yield b"".join(parts)


def header_lines(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse(data: bytes) -> dict:
    """The fields of one record; its lengths and digests are checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, headers = header_lines(head)
    if not gap or not version.startswith("WARC/1."):
        raise BrokenArchive("no record header")
    length = int(headers["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise BrokenArchive(f"Content-Length does not frame {headers['warc-record-id']}")
    if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise BrokenArchive(f"block digest of {headers['warc-record-id']}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    _, http_headers = header_lines(http)
    size, digest = int(http_headers["content-length"]), headers["warc-payload-digest"]
    kind = headers["warc-type"]
    if kind == "response" and (len(payload), f"sha1:{base32_sha1(payload)}") != (size, digest):
        raise BrokenArchive(f"payload of {headers['warc-record-id']}")
    number = {name: int(headers[name]) if name in headers else None for name in PAGE_HEADERS}
    return {
        "record_id": headers["warc-record-id"].strip("<>"),
        "record_type": kind,
        "url": headers.get("warc-target-uri"),
        "page_id": number["x-page-id"],
        "payload_bytes": size,
        "payload_digest": digest.removeprefix("sha1:"),
        "refers_to": number["x-refers-to-page-id"],
        "payload": payload if kind == "response" else None,
    }


PAGE_HEADERS = ("x-page-id", "x-refers-to-page-id")

# --- on Spark -------------------------------------------------------------------------


def write_warc(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    bytes_per_file: int = BYTES_PER_FILE,
) -> None:
    """A record per row of (page_id, url, html), in archives under `path`.

    The rows are read twice, so `pages` must be stored.
    """
    html = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index")).alias("at"),
        html.alias("payload"),
        F.sha1(html).alias("sha1"),
    ).withColumn("row", F.xxhash64("at"))
    repeated = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(
            F.count("*").alias("_n"),
            F.max(F.struct("page_id", "at", "row")).alias("_last"),
        )
        .where("_n > 1")
        .select(
            F.col("sha1").alias("_sha1"),
            F.col("_last.page_id").alias("response_id"),
            F.col("_last.row").alias("response_row"),
            F.col("_last.at").alias("response_at"),
        )
    )
    repeated = scratch_of(pages.sparkSession).keep(repeated, "repeated-payloads")
    revisit = F.col("response_at").isNotNull() & (F.col("response_at") != F.col("at"))
    planned = rows.join(repeated, F.col("sha1") == F.col("_sha1"), "left").select(
        "page_id",
        "url",
        "row",
        # A revisit needs the size and the digest, not the payload.
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.octet_length("payload").alias("size"),
        F.unhex("sha1").alias("digest"),
        revisit.alias("revisit"),
        "response_row",
        "response_id",
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["content"])

        for batch in batches:
            for row in zip(*(column for column in batch.columns)):
                page_id, url, number, payload, size, digest, *revisit = (v.as_py() for v in row)
                digest = base64.b32encode(digest).decode()
                parts.append(
                    gzip_member(record(page_id, url, number, payload, size, digest, *revisit))
                )
                n += len(parts[-1])
                if n >= bytes_per_file:
                    yield file()
                    parts, n = [], 0
        if parts:
            yield file()

    write_files(planned.mapInArrow(archive, "content binary"), path, END_MARK)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives under `path`."""

    def rows(records: list[dict]) -> pa.RecordBatch:
        if not with_payload:
            records = [{**r, "payload": None} for r in records]
        return pa.RecordBatch.from_pylist(records, schema=ARROW_FIELDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                records, size = [], 0
                for data in members(content.as_py()):
                    if data:
                        records.append(parse(data))
                        size += len(data)
                    if size >= BYTES_PER_FILE:
                        yield rows(records)
                        records, size = [], 0
                if records:
                    yield rows(records)

    return read_files(spark, path).select("content").mapInArrow(read, FIELDS)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write archives of stored pages and return what a reader finds in them."""
    path = f"{scratch_of(pages.sparkSession).root}/warc"
    write_warc(pages, path, least_bytes)
    return read_warc(pages.sparkSession, path, with_payload=False)


def op5_warc_records(spark, sf_dir):
    """All pages as read back from their archives."""
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
