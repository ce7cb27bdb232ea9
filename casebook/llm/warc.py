"""WARC archives: write whole-file gzip archives, normalise them, and read records by offset.

``write_archives`` lays pages down as WARC records, one gzip stream per file.
``normalise`` inflates every such stream once, rewrites each record as a gzip
member of its own, and returns the sidecar index (archive, offset, length,
record id and type), so a reader can fetch single records. ``read_records`` does
that and checks payload digests.

Files are opened through the file system that their address names, so any
shared store works. A task streams its archive and holds one record at a time; an
archive is written under a temporary name and moved into place, so a repeated
task writes the same bytes again.

Defined cases: null html is an empty payload; a null url has no target header, line
breaks in it become blanks; a null page_id is written as such and never becomes
the response if another page has the payload; rows that repeat the largest
page_id are all responses; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casebook.session import fresh_path, store

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"

INDEX = "archive string, offset long, length long, record_id string, record_type string"
RECORDS = (
    "archive string, offset long, length long, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, four characters from every five hex digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest, n_bytes, response: the page that holds the payload."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", html.alias("html"), base32_sha1(F.encode(html, "UTF-8")).alias("digest"),
        F.octet_length(html).cast("long").alias("n_bytes"),
    )
    holders = rows.where(F.col("n_bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("response"))
    if least_bytes:
        return rows.join(holders, "digest", "left").withColumn("response", F.coalesce("response", "page_id"))
    return rows.join(holders, "digest")


def record(url: Column, page_id: Column, html: Column, digest: Column, n_bytes: Column, response: Column) -> Column:
    """The text of one record up to its closing blank lines."""
    urn = lambda key: F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))
    first = page_id.eqNullSafe(response)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        n_bytes.cast("string"), F.lit(END),
    )
    block = F.when(first, F.concat(http, html)).otherwise(http)
    target = F.when(url.isNull(), "").otherwise(
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(url, r"[\r\n]+", " "), F.lit("\r\n"))
    )
    kind = F.when(first, F.lit("response\r\n")).otherwise(
        F.concat(F.lit(f"revisit\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), urn(response), F.lit("\r\n"))
    )
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), kind, F.lit("WARC-Record-ID: "), urn(page_id), F.lit("\r\n"), target,
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), digest,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block,
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write pages as WARC files, each one gzip stream. Payloads that are equal are stored once."""
    rows = with_responses(pages, least_bytes)
    text = record(*[F.col(c) for c in ("url", "page_id", "html", "digest", "n_bytes", "response")])
    rows.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def open_store(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address)


def read_headers(stream) -> dict[str, str]:
    """Header lines up to the blank line, names in lower case."""
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def raw_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and whole bytes of every record of an inflated stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        lines = [line]
        while (line := stream.readline()).strip():
            lines.append(line)
        if not line:
            raise ValueError("the archive ends in a header")
        head = b"".join(lines)
        headers = dict(
            (name.strip().lower(), value.strip())
            for name, _, value in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])
        )
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends in a block")
        yield headers, head + b"\r\n" + block + END.encode()


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def normalise_archive(archive: str, folder: str) -> Iterator[tuple[str, int, int, str, str]]:
    """Rewrite one archive into ``folder``; yields its index rows once it is in place."""
    source, path = open_store(archive)
    sink, out = open_store(folder)
    name = re.sub(r"(\.txt|\.warc)?\.gz$", "", posixpath.basename(path)) + ".warc.gz"
    final, draft = f"{out}/{name}", f"{out}/_{name}.{uuid.uuid4().hex}"
    sink.create_dir(out, recursive=True)
    rows, offset = [], 0
    with source.open_input_stream(path, compression=None) as packed, sink.open_output_stream(draft, compression=None) as to:
        for headers, data in raw_records(gzip.GzipFile(fileobj=packed)):
            piece = member(data)
            to.write(piece)
            rows.append((f"{folder}/{name}", offset, len(piece), headers.get("warc-record-id", ""), headers.get("warc-type", "")))
            offset += len(piece)
    sink.move(draft, final)
    yield from rows


def normalise(spark: SparkSession, archives: str, folder: str) -> DataFrame:
    """Rewrite all archives of a folder, one task each; returns the stored sidecar index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select("path")
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("record_id", pa.string()), ("record_type", pa.string())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = list(normalise_archive(archive, folder))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)] if rows
                    else [pa.array([], f.type) for f in schema], schema=schema)

    spread = files.repartition(max(1, files.count()))
    return spark.read.schema(INDEX).parquet(store(spread.mapInArrow(rewrite, INDEX), "offsets"))


def parse_member(data: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """page_id, payload length, digest, type, refers_to and stored payload of one record."""
    import io

    stream = io.BytesIO(data)
    stream.readline()
    headers = read_headers(stream)
    page = lambda urn: None if urn.endswith(":null>") else int(urn[len("<urn:page:"):-1])
    stream.readline()
    length = int(read_headers(stream)["content-length"])
    payload = stream.read()[: -len(END)]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{headers['warc-record-id']} does not have the payload its header names")
    refers = headers.get("warc-refers-to")
    return page(headers["warc-record-id"]), length, digest, kind, page(refers) if refers else None, payload


def read_records(index: DataFrame) -> DataFrame:
    """Fetch every indexed record by its offset; a revisit has no stored payload."""
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                rows = []
                for archive, offset, length in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    if archive != name:
                        store_, path = open_store(archive)
                        name, file = archive, store_.open_input_file(path)
                    file.seek(offset)
                    rows.append((archive, offset, length, *parse_member(zlib.decompress(file.read(length), 31))))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return index.select("archive", "offset", "length").mapInArrow(fetch, RECORDS)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back: the records of all pages."""
    spark = pages.sparkSession
    raw = fresh_path(spark, "archives")
    write_archives(pages, raw, least_bytes)
    index = normalise(spark, raw, fresh_path(spark, "members"))
    return read_records(index)
