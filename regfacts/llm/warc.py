"""WARC archives: writing, and normalising whole-file gzip into one member a record.

A crawl may hand over a .warc.gz that is a single gzip stream: nothing in it
can be reached without inflating all before it. The normaliser inflates such a
file once, as a stream, writes every record as a gzip member of its own and a
sidecar index of the members' places, so that records can be read by range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, dealt_files, file_system, record_batch, slices, table_rows
from regfacts.llm.registry import query

#: Payload bytes of one archive, and of the records that a reading task takes from an index at once.
ARCHIVE_BYTES = 16 << 20
#: Payloads of at least so many bytes are written once; equal ones refer to the first.
MIN_REVISIT_BYTES = 0
INDEX = struct.Struct("<QQ")
DATE = "2025-01-01T00:00:00Z"
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "archive string, offset long")
FILES = "name string, records long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without its payload if refers_to is given.

    The HTTP header tells the payload's length in both, its digest is in the
    WARC header.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{record_uri(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def read_header(source) -> tuple[bytes, dict[str, str]] | None:
    """The header of the next record of a stream, raw and by lower-case name; None at the end."""
    line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    raw, fields = [line], {}
    while True:
        line = source.readline()
        if not line:
            raise ValueError("a WARC header ends early")
        raw.append(line)
        if line in (b"\r\n", b"\n"):
            return b"".join(raw), fields
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()


def records_of(source) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields, raw header, block) of every record of an inflated stream."""
    while (head := read_header(source)) is not None:
        raw, fields = head
        size = int(fields["content-length"])
        block = source.read(size)
        if len(block) != size or source.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        yield fields, raw, block


def normalise(source, sink, index) -> int:
    """Copy a gzip stream record by record into members of their own; the number of records.

    The source may be one member or many. The index has (offset, length) of
    every member, in order.
    """
    n = at = 0
    with gzip.GzipFile(fileobj=source) as stream:
        for _, raw, block in records_of(io.BufferedReader(stream, 1 << 20)):
            member = zlib.compressobj(4, zlib.DEFLATED, 31)
            data = member.compress(raw + block + b"\r\n\r\n") + member.flush()
            sink.write(data)
            index.write(INDEX.pack(at, len(data)))
            at += len(data)
            n += 1
    return n


def parse(fields: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, type, payload bytes, digest, refers_to) of a record of `record`."""
    def number(uri: str) -> int | None:
        tail = uri.strip("<>").rpartition(":")[2]
        return None if tail == "none" else int(tail)

    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, told = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
    if kind == "response" and (len(payload) != size or digest(payload) != told):
        raise ValueError("a payload does not have its digest")
    refers = fields.get("warc-refers-to")
    return number(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, size, told, number(refers) if refers else None


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Monolithic archives of about ARCHIVE_BYTES; only names of finished tasks are read later."""
    fs, where = file_system(folder)
    fs.create_dir(where, recursive=True)
    sink = stream = None
    name, n, size = "", 0, 0

    def close() -> pa.RecordBatch:
        stream.close()
        sink.close()
        return record_batch(FILES, [[name], [n]])

    for batch in slices(batches):
        for row in batch.to_pylist():
            if stream is None:
                name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                sink = fs.open_output_stream(f"{where}/{name}", compression=None)
                stream = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=4, mtime=0)
            payload = (row["html"] or "").encode()
            stream.write(record(row["page_id"], row["url"], payload, row["refers_to"]))
            n, size = n + 1, size + len(payload)
            if size >= ARCHIVE_BYTES:
                yield close()
                stream = None
    if stream is not None:
        yield close()


def write_archives(pages: DataFrame, work: Workspace, *, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Whole-file gzip archives with a record for every page; (name, records).

    Of pages with equal payloads the smallest page_id is a response, pages of
    other ids revisit it. A null html is an empty payload. A null page_id
    counts as larger than any other and its page is a response; so is every
    repeated row of the smallest id. The payloads are shuffled once, by id.
    """
    keyed = pages.select(F.col("page_id").cast("long"), F.col("url"), F.col("html"),
                         F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha"))
    ids = keyed.where((F.octet_length(F.coalesce("html", F.lit(""))) >= min_revisit_bytes)
                      & F.col("page_id").isNotNull()).select("page_id", "sha")
    firsts = work.write(ids.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
                        .where("refers_to < last").select("sha", "refers_to"), "firsts")
    revisits = ids.join(firsts, "sha").where("page_id > refers_to").select("page_id", "sha", "refers_to").distinct()
    rows = keyed.join(revisits, ["page_id", "sha"], "left").select("page_id", "url", "html", "refers_to")
    return work.write(rows.mapInArrow(partial(_write, folder=work.path("raw")), FILES), "raw-files")


def _normalise(batches: Iterator[pa.RecordBatch], folder: str, target: str) -> Iterator[pa.RecordBatch]:
    fs, where = file_system(folder)
    out, to = file_system(target)
    out.create_dir(to, recursive=True)
    for batch in batches:
        for name in batch.column("name").to_pylist():
            new = f"{uuid.uuid4().hex}.warc.gz"
            # by default the file system would compress by the name's ending
            with fs.open_input_stream(f"{where}/{name}", compression=None) as source, \
                    out.open_output_stream(f"{to}/{new}", compression=None) as sink, \
                    out.open_output_stream(f"{to}/{new}.idx", compression=None) as index:
                n = normalise(source, sink, index)
            yield record_batch(FILES, [[new], [n]])


def normalise_archives(files: DataFrame, work: Workspace) -> DataFrame:
    """Member-per-record archives with sidecar indexes; a task takes whole files."""
    return work.write(dealt_files(files, "name").mapInArrow(
        partial(_normalise, folder=work.path("raw"), target=work.path("members")), FILES), "member-files")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, where = file_system(folder)
    for batch in batches:
        for row in batch.to_pylist():
            name, first, number = row["name"], row["first"], row["number"]
            with fs.open_input_file(f"{where}/{name}.idx") as index:
                index.seek(first * INDEX.size)
                places = list(INDEX.iter_unpack(index.read(number * INDEX.size)))
            with fs.open_input_file(f"{where}/{name}") as source:
                rows = []
                for at, size in places:
                    source.seek(at)
                    fields, _, block = next(records_of(io.BytesIO(zlib.decompress(source.read(size), 31))))
                    rows.append((*parse(fields, block), name, at))
            yield record_batch(RECORDS, list(zip(*rows, strict=True)) or [[]] * 8)


def read_archives(files: DataFrame, work: Workspace, *, records: int = 2000) -> DataFrame:
    """RECORDS of all archives, read by ranges of `records` members through the indexes."""
    ranges = files.where("records > 0").select(
        "name", "records", F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(records))).alias("first")).select(
        "name", "first", F.least(F.lit(records).cast("long"), F.col("records") - F.col("first")).alias("number"))
    return dealt_files(ranges, "name", "first").mapInArrow(partial(_read, folder=work.path("members")), RECORDS)


@query()
def op2_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the normalised archives."""
    work = Workspace(spark, "op2")
    raw = write_archives(table_rows(spark, sf_dir, "pages"), work)
    return read_archives(normalise_archives(raw, work), work).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "archive", "offset")
