"""Legacy archives to WARC: parse version-specific ARC headers, synthesise WARC records.

An ARC file starts with a `filedesc:` record whose block names its version and the fields of
every later header line (version 1: URL IP-address Archive-date Content-type Archive-length;
version 2 adds Result-code Checksum Location Offset Filename before the length). Each record is
a header line and as many bytes as its last field declares. From these a record gets its
identifier (name-based UUID), an ISO time from the 14 digits, a type and SHA-1 digests.
Of equal payloads of at least MIN_REVISIT bytes the one with the largest page id is a response,
the others revisit it; their record holds the HTTP headers only, whose Content-Length is the
full payload's.

Files are written and read by Spark: one row of at most ARCHIVE_BYTES (or one record, if that
is longer) is one gzipped file, so no task holds more than an archive. Digests meet as narrow
rows, without payloads. Revisits are looked up by archive while converting: by broadcast while
their counted content allows, else archives, still gzipped, and revisits are shuffled by path.

Defined cases: null html is an empty payload; a null or blank url is `urn:x-unknown`, blanks and
other unsafe characters of urls are percent-encoded; a null page id is smaller than any other;
of rows repeated with one page id one is the response; an empty table gives no archives and no
rows; other columns do not matter. A header that breaks its version's rules or a length beyond
the file's end raises ValueError with the place.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklore.llm.common import lookup_side
from stacklore.session import has_files, materialise, scratch_path

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT = 1000
UNKNOWN_URL = "urn:x-unknown"
BASE_DATE = "20040101000000"
# Field lists of the two ARC versions, and WARC names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


@dataclass
class Record:
    """One archived exchange: header fields, HTTP headers and payload."""

    fields: dict[str, str]
    http: dict[str, str]
    head: bytes
    payload: bytes
    offset: int

    @property
    def page_id(self) -> int | None:
        return int(self.http["x-page-id"]) if "x-page-id" in self.http else None


def gunzip(content: bytes) -> bytes:
    """All members of a gzip file; other content as it is."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(out) if out else content


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    head, mark, payload = block.partition(CRLF + CRLF)
    if not mark or not head.startswith(b"HTTP/"):
        return b"", {}, block
    named = (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])
    return head + mark, {k.strip().lower(): v.strip() for k, _, v in named}, payload


def parse_arc(content: bytes) -> Iterator[Record]:
    """Records after the version block."""
    data, at, names = gunzip(content), 0, None
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"unfinished ARC header at byte {at}")
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"ARC header without a length at byte {at}")
        start, size = end + 1, int(values[-1])
        if start + size > len(data):
            raise ValueError(f"ARC record at byte {at} declares {size} bytes, {len(data) - start} are left")
        block = data[start:start + size]
        if names is None:
            names = _version_fields(values, block)
        else:
            if len(values) != len(names):
                raise ValueError(f"ARC header at byte {at} has {len(values)} fields, its version {len(names)}")
            head, http, payload = split_http(block)
            yield Record(dict(zip(names, values, strict=True)), http, head, payload, at)
        at = start + size


def _version_fields(values: list[str], block: bytes) -> list[str]:
    lines = block.decode("utf-8", "replace").splitlines()
    version = lines[0].split(" ")[0] if lines else ""
    if not values[0].startswith("filedesc:") or version not in ("1", "2") or len(lines) < 2:
        raise ValueError("an ARC file starts with a filedesc record of version 1 or 2")
    if lines[1].strip() != ARC_FIELDS[int(version)]:
        raise ValueError(f"unknown fields for ARC version {version}: {lines[1]}")
    return lines[1].split()


def safe_url(url: str | None) -> str:
    return quote(url.strip(), safe=":/?#[]@!$&'()*+,;=%~-._") if url and url.strip() else UNKNOWN_URL


def arc_version_block(name: str, version: int) -> bytes:
    block = f"{version} 0 stacklore\n{ARC_FIELDS[version]}\n\n".encode()
    tail = "text/plain 200 - - 0 " + name + f" {len(block)}" if version == 2 else f"text/plain {len(block)}"
    return f"filedesc://{name} 0.0.0.0 {BASE_DATE} {tail}\n".encode() + block


def arc_record(page_id: int | None, url: str | None, html: str | None, version: int, offset: int, name: str) -> bytes:
    payload = (html or "").encode("utf-8", "replace")
    number = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    middle = f" 200 {hashlib.sha1(payload).hexdigest()} - {offset} {name}" if version == 2 else ""
    return f"{safe_url(url)} 0.0.0.0 {BASE_DATE} text/html{middle} {len(block)}\n".encode() + block + b"\n"


def sha1_hex(payload: bytes) -> str:
    return hashlib.sha1(payload).hexdigest()


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def archive_name(path: str) -> str:
    """Task and file number of a written archive: the same in every run over the same table."""
    found = re.search(r"part-(\d+)-.*-c(\d+)", path)
    return f"{found[1]}-{found[2]}" if found else path.rsplit("/", 1)[-1]


def record_id(url: str, date: str, digest: str, path: str, offset: int) -> str:
    path = archive_name(path)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {path} {offset}')}>"


def iso_time(digits: str) -> str:
    """14 digits to ISO; the shorter dates of old crawlers are filled up."""
    d = (digits + BASE_DATE[len(digits):])[:14] if digits.isdigit() else BASE_DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(record: Record, path: str, revisits: tuple[str, int | None] | None) -> bytes:
    """The equivalent WARC record; `revisits`: (record id, page id) of the response it repeats."""
    url, date = record.fields["URL"], record.fields["Archive-date"]
    digest = sha1_hex(record.payload)
    block = record.head if revisits else record.head + record.payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}",
        f"WARC-Record-ID: {record_id(url, date, digest, path, record.offset)}",
        f"WARC-Target-URI: {url}", f"WARC-Date: {iso_time(date)}",
        f"WARC-IP-Address: {record.fields['IP-address']}",
        f"WARC-Payload-Digest: sha1:{base32(digest)}",
        f"WARC-Block-Digest: sha1:{base32(sha1_hex(block))}",
    ]
    if revisits:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {revisits[0]}"]
        lines += [] if revisits[1] is None else [f"X-Refers-To-Page-Id: {revisits[1]}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record."""
    data, at = gunzip(content), 0
    while at < len(data):
        end = data.find(CRLF + CRLF, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC header at byte {at}")
        named = (line.partition(":") for line in data[at:end].decode("utf-8").split("\r\n")[1:])
        fields = {k.strip().lower(): v.strip() for k, _, v in named}
        start, size = end + 4, int(fields["content-length"])
        if data[start + size:start + size + 4] != CRLF + CRLF:
            raise ValueError(f"WARC record at byte {at} does not end after {size} bytes")
        yield fields, data[start:start + size]
        at = start + size + 4


def _write(files: DataFrame, path: str, separator: str) -> None:
    """One file per row; the separator, which ends the content, is the writer's."""
    files.write.option("lineSep", separator).option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the files written there."""
    if not has_files(spark, path):
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages as ARC archives, version 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def file(number: int, parts: list[bytes]) -> pa.RecordBatch:
            content = b"".join(parts)[:-1].decode("utf-8")
            return pa.RecordBatch.from_arrays([pa.array([content], pa.string())], names=["value"])

        number, parts, size, version, name = 0, [], 0, 1, ""
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, html = (batch.column(i)[at].as_py() for i in range(3))
                if not parts:
                    version, name = 1 + number % 2, f"pages-{number}.arc"
                    parts = [arc_version_block(name, version)]
                    size = len(parts[0])
                parts.append(arc_record(page_id, url, html, version, size, name))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield file(number, parts)
                    number, parts = number + 1, []
        if parts:
            yield file(number, parts)

    chosen = pages.select(pages["page_id"].cast("long"), pages["url"], pages["html"])
    _write(chosen.mapInArrow(run, "value string"), path, "\n")


def arc_index(archives: DataFrame) -> DataFrame:
    """(page_id, digest, size, path, offset, record_id) per record: what equal payloads meet by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for r in parse_arc(content):
                    digest = sha1_hex(r.payload)
                    key = record_id(r.fields["URL"], r.fields["Archive-date"], digest, path, r.offset)
                    rows.append((r.page_id, digest, len(r.payload), path, r.offset, key))
                if not rows:
                    continue
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "digest", "size", "path", "offset", "record_id"])

    return archives.mapInArrow(
        run, "page_id long, digest string, size long, path string, offset long, record_id string"
    )


def find_revisits(index: DataFrame) -> DataFrame:
    """(path, revisits): per archive the offsets of revisits with what they repeat."""
    large = index.filter(F.col("size") >= MIN_REVISIT)
    best = F.max(F.struct("page_id", "path", "offset", "record_id")).alias("_best")
    groups = large.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("_n"), best).filter("_n > 1").drop("_n")
    repeated = large.join(lookup_side(groups, "warc-groups"), ["digest", "size"]).filter(
        ~((F.col("path") == F.col("_best.path")) & (F.col("offset") == F.col("_best.offset")))
    )
    entry = F.struct("offset", F.col("_best.record_id").alias("record_id"), F.col("_best.page_id").alias("page_id"))
    return repeated.groupBy("path").agg(F.collect_list(entry).alias("revisits"))  # one archive's records at most


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Every ARC archive below one path to a WARC archive below the other."""
    archives = _archives(spark, arc_path)
    index = materialise(arc_index(archives), "warc-index")
    revisits = lookup_side(find_revisits(index).withColumnRenamed("path", "_path"), "warc-revisits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, repeated in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                known = {r["offset"]: (r["record_id"], r["page_id"]) for r in repeated or []}
                records = [warc_record(r, path, known.get(r.offset)) for r in parse_arc(content)]
                if records:
                    text = b"".join(records)[:-4].decode("utf-8")
                    yield pa.RecordBatch.from_arrays([pa.array([text], pa.string())], names=["value"])

    joined = archives.join(revisits, F.col("path") == F.col("_path"), "left").select("path", "content", "revisits")
    _write(joined.mapInArrow(run, "value string"), warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to, record_id, date) per record."""
    names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1).to_pylist():
                rows = [_described(fields, block) for fields, block in parse_warc(content)]
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
                )

    schema = "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, " \
             "refers_to long, record_id string, date string"
    return _archives(spark, path).mapInArrow(run, schema)


def _described(fields: dict[str, str], block: bytes) -> tuple:
    _, http, payload = split_http(block)
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and sha1_hex(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    size = int(http["content-length"]) if revisit else len(payload)
    page_id = int(http["x-page-id"]) if "x-page-id" in http else None
    refers_to = fields.get("x-refers-to-page-id")
    return (
        page_id, fields["warc-target-uri"], size, digest, fields["warc-type"],
        None if refers_to is None else int(refers_to), fields["warc-record-id"], fields["warc-date"],
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC archives read back."""
    spark = pages.sparkSession
    arc_path, warc_path = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc_path)
    convert(spark, arc_path, warc_path)
    return read_warc(spark, warc_path)
