"""WARC archives as a Spark data source, and deduplicated page archives.

    spark.dataSource.register(WarcSource)
    spark.read.format("warc").load(path).filter("record_type = 'response'")
    records.write.format("warc").mode("append").save(path)

Records are gzip members of their own. Each carries its compressed size in the member's extra
field (the skip-length field of the format's gzip annex), so a reader inflates the headers
of a record, tests the pushed predicates, and jumps over a payload that is not wanted. Paths may
be of any file system that Arrow knows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_bytes bigint, headers map<string,string>, payload binary"
)
ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "date", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
#: The record header of each column that a predicate can be pushed to.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 16


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def member(record: bytes, level: int) -> bytes:
    """One gzip member with its sizes in the extra field (left out from 4 GiB on)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(record)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, size, len(record))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def _line(value: str) -> str:
    """A header value: line ends would end the header."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record_bytes(row: dict) -> bytes:
    """A response or revisit record. The block of a revisit has the HTTP headers only."""
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"] or EPOCH)]
    head += [("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"])]
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_to"])]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_line(v)}\r\n" for k, v in head if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list  # (name, bytes, [offsets at which a split may start])


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own; a manifest makes those of the winning tasks visible.

    So a task that ran twice, or was lost half-way, leaves no record that a reader sees.
    """

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"]
        self.level = int(options.get("level", 6))
        self.file_bytes = int(options.get("filebytes", 256 << 20))
        self.split_bytes = int(options.get("splitbytes", 8 << 20))
        if overwrite:
            raise ValueError("archives are only appended to; write to a new path")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        done, out, name, at, marks = [], None, "", 0, [0]
        try:
            for b in iterator:
                for row in b.to_pylist():
                    if out is None:
                        name, at, marks = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0]
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = member(record_bytes(row), self.level)
                    if at - marks[-1] >= self.split_bytes:
                        marks.append(at)
                    out.write(data)
                    at += len(data)
                    if at >= self.file_bytes:
                        out.close()
                        done.append((name, at, marks))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((name, at, marks))
        return Written(done)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        listed = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            for name, _, _ in m.files if m is not None else []:
                fs.delete_file(f"{root}/{name}")


@dataclass
class Pieces(InputPartition):
    pieces: list  # (file, first byte, end byte)

    def __init__(self, pieces: list) -> None:
        self.pieces = pieces


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.bytes = int(options.get("partitionbytes", 16 << 20))
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        """Equality and membership on header columns; the rest stays with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[Pieces]:
        """Pieces between marked record starts, packed to about `partitionbytes`."""
        fs, root = file_system(self.path)
        info = [i for i in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if i.is_file]
        manifests = [i.path for i in info if i.base_name.startswith("_manifest-")]
        pieces = []
        if manifests:
            for m in sorted(manifests):
                with fs.open_input_stream(m) as f:
                    for name, size, marks in json.loads(f.read()):
                        pieces += [(f"{root}/{name}", s, e) for s, e in zip(marks, [*marks[1:], size], strict=True)]
        else:
            pieces = [(i.path, 0, i.size) for i in sorted(info, key=lambda i: i.path) if i.path.endswith((".warc.gz", ".warc"))]
        out, held = [[]], 0
        for p in pieces:
            if out[-1] and held + p[2] - p[1] > self.bytes:
                out.append([])
                held = 0
            out[-1].append(p)
            held += p[2] - p[1]
        return [Pieces(p) for p in out]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        rows, held = [], 0
        for path, start, end in partition.pieces:
            with fs.open_input_file(path) as f:
                source = gzip_records if path.endswith(".gz") else plain_records
                for row in source(f, start, end, self.accepts, self.with_payload):
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held >= 8 << 20 or len(rows) >= 4000:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    def accepts(self, headers: dict[str, str]) -> bool:
        return all(_value(headers, c) in values for c, values in self.wanted.items())


def _value(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(HEADERS[column].lower())
    if value is not None and column == "record_type":
        return value.lower()
    if value is not None and column == "target_uri" and ("%0D" in value or "%0A" in value):
        return value.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return value


def parse_headers(head: bytes) -> dict[str, str]:
    """Names in lower case; the version line is left out."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def to_row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """`block` may be cut after the HTTP headers if the payload is not wanted."""
    http, payload = {}, block
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = parse_headers(head)
    size = http.get("content-length", headers.get("content-length") if not http else None)
    row = {c: _value(headers, c) for c in HEADERS}
    row["payload_bytes"] = int(size) if size and size.isdigit() else None
    row["headers"] = list(headers.items())
    row["payload"] = payload if with_payload and row["record_type"] != "revisit" else None
    return row


def _skip_size(member_head: bytes) -> int | None:
    if len(member_head) < 12 or not member_head[3] & 4:
        return None
    n = struct.unpack_from("<H", member_head, 10)[0]
    at = 12
    while at + 4 <= 12 + n:
        size = struct.unpack_from("<H", member_head, at + 2)[0]
        if member_head[at : at + 2] == b"sl" and size == 8:
            return struct.unpack_from("<I", member_head, at + 4)[0]
        at += 4 + size
    return None


def gzip_records(f, start: int, end: int, accepts, with_payload: bool) -> Iterator[dict]:
    """Records of the gzip members that begin in [start, end)."""
    at = start
    while at < end:
        f.seek(at)
        data = f.read(READ_BYTES)
        if not data:
            return
        skip = _skip_size(data)
        inflate, used, out = zlib.decompressobj(31), 0, b""

        def more(limit: int) -> bool:
            nonlocal data, used, out
            if inflate.eof:
                return False
            chunk = inflate.unconsumed_tail or data
            if not inflate.unconsumed_tail:
                used += len(data)
                data = b""
                if not chunk:
                    chunk = f.read(READ_BYTES)
                    used += len(chunk)
                    if not chunk:
                        raise ValueError(f"a record is cut off at byte {at}")
            out += inflate.decompress(chunk, limit)
            return True

        while b"\r\n\r\n" not in out and more(4096):
            pass
        head, _, block = out.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        out = block
        wanted = accepts(headers)
        size = int(headers.get("content-length", 0))
        if wanted and with_payload:
            parts = [out]
            have = len(out)
            while have < size:
                out = b""
                if not more(1 << 20):
                    break
                parts.append(out)
                have += len(out)
            block = b"".join(parts)[:size]
        elif wanted:
            while b"\r\n\r\n" not in out and len(out) < size and more(4096):
                pass
            block = out[:size]
        if wanted and headers:
            yield to_row(headers, block, with_payload)
        if skip:
            at += skip
            continue
        while not inflate.eof:
            out = b""
            more(1 << 20)
        at += used - len(inflate.unused_data)


def plain_records(f, start: int, end: int, accepts, with_payload: bool) -> Iterator[dict]:
    """Records of an archive that is not compressed; payloads that are not wanted are not read."""
    at = start
    while at < end:
        f.seek(at)
        head = b""
        while b"\r\n\r\n" not in head:
            chunk = f.read(4096)
            if not chunk:
                return
            head += chunk
        head = head.partition(b"\r\n\r\n")[0]
        headers = parse_headers(head)
        size = int(headers.get("content-length", 0))
        body = at + len(head) + 4
        if accepts(headers):
            f.seek(body)
            yield to_row(headers, f.read(size if with_payload else min(size, READ_BYTES)), with_payload)
        at = body + size + 4


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known, with predicates pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """A record per row of `pages`: a response, or a revisit of the first page with the same payload.

    The payload is the text in UTF-8 (null: empty). Of equal payloads of at least `least` bytes, the
    page with the smallest id is the response; smaller payloads are all responses. Rows that repeat
    the first page's id are responses too. A row without an id is never the first; it is a
    response if no page with an id has its payload. Only digests that occur twice are joined, and
    they are counted per task before the shuffle, so a payload that very many pages share is
    one row of the small side.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("digest", F.sha2(body, 256)).withColumn("size", F.octet_length(body).cast("long"))
    seen = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = seen.filter("n > 1 and first is not null").select("digest", "first")
    joined = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        page_urn(F.col("id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.when(again, page_urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.col("size").alias("payload_bytes"),
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.when(again, F.lit(None).cast("binary")).otherwise(body).alias("payload"),
    )


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_of(urn: Column) -> Column:
    """The id in a record id; null if it is empty."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit(""))
