"""WARC archives: a writer with revisit records, and a Spark data source.

Records are gzip members.  Each carries the skip-length extra field ``sl``
(lengths of the member and of its content), so that a reader goes from record
to record without inflating what it does not want; members without it are
inflated to their end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from .common import attach_group, bitmap_of, text_or_empty, with_mark, written

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
#: Columns that come from the header alone; predicates on them are pushed down.
HEADER_COLUMNS = ("record_type", "record_id", "target_uri", "date", "payload_digest", "refers_to")


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member with its lengths in the ``sl`` extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = 24 + len(body) + 8
    return (struct.pack("<4BIBBH2sHII", 31, 139, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
            + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [f"WARC/1.1\r\nWARC-Type: {kind}"] + [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _page_record(page_id, url: str | None, payload: bytes, digest: str, keeper, date: str) -> bytes:
    uri = None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    fields = [("WARC-Record-ID", f"<{_URN}{page_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
              ("X-Payload-Length", str(len(payload)))]
    http = _HTTP.format(len(payload)).encode()
    if keeper is None:
        return record("response", fields, http + payload)
    return record("revisit", fields + [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<{_URN}{keeper}>")], http)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
               min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> list[str]:
    """Write one record per row under ``path``; returns the files.

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with
    the largest id is a response and the others revisit it; all else are
    responses.  Null html is an empty payload; a null url gives no target URI;
    a row with a null id is a response that nothing refers to, unless no other
    row has its payload; of repeated rows with the largest id each is a
    response.  Other columns are ignored.

    Payloads are not shuffled: groups are formed on digests, and only rows
    that revisit are joined with their response's id.  Tasks write under
    unique names; the driver moves the files of the attempts that succeeded
    into place, so a lost or repeated task leaves no record twice.
    """
    spark = pages.sparkSession
    html = text_or_empty(html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("html"))
    narrow = rows.where(F.octet_length("html") >= min_bytes).where("id is not null").select("id", F.sha1("html").alias("sha"))
    narrow = written(narrow, "payload-digests")
    groups = narrow.groupBy("sha").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(attach_group(narrow, groups, "sha", "n").where("id < keeper").select("id", "sha", "keeper").distinct(),
                    "revisits")
    marked = with_mark(rows, bitmap_of(again, "id"), "again", "id")
    known = marked.where("again").withColumn("sha", F.sha1("html")).join(again, ["id", "sha"], "left")
    full = known.select("id", "url", "html", "keeper").unionByName(
        marked.where("not again").select("id", "url", "html", F.lit(None).cast("long").alias("keeper")))
    system, base = _filesystem(path)
    system.create_dir(f"{base}/.attempts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, n = None, f"{uuid.uuid4().hex}.warc.gz", 0
        store, root = _filesystem(path)
        for batch in batches:
            for i, url, text, keeper in zip(*(batch[c].to_pylist() for c in ("id", "url", "html", "keeper"))):
                if out is None:
                    out = store.open_output_stream(f"{root}/.attempts/{name}", compression=None)
                    out.write(member(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                                         ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                                            b"format: WARC File Format 1.1\r\n")))
                payload = text.encode()
                out.write(member(_page_record(i, url, payload, digest_of(payload), keeper, date)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    done = full.mapInArrow(write, "file string, records long").collect()  # one row per task
    files = []
    for k, r in enumerate(sorted(done, key=lambda r: r.file)):
        files.append(f"{path}/part-{k:05d}.warc.gz")
        system.move(f"{base}/.attempts/{r.file}", f"{base}/part-{k:05d}.warc.gz")
    system.delete_dir(f"{base}/.attempts")
    return files


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    """Reads headers first; decodes a payload only of a record that passes the
    pushed predicates, and only if payloads are asked for."""

    def __init__(self, options: dict):
        self.path, self.filters = options["path"], []
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER_COLUMNS and isinstance(f, (EqualTo, In, IsNotNull)):
                self.filters.append((column, None if isinstance(f, IsNotNull) else
                                     [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def partitions(self):
        system, base = _filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return [_File(i.path) for i in sorted(found, key=lambda i: i.path)
                if i.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", i.path)] or [_File("")]

    def _wanted(self, row: dict) -> bool:
        return all(row[c] is not None if values is None else row[c] in values and row[c] is not None
                   for c, values in self.filters)

    def read(self, partition: _File):
        if not partition.path:
            return
        system = _filesystem(self.path)[0]
        with system.open_input_file(partition.path) as f:
            rows, size = [], 0
            for row in records(f, self._wanted, self.payload, self.verify):
                rows.append(row)
                size += len(row["payload"] or b"") + 200
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema([*((c, pa.string()) for c in HEADER_COLUMNS), ("payload_length", pa.int64()), ("payload", pa.binary())])


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` over a folder of WARC files.

    Options: ``payload`` (default true; false leaves the column null and
    inflates headers only), ``verify`` (default false; true fails on a payload
    that does not match its digest)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in HEADER_COLUMNS) + ", payload_length long, payload binary"

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def _header_row(head: bytes) -> tuple[dict, int]:
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower()] = v.strip().decode("utf-8", "replace")
    bare = lambda v: v.strip("<>") if v else v
    digest = fields.get(b"warc-payload-digest")
    row = {"record_type": fields.get(b"warc-type"), "record_id": bare(fields.get(b"warc-record-id")),
           "target_uri": fields.get(b"warc-target-uri"), "date": fields.get(b"warc-date"),
           "payload_digest": digest.partition(":")[2] if digest else None,
           "refers_to": bare(fields.get(b"warc-refers-to")),
           "payload_length": int(fields[b"x-payload-length"]) if b"x-payload-length" in fields else None,
           "payload": None}
    return row, int(fields.get(b"content-length", 0))


def _payload(row: dict, block: bytes, verify: bool) -> None:
    row["payload"] = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    row["payload_length"] = len(row["payload"])
    if verify and row["payload_digest"] and row["payload_digest"] != digest_of(row["payload"]):
        raise ValueError(f"payload of {row['record_id']} does not match its digest")


def records(f, wanted, payload: bool, verify: bool) -> Iterator[dict]:
    """Records of an open file (gzip members or plain), in order."""
    end, at = f.size(), 0
    while at < end:
        f.seek(at)
        start = f.read(24)
        gz = start[:2] == b"\x1f\x8b"
        skip = struct.unpack("<I", start[16:20])[0] if gz and start[3] & 4 and start[12:14] == b"sl" else None
        z, raw, text, head_end = (zlib.decompressobj(31) if gz else None), start, b"", -1
        while head_end < 0 and raw:  # inflate until the header's end only
            text += z.decompress(raw, 4096) if gz else raw
            raw = (z.unconsumed_tail if gz else b"") or f.read(8192)
            head_end = text.find(b"\r\n\r\n")
        if head_end < 0:
            return
        row, length = _header_row(text[:head_end])
        take = wanted(row)
        need = payload and take and row["record_type"] != "revisit"
        if not gz:
            begin = at + head_end + 4
            if need:
                f.seek(begin)
                _payload(row, f.read(length), verify)
            at = begin + length + 4
        else:
            if need or skip is None:
                parts = [text, z.decompress(raw)]
                while not z.eof and (raw := f.read(1 << 16)):
                    parts.append(z.decompress(raw))
                if skip is None:
                    at = f.tell() - len(z.unused_data)
                if need:
                    _payload(row, b"".join(parts)[head_end + 4:head_end + 4 + length], verify)
            if skip is not None:
                at += skip
        if take:
            yield row


def read_warc(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """The records of a folder of WARC files (see :class:`WarcSource`)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return (spark.read.format("warc").option("payload", str(payload)).option("verify", str(verify)).load(path))


def archived_pages(records_: DataFrame) -> DataFrame:
    """Page rows of response and revisit records: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``."""
    page = lambda c: F.regexp_extract(c, rf"^{_URN}(-?\d+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return records_.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                           "payload_digest", "record_type", number("refers_to").alias("refers_to"))
