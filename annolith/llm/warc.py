"""WARC files as a sink and as a Python data source.

Every record is one gzip member whose header carries the compressed and the plain size (extra field "sl", WARC 1.1 annex
on compressed files), so a reader goes from record to record without decoding bodies. The source plans byte ranges of the
files as partitions, decodes a record's headers first, tests pushed predicates on them, and decodes the body only of a
record that passes, and only where the schema asks for `payload`.
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from annolith.llm.common import arrow_batch, cut, lean, scratch

EXTRA = struct.Struct("<4sIBBH2sHII")
SIGNATURE = b"\x1f\x8b\x08\x04"
SPLIT_BYTES = 64 << 20
#: Digests (40 bytes and an id) that are broadcast; more are joined by a shuffle.
BROADCAST_DIGESTS = 500_000
SCHEMA = "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, refers_to string, content_length long, http_length long, payload binary"
#: The header that each column comes from.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def member(plain: bytes, level: int = 1) -> bytes:
    """One gzip member with its sizes in the header."""
    body = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = body.compress(plain) + body.flush()
    size = EXTRA.size + len(packed) + 8
    return EXTRA.pack(SIGNATURE, 0, 0, 255, 12, b"sl", 8, size, len(plain) & 0xFFFFFFFF) + packed + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def record(kind: str, record_id: str, uri: str, payload: bytes, digest: str, date: str, refers_to: str | None = None) -> bytes:
    """A response or revisit record; a revisit holds the HTTP header alone, whose Content-Length is the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if kind == "revisit" else http + payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def urn(page_id: int | None) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def _one_line(url: str | None) -> str:
    return "".join(c if c > " " else "%%%02X" % ord(c) for c in url or "")


def _writer(folder: str, date: str):
    out = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches):
        disk, root = pafs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():08d}.warc.gz"
        trial, sink, n = f"{root}/.trial-{uuid.uuid4().hex}", None, 0
        for batch in batches:
            for x in batch.to_pylist():
                if sink is None:
                    disk.create_dir(root, recursive=True)
                    sink = disk.open_output_stream(trial)
                payload = (x["html"] or "").encode("utf-8", "surrogatepass")
                sink.write(member(record(x["record_type"], urn(x["page_id"]), _one_line(x["url"]), payload, x["digest"], date, urn(x["refers_to"]))))
                n += 1
        if sink is not None:
            sink.close()
            disk.move(trial, f"{root}/{name}")
            yield arrow_batch(out, path=[f"{root}/{name}"], records=[n])

    return run


def write_archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write one record per row of pages (page_id, url, html; null html: empty) and return the folder.

    Of rows with equal payloads of least_bytes or more, those of the largest page_id are responses, all others revisits;
    smaller payloads are responses. Where no such row has an id, all are responses. Rows equal in id and payload are equal records. An empty table writes nothing."""
    folder = folder or scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    # payloads stay where they are unless the digests that repeat are too many to be sent to all
    again = cut(rows.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1").select("digest", "keep"), "repeats")
    rows = rows.join(F.broadcast(again) if again.count() <= BROADCAST_DIGESTS else again, "digest", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col("page_id"))
    rows = rows.select("page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("keep")).alias("refers_to"))
    cut(rows.mapInArrow(lean(_writer(folder, date)), "path string, records long"), "archive")
    return folder


class Span(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _is_member(head: bytes) -> bool:
    return len(head) >= EXTRA.size and head[:4] == SIGNATURE and head[12:16] == b"sl\x08\x00"


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, schema, split: int = SPLIT_BYTES):
        self.folder, self.names, self.split = folder, [f.name for f in schema.fields], split
        self.schema = pa.schema([(f.name, pa.binary() if f.dataType.typeName() == "binary" else pa.int64() if f.dataType.typeName() == "long" else pa.string()) for f in schema.fields])
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters):
        for x in filters:
            if isinstance(x, EqualTo) and x.attribute[0] in HEADERS and len(x.attribute) == 1:
                self.tests.append((HEADERS[x.attribute[0]], (x.value,)))
            elif isinstance(x, In) and x.attribute[0] in HEADERS and len(x.attribute) == 1:
                self.tests.append((HEADERS[x.attribute[0]], tuple(x.value)))
            else:
                if isinstance(x, IsNotNull) and x.attribute[0] in HEADERS:
                    self.tests.append((HEADERS[x.attribute[0]], ()))
                yield x

    def partitions(self):
        disk, root = pafs.FileSystem.from_uri(self.folder)
        found = disk.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((x.path, x.size) for x in found if x.is_file and x.base_name.endswith(".warc.gz") and not x.base_name.startswith("."))
        return [Span(path, a, min(size, a + self.split)) for path, size in files for a in range(0, size, self.split)] or [Span("", 0, 0)]

    def read(self, span: Span):
        if not span.path:
            return
        disk, _ = pafs.FileSystem.from_uri(self.folder)
        rows: dict[str, list] = {n: [] for n in self.names}
        held = 0
        with disk.open_input_file(span.path) as source:
            for row, size in self._records(source, span):
                for n in self.names:
                    rows[n].append(row.get(n))
                held += size
                if held > 8 << 20:
                    yield arrow_batch(self.schema, **rows)
                    rows, held = {n: [] for n in self.names}, 0
        if held:
            yield arrow_batch(self.schema, **rows)

    def _sync(self, source, span: Span, size: int) -> int:
        """The first member that starts in the span; its successor must be one too, or the end."""
        if not span.start:
            return 0
        at, tail = span.start, b""
        while at < span.end:
            source.seek(at)
            data = source.read((1 << 20) + EXTRA.size)
            i = data.find(SIGNATURE)
            while 0 <= i < 1 << 20 and at + i < span.end:
                if _is_member(data[i : i + EXTRA.size]):
                    after = at + i + EXTRA.unpack_from(data, i)[7]
                    source.seek(min(after, size))
                    tail = source.read(EXTRA.size) if after < size else b""
                    if after == size or _is_member(tail):
                        return at + i
                i = data.find(SIGNATURE, i + 1)
            at += 1 << 20
        return span.end

    def _records(self, source, span: Span):
        total = source.size()
        at = self._sync(source, span, total)
        while at < span.end:
            source.seek(at)
            head = source.read(EXTRA.size)
            if not _is_member(head):
                raise ValueError(f"{span.path}: no record at byte {at}")
            size = EXTRA.unpack(head)[7]
            body = source.read(min(size - EXTRA.size, 4096))
            unzip = zlib.decompressobj(-15)
            plain = unzip.decompress(body, 2048)
            read = EXTRA.size + len(body)
            while (end := plain.find(b"\r\n\r\n")) < 0 and not unzip.eof:
                more = unzip.unconsumed_tail or source.read(min(4096, size - read))
                read += 0 if unzip.unconsumed_tail else len(more)
                plain += unzip.decompress(more, 2048)
            head_lines = plain[:end].decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head_lines[1:])}
            if all(name in fields and (not values or _bare(fields[name]) in values) for name, values in self.tests):
                row = {c: _bare(fields[h]) for c, h in HEADERS.items() if h in fields}
                row["content_length"] = int(fields["content-length"])
                if "payload" in self.names or "http_length" in self.names:
                    want = end + 4 + (row["content_length"] if "payload" in self.names else 512)
                    while len(plain) < want and not unzip.eof:
                        more = unzip.unconsumed_tail or source.read(size - read)
                        read += 0 if unzip.unconsumed_tail else len(more)
                        plain += unzip.decompress(more, want - len(plain))
                    block = plain[end + 4 : end + 4 + row["content_length"]]
                    http, _, payload = block.partition(b"\r\n\r\n")
                    for line in http.split(b"\r\n"):
                        if line.lower().startswith(b"content-length:"):
                            row["http_length"] = int(line[15:])
                    if row["record_type"] != "revisit":
                        row["payload"] = payload
                yield row, len(row.get("payload") or b"") + 512
            at += size


def _bare(value: str) -> str:
    """A header value without the angle brackets of a URI."""
    return value[1:-1] if value[:1] == "<" and value[-1:] == ">" else value


class WarcDataSource(DataSource):
    """spark.read.format("warc").load(folder); a schema with fewer columns leaves payloads undecoded."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_archive(spark: SparkSession, folder: str, columns: str = SCHEMA) -> DataFrame:
    """The records of all .warc.gz files below folder; predicates on record_type and other headers are pushed down.

    Switches spark.sql.python.filterPushdown.enabled on in the session."""
    push = "spark.sql.python.filterPushdown.enabled"
    if spark.conf.get(push, "false") != "true":
        spark.conf.set(push, "true")  # read when a query is planned, so it has to stay
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").schema(columns).load(folder)


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from the archives: responses are digested anew, revisits from their headers."""
    rows = read_archive(spark, folder, "record_id string, record_type string, payload_digest string, refers_to string, http_length long, payload binary")
    page = lambda c: F.expr(f"cast(nullif(substring({c}, 12), '') as long)")
    response = rows.where("record_type = 'response'").select(page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    heads = read_archive(spark, folder, "record_id string, record_type string, payload_digest string, refers_to string, http_length long").where("record_type = 'revisit'")
    revisit = heads.select(page("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"), _hex("payload_digest").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    return response.union(revisit)


def _hex(column: str):
    """Hex of `sha1:` and 32 base-32 characters: 5 bits each, ten hex digits of every eight characters."""
    text = F.substring(column, 6, 32)
    part = lambda i: F.lower(F.lpad(F.conv(F.substring(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"), 8 * i + 1, 8), 32, 16), 10, "0"))
    return F.concat(*(part(i) for i in range(4)))


ORACLE_SQL = """
with p as (select page_id, coalesce(html, '') as payload from pages),
     k as (select *, strlen(payload) as size, max(page_id) over (partition by payload) as keep, count(*) over (partition by payload) as n from p)
select page_id, size::bigint as payload_bytes, sha1(payload) as payload_digest, case when size >= 1000 and n > 1 and keep is distinct from page_id and keep is not null then 'revisit' else 'response' end as record_type,
       case when size >= 1000 and n > 1 and keep is distinct from page_id then keep end as refers_to from k
"""
