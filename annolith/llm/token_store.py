"""Sorted-string-table shards of token ids, keyed by document id.

A shard holds documents in ascending key order. Layout, integers little-endian:

    blocks   each zstd-compressed: entry count; per entry the bytes shared with the key before, the rest of the key and the
             number of ids (varints); then all ids of the block, 2 bytes each (4 where the widest needs it)
    index    zstd-compressed: first key, offset, size, documents and ids of each block
    bloom    ten bits a key, seven probes
    footer   offsets and sizes of index and bloom, documents, ids, format number, magic

A key is the id plus 2**63 as 8 bytes big-endian, so that byte order is id order; the null id is the empty key, before
all others. lookup() asks the Bloom filter, bisects the index, decodes one block and bisects its keys.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolith.llm.common import arrow_batch, cut, lean, scratch, utf8
from annolith.llm.segments import encoder, forget

MAGIC = b"ANNOSST1"
FOOTER = struct.Struct("<QQQQQQI8s")
BLOCK_BYTES = 1 << 18
SHARD_DOCS = 4096
BLOOM_BITS, BLOOM_PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key, "big") - (1 << 63) if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (data[at] & 127) << shift
        shift += 7
        at += 1
        if data[at - 1] < 128:
            return n, at


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x5BD1E995) | 1
    h = (a << 32 | b) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    step = h >> 31 | 1
    return [(h + i * step) % bits for i in range(BLOOM_PROBES)]


class ShardWriter:
    """add() in ascending key order, then close(); equal keys may repeat."""

    def __init__(self, sink):
        self.sink, self.at, self.docs, self.ids = sink, 0, 0, 0
        self.index: list[tuple] = []
        self.keys: list[bytes] = []
        self.zip = zstandard.ZstdCompressor(level=1)
        self._open()

    def _open(self) -> None:
        self.entries, self.payload, self.size, self.first, self.last, self.count, self.wide = bytearray(), [], 0, None, b"", 0, False

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.first is None:
            self.first = key
        shared = 0
        while shared < len(key) and shared < len(self.last) and key[shared] == self.last[shared]:
            shared += 1
        self.entries += _varint(shared) + _varint(len(key) - shared) + key[shared:] + _varint(len(ids))
        self.wide |= bool(len(ids)) and int(ids.max()) > 0xFFFF
        self.payload.append(ids)
        self.last = key
        self.count += 1
        self.size += 2 * len(ids)
        self.keys.append(key)
        if self.size >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if not self.count:
            return
        ids = np.concatenate(self.payload)
        raw = _varint(self.count) + bytes([4 if self.wide else 2]) + bytes(self.entries) + ids.astype("<u4" if self.wide else "<u2").tobytes()
        block = self.zip.compress(raw)
        self.sink.write(block)
        self.index.append((self.first, self.at, len(block), self.count, len(ids)))
        self.at += len(block)
        self.docs += self.count
        self.ids += len(ids)
        self._open()

    def close(self) -> None:
        self._flush()
        bits = max(64, BLOOM_BITS * len(self.keys))
        bloom = bytearray(-(-bits // 8))
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        index = self.zip.compress(b"".join(bytes([len(k)]) + k + struct.pack("<QQQQ", *rest) for k, *rest in self.index))
        self.sink.write(index)
        self.sink.write(struct.pack("<Q", bits) + bytes(bloom))
        self.sink.write(FOOTER.pack(self.at, len(index), self.at + len(index), 8 + len(bloom), self.docs, self.ids, 1, MAGIC))


class ShardReader:
    """Random access to one shard; `source` is a pyarrow file or anything with read, seek and size."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        if size < FOOTER.size:
            raise ValueError("not a token shard: too short")
        index_at, index_size, bloom_at, bloom_size, self.docs, self.ids, form, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or form != 1:
            raise ValueError("not a token shard of format 1")
        raw, at, self.index = zstandard.ZstdDecompressor().decompress(self._at(index_at, index_size)), 0, []
        while at < len(raw):
            n = raw[at]
            self.index.append((raw[at + 1 : at + 1 + n], *struct.unpack_from("<QQQQ", raw, at + 1 + n)))
            at += 33 + n
        self._bloom_at = bloom_at, bloom_size
        self._bloom: bytes | None = None

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def may_hold(self, key: bytes) -> bool:
        if self._bloom is None:
            self._bloom = self._at(*self._bloom_at)
        bits = struct.unpack_from("<Q", self._bloom)[0]
        return all(self._bloom[8 + (p >> 3)] >> (p & 7) & 1 for p in _probes(key, bits))

    def block(self, i: int) -> tuple[list[bytes], list[np.ndarray]]:
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.index[i][1], self.index[i][2]))
        count, at = _read_varint(raw, 0)
        width = raw[at]
        at += 1
        keys, lens, last = [], [], b""
        for _ in range(count):
            shared, at = _read_varint(raw, at)
            rest, at = _read_varint(raw, at)
            last = last[:shared] + raw[at : at + rest]
            n, at = _read_varint(raw, at + rest)
            keys.append(last)
            lens.append(n)
        ids = np.frombuffer(raw, "<u4" if width == 4 else "<u2", offset=at)
        return keys, np.split(ids, np.cumsum(lens)[:-1]) if lens else []

    def scan(self):
        for i in range(len(self.index)):
            yield from zip(*self.block(i), strict=True)

    def lookup(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of a document (the first of equal keys), or None."""
        key = key_of(doc_id)
        if not self.may_hold(key):
            return None
        i = max(0, bisect.bisect_left([x[0] for x in self.index], key) - 1)
        while i < len(self.index) and self.index[i][0] <= key:
            keys, ids = self.block(i)
            if (j := bisect.bisect_left(keys, key)) < len(keys) and keys[j] == key:
                return ids[j]
            i += 1
        return None


def _writer(path: str, end_id: int, folder: str):
    out = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
    end = np.array([end_id], np.uint32)

    def run(batches):
        disk, root = pafs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        final, trial, writer, sink = f"{root}/shard-{shard:08d}.sst", f"{root}/.trial-{uuid.uuid4().hex}", None, None
        library = encoder(path)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for a, b, ids, at in library.encode(*utf8(batch.column(1))):
                if writer is None:
                    disk.create_dir(root, recursive=True)
                    sink = disk.open_output_stream(trial)
                    writer = ShardWriter(sink)
                for i in range(b - a):
                    writer.add(key_of(docs[a + i]), np.concatenate((ids[at[i] : at[i + 1]], end)))
        if writer is not None:
            writer.close()
            sink.close()
            disk.move(trial, final)  # a task that runs again puts the same shard in place of the first
            yield arrow_batch(out, shard=[shard], path=[final], docs=[writer.docs], ids=[writer.ids])

    return run


def write_shards(docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS) -> tuple[str, DataFrame]:
    """Tokenize each row's whole text (null: empty), append end_id, and write shards in ascending id order.

    Returns the folder and its manifest (shard, path, docs, ids, start: ids in the shards before). Rows of one id keep
    apart, in order of their texts' hashes; an empty table writes no shard."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = max(1, -(-rows.count() // shard_docs))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(n, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie, "text")
    done = cut(rows.mapInArrow(lean(_writer(path, end_id, folder), forget), "shard long, path string, docs long, ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return folder, done.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def _reader(folder: str):
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        disk, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with disk.open_input_file(path) as source:
                    reader = ShardReader(source)
                    for i in range(len(reader.index)):
                        keys, ids = reader.block(i)
                        n = [len(x) for x in ids]
                        first = start + np.cumsum([0, *n])
                        start = int(first[-1])
                        yield arrow_batch(out, doc_id=[id_of(k) for k in keys], start=first[:-1], n_tokens=n, ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in ids])

    return run


def read_shards(folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards that the manifest lists."""
    shards = max(1, manifest.count())
    rows = manifest.select("path", "start", "shard").repartitionByRange(shards, "shard").select("path", "start")
    return rows.mapInArrow(lean(_reader(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")
