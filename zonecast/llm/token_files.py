"""Token-id files in ascending document order, coded by ``mixcoder``.

Writing: documents are range-partitioned and sorted by (doc_id, hash of the
text); each task encodes its texts and writes files of at most FILE_IDS ids
or one document more.  A file is a series of coded runs, a table of its
documents and a trailer.  Files get their final names when complete, as the
archive writer does; the manifest lists them with their id counts.  Where a
document starts among all ids follows from the manifest (ids of earlier files)
and its file's table, so texts are encoded once.

Layout, numbers little-endian: ``TIDS3`` | runs | table | trailer.
  run      u32 ids, u32 blocks, u32 length of each block, CRC-32 of these, blocks
           (the first one is the run's prior)
  table    zlib of: i64 doc_id, u8 null flag, i64 ids, column after column
  trailer  u64 place of the table, u32 its length, u32 its CRC-32, u64 documents, u64 ids

Defined cases: a null text is an empty one and has its end id alone; a null
doc_id comes first; equal ids stand in the order of their text's hash; an
empty table gives no files.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import mixcoder, tokens
from .util import tidy, written
from .warc import file_system

END_ID = 2
FILE_IDS = 1 << 24
RUN_IDS = 1 << 23  # coded side by side: 2048 blocks
MAGIC = b"TIDS3"
TRAILER = struct.Struct("<QIIQQ")
MANIFEST = "file string, part int, number int, docs bigint, ids bigint, bytes bigint, sha256 string"


class _File:
    """One file, written under a temporary name."""

    def __init__(self, folder: str, part: int, number: int):
        self.fs, self.folder = file_system(folder)
        self.name, self.part, self.number = f"ids-{part:06d}-{number:05d}.tids", part, number
        self.tmp = f"{self.folder}/{self.name}.{uuid.uuid4().hex}.tmp"
        self.out, self.sha, self.size = self.fs.open_output_stream(self.tmp, compression=None), hashlib.sha256(), 0
        self.docs: list[tuple[int | None, int]] = []
        self.waiting: list[bytes] = []
        self.n_waiting = self.ids = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, doc_id: int | None, data: bytes) -> None:
        n = len(data) // 4
        self.docs.append((doc_id, n))
        self.ids += n
        self.waiting.append(data)
        self.n_waiting += n
        if self.n_waiting >= RUN_IDS:
            self._code(last=False)

    def _code(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        at = 0
        while len(ids) - at >= RUN_IDS or last and at < len(ids):
            run = ids[at:at + RUN_IDS]
            blocks = mixcoder.encode_run(run)
            head = struct.pack(f"<{2 + len(blocks)}I", len(run), len(blocks), *map(len, blocks))
            self._put(head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks))
            at += len(run)
        self.waiting, self.n_waiting = [ids[at:].tobytes()], len(ids) - at

    def close(self) -> tuple:
        self._code(last=True)
        doc = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        null = np.array([d is None for d, _ in self.docs], "u1").tobytes()
        count = np.array([n for _, n in self.docs], "<i8").tobytes()
        table, place = zlib.compress(doc + null + count, 6), self.size
        self._put(table)
        self._put(TRAILER.pack(place, len(table), zlib.crc32(table), len(self.docs), self.ids))
        self.out.close()
        final = f"{self.folder}/{self.name}"
        if not isinstance(self.fs, pa.fs.LocalFileSystem) and self.fs.get_file_info(final).is_file:
            self.fs.delete_file(final)
        self.fs.move(self.tmp, final)
        return self.name, self.part, self.number, len(self.docs), self.ids, self.size, self.sha.hexdigest()


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) to ``folder``; returns the
    manifest."""
    fs, local = file_system(folder)
    fs.create_dir(local, recursive=True)
    names = [x.split(" ")[0] for x in MANIFEST.split(", ")]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = tokens.load(path), np.array([end_id], "<u4").tobytes()
        part, done, file = TaskContext.get().partitionId(), [], None
        for b in batches:
            for doc_id, data in zip(b.column(0).to_pylist(), bpe.encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                file = file or _File(folder, part, len(done))
                file.add(doc_id, data + end)
                if file.ids >= file_ids:
                    done.append(file.close())
                    file = None
        if file:
            done.append(file.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types, strict=True)], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = written(rows.mapInArrow(tidy(run), MANIFEST), "token-manifest")
    manifest.orderBy("part", "number").write.mode("overwrite").json(f"{folder.rstrip('/')}/manifest")
    return manifest


def read_file(fs: pa.fs.FileSystem, path: str) -> Iterator[tuple]:
    """(doc_id, place of its first id in the file, its ids in pieces) for each
    document, run by run; every checksum is verified."""
    with fs.open_input_file(path) as f:
        size = f.size()
        place, length, crc, n_docs, n_ids = TRAILER.unpack(f.read_at(TRAILER.size, size - TRAILER.size))
        table = f.read_at(length, place)
        if zlib.crc32(table) != crc or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is damaged")
        table = zlib.decompress(table)
        doc = np.frombuffer(table, "<i8", n_docs).tolist()
        null = np.frombuffer(table, "u1", n_docs, 8 * n_docs).tolist()
        count = np.frombuffer(table, "<i8", n_docs, 9 * n_docs).tolist()
        at, have, left, start = len(MAGIC), np.zeros(0, "<u4"), 0, 0
        for d, is_null, n in zip(doc, null, count, strict=True):
            pieces, need = [], n
            while need:
                if left == len(have):
                    ids, blocks = struct.unpack("<2I", f.read_at(8, at))
                    head = f.read_at(8 + 4 * blocks + 4, at)
                    if zlib.crc32(head[:-4]) != int.from_bytes(head[-4:], "little"):
                        raise ValueError(f"{path} is damaged")
                    lengths = struct.unpack(f"<{blocks}I", head[8:-4])
                    at += len(head)
                    data = f.read_at(sum(lengths), at)
                    at += len(data)
                    ends = np.cumsum(lengths).tolist()
                    have = mixcoder.decode_run([data[e - k:e] for e, k in zip(ends, lengths, strict=True)], ids)
                    left = 0
                piece = have[left:left + need]
                pieces.append(piece)
                left += len(piece)
                need -= len(piece)
            yield None if is_null else d, start, pieces
            start += n
        if start != n_ids or at != place:
            raise ValueError(f"{path} is damaged")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files that the manifest lists: doc_id, start (ids
    before it, over all files), n_tokens, ids_crc32 and, if wanted, ids."""
    files = spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifest")
    # one row per file
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.withColumn("before", before)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    names = [x.split(" ")[0] for x in schema.split(", ")]
    types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, local = file_system(folder.rstrip("/"))
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, start, pieces in read_file(fs, f"{local}/{name}"):
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(p.tobytes(), crc)
                    row = (doc_id, first + start, sum(map(len, pieces)), crc)
                    rows.append((*row, np.concatenate(pieces).astype(np.int32)) if with_ids else row)
                    if len(rows) == (256 if with_ids else 10_000):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file", "before").repartition(n, "file").mapInArrow(tidy(run), schema)
