"""Deterministic sharded WARC writer and reader.

Writing: payload digests come first, as narrow rows; of records with equal
payloads the one with the largest id is the response and the others become
revisits of it.  Records are then sorted by id over range shards that follow from the table
alone (running bytes over slices of the id range), so the same table gives the
same files in any run.  A shard rolls to
its next file when the compressed size passes the limit.  Headers and digests
are regenerated from the payload; record ids derive from page id and digest
and all dates are one fixed date, so a file's bytes depend on its records
only.

Commit: a task writes ``<name>.<unique>.tmp`` and renames it to its final
name when complete; a repeated or speculative task replaces the file by equal
bytes.  Each task returns its files with record counts, sizes and SHA-256;
the manifest, written after all tasks are done, lists what belongs to the
archive.  The reader reads listed files only and checks size, counts and
digests.

Files go through ``pyarrow.fs`` to a folder that driver and executors share.

Defined cases: a null payload is an empty one; a null url is written as
``about:blank``; a null id sorts first, is the smallest, and reads back as
null; of rows equal in id and payload the first is the response and the
others revisit it; an empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from decimal import Decimal
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.guards import require_columns
from ..operators.ordering import prefix_sums
from .util import tidy, written

FILE_BYTES = 16 << 20  # compressed; a file ends at the first record past it
SHARD_BYTES = 64 << 20  # of payload in a shard, about
SLICES = 16  # slices of the id range per shard wanted
DATE = "2024-01-01T00:00:00Z"  # fixed, for equal bytes in every run
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_STATUS = b"HTTP/1.1 200 OK"

MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha256 string"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, target_uri string, file string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a URI that Hadoop's or plain notation names."""
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def _uuid(page_id, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{kind}')}>"


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record.  A revisit's block is the HTTP header only."""
    http = HTTP_STATUS + CRLF + b"Content-Type: text/html; charset=utf-8" + CRLF + b"Content-Length: %d" % len(payload) + CRLF * 2
    block = http + payload if kind == "response" else http
    uri = re.sub(r"[\x00-\x20\x7f-\x9f\u2028\u2029]", lambda m: quote(m[0], safe=""), url or "about:blank")
    head = [("WARC-Type", kind), ("WARC-Record-ID", _uuid(page_id, digest, kind)), ("WARC-Date", DATE),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if kind == "revisit":
        head += [("WARC-Refers-To", _uuid(refers_to, digest, "response")), ("WARC-Profile", PROFILE)]
        head += [] if refers_to is None else [("Page-Refers-To", str(refers_to))]
    head += [] if page_id is None else [("Page-Id", str(page_id))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}".encode() + CRLF for k, v in head)
    return b"WARC/1.1" + CRLF + lines + CRLF + block + CRLF * 2


class _Roll:
    """The files of one shard, written under temporary names."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.fs, self.folder = file_system(folder)
        self.shard, self.limit, self.n, self.out, self.done = shard, limit, 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.n:05d}.warc.gz"
            self.tmp = f"{self.folder}/{self.name}.{uuid.uuid4().hex}.tmp"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.tmp, compression=None), 0, 0, hashlib.sha256()
        z = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member per record, without time or name
        data = z.compress(record) + z.flush()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        final = f"{self.folder}/{self.name}"
        if not isinstance(self.fs, pa.fs.LocalFileSystem) and self.fs.get_file_info(final).is_file:
            self.fs.delete_file(final)  # of an earlier attempt; a local rename replaces it
        self.fs.move(self.tmp, final)
        self.done.append((self.name, self.shard, self.records, self.size, self.sha.hexdigest()))
        self.n, self.out = self.n + 1, None


def _write(folder: str, file_bytes: int):
    names = ["file", "shard", "records", "bytes", "sha256"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, done, last, known = None, [], None, None
        for b in batches:
            for shard, page_id, url, html, sha1, rep, met in zip(*(b.column(c).to_pylist() for c in (
                    "shard", "page_id", "url", "html", "digest", "rep", "met")), strict=True):
                if met:  # this payload has several records, and ``rep`` is its response
                    known = (page_id, sha1, rep)
                    continue
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        done += roll.done
                    roll = _Roll(folder, shard, file_bytes)
                payload = (html or "").encode()
                kind, refers = "response", None
                if known is not None and known[:2] == (page_id, sha1):
                    # rows equal in id and payload stand together: the first is the response
                    if page_id != known[2] or last == (page_id, sha1):
                        kind, refers = "revisit", known[2]
                last = (page_id, sha1)
                roll.add(record_bytes(page_id, url, payload, base32_sha1(payload), kind, refers))
        if roll is not None:
            roll.close()
            done += roll.done
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types, strict=True)], names=names)

    return run


def _shard_table(keyed: DataFrame, shard_bytes: int) -> tuple[Column, DataFrame]:
    """Slice of the id range -> its first shard and how many shards it spans.

    Slices are equal widths of the id range, at most SLICES per shard wanted;
    running bytes over them cut the shards.  A slice of one id that alone
    exceeds a shard spans several, by the leading digits of the digest."""
    got = keyed.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi"), F.sum("size").alias("b")).first()
    lo, hi = got["lo"] or 0, got["hi"] or 0
    wanted = max(1, -(-(got["b"] or 0) // shard_bytes))
    width = max(1, -(-(hi - lo + 1) // (wanted * SLICES)))
    # ids at both ends of their range are further apart than a long
    from_lo = F.col("page_id").cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)")
    slice_of = F.coalesce(F.floor(from_lo / F.lit(Decimal(width))), F.lit(-1)).cast("bigint")
    table = keyed.groupBy(slice_of.alias("slice")).agg(F.sum("size").alias("b"))
    table = prefix_sums(table, [F.col("slice")], ["b"])
    before = F.col("b_cum") - F.col("b")
    single = F.lit(width == 1) | (F.col("slice") == -1)
    table = table.select("slice", F.floor(before / shard_bytes).alias("base"),
                         F.when(single, F.greatest(F.lit(1), F.floor(F.col("b") / shard_bytes))).otherwise(1).alias("span"))
    return slice_of, table


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to ``folder`` and returns the
    manifest.  Payloads under ``min_bytes`` are never revisits."""
    require_columns(pages, ["page_id", "url", "html"])
    spark = pages.sparkSession
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", "html", F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    slice_of, table = _shard_table(keyed, shard_bytes)
    table = written(table, "warc-shards")  # two numbers for each SHARD_BYTES / SLICES of payload
    n = (table.agg(F.max(F.col("base") + F.col("span"))).first()[0] or 1)
    # of each payload met more than once: the response's id; a partial maximum, however hot the payload
    reps = (keyed.groupBy("digest", "size").agg(F.max("page_id").alias("rep"), F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & (F.col("size") >= min_bytes)).select("digest", "rep", F.lit(True).alias("met")))
    part = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") * F.col("span") / F.lit(1 << 32))
    placed = keyed.withColumn("slice", slice_of).join(table, "slice").withColumn("shard", (F.col("base") + part).cast("bigint"))
    # payloads move once, to their shard; what is known of repeated ones joins
    # narrow rows and travels to the same place, sorted before the payloads
    known = placed.select("shard", "page_id", "digest").join(reps, "digest").select(
        "shard", "page_id", "digest", "rep", "met", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    rows = placed.select("shard", "page_id", "digest", F.lit(None).cast("bigint").alias("rep"), F.lit(False).alias("met"), "url", "html")
    # the shard is the partition: no two shards in one task, none left empty
    rows = known.unionByName(rows).repartitionById(max(1, n), F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "page_id", "digest", F.col("met").desc(), "url")
    files = rows.select("shard", "page_id", "url", "html", "digest", "rep", "met").mapInArrow(
        tidy(_write(folder.rstrip("/"), file_bytes)), MANIFEST)
    manifest = written(files, "warc-manifest")
    # complete or absent: Spark's committer writes it, after every file has its final name
    manifest.orderBy("file").write.mode("overwrite").json(f"{folder.rstrip('/')}/manifest")
    return manifest


def split_records(data: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """Header fields (names in lower case) and block of each record in a run
    of gzip members, read piece by piece."""
    z, buffer = zlib.decompressobj(31), bytearray()

    def parse(raw: bytes) -> tuple[dict, bytes]:
        head, _, rest = raw.partition(CRLF * 2)
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC/1.1 record")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        n = int(fields["content-length"])
        if rest[n:] != CRLF * 2:
            raise ValueError("a record's length is wrong")
        return fields, rest[:n]

    for piece in data:
        while piece:
            buffer += z.decompress(piece)
            piece = b""
            if z.eof:
                yield parse(bytes(buffer))
                piece, z, buffer = z.unused_data, zlib.decompressobj(31), bytearray()
    if buffer:
        raise ValueError("the file ends inside a record")


def _read(folder: str):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "file"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def rows(fs, path, name, records, size):
        n = 0
        with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
            def pieces():
                got = 0
                while piece := f.read(1 << 20):
                    got += len(piece)
                    yield piece
                if got != size:
                    raise ValueError(f"{name} has {got} bytes; the manifest says {size}")

            for head, block in split_records(pieces()):
                n += 1
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if "sha1:" + base32_sha1(block) != head["warc-block-digest"]:
                    raise ValueError(f"a block digest in {name} is wrong")
                http, _, payload = block.partition(CRLF * 2)
                length = int(http.rpartition(b"Content-Length: ")[2])
                if head["warc-type"] == "response" and (len(payload) != length or base32_sha1(payload) != digest):
                    raise ValueError(f"a payload in {name} is wrong")
                page, refers = head.get("page-id"), head.get("page-refers-to")
                yield (None if page is None else int(page), length, digest, head["warc-type"],
                       None if refers is None else int(refers), head["warc-target-uri"], name)
        if n != records:
            raise ValueError(f"{name} has {n} records; the manifest says {records}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for b in batches:
            for name, records, size in zip(*(b.column(c).to_pylist() for c in ("file", "records", "bytes")), strict=True):
                some = []
                for r in rows(fs, path, name, records, size):
                    some.append(r)
                    if len(some) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types, strict=True)], names=names)
                        some = []
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types, strict=True)], names=names)

    return run


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files that the manifest in ``folder`` lists."""
    files = spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifest")
    n = spark.sparkContext.defaultParallelism
    return files.repartition(max(1, n), "file").mapInArrow(tidy(_read(folder.rstrip('/'))), RECORDS)
