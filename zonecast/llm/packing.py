"""Best-fit packing of documents into sequences, with certified repacking.

Pieces (documents, or parts of those over the capacity) are dealt into parts
of about PART_PIECES.  Each part is packed best-fit decreasing, and lower
bounds from dual-feasible functions of its length histogram say how few bins
any packing needs.  A part that meets its bound is done.  Parts with a gap keep
only pieces that fill a bin alone and give away the others; what all such parts
give is dealt anew, with another mix and into half as many parts or fewer, and
packed again.  That ends when nothing is given away, when
one part remains (no other documents to exchange with), or after ROUNDS
rounds, so that no part exceeds PART_PIECES * 2 ** (ROUNDS - 1) pieces.

Only narrow rows (ids of piece and document, lengths, checksums) are moved;
texts and token ids stay in the task that reads them.  Rounds are written to
the shared scratch folder.  Parts are dealt by a running number within the
reading task joined with a hash, so equal rows spread too.

Defined cases: a null text is an empty one and yields its end id alone; equal
rows are packed one by one; an empty table gives no pieces; other columns of
the input aren't looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .util import tidy, written

CAPACITY = 2048
END_ID = 0
PART_PIECES = 200_000
ROUNDS = 4
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, slot bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint, done boolean"
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: whole if
    it fits, else full pieces after a first one that takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): its place in the
    document's ids (with the end id), length and CRC-32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, slot = tokens.load(path), np.array([end_id], "<u4").tobytes(), 0
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
        for b in batches:
            rows = []
            for doc_id, data in zip(b.column(0).to_pylist(), bpe.encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                data += end
                for k, (s, n) in enumerate(cuts(len(data) // 4, capacity)):
                    rows.append((doc_id, k, s, n, zlib.crc32(data[4 * s:4 * (s + n)]), slot))
                    slot += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=NAMES)

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(tidy(run), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs at least: the largest sum, over bins, of a
    dual-feasible function of the lengths.  Two published families: the
    threshold functions (lengths over capacity - t count whole, those under t
    not at all), and the rounding functions floor((k + 1) x) / k."""
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    total = np.cumsum(count * np.arange(capacity + 1))
    above = count.sum() - np.cumsum(count)  # longer than x
    best = -(-int(total[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):
        middle = int(total[capacity - t] - total[t - 1])
        best = max(best, -(-(int(above[capacity - t]) * capacity + middle) // capacity))
    x = np.arange(capacity + 1)
    for k in range(1, 33):
        part = (k + 1) * x // capacity
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(whole, x * k, part * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each length and its offset there."""
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: a bin with room r is open
    bins = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1  # the least room that fits
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b, bins = capacity, bins, bins + 1
        bin_of[i], offset[i] = b, capacity - room
        room -= n
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return bin_of, offset


def _pack_part(capacity: int, turn: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        lengths = table.column("length").to_numpy()
        bin_of, offset = best_fit_decreasing(lengths, capacity)
        n_bins = int(bin_of.max()) + 1
        if last or n_bins == lower_bound(lengths, capacity):
            done = np.ones(len(lengths), bool)
        else:
            done = lengths == capacity
        ids = (turn << 56) + (part << 28) + bin_of
        out = table.select(NAMES)
        for name, column in (("sequence_id", ids), ("offset", offset), ("done", done)):
            out = out.append_column(name, pa.array(column))
        return out

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with the sequence each one goes to and its offset there."""
    left, done, parts = written(pieces, "pack-pieces"), [], 1 << 62
    for turn in range(1, rounds + 1):
        n = left.count()
        if not n and done:
            break
        parts = max(1, min(-(-n // part_pieces), -(-parts // 2)))
        part = F.pmod(F.xxhash64("doc_id", "piece", "slot", F.lit(turn)), F.lit(parts))
        packed = left.groupBy(part.alias("part")).applyInArrow(
            _pack_part(capacity, turn, parts == 1 or turn == rounds), PACKED)
        packed = written(packed, f"pack-{turn}")
        done.append(packed.where("done"))
        left = packed.where("NOT done").select(NAMES)
        if parts == 1 or turn == rounds:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*NAMES[:-1], "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) and their places: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, path, capacity), capacity)
