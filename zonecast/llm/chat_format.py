r"""Chat formatting by columnar byte assembly.

A turn becomes ``### <role>: <text></turn>\n``.  In texts a backslash goes
before every backslash, every ``###`` and every ``</turn>``; in roles also
before colons.  So an unescaped ``###`` or ``</turn>`` is always the
template's own, and dropping each backslash that escapes restores the text.

Slices of SLICE_BYTES of an Arrow batch are formatted at once: segment lengths,
their cumulative offsets and the place of every content byte are numpy arrays,
and headers, contents, escapes and ends are scattered into one preallocated
buffer that becomes the Arrow column.  A turn longer than a slice is put
together alone, without index arrays.  Turns are formatted independently, so the format
step needs no shuffle; a conversation is its turns in (turn, role, text)
order.

Defined cases: null text or role counts as empty; a null conversation id is a
conversation of its own; null turns come first; repeated rows stay repeated;
other columns of the input aren't looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import tidy

# The template.
TURN_MARK = b"### "
ROLE_END = b": "
TURN_END = b"</turn>\n"
CONTROL = (b"###", b"</turn>")
LOSS_ROLE = b"assistant"

SLICE_BYTES = 4 << 20  # of texts assembled together: index arrays take some 25 bytes a byte
FORMATTED = "conv_id bigint, turn bigint, formatted binary, loss_start bigint, loss_length bigint"
DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
           "loss_sha256 string, formatted_chars bigint")


def escape(s: bytes, extra: bytes = b"") -> bytes:
    marks = b"|".join([rb"\\", *(rb"(?=" + re.escape(c) + rb")" + re.escape(c[:1]) for c in CONTROL),
                       *(re.escape(extra[i:i + 1]) for i in range(len(extra)))])
    return re.sub(marks, lambda m: b"\\" + m[0], s, flags=re.S)


def unescape(s: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", s, flags=re.S) if b"\\" in s else s


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Contents and offsets of a string column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _starts(data: np.ndarray, row: np.ndarray, mark: bytes) -> np.ndarray:
    """Where ``mark`` starts inside one row."""
    n = len(data) - len(mark) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:n] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at[row[at] == row[at + len(mark) - 1]]


def assemble(roles: list[bytes], data: np.ndarray, offsets: np.ndarray):
    """One buffer with all formatted turns; their offsets; where each text
    starts in its turn and how many bytes it takes there."""
    n = len(roles)
    headers = {r: TURN_MARK + escape(r, b":") + ROLE_END for r in set(roles)}
    row = np.repeat(np.arange(n), np.diff(offsets))
    escapes = np.unique(np.concatenate([np.flatnonzero(data == ord("\\")), *(_starts(data, row, c) for c in CONTROL)]))
    per_row = np.bincount(row[escapes], minlength=n)
    head = np.array([len(headers[r]) for r in roles], np.int64)
    body = np.diff(offsets) + per_row
    ends = np.cumsum(head + body + len(TURN_END))
    out_offsets = np.concatenate([[0], ends]).astype(np.int64)
    out = np.empty(out_offsets[-1], np.uint8)
    # contents: moved on by what stands before their row and by earlier escapes
    shift = out_offsets[:-1] + head - offsets[:-1] - (np.cumsum(per_row) - per_row)
    before = np.zeros(len(data), np.int64)
    before[escapes] = 1
    before = np.cumsum(before)
    place = np.arange(len(data)) + shift[row] + before
    out[place] = data
    out[place[escapes] - 1] = ord("\\")
    for r, h in headers.items():
        at = np.array([i for i, x in enumerate(roles) if x == r], np.int64)
        out[out_offsets[at][:, None] + np.arange(len(h))] = np.frombuffer(h, np.uint8)
    if n:
        out[(ends - len(TURN_END))[:, None] + np.arange(len(TURN_END))] = np.frombuffer(TURN_END, np.uint8)
    return out, out_offsets, head, body


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in by_bytes(whole, "text", SLICE_BYTES):
            roles = [(r or "").encode() for r in b.column("role").to_pylist()]
            masked = np.array([r == LOSS_ROLE for r in roles])
            text = b.column("text").fill_null("")
            if b.num_rows == 1 and pc.binary_length(text)[0].as_py() > SLICE_BYTES:
                # a long turn alone: no index arrays, a few times its bytes
                header, body_ = TURN_MARK + escape(roles[0], b":") + ROLE_END, escape(text[0].as_py().encode())
                column, head, body = pa.array([header + body_ + TURN_END], pa.binary()), np.array([len(header)]), np.array([len(body_)])
            else:
                data, offsets = _bytes_of(text)
                out, out_offsets, head, body = assemble(roles, data, offsets)
                column = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(out_offsets.astype(np.int32)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), column,
                 pa.array(np.where(masked, head, 0)), pa.array(np.where(masked, body, 0))],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_length"])


def by_bytes(b: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of rows whose ``column`` takes at most ``limit`` bytes together;
    a longer row is a slice of its own."""
    size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < b.num_rows:
        end, total = at + 1, int(size[at])
        while end < b.num_rows and total + size[end] <= limit:
            total += int(size[end])
            end += 1
        yield b.slice(at, end - at)
        at = end


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, the formatted bytes, and the span of
    bytes under the loss mask (all of an assistant's escaped text).  Rows come
    grouped by conversation and in order within each Spark partition."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(tidy(_format), FORMATTED)


_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*): ((?:[^\\]|\\.)*?)</turn>\n", re.S)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn in formatted bytes."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class _Reader:
    """Digests of one conversation, fed turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: bytes, start: int, length: int) -> None:
        for role, text in parse(formatted):
            self.n += 1
            self.turns.update(role + b"\n" + text + b"\n")
        self.chars += len(formatted.decode())
        masked = unescape(formatted[start:start + length])
        self.loss += len(masked.decode())
        self.masked.update(masked)

    def row(self):
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.masked.hexdigest(), self.chars)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    now, done = None, []
    for b in (part for whole in batches for part in by_bytes(whole, "formatted", SLICE_BYTES)):
        for conv, data, start, length in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(),
                                             b.column("loss_start").to_pylist(), b.column("loss_length").to_pylist(),
                                             strict=True):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.row())
                now = _Reader(conv)
            now.add(data, start, length)
        if len(done) >= 5000:
            yield batch(done)
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield batch(done)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, parsed from what ``format_turns`` returned.
    A digest over a conversation's turns is sequential, so one task reads a
    conversation; it holds one batch at a time, however many turns it has."""
    return formatted.mapInArrow(tidy(_read), DIGESTS)


def with_probe(conversations: DataFrame) -> DataFrame:
    r"""``conversations`` plus conversation -7, whose texts hold the template's
    own control strings."""
    text = "\\### Assistant: </turn> ok"
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(probe)
