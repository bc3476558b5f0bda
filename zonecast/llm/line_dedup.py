"""Near-duplicate line removal by a deletion-neighbourhood join.

The unit of edits is the word (a run of characters other than space and
TAB..CR).  Two lines are near when both have at least MIN_WORDS words and one
word inserted, deleted or replaced turns one into the other; lines with equal
words are always near.  In the order of (doc_id, line number) a line goes if
some earlier line is near it; lines without words stay.

First equal lines meet by the hash of the whole, and lines from MIN_WORDS words
on by the hashes of their halves: split the shorter of two near lines in two,
then one of the halves begins or ends the other line too, as one edit can't
touch both.  So a line that shares no half with a different line has no near
one.  Three halves a line do for both lengths that its partner may have.  Of a
half that several lines of a task have, two lines are passed on and all are
told; equal lines go at once.

The earliest of equal lines that share a half with a different line then emit
hashed keys of their variants within the bound: the whole line and the line
without each one word, with that word's
place.  Equal keys mean: whole and whole, equal lines; variant and variant
without the same place, one word replaced; whole and variant, one word more.
Each of the first two kinds of group is a clique, so its earliest line stands
for it.  A task therefore links the other lines of a group to the earliest at
once and passes only that one on: however often a line or its near copies
occur, a key leaves a task once.  Keys travel packed by hash bucket (numpy
arrays in binary columns, 32 bits of each hash besides the bucket's); the
buckets' tasks link what meets there, and chance meetings fail verification.

The texts of lines that take part are read again, told by a bitmap of fixed
size, and the join drops its false hits.  Links between different lines are
verified on their words.  Equal lines are told by 128 bits of hash: two hashes of
independent random values per byte and place (see ``words``), one of which
isn't used to find them.

Defined cases: a null text has no lines and stays null; a null doc_id comes
first; rows with equal id and text are one document, whose repeated rows are
treated alike; other columns pass through whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import free_name, release, row_key, tidy, written
from .words import GOLDEN, IS_SPACE, MORE_VALUES, U, Words, mix, pieces

MIN_WORDS = 8
WORDS_TOGETHER = 1_000_000  # whose variants a task holds
TEXT_TOGETHER = 16_000_000  # bytes of text whose halves a task holds
VARIANTS_PER_BUCKET = 1_000_000
BITMAP = 1 << 23
PACKED = "bucket int, docs binary, lines binary, wholes binary, variants binary, hashes binary, links binary"
PACKED_HALVES = "bucket int, docs binary, lines binary, wholes binary, halves binary, hashes binary, marks binary"
MARKS = "key bigint, line int, same boolean"
LINKS = ("later_key bigint, later_line int, earlier_key bigint, earlier_line int, same boolean")
LINE = np.dtype([("doc", "<u4"), ("line", "<u4")])
DOC = np.dtype([("null", "u1"), ("id", "<i8"), ("key", "<i8")])
MARK = np.dtype([("key", "<i8"), ("line", "<i4"), ("same", "?")])
LINK = np.dtype([("later_key", "<i8"), ("later_line", "<i4"), ("earlier_key", "<i8"), ("earlier_line", "<i4"), ("same", "?")])


def planes(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, least significant plane of each first, compressed:
    differences and places of words take few bits."""
    out = [np.array([len(arrays[0])], "<u8").tobytes()]
    for a in arrays:
        raw = np.ascontiguousarray(a)
        out.append(np.ascontiguousarray(raw.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())
    return zlib.compress(b"".join(out), 1)


def unplanes(data: bytes, *dtypes: str) -> list[np.ndarray]:
    data = zlib.decompress(data)
    n, at, out = int(np.frombuffer(data, "<u8", 1)[0]), 8, []
    for d in map(np.dtype, dtypes):
        raw = np.frombuffer(data, np.uint8, n * d.itemsize, at).reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(raw.T).reshape(-1).view(d))
        at += n * d.itemsize
    return out


class _Hashed:
    """Sums of the words' hashes of ``lines``, and the keys of whole lines: of
    lines with words (``has``) the key and a second hash."""

    def __init__(self, lines: list[bytes]):
        words = Words(lines)
        self.h, at = words.hashes(lower=False), words.first
        self.start, self.end = start, end = at[:-1], at[1:]
        self.n = n = end - start
        self.has = np.flatnonzero(n > 0)
        self.long = np.flatnonzero(n >= MIN_WORDS)
        self.place = (np.arange(len(self.h)) - np.repeat(start, n)).astype(U) * GOLDEN
        # a line is the sum of its words, each mixed with its place
        self.sums = self.summed(self.place)
        sums2 = np.zeros(len(self.h) + 1, U)
        np.cumsum(mix(words.hashes(False, MORE_VALUES) + self.place), out=sums2[1:])
        s, e = start[self.has], end[self.has]
        short = (n[self.has] < MIN_WORDS).astype(U) * U(0x632BE59BD9B4E019)  # their wholes equal no variant
        self.whole = mix(self.sums[e] - self.sums[s] + n[self.has].astype(U) + short)
        self.second = mix(sums2[e] - sums2[s] + n[self.has].astype(U))

    def summed(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.h) + 1, U)
        np.cumsum(mix(self.h + place), out=out[1:])
        return out


def variants(lines: list[bytes]) -> tuple[np.ndarray, ...]:
    """Keys of all variants of ``lines``.  Of lines with words: number, key,
    second hash; of lines from MIN_WORDS on: number, key, place of the word
    left out."""
    out = []
    for a, b in pieces(lines):
        x = _Hashed(lines[a:b])
        n, start, end, sums = x.n, x.start, x.end, x.sums
        moved = x.summed(x.place - GOLDEN)  # after the word left out the places are one less
        line = np.repeat(x.long, n[x.long])
        word = np.arange(len(line)) - np.repeat(np.cumsum(n[x.long]) - n[x.long], n[x.long]) + start[line]
        left, right = sums[word] - sums[start[line]], moved[end[line]] - moved[word + 1]
        key = mix(left + right + (n[line] - 1).astype(U))
        out.append((x.has + a, x.whole, x.second, line + a, key, (word - start[line]).astype(np.uint32)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, U, U, np.int64, U, np.uint32))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def halves(lines: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of lines with words: number, key, second hash; of lines from MIN_WORDS
    on, in their order: number and hash of each half that a near line shares.
    The shorter line of n words is split after n // 2; a line of n words may be
    the shorter one or, from MIN_WORDS + 1 on, have one word more than it."""
    out = []
    for a, b in pieces(lines):
        x = _Hashed(lines[a:b])
        back = x.summed((np.repeat(x.end, x.n) - 1 - np.arange(len(x.h))).astype(U) * GOLDEN)
        n, start, end = x.n[x.long], x.start[x.long], x.end[x.long]
        found = []
        for shorter in (n, n - 1):
            head = shorter // 2
            tail = shorter - head
            found.append((head, mix(x.sums[start + head] - x.sums[start] + head.astype(U))))
            found.append((tail, mix(back[end] - back[end - tail] + tail.astype(U) + U(0x632BE59BD9B4E019))))
        (head, h0), (tail, t0), (head1, h1), (tail1, t1) = found
        more = n > MIN_WORDS
        keep = np.stack([np.ones(len(n), bool), np.ones(len(n), bool), more & (head1 != head), more & (tail1 != tail)], axis=1)
        half = np.stack([h0, t0, h1, t1], axis=1)
        line = np.repeat(x.long + a, 4).reshape(-1, 4)
        out.append((x.has + a, x.whole, x.second, line[keep], half[keep]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, U, U, np.int64, U))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by key, and for each place there the place of its group's
    first."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    return order, np.maximum.accumulate(np.where(new, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)


def clique_links(keys: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries in line order: which are the first of their key; and links
    (later, earlier) of the others to the first and to the one before (two, so
    that a chance collision of the keys at one of them loses nothing)."""
    order, first = _groups(keys)
    at = np.arange(len(order))
    is_first = np.zeros(len(keys), bool)
    is_first[order[first == at]] = True
    rest = np.flatnonzero(first != at)
    later = line[order[rest]]
    pairs = np.concatenate([np.stack([later, line[order[first[rest]]]]), np.stack([later, line[order[rest - 1]]])], axis=1)
    pairs = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
    return is_first, pairs[0], pairs[1]


def _link_rows(doc: np.ndarray, lines: np.ndarray, later: np.ndarray, earlier: np.ndarray, same: bool) -> np.ndarray:
    out = np.zeros(len(later), LINK)
    for name, of in (("later", later), ("earlier", earlier)):
        out[f"{name}_key"] = doc["key"][lines["doc"][of]]
        out[f"{name}_line"] = lines["line"][of]
    out["same"] = same
    # repeated rows are one document: a line isn't later than itself
    return out[(out["later_key"] != out["earlier_key"]) | (out["later_line"] != out["earlier_line"])]


def _lined(docs: list[tuple]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Documents (null flag, id, key, text and, unless they are all of it, the
    numbers of its lines) in their order, their lines, and the lines' texts."""
    # repeated rows are one document: a second copy's lines aren't later than the first's
    docs = sorted({d[:3]: d for d in docs}.values(), key=lambda d: (not d[0], d[1], d[2]))
    doc = np.array([d[:3] for d in docs], DOC)
    split = [d[3].split(b"\n") for d in docs]
    count = np.array([len(x) for x in split])
    lines = np.zeros(int(count.sum()), LINE)
    lines["doc"] = np.repeat(np.arange(len(docs)), count)
    lines["line"] = np.concatenate([d[4] if len(d) > 4 else np.arange(n) for d, n in zip(docs, count.tolist(), strict=True)])
    return doc, lines, [x for s in split for x in s]


def _buckets(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    if n_buckets == 1:
        return np.zeros(len(keys), np.int64)
    return (keys >> U(64 - int(n_buckets).bit_length() + 1)).astype(np.int64)


def _cuts(met: np.ndarray, bucket: np.ndarray) -> list[np.ndarray]:
    """Which entries belong to each of the buckets ``met``."""
    order = np.argsort(bucket, kind="stable")
    lo, hi = (np.searchsorted(bucket[order], met, side) for side in ("left", "right"))
    return [order[i:j] for i, j in zip(lo.tolist(), hi.tolist(), strict=True)]


def _ends(doc: np.ndarray, lines: np.ndarray, of: np.ndarray, same: bool) -> np.ndarray:
    out = np.zeros(len(of), MARK)
    out["key"], out["line"], out["same"] = doc["key"][lines["doc"][of]], lines["line"][of], same
    return out


def _pack_halves(docs: list[tuple], n_buckets: int, turn: int) -> Iterator[tuple]:
    """PACKED_HALVES rows of some documents (null flag, id, key, text)."""
    doc, lines, texts = _lined(docs)
    w_line, whole, second, h_line, half = halves(texts)
    order, first = _groups(whole ^ mix(second))
    at = np.arange(len(order))
    marks = [_ends(doc, lines, w_line[order[first != at]], True)]
    kept = np.sort(order[first == at])
    w_line, whole, second = w_line[kept], whole[kept], second[kept]
    tag = np.zeros(len(lines), U)
    tag[w_line] = whole
    new = np.zeros(len(lines), bool)
    new[w_line] = True
    stays = new[h_line]
    h_line, half = h_line[stays], half[stays]
    # different lines with a half in common are told here; two of them tell the others
    order, first = _groups(half)
    at = np.arange(len(order))
    several = np.bincount(first, minlength=len(order))[first] > 1
    marks.append(_ends(doc, lines, np.unique(h_line[order[several]]), False))
    kept = np.sort(order[at - first < 2])
    h_line, half = h_line[kept], half[kept]
    marks = np.concatenate(marks)
    w_bucket, h_bucket = _buckets(whole, n_buckets), _buckets(half, n_buckets)
    # marks ride along to any one bucket
    met = np.unique(np.concatenate([w_bucket, h_bucket, np.full(min(1, len(marks)), turn % n_buckets)]))
    for k, w, h in zip(met.tolist(), _cuts(met, w_bucket), _cuts(met, h_bucket), strict=True):
        own = marks if k == turn % n_buckets else marks[:0]
        used, where = np.unique(np.concatenate([w_line[w], h_line[h]]), return_inverse=True)
        used_docs, doc_at = np.unique(lines["doc"][used], return_inverse=True)
        d = doc[used_docs]
        yield (k, planes(d["null"], d["id"].astype("<i8"), d["key"].astype("<i8")),
               planes(np.diff(doc_at, prepend=0).astype("<u4"), lines["line"][used].astype("<u4"), tag[used]),
               planes(where[:len(w)].astype("<u4"), second[w]), planes(np.diff(where[len(w):], prepend=0).astype("<i4")),
               half[h].astype("<u4").tobytes(), own.tobytes())


def _meet_halves(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """MARKS of one bucket: lines that an earlier one equals, and lines that
    share a half with a different line (the earliest of equal ones)."""
    doc, lines, tags, wholes, shared, marks = [], [], [], [], [], []
    n_docs = n_lines = 0
    for row in table.to_pylist():
        marks.append(np.frombuffer(row["marks"], MARK))
        null, id_, k = unplanes(row["docs"], "u1", "<i8", "<i8")
        delta, number, tag = unplanes(row["lines"], "<u4", "<u4", "<u8")
        line, second = unplanes(row["wholes"], "<u4", "<u8")
        d_line, = unplanes(row["halves"], "<i4")
        d, l = np.zeros(len(null), DOC), np.zeros(len(number), LINE)
        d["null"], d["id"], d["key"] = null, id_, k
        l["doc"], l["line"] = np.cumsum(delta) + n_docs, number
        doc.append(d), lines.append(l), tags.append(tag)
        wholes.append((line.astype(np.int64) + n_lines, second))
        shared.append((np.cumsum(d_line) + n_lines, np.frombuffer(row["hashes"], "<u4").astype(np.uint32)))
        n_docs, n_lines = n_docs + len(d), n_lines + len(l)
    doc, lines, tag = np.concatenate(doc), np.concatenate(lines), np.concatenate(tags)
    w_line, second = (np.concatenate(c) for c in zip(*wholes, strict=True))
    h_line, half = (np.concatenate(c) for c in zip(*shared, strict=True))
    # number the lines in their order, over all tasks
    d = doc[lines["doc"]]
    by_age = np.lexsort((lines["line"], d["key"], d["id"], 1 - d["null"]))
    age = np.empty(len(lines), np.int64)
    age[by_age] = np.arange(len(lines))
    lines, tag = lines[by_age], tag[by_age]
    w_line, h_line = age[w_line], age[h_line]

    order = np.argsort(w_line, kind="stable")
    w_line, second = w_line[order], second[order]
    order, first = _groups(tag[w_line] ^ mix(second))
    ends = _ends(doc, lines, w_line[order], True)
    # repeated rows are one document: a line isn't later than itself
    marks.append(ends[(ends["key"] != ends["key"][first]) | (ends["line"] != ends["line"][first])])
    order = np.lexsort((h_line, tag[h_line], half))
    h_line, half = h_line[order], half[order]
    t = tag[h_line]
    edge = np.ones(len(half), bool)
    edge[1:] = half[1:] != half[:-1]
    new = edge.copy()
    new[1:] |= t[1:] != t[:-1]  # the earliest of equal lines
    group = np.cumsum(edge) - 1
    several = np.bincount(group[new], minlength=len(half))[group] > 1
    marks.append(_ends(doc, lines, h_line[new & several], False))
    out = np.unique(np.concatenate(marks))
    return pa.Table.from_arrays([pa.array(out[n]) for n in MARK.names], names=list(MARK.names))


def _pack(docs: list[tuple], n_buckets: int, turn: int) -> Iterator[tuple]:
    """PACKED rows of some documents (null flag, id, key, text and, unless they
    are all of it, the numbers of its lines)."""
    doc, lines, texts = _lined(docs)
    w_line, whole, second, v_line, key, place = variants(texts)
    first, later, earlier = clique_links(whole ^ mix(second), w_line)
    links = [_link_rows(doc, lines, later, earlier, True)]
    new = np.zeros(len(lines), bool)
    new[w_line[first]] = True
    w_line, whole, second = w_line[first], whole[first], second[first]
    stays = new[v_line]  # an equal line's variants are its first's
    v_line, key, place = v_line[stays], key[stays], place[stays]
    first, later, earlier = clique_links(mix(key + place.astype(U)), v_line)
    links.append(_link_rows(doc, lines, later, earlier, False))
    v_line, key, place = v_line[first], key[first], place[first]
    w_bucket, v_bucket = _buckets(whole, n_buckets), _buckets(key, n_buckets)
    linked = np.concatenate(links)
    # links ride along to any one bucket
    met = np.unique(np.concatenate([w_bucket, v_bucket, np.full(min(1, len(linked)), turn % n_buckets)]))
    for k, w, v in zip(met.tolist(), _cuts(met, w_bucket), _cuts(met, v_bucket), strict=True):
        own = linked if k == turn % n_buckets else linked[:0]
        used, where = np.unique(np.concatenate([w_line[w], v_line[v]]), return_inverse=True)
        used_docs, doc_at = np.unique(lines["doc"][used], return_inverse=True)
        delta = np.diff(doc_at, prepend=0).astype("<u4")
        d = doc[used_docs]
        yield (k, planes(d["null"], d["id"].astype("<i8"), d["key"].astype("<i8")), planes(delta, lines["line"][used].astype("<u4")),
               planes(where[:len(w)].astype("<u4"), whole[w], second[w]),
               planes(np.diff(where[len(w):], prepend=0).astype("<i4"), place[v].astype("<u4")),
               key[v].astype("<u4").tobytes(), own.tobytes())


def _emit(pack: Callable, schema: str, n_buckets: int, together: int):
    """``pack``'s rows of documents (doc_id, key, text), or of lines of
    documents (with a fourth column, their numbers)."""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    types = [pa.int32(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, turn = [], 0, TaskContext.get().partitionId()

        def flush():
            nonlocal waiting, size, turn
            if waiting and len(waiting[0]) > 4:
                of = defaultdict(list)
                for *d, text, number in waiting:
                    of[tuple(d)].append((number, text))
                waiting = [(*d, b"\n".join(t for _, t in x), [n for n, _ in x]) for d, x in ((d, sorted(x)) for d, x in of.items())]
            rows = list(pack(waiting, n_buckets, turn))
            waiting, size, turn = [], 0, turn + 1
            return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)] if rows else []

        for b in batches:
            number = [x.to_pylist() for x in b.columns[3:]]
            for doc_id, key, text, *n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), *number, strict=True):
                if not text:
                    continue
                waiting.append((doc_id is None, doc_id or 0, key, text, *n))
                size += len(text)
                if size >= together:
                    yield from flush()
        if waiting:
            yield from flush()

    return run


def _meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """LINKS of one bucket."""
    doc, lines, wholes, variants_, links = [], [], [], [], []
    n_docs = n_lines = 0
    for row in table.to_pylist():
        links.append(np.frombuffer(row["links"], LINK))
        null, id_, k = unplanes(row["docs"], "u1", "<i8", "<i8")
        delta, number = unplanes(row["lines"], "<u4", "<u4")
        line, whole, second = unplanes(row["wholes"], "<u4", "<u8", "<u8")
        d_line, place = unplanes(row["variants"], "<i4", "<u4")
        hashes = np.frombuffer(row["hashes"], "<u4").astype(U)
        d, l = np.zeros(len(null), DOC), np.zeros(len(number), LINE)
        d["null"], d["id"], d["key"] = null, id_, k
        l["doc"], l["line"] = np.cumsum(delta) + n_docs, number
        doc.append(d), lines.append(l)
        wholes.append((line.astype(np.int64) + n_lines, whole, second))
        variants_.append((np.cumsum(d_line) + n_lines, hashes, place))
        n_docs, n_lines = n_docs + len(d), n_lines + len(l)
    doc, lines = np.concatenate(doc), np.concatenate(lines)
    w_line, whole, second = (np.concatenate(c) for c in zip(*wholes, strict=True))
    v_line, v_key, place = (np.concatenate(c) for c in zip(*variants_, strict=True))
    # number the lines in their order, over all tasks
    d = doc[lines["doc"]]
    by_age = np.lexsort((lines["line"], d["key"], d["id"], 1 - d["null"]))
    age = np.empty(len(lines), np.int64)
    age[by_age] = np.arange(len(lines))
    lines = lines[by_age]
    order = np.argsort(age[w_line], kind="stable")
    w_line, whole, second = age[w_line][order], whole[order], second[order]
    order = np.argsort(age[v_line], kind="stable")
    v_line, v_key, place = age[v_line][order], v_key[order], place[order]

    first, later, earlier = clique_links(whole ^ mix(second), w_line)
    links.append(_link_rows(doc, lines, later, earlier, True))
    w_line, w_key = w_line[first], whole[first] & U(0xFFFFFFFF)
    first, later, earlier = clique_links(mix(v_key + (place.astype(U) << U(42))), v_line)
    links.append(_link_rows(doc, lines, later, earlier, False))
    # a whole line that equals another line's variant; of each variant and place the earliest
    v_line, v_key = v_line[first], v_key[first]
    order = np.argsort(v_key, kind="stable")
    v_line, v_key = v_line[order], v_key[order]
    lo, hi = np.searchsorted(v_key, w_key), np.searchsorted(v_key, w_key, side="right")
    one = np.repeat(w_line, hi - lo)
    other = v_line[np.arange(len(one)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
    links.append(_link_rows(doc, lines, np.maximum(one, other), np.minimum(one, other), False))
    out = np.unique(np.concatenate(links))
    return pa.Table.from_arrays([pa.array(out[n]) for n in LINK.names], names=list(LINK.names))


def near(a: bytes, b: bytes) -> bool:
    """Whether one word inserted, deleted or replaced, or none, turns one line
    into the other, and both are long enough for that."""
    x, y = _words(a), _words(b)
    if x == y:
        return True
    if min(len(x), len(y)) < MIN_WORDS or abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    i = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), len(x))
    return x[i + (len(x) == len(y)):] == y[i + 1:]


def _words(line: bytes) -> list[bytes]:
    return [w for w in line.translate(_SPACES).split(b" ") if w]


_SPACES = bytes(32 if IS_SPACE[i] else i for i in range(256))


def _slots(key: np.ndarray, line: np.ndarray) -> np.ndarray:
    return (mix(key.astype(U) + mix(line.astype(U))) & U(BITMAP - 1)).astype(np.int64)


def _texts(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """doc_id, key, words, line of the lines (key, line) in ``ends``."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_slots(b.column(0).to_numpy(), b.column(1).to_numpy()))], names=["slot"])

    words = ends.mapInArrow(tidy(slots), "slot bigint").groupBy(F.shiftright("slot", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("v"))
    bits = np.zeros(BITMAP // 64, np.int64)
    for r in words.collect():  # BITMAP bits, whatever the number of lines
        bits[r["w"]] = r["v"]
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint64)
        for b in batches:
            ids, keys, numbers, found = [], [], [], []
            for doc_id, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                if not text:
                    continue
                lines = text.split(b"\n")
                slot = _slots(np.full(len(lines), key), np.arange(len(lines)))
                for i in np.flatnonzero((bitmap[slot >> 6] >> (slot & 63).astype(U)) & U(1)).tolist():
                    ids.append(doc_id), keys.append(key), numbers.append(i), found.append(lines[i])
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(found, pa.binary()), pa.array(numbers, pa.int32())],
                                                 names=["doc_id", "key", "words", "line"])

    found = docs.mapInArrow(tidy(texts), "doc_id bigint, key bigint, words binary, line int")
    return found.join(ends, ["key", "line"], "left_semi").dropDuplicates(["key", "line"]).select("doc_id", "key", "words", "line")


def _verified(links: DataFrame, found: DataFrame) -> DataFrame:
    """Those ``links`` whose lines, ``found``, are near by their words."""
    found = found.select("key", "line", "words")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [near(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            yield b.select(["later_key", "later_line"]).filter(pa.array(ok, pa.bool_()))

    return (links.join(found.toDF("later_key", "later_line", "x"), ["later_key", "later_line"])
            .join(found.toDF("earlier_key", "earlier_line", "y"), ["earlier_key", "earlier_line"])
            .select("later_key", "later_line", "x", "y").mapInArrow(tidy(verify), "later_key bigint, later_line int"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """key, line, near for every line of ``docs`` (doc_id, key, text) that
    goes; near is false if an earlier line has the same words."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = docs.mapInArrow(tidy(_emit(_pack_halves, PACKED_HALVES, _n_buckets(size // 64), TEXT_TOGETHER)), PACKED_HALVES)
    marks = written(packed.groupBy("bucket").applyInArrow(_meet_halves, MARKS), "line-marks")
    release(spark)  # the packed keys' shuffle files
    same = marks.where("same").select("key", "line").distinct()
    ends = written(marks.where("NOT same").select("key", "line").distinct().join(same, ["key", "line"], "left_anti"), "line-ends")
    found = written(_texts(docs, ends), "line-texts")
    size = found.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    packed = found.mapInArrow(tidy(_emit(_pack, PACKED, _n_buckets(size // 6), 5 * WORDS_TOGETHER)), PACKED)
    links = written(packed.groupBy("bucket").applyInArrow(_meet, LINKS), "line-links")
    release(spark)
    close = _verified(written(links.where("NOT same").distinct(), "line-close"), found).toDF("key", "line")
    return same.withColumn("near", F.lit(False)).union(close.withColumn("near", F.lit(True))).distinct()


def _n_buckets(keys: int) -> int:
    return 1 << max(0, keys // VARIANTS_PER_BUCKET).bit_length()


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines that go taken out of the text, and n_lines,
    n_same and n_near (lines; those that went because of an equal, or only of
    a near, line).  Input columns of these names are replaced."""
    counts = ["n_lines", "n_same", "n_near"]
    rest = [c for c in docs.columns if c.lower() not in counts]
    key, gone, row = free_name(docs, "key"), free_name(docs, "gone"), free_name(docs, "row")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest if c != text]).alias(row) if len(rest) > 1 else F.lit(0).alias(row),
                        F.col(f"`{text}`").cast("string").alias("text_"), row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias(key))
    narrow = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                         row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    drops = written(dropped_lines(narrow), "line-drops")
    drops = drops.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("line", "near"))).alias(gone))
    joined = keyed.join(drops.withColumnRenamed("key", key), key, "left").select(row, "text_", gone)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_same, n_near = [], [], [], []
            for t, gone_ in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                lines = [] if t is None else t.split("\n")
                n_lines.append(len(lines))
                n_near.append(sum(x["near"] for x in gone_ or ()))
                n_same.append(len(gone_ or ()) - n_near[-1])
                if gone_:
                    without = {x["line"] for x in gone_}
                    t = "\n".join(x for i, x in enumerate(lines) if i not in without)
                texts.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in (n_lines, n_same, n_near))],
                                             names=["row_", "text_", *counts])

    schema = T.StructType([T.StructField("row_", joined.schema[row].dataType), T.StructField("text_", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in counts)])
    out = joined.mapInArrow(tidy(cut), schema)
    return out.select(*[F.col("text_").alias(c) if c == text else F.col("row_").getField(c).alias(c) for c in rest], *counts)


def line_sql(source: str = "documents") -> str:
    """DuckDB SQL of the query over ``source`` with distinct doc_ids."""
    return f"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS no, unnest(ls) AS line
           FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {source} WHERE text IS NOT NULL)),
w AS (SELECT doc_id, no, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM l),
f AS (SELECT doc_id, no, array_to_string(w, ' ') AS s, len(w) AS n FROM w WHERE len(w) > 0),
v AS (SELECT doc_id, no, n, j, array_to_string(list_concat(w[1:j - 1], w[j + 1:]), ' ') AS s
      FROM (SELECT doc_id, no, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS j FROM w WHERE len(w) >= {MIN_WORDS})),
same AS (SELECT doc_id, no FROM f QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, no) > 1),
mine AS (SELECT s, n, min((doc_id, no)) AS k FROM f WHERE n >= {MIN_WORDS} GROUP BY s, n),
fewest AS (SELECT s, n, min((doc_id, no)) AS k FROM v GROUP BY s, n),
near AS (
  SELECT doc_id, no FROM (SELECT doc_id, no, (doc_id, no) AS k, min((doc_id, no)) OVER (PARTITION BY s, j) AS k0 FROM v) WHERE k0 < k
  UNION SELECT v.doc_id, v.no FROM v JOIN mine ON mine.s = v.s AND mine.n = v.n - 1 WHERE mine.k < (v.doc_id, v.no)
  UNION SELECT f.doc_id, f.no FROM f JOIN fewest ON fewest.s = f.s AND fewest.n = f.n + 1 WHERE f.n >= {MIN_WORDS} AND fewest.k < (f.doc_id, f.no)),
g AS (SELECT doc_id, no, false AS near FROM same UNION ALL SELECT * , true FROM (SELECT * FROM near EXCEPT SELECT * FROM same)),
t AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (near = false) AS n_same, count(*) FILTER (near) AS n_near,
        coalesce(string_agg(line, chr(10) ORDER BY l.no) FILTER (near IS NULL), '') AS kept
      FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.no = l.no GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_same, 0)::BIGINT AS n_same, coalesce(n_near, 0)::BIGINT AS n_near,
  md5(kept) AS kept_md5 FROM {source} d LEFT JOIN t ON t.doc_id = d.doc_id"""
