"""Benchmark decontamination with a generalised suffix automaton.

Words are runs of digits, letters and characters beyond ASCII, A-Z in lower
case.  A window is WINDOW successive words of a benchmark item; an item of
fewer words, but not none, is one window.  A word of a document that is inside
any occurrence of a window is hit.

The items' words become a generalised suffix automaton.  Documents stream
through it word by word: the state stands for the longest text of items that
ends at the word, its length is tracked, and a word without a transition
follows suffix links.  A length of WINDOW or more hits all words matched; a
whole short item is found at the nearest state of the suffix chain that ends
one.  Items with a window that ends here are kept at the states where the
length passes WINDOW.  A task advances thousands of places of its texts at
once (numpy): it cuts its words into lanes, each lane starts at the root and
goes on past its end while its match began before it, so every occurrence is
found by the lane that it begins in.

Words are told by 64-bit hashes; the words of every hit are then compared, and
texts in which a hash lied are read again with exact words.

Items are cut into pieces of PIECE_WORDS that overlap by a window less one, and
dealt into parts of about PART_WORDS words.  A part's automaton is built in one
task and broadcast: its size is bounded, whatever the benchmark's.  Documents
pass the parts one after another, written in between; they never shuffle.

Defined cases: a null text has no words and stays null; null or empty items
have no windows; a null item_id is the empty string, and rows of one item_id
are one item; repeated documents are treated alike; an empty benchmark hits
nothing; other columns pass through, but for those named as the results, which
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import free_name, tidy, written
from .words import LOWER, U, Words, pieces

WINDOW = 10
PIECE_WORDS, PART_WORDS = 50_000, 1_000_000
LONG_TEXT = 8 << 20  # bytes; longer texts are read in blocks
STEPS = 64  # words of a lane, where there are few
SEPARATES = np.ones(256, bool)
SEPARATES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LOWER_BYTES = bytes(LOWER)
MULTIPLIER = U(0x9E3779B97F4A7C15)
RESULTS = {"n_words": "bigint", "spans": "array<struct<start:bigint,words:bigint,at:bigint,until:bigint>>", "items": "array<string>"}


def item_words(text: bytes) -> list[bytes]:
    return WORD.findall(text.translate(_LOWER_BYTES))


class Automaton:
    """The generalised suffix automaton of some items (item id, words, whether
    they are the whole item), as arrays."""

    def __init__(self, items: list[tuple[str, list[bytes], bool]], window: int):
        self.window = window
        vocabulary: dict[bytes, int] = {}
        self.item_ids = sorted({i for i, _, _ in items})
        number = {x: k for k, x in enumerate(self.item_ids)}
        follow: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def clone(p: int, c: int, q: int) -> int:
            """A state for the shorter texts of ``q``, those that ``p`` and c give."""
            new = len(follow)
            follow.append(dict(follow[q])), link.append(link[q]), length.append(length[p] + 1)
            link[q] = new
            while p >= 0 and follow[p].get(c) == q:
                follow[p][c] = new
                p = link[p]
            return new

        def add(last: int, c: int) -> int:
            if (q := follow[last].get(c)) is not None:  # another item has this beginning
                return q if length[q] == length[last] + 1 else clone(last, c, q)
            new, p = len(follow), last
            follow.append({}), link.append(0), length.append(length[last] + 1)
            while p >= 0 and (q := follow[p].get(c)) is None:
                follow[p][c] = new
                p = link[p]
            if p >= 0:
                link[new] = q if length[q] == length[p] + 1 else clone(p, c, q)
            return new

        ends = []  # of every window and short item: state and item, looked up once all are in
        for id_, words, whole in items:
            coded, last = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], 0
            for c in coded:
                last = add(last, c)
            ends.append((number[id_], coded, whole))
        self.link, self.length = np.array(link, np.int64), np.array(length, np.int64)
        at_window: dict[int, set[int]] = {}
        whole_at: dict[int, set[int]] = {}
        for item, coded, whole in ends:
            if len(coded) < window:
                if whole and coded:
                    state = 0
                    for c in coded:
                        state = follow[state][c]
                    whole_at.setdefault(state, set()).add(item)
                continue
            state = n = 0
            for c in coded:
                state, n = follow[state][c], n + 1
                while length[link[state]] >= window:
                    state = link[state]
                    n = length[state]
                if n >= window:
                    at_window.setdefault(state, set()).add(item)
        # the state in whose range of lengths the window's length lies, and the nearest one that ends a short item
        order = np.argsort(self.length, kind="stable")
        self.of_window = np.full(len(link), -1, np.int64)
        self.short = np.full(len(link), -1, np.int64)
        for s in order[1:].tolist():
            if length[s] >= window:
                self.of_window[s] = s if length[link[s]] < window else self.of_window[link[s]]
            self.short[s] = s if s in whole_at else self.short[link[s]]
        # items found at a state: of its window, or of it and the shorter short items that end there too
        found: dict[int, set[int]] = dict(at_window)
        self.short_items = np.zeros(len(link), bool)
        for s in order[1:].tolist():
            if s in whole_at:
                self.short_items[s] = True
                further = self.short[link[s]]
                found[s] = whole_at[s] | (found[int(further)] if further > 0 else set())
        states = sorted(found)
        self.found_from = np.full(len(link), -1, np.int64)
        self.found_from[states] = np.arange(len(states))
        self.found_cut = np.concatenate([[0], np.cumsum([len(found[s]) for s in states])]).astype(np.int64)
        self.found_items = np.array([i for s in states for i in sorted(found[s])], np.int64)
        self.vocabulary = list(vocabulary)
        n = len(vocabulary) + 1
        self.root = np.zeros(n, np.int64)
        for c, q in follow[0].items():
            self.root[c] = q
        keys = np.array([s * n + c for s, f in enumerate(follow) if s for c in f], np.int64)
        values = np.array([q for s, f in enumerate(follow) if s for q in f.values()], np.int64)
        self._table(keys, values)
        hashes = self.hash_of(self.vocabulary)
        self.by_hash = np.argsort(hashes, kind="stable").astype(np.int64)
        self.hashes = hashes[self.by_hash]
        self.by_hash += 1
        self.exact = len(np.unique(hashes)) < len(hashes)  # hashes can't tell the words

    @staticmethod
    def hash_of(words: list[bytes]) -> np.ndarray:
        return Words(words, SEPARATES).hashes(True)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing, a quarter full at most."""
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = U(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == -1
            take, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[take], self.values[take] = keys[put], values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) % len(self.keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(U) * MULTIPLIER >> self.shift).astype(np.int64)

    def follow(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after ``word``, -1 where there is none."""
        out = np.where(state == 0, self.root[word], -1)
        left = np.flatnonzero(state)
        keys = state[left] * len(self.root) + word[left]
        slot = self._slot(keys)
        while len(left):
            have = self.keys[slot]
            same = have == keys
            out[left[same]] = self.values[slot[same]]
            on = np.flatnonzero(~same & (have != -1))
            left, keys, slot = left[on], keys[on], (slot[on] + 1) % len(self.keys)
        return out

    def matches(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hits among ``words`` (numbers in the vocabulary, 0 for others;
        ``first`` marks the first word of a text): the last word's place, how
        many words, and the state whose items are found."""
        n = len(words)
        steps = max(STEPS, -(-n // 8192))
        start = np.arange(0, n, steps)
        state, matched = np.zeros((2, len(start)), np.int64)
        lane, out, j = np.arange(len(start)), [], 0
        while len(lane):
            place = start[lane] + j
            if j >= steps:  # beyond the lane: as long as its match began before its end
                on = (place < n) & (matched[lane] > j - steps)
                on[on] &= ~first[place[on]]
            else:
                on = place < n
            lane, place = lane[on], place[on]
            c, s, m = words[place], state[lane], matched[lane]
            s[first[place] | (c == 0)] = 0
            m[s == 0] = 0
            going = np.flatnonzero(c)
            to, was = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
            while len(going):
                q = self.follow(s[going], c[going])
                done = q >= 0
                to[going[done]], was[going[done]] = q[done], m[going[done]] + 1
                going = going[~done]
                s[going] = self.link[s[going]]
                m[going] = self.length[s[going]]
            state[lane], matched[lane] = to, was
            long = np.flatnonzero(was >= self.window)
            if len(long):
                out.append((place[long], was[long], self.of_window[to[long]]))
            # a whole short item ends here if it is the match or a suffix of it that a linked state stands for
            short = np.where(self.short_items[to] & (was == self.length[to]), to, self.short[self.link[to]])
            short[to == 0] = -1
            ends = np.flatnonzero(short > 0)
            if len(ends):
                out.append((place[ends], self.length[short[ends]], short[ends]))
            j += 1
        if not out:
            return tuple(np.zeros((3, 0), np.int64))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _numbers(a: Automaton, w: Words, texts: list[bytes], exact: bool) -> np.ndarray:
    """The words' numbers in the vocabulary, 0 for others."""
    if exact:
        of = {x: k + 1 for k, x in enumerate(a.vocabulary)}
        return np.array([of.get(x, 0) for t in texts for x in item_words(t)], np.int64)
    h = w.hashes(True)
    at = np.minimum(np.searchsorted(a.hashes, h), len(a.hashes) - 1)
    return np.where(a.hashes[at] == h, a.by_hash[at], 0)


def contaminated_spans(a: Automaton, texts: list[bytes]) -> Iterator[tuple[int, list[dict], list[str]]]:
    """Per text: number of words; maximal runs of hit words (first word, words,
    first byte, byte after); the items found, sorted."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > LONG_TEXT:
            yield _long_text(a, texts[at])
            at += 1
            continue
        end = next((k for k in range(at, len(texts)) if len(texts[k]) > LONG_TEXT), len(texts))
        yield from _short_texts(a, texts[at:end])
        at = end


def _long_text(a: Automaton, text: bytes) -> tuple[int, list[dict], list[str]]:
    """A long text's result, in blocks that share a window's words less one:
    any window is within one block."""
    n_words, spans, ids, back, shared, end = 0, [], set(), 0, 0, 0
    while end < len(text):
        gap = SEPARATOR.search(text, end + LONG_TEXT)
        end = gap.start() if gap else len(text)
        n, found, items = next(_short_texts(a, [text[back:end]]))
        first = n_words - shared
        k = len(spans)  # runs that reach this block
        while k and spans[k - 1]["start"] + spans[k - 1]["words"] >= first:
            k -= 1
        spans[k:] = _joined(spans[k:], [s | {"start": s["start"] + first, "at": s["at"] + back, "until": s["until"] + back} for s in found])
        ids.update(items)
        n_words = first + n
        starts = [m.start() for m in WORD.finditer(text[back:end].translate(_LOWER_BYTES))][-(a.window - 1):] if a.window > 1 else []
        back, shared = (back + starts[0] if starts else end), len(starts)
    return n_words, spans, sorted(ids)


def _short_texts(a: Automaton, texts: list[bytes]) -> Iterator[tuple[int, list[dict], list[str]]]:
    for i, j in pieces(texts):
        w = Words(texts[i:j], SEPARATES)
        n = len(w.starts)
        first = np.zeros(n + 1, bool)
        first[w.first[:-1]] = True
        hit, found = np.zeros(n, bool), []
        if len(a.vocabulary) and n:
            for exact in (a.exact, True):
                words = _numbers(a, w, texts[i:j], exact)
                place, length, state = a.matches(words, first[:n])
                marks = np.zeros(n + 1, np.int64)
                np.add.at(marks, place - length + 1, 1)
                np.add.at(marks, place + 1, -1)
                hit = np.cumsum(marks[:-1]) > 0
                raw = w.raw.tobytes()
                if exact or all(raw[w.starts[k]:w.ends[k]].translate(_LOWER_BYTES) == a.vocabulary[words[k] - 1] for k in np.flatnonzero(hit).tolist()):
                    break
            text = np.searchsorted(w.first, place, side="right") - 1
            pairs = np.unique(np.stack([text, state]), axis=1)
            row = a.found_from[pairs[1]]
            count = a.found_cut[row + 1] - a.found_cut[row]
            item = a.found_items[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a.found_cut[row], count)]
            found = np.unique(np.stack([np.repeat(pairs[0], count), item]), axis=1) if len(item) else []
        new = hit & (first[:n] | ~np.concatenate([[False], hit[:-1]]))
        run, end = np.flatnonzero(new), np.flatnonzero(hit & np.concatenate([~hit[1:] | first[1:n], [True]])) + 1 if n else np.zeros(0, np.int64)
        cut = np.searchsorted(run, w.first)
        items_cut = np.searchsorted(found[0], np.arange(j - i + 1)) if len(found) else np.zeros(j - i + 1, np.int64)
        begin = np.concatenate([[0], w.text_ends])
        for k in range(j - i):
            spans = [{"start": s - int(w.first[k]), "words": e - s, "at": int(w.starts[s] - begin[k]), "until": int(w.ends[e - 1] - begin[k])}
                     for s, e in zip(run[cut[k]:cut[k + 1]].tolist(), end[cut[k]:cut[k + 1]].tolist(), strict=True)]
            ids = sorted(a.item_ids[x] for x in (found[1][items_cut[k]:items_cut[k + 1]].tolist() if len(found) else ()))
            yield int(w.first[k + 1] - w.first[k]), spans, ids


def _item_pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = item_words(text or b"")
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    part = words[at:at + PIECE_WORDS + window - 1]
                    if part:
                        rows.append((id_, len(part), len(part) == len(words), b" ".join(part)))
            if rows:
                ids, n, whole, words = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(n, pa.int64()), pa.array(whole), pa.array(words, pa.binary())],
                                                 names=["id", "n", "whole", "words"])

    return run


def item_parts(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """id, n, whole, words, part: the items' pieces, dealt into parts."""
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    cut = written(texts.mapInArrow(tidy(_item_pieces(window)), "id string, n bigint, whole boolean, words binary").distinct(), "item-pieces")
    n_parts = -(-(cut.agg(F.sum("n")).first()[0] or 0) // PART_WORDS) or 1
    return cut.withColumn("part", F.pmod(F.xxhash64("id", "words"), F.lit(n_parts)).cast("int"))


def automata(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """part, automaton (pickled): one row per part of the items."""
    import pickle

    def build(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        a = Automaton([(r["id"], r["words"].split(b" "), r["whole"]) for r in rows], window)
        return pa.table({"part": pa.array([rows[0]["part"]], pa.int32()), "automaton": pa.array([pickle.dumps(a)], pa.binary())})

    return written(item_parts(items, window).groupBy("part").applyInArrow(build, "part int, automaton binary"), "automata")


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, spans (maximal runs of hit words: first word,
    words, first byte, byte after) and items (ids, sorted as strings)."""
    import pickle

    built = automata(items, window)
    rest = [c for c in docs.columns if c.lower() not in RESULTS]
    row = free_name(docs, "row")
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest if c != text] or [F.lit(0).alias("none")]).alias(row), F.col(f"`{text}`").cast("string").alias("text_"),
                        F.lit(0).cast("bigint").alias("n_words"), F.array().cast(RESULTS["spans"]).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField("row_", state.schema[row].dataType), T.StructField("text_", T.StringType()),
                           *(T.StructField(c, T._parse_datatype_string(t)) for c, t in RESULTS.items())])
    spans_type = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "words", "at", "until")]))

    def through(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = pickle.loads(shared.value)
            for b in batches:
                texts = b.column(1).fill_null("").cast(pa.binary()).to_pylist()
                n_words, spans, ids = [], [], []
                for (n, s, i), s0, i0 in zip(contaminated_spans(a, texts), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                    n_words.append(n), spans.append(_joined(s0, s)), ids.append(sorted({*i0, *i}) if i0 else i)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(spans, spans_type), pa.array(ids, pa.list_(pa.string()))],
                                                 names=["row_", "text_", *RESULTS])

        return run

    parts = sorted(r["part"] for r in built.select("part").collect())  # one number per part
    for k, part in enumerate(parts or [None]):
        one = Automaton([], window) if part is None else None
        data = pickle.dumps(one) if one else bytes(built.where(F.col("part") == part).first()["automaton"])
        state = state.mapInArrow(tidy(through(docs.sparkSession.sparkContext.broadcast(data))), schema)  # bounded by PART_WORDS
        if k + 1 < len(parts):
            state = written(state, "contamination")
    return state.select(*[F.col("text_").alias(c) if c == text else F.col("row_").getField(c).alias(c) for c in rest], *RESULTS)


def _joined(x: list[dict], y: list[dict]) -> list[dict]:
    """The maximal runs of words that are in a run of ``x`` or of ``y``."""
    if not x or not y:
        return x or y
    out: list[dict] = []
    for s in sorted(x + y, key=lambda s: s["start"]):
        end = s["start"] + s["words"]
        if out and s["start"] <= out[-1]["start"] + out[-1]["words"]:
            last = out[-1]
            if end > last["start"] + last["words"]:
                last |= {"words": end - last["start"], "until": s["until"]}
        else:
            out.append(dict(s))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW,
                  max_span: int = 0, max_cover: float = 1.0) -> DataFrame:
    """``docs`` without the runs of more than ``max_span`` hit words; documents
    of whose words more than the share ``max_cover`` is hit go."""
    found = find_contamination(docs, items, text, window)
    n_hit = F.aggregate(F.col("spans"), F.lit(0).cast("bigint"), lambda s, x: s + x["words"])
    stays = n_hit <= F.col("n_words") * F.lit(max_cover)
    # the bytes between the runs that go; cut as binary, runs end at characters
    going = F.filter("spans", lambda x: x["words"] > max_span)
    raw = F.encode(F.col(f"`{text}`"), "UTF-8")
    zero = F.lit(0).cast("bigint")
    begins = F.concat(F.array(zero), F.transform(going, lambda x: x["until"]))
    ends = F.concat(F.transform(going, lambda x: x["at"]), F.array(F.octet_length(F.col(f"`{text}`")).cast("bigint")))
    kept = F.zip_with(begins, ends, lambda b, e: F.decode(F.substring(raw, (b + 1).cast("int"), (e - b).cast("int")), "UTF-8"))
    clean = F.when(F.size(going) > 0, F.array_join(kept, "")).otherwise(F.col(f"`{text}`"))
    return found.where(stays).withColumn(text, clean).drop(*RESULTS)


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs.select("doc_id", "text"), items)
    n_hit = F.aggregate(F.col("spans"), F.lit(0).cast("bigint"), lambda s, x: s + x["words"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def contamination_sql(window: int = WINDOW) -> str:
    """DuckDB SQL of the query over ``documents`` (distinct ids) and
    ``benchmark``."""
    def words(table: str, id_: str) -> str:
        lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {id_} AS id, regexp_extract_all(coalesce({lower}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"

    return f"""
WITH i AS ({words("benchmark", "coalesce(item_id::VARCHAR, '')")}),
x AS (SELECT DISTINCT id AS item, least(len(w), {window}) AS m, unnest(list_transform(range(1, greatest(len(w) - {window} + 1, 1) + 1),
        lambda k: array_to_string(w[k:k + {window - 1}], ' '))) AS gram FROM i WHERE len(w) > 0),
d AS ({words("documents", "doc_id")}),
g AS (SELECT id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: struct_pack(pos := k, gram := array_to_string(w[k:k + m - 1], ' ')))) AS g
      FROM d, (SELECT DISTINCT m FROM x) WHERE len(w) >= m),
h AS (SELECT id, g.m AS m, g.g.pos AS pos, item FROM g JOIN x ON x.m = g.m AND x.gram = g.g.gram),
n AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT id, unnest(range(pos, pos + m)) AS p FROM (SELECT DISTINCT id, m, pos FROM h)) GROUP BY id),
s AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM h) GROUP BY id)
SELECT d.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n ON n.id = d.id LEFT JOIN s ON s.id = d.id"""
