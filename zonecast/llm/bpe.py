"""BPE encoding by a segment tree over adjacent pair ranks, and decoding.

The leaves of a word's tree hold, for each live symbol, the merge rank of the
pair it forms with its right neighbour, joined with its position; inner nodes
hold the least of their children.  So the root is the leftmost pair of lowest
rank.  A merge changes three leaves, each updated in logarithmic time; it ends
when the root holds no rank.  The trees of many words (padded to one power of
two) are rows of one numpy matrix and take their next merge together.

Whitespace-separated chunks are encoded once and remembered within a worker
(bounded by CACHE_CHARS, then started anew); whole texts are assembled from
chunks.  The vocabulary file (``tokenizers`` JSON with a BPE model, an end of
word suffix and byte-level symbols) is read in the tasks from ``path``.

Normalising and word splitting follow the file's own components: texts with
characters beyond U+024F go through the library's normaliser, and chunks with
such characters through its splitter; others take equal Python steps.

Defined cases: a null text encodes like an empty one, to no ids; the strings
of special tokens become their ids; repeated rows are encoded alike; an empty
table stays empty.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .util import tidy

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_CHARS = 3_000_000
TEXT_CHARS = 2_000_000  # of text looked at together
TREE_CELLS = 1 << 19  # leaves of the trees merged together
NONE = np.iinfo(np.int64).max
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
FAR = re.compile("[^\x00-ɏ]")
INFORMATION_SEPARATORS = re.compile("[\x1c-\x1f]")  # split() takes these for white space; the file doesn't


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


class Merger:
    """Merges of byte words, by a vocabulary and its ranked pairs."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str):
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        code = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        self.made = np.array([c for _, _, c in pairs], np.int64)  # by rank
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it doesn't merge."""
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.code, want), len(self.code) - 1)
        return np.where(self.code[at] == want, self.rank[at], NONE)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        widths = 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        for width in np.unique(widths).tolist():
            group = np.flatnonzero((widths == width) & (lengths > 0))
            step = max(1, TREE_CELLS // width)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                for k, ids in zip(part.tolist(), self._merge([words[k] for k in part], lengths[part], width), strict=True):
                    out[k] = ids
        return out

    def _merge(self, words: list[bytes], lengths: np.ndarray, width: int) -> list[np.ndarray]:
        n, none = len(words), width  # column ``none`` stands for no neighbour
        raw = np.zeros((n, width), np.uint8)
        raw[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        symbol = np.full((n, width + 1), (1 << 31) - 1, np.int64)
        inside = np.arange(width) < lengths[:, None]
        symbol[:, :width][inside] = self.inner[raw[inside]]
        rows = np.arange(n)
        symbol[rows, lengths - 1] = self.last[raw[rows, lengths - 1]]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        after[rows, lengths - 1] = none
        before = np.tile(np.arange(-1, width), (n, 1))
        before[:, 0] = none
        live = inside.copy()

        def key(row, at):
            """Rank and position in one number, as a leaf holds it."""
            rank = self.ranks(symbol[row, at], symbol[row, after[row, at]])
            return np.where(rank == NONE, NONE, rank * width + at)

        tree = np.full((n, 2 * width), NONE, np.int64)
        row, at = np.nonzero(inside)
        tree[row, width + at] = key(row, at)
        half = width
        while half > 1:
            tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
            half //= 2

        def update(row, at, value):
            node = width + at
            tree[row, node] = value
            while node[0] > 1:  # all leaves are equally deep
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        active = rows
        while width > 1:
            root = tree[active, 1]
            active, root = active[root != NONE], root[root != NONE]
            if not len(active):
                break
            at = root % width
            gone = after[active, at]
            symbol[active, at] = self.made[root // width]
            beyond = after[active, gone]
            after[active, at] = beyond
            before[active, beyond] = at  # where nothing follows, this writes the spare column
            live[active, gone] = False
            update(active, gone, np.full(len(active), NONE))
            update(active, at, key(active, at))
            left = before[active, at]
            left = np.where(left == none, at, left)
            update(active, left, key(active, left))
        ends = np.cumsum(live.sum(axis=1))[:-1]
        return np.split(symbol[:, :width][live], ends)


class WordBpe:
    """Encoder of whole texts for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        self.merger = Merger(model["vocab"], (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]),
                             model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_text = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.symbol_byte = {s: b for b, s in enumerate(byte_symbols())}
        self.tokens = [""] * (max([*model["vocab"].values(), *self.special.values()]) + 1)
        for t, i in [*model["vocab"].items(), *self.special.items()]:
            self.tokens[i] = t
        self._start_cache()

    def _start_cache(self) -> None:
        # special tokens are keyed by a tuple, which no chunk of text equals
        self.cache = {(t,): np.array([i], np.int32).tobytes() for t, i in self.special.items()}
        self.chars = 0

    def _normalised(self, text: str) -> list:
        """Whitespace-separated chunks of a text in normal form."""
        if "<|" in text and (parts := self.special_text.split(text))[1:]:
            return [c for k, p in enumerate(parts) for c in ([(p,)] if k % 2 else self._normalised(p))]
        text = self.library.normalizer.normalize_str(text) if FAR.search(text) else text.lower()
        if INFORMATION_SEPARATORS.search(text):
            return [c for c in regex.split(r"\p{White_Space}+", text) if c]
        return text.split()

    def _words(self, chunk: str) -> list[bytes]:
        if FAR.search(chunk):
            return [bytes(self.symbol_byte[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        return [w.encode() for w in WORDS.findall(chunk)]

    def _learn(self, chunks: list[str]) -> None:
        words = [self._words(c) for c in chunks]
        distinct = list(dict.fromkeys(w for ws in words for w in ws))
        ids = dict(zip(distinct, (x.astype(np.int32).tobytes() for x in self.merger.encode(distinct)), strict=True))
        for c, ws in zip(chunks, words, strict=True):
            self.cache[c] = b"".join(map(ids.__getitem__, ws))
        self.chars += sum(map(len, chunks))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= TEXT_CHARS):
                size += len(texts[end])
                end += 1
            parts = [self._normalised(t) for t in texts[at:end]]
            if self.chars > CACHE_CHARS:
                self._start_cache()
            new = set().union(*parts).difference(self.cache)
            if new:
                self._learn(sorted(new))
            for p in parts:
                yield b"".join(map(self.cache.__getitem__, p))
            at = end

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the text column replaced by its ids (array of int), last;
    and, if ``decoded`` names a column, by the text that these ids decode to.
    Input columns of these names are replaced."""
    new = [ids] + ([decoded] if decoded else [])
    rest = [c for c in docs.columns if c != text and c.lower() not in {n.lower() for n in new}]
    spare = [f"c{i}_" for i in range(len(rest))]  # any names may clash in the input
    packed = docs.select(docs[text].cast("string").alias("t_"), *[docs[c].alias(s) for c, s in zip(rest, spare, strict=True)])
    names = [*spare, "ids_"] + (["decoded_"] if decoded else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for b in by_chars(whole):
                data = list(bpe.encode([t or "" for t in b.column(0).to_pylist()]))
                ends = np.cumsum([0, *(len(x) // 4 for x in data)])
                values = np.frombuffer(b"".join(data), "<i4")
                columns = [*b.columns[1:], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))]
                if decoded:
                    columns.append(pa.array([bpe.decode(values[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([*(packed.schema[s] for s in spare), T.StructField("ids_", T.ArrayType(T.IntegerType())),
                           *([T.StructField("decoded_", T.StringType())] if decoded else [])])
    return packed.mapInArrow(tidy(run), schema).toDF(*rest, *new)


def by_chars(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose first column holds about TEXT_CHARS bytes, so
    that what is made of them stays small too."""
    size = np.cumsum([0 if n is None else n for n in pc.binary_length(b.column(0)).to_pylist()])
    at = 0
    while at < b.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + TEXT_CHARS, side="right")))
        yield b.slice(at, end - at)
        at = end


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for, last."""
    rest = [c for c in encoded.columns if c != text]
    spare = [f"c{i}_" for i in range(len(rest))]
    where = rest.index(ids)
    packed = encoded.select(*[encoded[c].alias(s) for c, s in zip(rest, spare, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in b.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*spare, "text_"])

    schema = T.StructType([*packed.schema.fields, T.StructField("text_", T.StringType())])
    return packed.mapInArrow(tidy(run), schema).toDF(*rest, text)
