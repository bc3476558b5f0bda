"""Byte-level BPE ids of whole texts, by the ``tokenizers`` library, with
chunks remembered.

The file's pattern lets white space join only the letters, digits or marks
right after it, so a text may be cut before every space that a letter or mark
up to U+024F follows: the ids of the pieces, one after another, are the ids of
the text.  Each distinct piece is encoded once per worker (bounded by
CACHE_CHARS, then started anew).  New pieces are encoded many at a time, as
the texts they form, and their ids told apart by the bytes that each id
stands for.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_CHARS = 8_000_000  # some 150 MB in a worker
TEXT_CHARS = 1_000_000  # of text looked at together
JOINED = 256  # pieces encoded as one text
CUT = re.compile(" (?=[!-~À-ɏ])")
NO_CUT = re.compile(" (?![!-~À-ɏ])")


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.n_bytes = np.zeros(max([*vocab.values(), *special]) + 1, np.int64)
        for t, i in vocab.items():
            self.n_bytes[i] = len(t)  # one character per byte
        for i, t in special.items():
            self.n_bytes[i] = len(t.encode())
        self.cache: dict[str, bytes] = {}
        self.chars = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        groups = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
        for group, ids in zip(groups, self._ids(["".join(" " + p for p in g) for g in groups]), strict=True):
            ends = np.cumsum(self.n_bytes[ids])
            want = np.cumsum([len(p.encode()) + 1 for p in group])
            cut = np.searchsorted(ends, want)
            if not (ends[np.minimum(cut, len(ends) - 1)] == want).all():
                raise ValueError("an id crosses a piece's end: the file's pattern isn't the one that this cut is for")
            data, at = ids.astype("<u4").tobytes(), 0
            for p, c in zip(group, (cut + 1).tolist(), strict=True):
                self.cache[p] = data[4 * at:4 * c]
                at = c
        self.chars += sum(map(len, pieces))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= TEXT_CHARS):
                size += len(texts[end])
                end += 1
            parts = [CUT.split(t) if NO_CUT.search(t) else t.split(" ") for t in texts[at:end]]
            first = self._ids([p.pop(0) for p in parts])  # the only piece without a space before it
            if self.chars > CACHE_CHARS:
                self.cache, self.chars = {}, 0
            new = set().union(*parts).difference(self.cache)
            if new:
                self._learn(sorted(new))
            for f, p in zip(first, parts, strict=True):
                yield f.astype("<u4").tobytes() + b"".join(map(self.cache.__getitem__, p))
            at = end


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)
