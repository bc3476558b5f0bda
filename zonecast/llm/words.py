"""Word hashes of many texts at once, in numpy.

Words are runs of bytes other than the separators (space and TAB..CR unless
told otherwise; bytes of the separators never occur inside a character of
UTF-8).  A word's hash is the sum, modulo 2^64, of one fixed random value per
(place in the word, byte), finished by a mixing function: no two words collide
by their structure, as they would under a polynomial modulo 2^64.  Places from
PLACES on take the values of the place modulo PLACES, mixed with the rest of
the place.  Prefix sums give the hashes of all words in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
PIECE = 1 << 20  # bytes of text hashed together
PLACES = 64
_rng = np.random.default_rng(20240101)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


def _values() -> tuple[np.ndarray, np.ndarray]:
    """A random value per place and byte; the same without case."""
    value = _rng.integers(0, 1 << 64, (PLACES, 256), dtype=U)
    return value.reshape(-1), value[:, LOWER].reshape(-1)


VALUES, MORE_VALUES = _values(), _values()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about PIECE bytes together."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) < PIECE):
            size += len(texts[end]) + 1
            end += 1
        yield at, end
        at = end


class Words:
    """The words of ``texts``: where they start and end among the joined texts'
    bytes, and where each text's words start (one more entry for the end)."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = IS_SPACE):
        # any separator does between two texts; both sets have the newline
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = separators[self.raw]
        before = np.concatenate([[True], space[:-1]])
        self.starts, self.ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        self.text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(self.starts, self.text_ends)])
        place = np.zeros(len(self.raw), np.int32)
        place[self.starts] = self.starts
        place = np.arange(len(place), dtype=np.int32) - np.maximum.accumulate(place)
        self.far = np.flatnonzero((place >= PLACES) & ~space)
        self.beyond = place[self.far] // PLACES
        self.cell = (place & (PLACES - 1)) << 8 | self.raw

    def hashes(self, lower: bool, values: tuple[np.ndarray, np.ndarray] = VALUES) -> np.ndarray:
        value = values[lower][self.cell]
        if len(self.far):
            value[self.far] = mix(value[self.far] + self.beyond.astype(U) * GOLDEN)
        sums = np.zeros(len(value) + 1, U)
        np.cumsum(value, out=sums[1:])
        return mix(sums[self.ends] - sums[self.starts] + (self.ends - self.starts).astype(U))


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words start (one more entry
    for the end)."""
    w = Words(texts)
    return w.hashes(lower), w.first
