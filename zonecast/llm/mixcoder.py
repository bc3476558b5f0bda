"""Adaptive context-mixing range coder for token ids of any width.

A run of ids is cut into blocks that are coded on their own: every block
starts with the run's prior, an untaught context model and a new coder, and has
a checksum.  The blocks of a run advance side by side, one id of each per step,
as numpy rows; whatever hangs on the ids alone is worked out for many steps at
once, and the steps write into buffers that are made once per run.

The prior names the run's distinct ids and how often each occurs; it is stored
once, before the blocks, with a checksum of its own.  Ids are coded by their
place among the distinct ids, so their width doesn't matter.

Model of a block: order 0 is the prior.  For the contexts of order 1 and 2 a
table names two ids expected next, a recent and an earlier one, and how sure
the first is; adaptive probabilities per order, candidate and sureness say how
often such an expectation holds.  Each order is thus a distribution: these
probabilities on its expected ids, the rest spread as the prior is.  The three
are mixed linearly with weights that follow each order's likelihood (Bayesian,
with a fixed share so that an order can recover).

Coder: 64-bit range coder with carries, 32-bit words, cumulative counts out of
2^30.  The model uses float64 sums, products and quotients element by element
only, which IEEE 754 defines exactly, so encoder and decoder agree anywhere.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
SLOTS = 4096  # per block and order
SURE = 8
SHARE = 0.02  # of the weights, dealt evenly at each step
RATE = 1 / 64
CONTEXTS = 2  # orders 1 and 2
WHOLE = 1 << 30
PRIOR_BITS = 24  # the prior's frequencies add up to 2^24 at most
PRIOR_ROOM = 8  # and to 2^8 times as many as there are distinct ids, if that is less
FIND_BITS = 23  # places of the prior's ids are looked up, not searched for, up to here
LITERAL = 1 / 64  # of the mass at least stays with the prior
SPREAD = WHOLE * (1 - LITERAL)  # the weights' sum
RANK_BITS = 24
RANKS = (1 << RANK_BITS) - 1
STEPS = 64  # prepared together
DENSE = 1 << 18  # ids below this are counted in an array
SLICE = 1 << 18
SHIFT, TOP = np.uint64(30), np.uint64(WHOLE - 1)
EMIT = np.uint64(1 << 32)
HALF, LOW = np.uint64(32), np.uint64((1 << 32) - 1)
U = np.uint64


class Prior:
    """The distinct ids of a run and their frequencies out of 2^bits."""

    def __init__(self, values: np.ndarray, counts: np.ndarray):
        n = len(values)
        if n >= 1 << PRIOR_BITS - 1:
            raise ValueError(f"a run holds fewer than 2^{PRIOR_BITS - 1} distinct ids")
        self.values, self.counts = values.astype(np.int64), counts.astype(np.int64)
        self.bits = min(PRIOR_BITS, n.bit_length() + PRIOR_ROOM)
        room = (1 << self.bits) - n
        freq = 1 + self.counts * room // max(1, int(self.counts.sum()))
        if n:
            freq[np.argmax(self.counts)] += (1 << self.bits) - int(freq.sum())
        self.freq = np.append(freq, 0)  # a spare id that nothing is coded as
        self.cum = np.concatenate([[0], np.cumsum(freq)])
        self.chance = self.freq / (1 << self.bits)
        places = np.arange(n + 1, dtype=np.int64)
        mixed = places * 40503
        self.slot = (mixed >> 4 ^ places) & SLOTS - 1
        self.slot_of_last = places * 30029 + (places >> 3) & SLOTS - 1
        self._place = None

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple["Prior", np.ndarray]:
        """The prior of ``ids`` and their places among its values."""
        most = int(ids.max(initial=0))
        if most < DENSE:
            slices = [slice(i, i + SLICE) for i in range(0, len(ids), SLICE)]
            counts = sum((np.bincount(ids[s], minlength=most + 1) for s in slices), np.zeros(most + 1, np.int64))
            values = np.flatnonzero(counts)
            place, places = np.zeros(most + 1, np.uint32), np.empty(len(ids), np.uint32)
            place[values] = np.arange(len(values))
            for s in slices:
                place.take(ids[s], None, places[s], "clip")
            return cls(values, counts[values]), places
        values, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
        return cls(values, counts), places.astype(np.uint32)

    def find(self, u: np.ndarray) -> np.ndarray:
        """Places of the ids in whose intervals ``u`` lies; what lies outside
        all counts under the first or the last."""
        if self.bits > FIND_BITS:
            return np.searchsorted(self.cum, u.clip(0, (1 << self.bits) - 1), side="right") - 1
        if self._place is None:
            self._place = np.repeat(np.arange(len(self.values), dtype=np.uint32), self.freq[:-1])
        return self._place.take(u, mode="clip")

    def packed(self) -> bytes:
        gaps = np.diff(self.values, prepend=0).astype("<u4")
        data = zlib.compress(b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes() for a in (gaps, self.counts.astype("<u4"))), 6)
        return zlib.crc32(data).to_bytes(4, "little") + data

    @classmethod
    def unpacked(cls, data: bytes) -> "Prior":
        if zlib.crc32(data[4:]) != int.from_bytes(data[:4], "little"):
            raise ValueError("a prior's checksum is wrong")
        raw = np.frombuffer(zlib.decompress(data[4:]), np.uint8)
        gaps, counts = (np.ascontiguousarray(x.reshape(4, -1).T).view("<u4").reshape(-1) for x in np.split(raw, 2))
        return cls(np.cumsum(gaps.astype(np.int64)), counts)


class _Model:
    """Arrays of a step are [kind, order, lane], kind 0 the recent expected id
    and 1 the earlier one.  A table's entry holds, from the low bits up, the
    recent id, the earlier one, which always differs, and how sure."""

    def __init__(self, lanes: int, prior: Prior):
        shape = (2, CONTEXTS, lanes)
        ints, floats = lambda *s: np.zeros(s, np.int64), lambda *s: np.zeros(s)
        self.prior, self.lane, self.lanes = prior, np.arange(lanes), lanes
        rows = np.arange(CONTEXTS * lanes).reshape(CONTEXTS, lanes)
        self.base = rows * SLOTS
        self.table = np.full(CONTEXTS * lanes * SLOTS, 1 << RANK_BITS, np.int64)
        first, second = np.linspace(0.1, 0.9, SURE), np.full(SURE, 0.08)
        self.chance = np.concatenate([np.tile(first, CONTEXTS * lanes), np.tile(second, CONTEXTS * lanes)])
        self.chance_base = np.stack([rows, rows + CONTEXTS * lanes]) * SURE
        self.weight = np.full((CONTEXTS + 1, lanes), SPREAD / (CONTEXTS + 1))
        self.at = self.base.copy()
        self.ids, self.chance_at, self.p = ints(*shape), ints(*shape), floats(*shape)
        self.entry, self.sure = ints(CONTEXTS, lanes), ints(CONTEXTS, lanes)
        # a step's intervals: of the expected ids, one after another, and of the rest
        self.starts, self.lengths = ints(5, lanes), ints(5, lanes)
        self.rest, self.unit = ints(lanes), ints(lanes)
        self.hit, self.hits = np.zeros(shape, bool), floats(*shape)
        # an id expected by both orders has the interval of order 1
        self.of_hits = np.array([0 if c & 1 else 2 if c & 4 else 1 if c & 2 else 3 if c & 8 else 4 for c in range(16)]) * lanes
        self.of_ends = np.arange(5) * lanes
        # buffers, and views of parts
        self.flags, self.common = np.zeros(shape, bool), ints(*shape)
        self.f, self.g = floats(*shape), floats(*shape)
        self.s, self.t, self.a, self.b = floats(CONTEXTS, lanes), floats(lanes), ints(CONTEXTS, lanes), ints(CONTEXTS, lanes)
        self.bytes, self.flat_hit, self.flat_ids = np.zeros((4, lanes), np.uint8), self.hit.reshape(4, lanes).view(np.uint8), ints(5, lanes)
        self.ids = self.flat_ids[:4].reshape(shape)
        share = self.share = self.lengths[:4].reshape(shape)
        self.v_ids = self.ids[0], self.ids[1], self.ids[:, :1], self.ids[None, :, 1]
        self.v_share = share[:, 0], share[:, 1], share[None, :, 1]
        self.v_common = self.common[0], self.common[1], self.common[:, 0], self.common[:, 1]
        self.v_starts, self.v_lengths = [*self.starts], [*self.lengths]
        self.v_weight = self.weight[0], self.weight[1], self.weight[2], self.weight[1:]
        self.v_f, self.v_hit, self.v_flag = (self.f[0], self.f[1]), self.hit[0], self.flags[0]
        self.inner = self.starts[1:4]

    def predict(self) -> None:
        """Expected ids and their intervals."""
        recent, earlier, one, two = self.v_ids
        self.table.take(self.at, None, self.entry, "clip")
        np.bitwise_and(self.entry, RANKS, recent)
        np.right_shift(self.entry, RANK_BITS, self.a)
        np.bitwise_and(self.a, RANKS, earlier)
        np.right_shift(self.a, RANK_BITS, self.sure)
        np.add(self.chance_base, self.sure, self.chance_at)
        self.chance.take(self.chance_at, None, self.p, "clip")
        np.multiply(self.v_weight[3], self.p, self.f)
        np.copyto(self.share, self.f, casting="unsafe")
        # what order 2 gives to ids that order 1 expects too goes there
        of_1, of_2, of_2_wide = self.v_share
        np.equal(one, two, self.flags)
        np.multiply(self.flags, of_2_wide, self.common)
        by_recent, by_earlier, to_recent, to_earlier = self.v_common
        of_1 += to_recent
        of_1 += to_earlier
        of_2 -= by_recent
        of_2 -= by_earlier
        starts, lengths = self.v_starts, self.v_lengths
        np.copyto(starts[1], lengths[0])
        np.add(starts[1], lengths[1], starts[2])
        np.add(starts[2], lengths[2], starts[3])
        np.add(starts[3], lengths[3], self.rest)
        np.subtract(WHOLE, self.rest, self.unit)
        np.right_shift(self.unit, self.prior.bits, self.unit)

    def _literal(self, freq: np.ndarray, cum: np.ndarray) -> None:
        start = self.v_starts[4]
        np.multiply(self.unit, freq, self.v_lengths[4])
        np.multiply(self.unit, cum, start)
        np.add(start, self.rest, start)

    def interval(self, x: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of each id's interval; ``freq`` and ``cum`` are
        these ids' in the prior."""
        np.equal(self.ids, x, self.hit)
        self._literal(freq, cum)
        np.multiply(self.flat_hit, BITS, self.bytes)
        which = self.of_hits.take(np.add.reduce(self.bytes, 0, np.uint8))
        which += self.lane
        return self.starts.take(which), self.lengths.take(which)

    def find(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id in whose interval each value lies, the interval's start and
        length."""
        ends = self.bytes.view(bool)
        np.greater_equal(v, self.inner, ends[:3])
        np.greater_equal(v, self.rest, ends[3])
        which = self.of_ends.take(np.add.reduce(self.bytes, 0, np.uint8))
        which += self.lane
        x = self.flat_ids[4]
        x[:] = self.prior.find((v - self.rest) // self.unit)
        self._literal(self.prior.freq.take(x), self.prior.cum.take(x))
        x = self.flat_ids.take(which)
        np.equal(self.ids, x, self.hit)
        return x, self.starts.take(which), self.lengths.take(which)

    def update(self, x: np.ndarray, literal: np.ndarray, at: np.ndarray) -> None:
        """Learns the ids whose intervals were asked for last; ``literal`` is
        their chance by the prior, ``at`` the places of the next contexts."""
        hits, p, f, g, s, t = self.hits, self.p, self.f, self.g, self.s, self.t
        np.copyto(hits, self.hit)
        # an order's likelihood: literal + the sum of p * (hit - literal)
        np.subtract(hits, literal, f)
        np.multiply(f, p, f)
        np.add(*self.v_f, s)
        np.add(s, literal, s)
        w0, w1, w2, w12 = self.v_weight
        np.multiply(w12, s, w12)
        np.multiply(w0, literal, w0)
        np.add(w0, w1, t)
        np.add(t, w2, t)
        np.divide(SPREAD * (1 - SHARE), t, t)
        np.multiply(self.weight, t, self.weight)
        np.add(self.weight, SPREAD * SHARE / (CONTEXTS + 1), self.weight)
        np.multiply(hits, HELD, f)
        np.multiply(p, 1 - RATE, g)
        np.add(f, g, f)
        np.add(f, 0.001 * RATE, f)
        self.chance[self.chance_at] = f
        # a missed id becomes the earlier one or, where the recent one isn't sure, the recent one
        recent, a = self.v_ids[0], self.a
        np.equal(self.sure, 0, self.v_flag)
        first = np.where(self.v_flag, x, recent)
        np.bitwise_xor(recent, x, a)
        np.bitwise_xor(a, first, a)
        np.left_shift(a, RANK_BITS, a)
        np.bitwise_or(a, first, a)
        np.bitwise_or(a, LESS.take(self.sure), a)
        np.add(self.entry, MORE.take(self.sure), self.b)
        np.copyto(a, self.b, where=self.v_hit)
        self.table[self.at] = a
        self.at = at


BITS = np.array([[1], [2], [4], [8]], np.uint8)
HELD = np.array([0.997, 0.95])[:, None, None] * RATE  # an order's probabilities never add up to more than 0.999
LESS = np.arange(SURE) >> 1 << 2 * RANK_BITS
MORE = np.append(np.ones(SURE - 1, np.int64), 0) << 2 * RANK_BITS


def lane_lengths(n: int, block: int = BLOCK) -> np.ndarray:
    """Even lengths of the blocks of a run of ``n`` ids."""
    lanes = -(-n // block)
    return np.array([n // lanes + (i < n % lanes) for i in range(lanes)], np.int64) if lanes else np.zeros(0, np.int64)


def encode_run(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The prior and the coded blocks of a run.  A block begins with the
    CRC-32 of its ids."""
    lengths = lane_lengths(len(ids), block)
    lanes = len(lengths)
    if not lanes:
        return []
    raw = np.asarray(ids, "<u4")
    prior, places = Prior.of(raw)
    steps = int(lengths[0])
    ends = np.cumsum(lengths)
    grid, long = np.zeros((lanes, steps), np.uint32), int((lengths == steps).sum())  # a shorter block ends with one spare id
    grid[:long] = places[:long * steps].reshape(long, steps)
    grid[long:, :steps - 1] = places[long * steps:].reshape(lanes - long, steps - 1)
    del places
    model = _Model(lanes, prior)
    low, span = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    wide = steps * 5 // 16 + STEPS + 2  # ten bits an id, doubled if that is too little
    words = np.zeros((lanes, wide), U)  # carries stay in a word's upper half until the end
    row, n_words = np.arange(lanes) * wide, np.zeros(lanes, np.int64)
    last = np.zeros(lanes, np.int64)
    for t in range(0, steps, STEPS):
        xs = np.ascontiguousarray(grid[:, t:t + STEPS].T).astype(np.int64)
        freqs, cums, literals = prior.freq.take(xs), prior.cum.take(xs), prior.chance.take(xs)
        ats = np.empty((len(xs), CONTEXTS, lanes), np.int64)
        slots = prior.slot.take(xs)
        ats[:, 0] = slots
        ats[:, 1] = slots ^ prior.slot_of_last.take(np.concatenate([last[None], xs[:-1]]))
        ats += model.base
        last = xs[-1]
        if int(n_words.max()) + STEPS + 2 > wide:
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
            wide *= 2
            row = np.arange(lanes) * wide
        flat, place = words.reshape(-1), row + n_words
        for x, freq, cum, literal, at in zip(xs, freqs, cums, literals, ats, strict=True):
            model.predict()
            start, length = model.interval(x, freq, cum)
            np.right_shift(span, SHIFT, span)
            add = start.view(U)
            np.multiply(add, span, add)
            np.add(low, add, low)
            carried = (low < add).nonzero()[0]
            if len(carried):
                flat[place[carried] - 1] += U(1)
            np.multiply(span, length.view(U), span)
            full = (span < EMIT).nonzero()[0]
            out, to = low[full], place[full]
            flat[to] = out >> HALF
            place[full] = to + 1
            low[full] = out << HALF
            span[full] <<= HALF
            model.update(x, literal, at)
        n_words = place - row
    words = np.concatenate([words, np.zeros((lanes, 2), U)], axis=1)
    words[np.arange(lanes), n_words] = low >> HALF
    words[np.arange(lanes), n_words + 1] = low & LOW
    while (over := words >> HALF).any():
        words &= LOW
        words[:, :-1] += over[:, 1:]
    return [prior.packed(), *(zlib.crc32(raw[e - n:e].tobytes()).to_bytes(4, "little") + words[i, :k + 2].astype("<u4").tobytes()
                              for i, (e, n, k) in enumerate(zip(ends.tolist(), lengths.tolist(), n_words.tolist(), strict=True)))]


def decode_run(blocks: list[bytes], n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of a run, checked against the checksums."""
    lengths = lane_lengths(n, block)
    lanes = len(lengths)
    if lanes + bool(lanes) != len(blocks):
        raise ValueError("the run has another number of blocks")
    if not lanes:
        return np.zeros(0, np.uint32)
    prior, blocks = Prior.unpacked(blocks[0]), blocks[1:]
    steps = int(lengths[0])
    wide = max(len(b) for b in blocks) // 4 + 2
    words = np.zeros((lanes, wide), np.uint32)
    for i, b in enumerate(blocks):
        words[i, :len(b) // 4 - 1] = np.frombuffer(b, "<u4", offset=4)
    model = _Model(lanes, prior)
    code, span = words[:, 0].astype(U) << HALF | words[:, 1], np.full(lanes, (1 << 64) - 1, U)
    flat, place = words.reshape(-1), np.arange(lanes) * wide + 2
    grid = np.zeros((steps, lanes), np.uint32)
    at_2 = prior.slot_of_last.take(np.zeros(lanes, np.int64))
    for t in range(steps):
        model.predict()
        np.right_shift(span, SHIFT, span)
        v = code // span
        np.minimum(v, TOP, v)
        x, start, length = model.find(v.view(np.int64))
        add = start.view(U)
        np.multiply(add, span, add)
        np.subtract(code, add, code)
        np.multiply(span, length.view(U), span)
        full = (span < EMIT).nonzero()[0]
        to = place[full]
        code[full] = code[full] << HALF | flat.take(to, mode="clip")  # damaged data may ask for more
        place[full] = to + 1
        span[full] <<= HALF
        grid[t] = x
        at = np.empty((CONTEXTS, lanes), np.int64)
        prior.slot.take(x, None, at[0], "clip")
        np.bitwise_xor(at[0], at_2, at[1])
        at += model.base
        at_2 = prior.slot_of_last.take(x)
        model.update(x, prior.chance.take(x), at)
    values, long = np.append(prior.values, 0).astype("<u4"), int((lengths == steps).sum())
    ids = np.concatenate([values.take(grid[:, :long].T).reshape(-1), values.take(grid[:steps - 1, long:].T).reshape(-1)])
    ends = np.cumsum(lengths)
    for b, e, k in zip(blocks, ends.tolist(), lengths.tolist(), strict=True):
        if zlib.crc32(ids[e - k:e].tobytes()) != int.from_bytes(b[:4], "little"):
            raise ValueError("a block's checksum is wrong")
    return ids
