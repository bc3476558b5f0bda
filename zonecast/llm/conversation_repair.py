"""Conversation structure repair by a persistent audit DP.

A conversation's rows, in order, become a sequence of roles of the form
``(s?(ua)+)?`` (s, u, a: the first character of the role) by the cheapest
edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and
duplicate rows), Insert an empty user or assistant turn 5; a truncated row that
isn't deleted costs 5 more.  The audit is the edits' initials in order; of the
cheapest edits the one with the ASCII-least audit counts.

The DP walks the rows with four states (nothing, s, u, a so far).  Each state's
best audit is a linked node: its parent, what the last row added (inserts, then
D, K or R), the rolling hash of the whole audit and the binary-lifting
ancestors.  All states' audits share their common beginnings.  Audits of equal
cost are compared at the first row where they differ, found by lifting both
while the hashes differ; there the parents must be one node, or the hashes
collided and the nodes are walked one by one.  This works row by row because an
audit determines its states: different states never have equal audits, and
audits of equal cost never begin one another.

The same DP joins blocks: up to BLOCK rows are folded into a table (state
before, state after) -> (cost, audit), for every state before; a node's
addition is then a block's audit.  Rows are sorted by range partitions, so a
conversation with a third of all rows is folded by many tasks, and what one
task joins is four audits, about one byte a row.  The repaired rows come from a
second pass, in which an audit goes before its conversation's rows, and texts
stream by one batch at a time.  Texts move once.

Defined cases: rows go by turn (nulls first), rows of one turn by role, then by
the SHA-256 of the text (equal rows are next to each other).  A row's first
fault counts: blank (no character but space and TAB..CR), duplicate (an earlier
row of the conversation has its role and text), truncated (its last such
character isn't one of ``.!?``).  A null role or text is one space, so a null
role can't be kept.  Null conv_ids are one conversation.  Gaps beyond a long
are its largest value.  A conversation without rows has zeros, an empty audit
and no repaired rows; an empty table gives no rows.  Other columns are ignored
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import tidy, written

BLOCK = 4096  # rows folded into one table of state pairs
PRIME, BASE = (1 << 61) - 1, 0x1F3A5C7E9B2D4861
MAX_LONG = (1 << 63) - 1
SPACES = " \t\n\x0b\x0c\r"
NOTHING, S, U, A, END = range(5)
AFTER_INSERT = {NOTHING: U, S: U, U: A, A: U}
FINISH = {NOTHING: (0, b""), S: (10, b"II"), U: (5, b"I"), A: (0, b"")}  # inserts after the last row
OK, TRUNCATED, DELETED = range(3)
FAULTS = ("blank", "duplicate", "truncated")


def _row_table(initial: str, fault: int) -> dict[tuple[int, int], tuple[int, bytes]]:
    """(state before, state after) -> (cost, audit) of one row."""
    keeps = {"s": {NOTHING: S}, "u": {NOTHING: U, S: U, A: U}, "a": {U: A}}.get(initial, {})
    best: dict[tuple[int, int], tuple[int, bytes]] = {}
    for p in range(4):
        options = [(p, 2, b"D")]
        if fault != DELETED:
            more, at, inserts = 5 * (fault == TRUNCATED), p, b""
            for _ in range(3):  # three inserts come back to where two were
                if at in keeps:
                    options.append((keeps[at], 5 * len(inserts) + more, inserts + b"K"))
                options.append((AFTER_INSERT[at], 5 * len(inserts) + more + 1, inserts + b"R"))
                at, inserts = AFTER_INSERT[at], inserts + b"I"
        for q, cost, audit in options:
            best[p, q] = min(best.get((p, q), (cost, audit)), (cost, audit))
    return best


ROW_TABLES = {(c, f): _row_table(c, f) for c in ("s", "u", "a", "") for f in (OK, TRUNCATED, DELETED)}


class Audits:
    """Audits as linked nodes that share their beginnings."""

    def __init__(self, prime: int = PRIME, base: int = BASE):
        self.prime, self.base = prime, base
        self.parent, self.added, self.hash, self.up = [0], [b""], [0], [()]
        self.hashed: dict[bytes, tuple[int, int]] = {}

    def _hash_of(self, text: bytes) -> tuple[int, int]:
        """The text's hash and the power of the base for its length."""
        if (h := self.hashed.get(text)) is None:
            value, power = 0, 1
            for c in text:
                value, power = (value * self.base + c) % self.prime, power * self.base % self.prime
            h = value, power
            if len(text) < 8:
                self.hashed[text] = h
        return h

    def add(self, parent: int, added: bytes) -> int:
        value, power = self._hash_of(added)
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.parent.append(parent), self.added.append(added), self.up.append(tuple(up))
        self.hash.append((self.hash[parent] * power + value) % self.prime)
        return len(self.parent) - 1

    def less(self, x: int, y: int) -> bool:
        """Whether x's audit is less than y's, both of equally many rows."""
        hash_, up = self.hash, self.up
        if hash_[x] != hash_[y]:
            a, b = x, y
            for k in range(len(up[a]) - 1, -1, -1):
                if k < len(up[a]) and hash_[up[a][k]] != hash_[up[b][k]]:
                    a, b = up[a][k], up[b][k]
            if self.parent[a] == self.parent[b] and self.added[a] != self.added[b]:
                return self.added[a] < self.added[b]
        first = None  # the hashes collided: walk to the node that both share
        while x != y:
            if self.added[x] != self.added[y]:
                first = x, y
            x, y = self.parent[x], self.parent[y]
        return first is not None and self.added[first[0]] < self.added[first[1]]

    def text(self, node: int) -> bytes:
        parts = []
        while node:
            parts.append(self.added[node])
            node = self.parent[node]
        return b"".join(reversed(parts))


class Fold:
    """The DP from one state on, over tables of rows or blocks."""

    def __init__(self, state: int, **hashing):
        self.audits = Audits(**hashing)
        self.best = {state: (0, 0)}  # state: cost, node

    def step(self, table: dict[tuple[int, int], tuple[int, bytes]]) -> None:
        won: dict[int, tuple[int, int, bytes]] = {}
        for (p, q), (cost, added) in table.items():
            if p not in self.best:
                continue
            total, node = self.best[p][0] + cost, self.best[p][1]
            have = won.get(q)
            if have is None or total < have[0] or total == have[0] and (
                    added < have[2] if node == have[1] else self.audits.less(node, have[1])):
                won[q] = total, node, added
        self.best = {q: (cost, self.audits.add(node, added)) for q, (cost, node, added) in won.items()}

    def table(self, state: int) -> dict[tuple[int, int], tuple[int, bytes]]:
        return {(state, q): (cost, self.audits.text(node)) for q, (cost, node) in self.best.items()}

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the whole."""
        self.step({(p, END): end for p, end in FINISH.items()})
        cost, node = self.best[END]
        return cost, self.audits.text(node).decode()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of every row of ``rows`` after
    damage by crc32(``conv_id:turn``) % 20: 0 drops it (no copies), 1 empties
    the text, 2 takes out its ``[.!?]``, 3 makes two copies, 4 sets role user.
    Nulls are one space."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("copies"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text and, if there, copies) with the
    digest of the text, no nulls in role and text."""
    copies = F.col("copies").cast("bigint") if "copies" in rows.columns else F.lit(1).cast("bigint")
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), copies.alias("copies"), text.alias("text"))


def row_facts(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text), the text as its
    digest: copies, blank, truncated, and whether an earlier turn has it."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    facts = _keyed(rows).select(
        "conv_id", "turn", "role", "digest", "copies", (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    facts = facts.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    facts = written(facts, "turn-facts")
    # structs order nulls first, as turns are
    first = facts.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    f, g = facts.alias("f"), first.where("n > 1").alias("g")
    same = F.col("f.conv_id").eqNullSafe(F.col("g.conv_id")) & (F.col("f.role") == F.col("g.role")) & (F.col("f.digest") == F.col("g.digest"))
    seen = F.col("g.first").isNotNull() & ~F.col("g.first.turn").eqNullSafe(F.col("f.turn"))
    return f.join(g, same, "left").select("f.*", seen.alias("seen"))


class Stretch:
    """Counts and tables of successive rows of one conversation."""

    def __init__(self, states: tuple[int, ...]):
        self.folds = {p: Fold(p) for p in states}
        self.n = self.illegal = self.turns = 0
        self.counts = dict.fromkeys(FAULTS, 0)
        self.first = self.last = None  # initials
        self.low = self.high = None

    def row(self, turn, role, copies, blank, truncated, seen) -> None:
        if not copies:
            return
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.illegal += copies - 1
        self.last = initial
        if turn is not None:  # turns ascend
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        kind = initial if initial in ("s", "u", "a") else ""
        for i in range(copies):
            fault = "blank" if blank else "duplicate" if seen or i else "truncated" if truncated else None
            if fault:
                self.counts[fault] += 1
            table = ROW_TABLES[kind, OK if fault is None else TRUNCATED if fault == "truncated" else DELETED]
            for f in self.folds.values():
                f.step(table)
        self.n += copies


BLOCKS = ("conv_id bigint, at struct<turn:bigint, role:string, digest:binary>, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "first string, last string, turns bigint, low bigint, high bigint, before array<int>, after array<int>, cost array<bigint>, audit array<binary>")
_AT = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary())])
_BLOCK_TYPES = [pa.int64(), _AT, *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3,
                pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.binary())]
_BLOCK_NAMES = ["conv_id", "at", "n", *FAULTS, "illegal", "first", "last", "turns", "low", "high", "before", "after", "cost", "audit"]


def _blocks(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by conversation -> its blocks."""
        now, conv, at, begun = None, None, None, False
        out: list[tuple] = []

        def close() -> None:
            if now is not None:
                table = {k: v for p, f in now.folds.items() for k, v in f.table(p).items()}
                out.append((conv, at, now.n, *now.counts.values(), now.illegal, now.first, now.last, now.turns, now.low, now.high,
                            [p for p, _ in table], [q for _, q in table], [c for c, _ in table.values()], [a for _, a in table.values()]))

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BLOCK_TYPES, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=_BLOCK_NAMES)

        for b in batches:
            for id_, turn, role, digest, copies, blank, truncated, seen in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not begun or id_ != conv or now.n >= block:
                    close()
                    # only a partition's first conversation can have begun in another one
                    known = begun and id_ != conv
                    now = Stretch((NOTHING,) if known else (NOTHING, S, U, A))
                    conv, begun, at = id_, True, {"turn": turn, "role": role, "digest": digest}
                now.row(turn, role, copies, blank, truncated, seen)
            if len(out) > 1000:
                yield flushed()
        close()
        if out:
            yield flushed()

    return run


AUDITED = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_AUDITED_NAMES = ["conv_id", "gaps", *FAULTS, "illegal", "cost", "audit"]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation and place -> one audited row each."""
    conv = total = None
    out: list[tuple] = []

    def close() -> None:
        gaps = 0 if total["low"] is None else min(total["high"] - total["low"] + 1 - total["turns"], MAX_LONG)
        out.append((conv, gaps, *(total[f] for f in FAULTS), total["illegal"], *total["fold"].finish()))

    def flushed() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [*[pa.int64()] * 7, pa.string()], strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=_AUDITED_NAMES)

    for b in batches:
        for i in range(b.num_rows):
            r = {n: c[i].as_py() for n, c in zip(_BLOCK_NAMES, b.columns, strict=True)}
            if total is None or r["conv_id"] != conv:
                if total is not None:
                    close()
                conv = r["conv_id"]
                total = dict.fromkeys((*FAULTS, "illegal", "turns"), 0) | {"low": None, "high": None, "last": None, "fold": Fold(NOTHING)}
            if r["n"]:
                for f in (*FAULTS, "illegal", "turns"):
                    total[f] += r[f]
                if total["last"] is not None:
                    total["illegal"] += total["last"] + r["first"] not in ("su", "ua", "au")
                if r["low"] is not None:
                    total["turns"] -= r["low"] == total["high"]
                    total["low"] = r["low"] if total["low"] is None else total["low"]
                    total["high"] = r["high"]
                total["last"] = r["last"]
                total["fold"].step({(p, q): (c, a) for p, q, c, a in zip(r["before"], r["after"], r["cost"], r["audit"], strict=True)})
        if len(out) > 1000:
            yield flushed()
    if total is not None:
        close()
    if out:
        yield flushed()


def audit_conversations(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text; copies, if
    there, says how often a row counts, 0 for rows that are gone): gaps, blank,
    duplicate, truncated, illegal, cost, audit."""
    order = ["conv_id", "turn", "role", "digest"]
    facts = written(row_facts(rows).select(*order, "copies", "blank", "truncated", "seen"), "turn-faults")
    blocks = facts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidy(_blocks(block)), BLOCKS)
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(tidy(_joined), AUDITED)


REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An audit, then its conversation's rows in order -> the repaired rows."""
    conv, audit, at, place, state, out = None, "", 0, 0, NOTHING, []

    def inserts() -> None:
        nonlocal at, place, state
        while audit[at:at + 1] == "I":
            state = AFTER_INSERT[state]
            out.append((conv, place, "I", "user" if state == U else "assistant", ""))
            at, place = at + 1, place + 1

    for b in batches:
        for i in range(b.num_rows):
            id_, kind, role, copies, text, edits = (b.column(n)[i].as_py() for n in ("conv_id", "kind", "role", "copies", "text", "audit"))
            if kind == 0:
                audit, conv, at, place, state = edits, id_, 0, 0, NOTHING
                continue
            for _ in range(copies):
                inserts()
                edit, at = audit[at], at + 1
                if edit != "D":
                    if edit == "R":
                        role = "assistant" if state == U else "user"
                    state = {"s": S, "u": U, "a": A}[role[0]]
                    out.append((conv, place, edit, role, text))
                    place += 1
                if len(audit) - at <= 2 and not audit[at:].strip("I"):
                    inserts()  # after the last row
            if len(out) > 256:
                yield pa.RecordBatch.from_pylist([dict(zip(_REPAIRED_NAMES, r, strict=True)) for r in out], _REPAIRED_SCHEMA)
                out.clear()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(_REPAIRED_NAMES, r, strict=True)) for r in out], _REPAIRED_SCHEMA)
            out.clear()


_REPAIRED_NAMES = ["conv_id", "place", "edit", "role", "text"]
_REPAIRED_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations' turns: conv_id, place (from 0), edit (I, K
    or R), role, text.  A task holds whole conversations, their turns in
    order, and reads them one batch at a time."""
    texts = _keyed(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "copies", "text", F.lit(None).cast("string").alias("audit"))
    audits = audited.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
                            F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("copies"), F.lit(None).cast("string").alias("text"), "audit")
    both = texts.union(audits).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.mapInArrow(tidy(_repaired), REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order -> the SHA-256 of ``role:text``, joined by newlines."""
    conv, sha, out = None, None, []
    for b in batches:
        for id_, place, _, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if place == 0:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = id_, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
    if sha is not None:
        out.append((conv, sha.hexdigest()))
    if out:
        ids, hashes = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def repair_report(rows: DataFrame) -> DataFrame:
    """The audited conversations with the digest of what the repair makes of
    them."""
    audited = written(audit_conversations(rows), "audits")
    digests = repaired_turns(rows, audited).mapInArrow(tidy(_digests), "conv_id bigint, repaired_sha256 string")
    a, d = audited.alias("a"), digests.alias("d")
    return a.join(d, F.col("a.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select(
        "a.*", F.coalesce("d.repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


# DuckDB: the CRC-32 of each byte, as a list (of a recursive WITH)
CRC_SQL = """crc_bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(0, 256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS crc_of FROM crc_bits WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """DuckDB SQL: the unsigned CRC-32 of a string's UTF-8 bytes; ``crc_of``
    of CRC_SQL must be in scope."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, (2 * k + 1)::INTEGER, 2))::BIGINT"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, length({digits}) // 2), lambda k: {byte})), "
            f"lambda x, y: xor(x >> 8, crc_of[xor(x, y) % 256 + 1])), 4294967295::BIGINT)")


def repair_sql(source: str = "conversations") -> str:
    """DuckDB SQL of the query over ``source``."""
    moves = [(initial, fault, p, q, cost, audit.decode()) for (initial, fault), t in ROW_TABLES.items() for (p, q), (cost, audit) in t.items()]
    values = ", ".join(f"('{c}', {f}, {p}, {q}, {cost}, '{a}')" for c, f, p, q, cost, a in moves)
    ends = ", ".join(f"({p}, {cost}, '{a.decode()}')" for p, (cost, a) in FINISH.items())
    return f"""
WITH RECURSIVE {CRC_SQL},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM {source}, crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS no,
        regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS stripped FROM d),
f AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY no) AS prior,
        CASE WHEN stripped = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY no) > 1 THEN 'duplicate'
             WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
c AS (SELECT conv_id, no, role, text, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '' END AS initial,
        CASE fault WHEN 'truncated' THEN {TRUNCATED} WHEN '' THEN {OK} ELSE {DELETED} END AS f FROM f),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (prior IS NOT NULL AND left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
moves(initial, f, p, q, cost, added) AS (VALUES {values}),
ends(p, cost, added) AS (VALUES {ends}),
dp AS (SELECT conv_id, 0::BIGINT AS no, {NOTHING} AS state, (0, '') AS best FROM n
  UNION ALL SELECT d.conv_id, c.no, m.q, min((d.best[1] + m.cost, d.best[2] || m.added))
  FROM dp d JOIN c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.no = d.no + 1
  JOIN moves m ON m.initial = c.initial AND m.f = c.f AND m.p = d.state GROUP BY d.conv_id, c.no, m.q),
e AS (SELECT d.conv_id, min((best[1] + cost, best[2] || added)) AS best FROM dp d JOIN n ON n.conv_id IS NOT DISTINCT FROM d.conv_id AND n.n = d.no
      JOIN ends ON ends.p = d.state GROUP BY d.conv_id),
s AS (SELECT conv_id, i, audit[i] AS edit, length(replace(audit[1:i], 'I', '')) AS no,
        length(replace(audit[1:i], 'D', '')) AS place
      FROM (SELECT conv_id, best[2] AS audit, unnest(range(1, length(best[2])::BIGINT + 1)) AS i FROM e)),
r AS (SELECT s.conv_id, s.place, s.edit, c.role, CASE WHEN edit = 'I' THEN '' ELSE c.text END AS text,
        max(CASE WHEN edit = 'K' AND c.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS head
      FROM s LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.no = s.no WHERE edit <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
        chr(10) ORDER BY place)) AS sha FROM r GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best[1], 0)::BIGINT AS cost,
  coalesce(e.best[2], '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {source}) i LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM i.conv_id"""
