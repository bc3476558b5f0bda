"""Conversation repair against an enumeration of all edits, a DP over whole
audits, and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from zonecast.llm import conversation_repair as cr

SHAPE = re.compile(r"(s?(ua)+)?$")


def enumerated(rows):
    """(cost, audit, roles) by trying every edit of every row and up to two
    inserts in every gap."""
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u"), ("u", "u"), ("a", "a")]
    best = None
    for edits in itertools.product("DKua", repeat=len(rows)):
        if any(f == cr.DELETED and e != "D" for (_, f), e in zip(rows, edits)):
            continue
        for where in itertools.product(gaps, repeat=len(rows) + 1):
            roles, audit, cost = "", "", 0
            for i, (g, e) in enumerate(zip(where, (*edits, ""))):
                roles, audit, cost = roles + "".join(g), audit + "I" * len(g), cost + 5 * len(g)
                if e and e != "D":
                    roles += rows[i][0] or "?" if e == "K" else e
                    cost += 5 * (rows[i][1] == cr.TRUNCATED) + (e != "K")
                cost += 2 * (e == "D")
                audit += {"u": "R", "a": "R"}.get(e, e)
            if SHAPE.match(roles) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, roles
    return best


def plain(rows):
    """(cost, audit) with whole audits compared as strings."""
    now = {cr.NOTHING: (0, "")}
    for r in rows:
        new = {}
        for (p, q), (cost, added) in cr.ROW_TABLES[r].items():
            if p in now:
                x = now[p][0] + cost, now[p][1] + added.decode()
                new[q] = min(new.get(q, x), x)
        now = new
    return min((now[p][0] + c, now[p][1] + a.decode()) for p, (c, a) in cr.FINISH.items() if p in now)


def random_rows(r, n):
    return [(r.choice(["s", "u", "u", "a", "a", ""]), r.choice([cr.OK, cr.OK, cr.TRUNCATED, cr.DELETED])) for _ in range(n)]


def folded(rows, **hashing):
    f = cr.Fold(cr.NOTHING, **hashing)
    for x in rows:
        f.step(cr.ROW_TABLES[x])
    return f.finish()


def test_every_edit_of_short_conversations():
    r = random.Random(11)
    for n, times in ((0, 1), (1, 18), (2, 25)):
        for _ in range(times):
            rows = random_rows(r, n)
            assert enumerated(rows)[:2] == folded(rows), rows
    for first, second in itertools.product("sua", repeat=2):
        rows = [(first, cr.OK), (second, cr.TRUNCATED)]
        assert enumerated(rows)[:2] == folded(rows), rows


@pytest.mark.parametrize("hashing", [{}, {"prime": 3, "base": 2}, {"prime": 1, "base": 0}])
def test_long_conversations_and_colliding_hashes(hashing):
    r = random.Random(12)
    for n in (3, 7, 30, 300):
        for _ in range(40):
            rows = random_rows(r, n)
            assert folded(rows, **hashing) == plain(rows)
    for same in ("u", "a", "s", ""):  # ties at every row
        rows = [(same, cr.OK)] * 500
        assert folded(rows, **hashing) == plain(rows)


def test_blocks_join_to_the_same():
    r = random.Random(13)
    for n, block in ((9, 2), (40, 7), (300, 32)):
        rows = random_rows(r, n)
        whole = cr.Fold(cr.NOTHING)
        for at in range(0, n, block):
            table = {}
            for p in (cr.NOTHING, cr.S, cr.U, cr.A):
                f = cr.Fold(p)
                for x in rows[at:at + block]:
                    f.step(cr.ROW_TABLES[x])
                table |= f.table(p)
            whole.step(table)
        assert whole.finish() == plain(rows)


def expected(rows):
    """The contract, one conversation after another."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
        after.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
        count, seen, coded = dict.fromkeys(cr.FAULTS, 0), set(), []
        for _, role, text in after:
            bare = text.strip(cr.SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            code = cr.OK if not fault else cr.TRUNCATED if fault == "truncated" else cr.DELETED
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else "", code))
        turns = [t for t, *_ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [x[1][:1] for x in after]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = plain(coded) if coded else (0, "")
        made, i, state = [], 0, "a"
        for e in audit:
            if e == "D":
                i += 1
                continue
            if e == "I":
                role, text = "user" if state != "u" else "assistant", ""
            else:
                role, text, i = after[i][1], after[i][2], i + 1
                if e == "R":
                    role = "user" if state != "u" else "assistant"
            state = role[0]
            made.append(f"{role}:{text}")
        assert SHAPE.match("".join(m[0] for m in made))
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversations(seed):
    r = random.Random(seed)
    texts = ["Hello there.", "Hello there.", "ok!", "cut off", "", " \t\n", "why?", "a. b", None, "é漢.", "end.  \n", "x" * 50_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]
    rows = []
    for conv in [None, *range(60)]:
        n = 300 if conv == 7 else r.randint(1, 9)
        for t in range(n):
            turn = r.choice([t, t, t, t + 1, t * 3, None])
            rows.append((conv, turn, r.choice(roles[:5]) if r.random() < .8 else r.choice(roles), r.choice(texts[:-1]) if n > 9 else r.choice(texts)))
    return rows + [rows[3], rows[3], rows[10]] + [(1000 + i, 0, "user", "Only.") for i in range(60)]  # some lose all rows


@pytest.mark.parametrize("block", [3, cr.BLOCK])
def test_against_a_plain_reading(spark, block):
    rows = conversations(5)
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "conv_id bigint, turn bigint, role string, text string, audit string, cost int").repartition(7)
    want = expected(rows)
    damaged = cr.damaged(df)
    if block == cr.BLOCK:
        got = cr.repair_report(damaged).collect()
        assert {x["conv_id"]: tuple(x)[1:] for x in got} == want and len(got) == len(want)
        assert any(w[6] == "" and w[4] == 0 for w in want.values())
    else:
        got = cr.audit_conversations(damaged, block).collect()
        assert {x["conv_id"]: tuple(x)[1:] for x in got} == {k: v[:-1] for k, v in want.items()}


def test_empty_table_and_far_turns(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert cr.repair_report(cr.damaged(spark.createDataFrame([], schema))).collect() == []
    far = spark.createDataFrame([(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "Hi.")], schema)
    got = cr.audit_conversations(far).collect()
    assert [tuple(x) for x in got] == [(1, cr.MAX_LONG, 0, 0, 0, 0, 0, "KK")]


def test_undamaged_rows_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Well."), (2, 0, "user", "Only")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    audited = cr.audit_conversations(df)
    assert {x["conv_id"]: (x["cost"], x["audit"]) for x in audited.collect()} == {1: (1, "KRK"), 2: (2, "D")}
    turns = cr.repaired_turns(df, audited).orderBy("conv_id", "place").collect()
    assert [tuple(x) for x in turns] == [(1, 0, "K", "system", "Be kind."), (1, 1, "R", "user", "Hi."), (1, 2, "K", "assistant", "Well.")]
