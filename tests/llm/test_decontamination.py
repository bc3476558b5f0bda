"""Benchmark decontamination against a plain search of all windows."""

import random
import re

import duckdb
import numpy as np
import pytest

from zonecast.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=dc.WINDOW):
    """Per text: number of words, hit places, items."""
    windows = {}
    for id_, t in items:
        w = tokens(t)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i:i + window]), set()).add("" if id_ is None else str(id_))
    out = []
    for t in docs:
        w, hit, found = tokens(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if ids := windows.get(tuple(w[i:i + m])):
                    hit |= set(range(i, i + m))
                    found |= ids
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def corpus(seed, letters="abc", n_items=40, n_docs=120):
    r = random.Random(seed)
    word = lambda: r.choice([r.choice(letters), r.choice(letters) * 2, "É" + r.choice(letters), r.choice(letters).upper(), "9", "ß漢"])
    line = lambda n: "".join(word() + r.choice([" ", "  ", ", ", "\n", "-", "_"]) for _ in range(n))
    items = [(i, line(r.choice([0, 1, 2, 3, 8, 9, 10, 11, 25, 60]) if i > 3 else 30)) for i in range(n_items)]
    items += [(None, items[0][1]), (None, ""), (3, line(12)), (n_items, items[1][1]), (n_items + 1, None), items[2]]
    docs = [None, "", " .,; ", "a" * 5000, line(3000)]
    for _ in range(n_docs):
        parts = [line(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            t = r.choice(items)[1] or ""
            w = t.split(" ")
            i = r.randint(0, len(w))
            parts += [" ".join(w[i:i + r.choice([5, 12, 40, 99])]), " ", line(r.randint(0, 10))]
        docs.append("".join(parts))
    return docs + docs[:8], items


def automaton(items, window=dc.WINDOW):
    return dc.Automaton([("" if i is None else str(i), dc.item_words((t or "").encode()), True) for i, t in items if tokens(t)], window)


def as_brute(a, docs):
    out = []
    for n, spans, items in dc.contaminated_spans(a, [(t or "").encode() for t in docs]):
        places = [p for s in spans for p in range(s["start"], s["start"] + s["words"])]
        out.append((n, places, items))
    return out


@pytest.mark.parametrize("seed,letters,window", [(1, "abcdefghijklmnop", 10), (2, "abc", 10), (3, "ab", 4), (4, "a", 3), (5, "ab", 1)])
def test_spans_equal_a_plain_search(seed, letters, window, monkeypatch):
    docs, items = corpus(seed, letters)
    want = brute(docs, items, window)
    assert any(w[1] for w in want)
    a = automaton(items, window)
    assert as_brute(a, docs) == want
    monkeypatch.setattr(dc, "STEPS", 3)  # matches over many lanes
    assert as_brute(a, docs) == want
    monkeypatch.setattr(dc, "LONG_TEXT", 50)  # and over many blocks
    assert as_brute(a, docs) == want
    for t, (_, spans, _) in zip(docs, dc.contaminated_spans(a, [(t or "").encode() for t in docs]), strict=True):
        for s in spans:
            assert len(tokens((t or "").encode()[s["at"]:s["until"]].decode())) == s["words"]


def test_lying_hashes_are_found_out(monkeypatch):
    docs, items = corpus(6, "abcdefgh")
    want = brute(docs, items)
    few = dc.Words.hashes
    monkeypatch.setattr(dc.Words, "hashes", lambda self, lower: few(self, lower) & np.uint64(7))
    assert as_brute(automaton(items), docs) == want  # the vocabulary's own collide
    monkeypatch.setattr(dc.Words, "hashes", lambda self, lower: few(self, lower) & np.uint64((1 << 7) - 1))
    some = [(1, items[0][1])]
    assert as_brute(automaton(some), docs) == brute(docs, some)


DOCS = "doc_id bigint, text string, spans string, n_words int, row string"


def test_report_equals_search_and_sql(spark, monkeypatch):
    docs, items = corpus(7, "abcdef")
    rows = [(i, t, "x", 1, "r") for i, t in enumerate(docs)] + [(None, docs[10], "x", 1, "r")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, part int").repartition(3)
    want = brute([r[1] for r in rows], items)
    as_rows = lambda out: sorted(out, key=str)
    expected = as_rows((r[0], n, len(h), len(f), bool(h)) for r, (n, h, f) in zip(rows, want, strict=True))
    cols = ["doc_id", "n_words", "n_hit", "n_items", "contaminated"]
    assert as_rows(tuple(x) for x in dc.contamination_report(df, bench).select(*cols).collect()) == expected
    con = duckdb.connect()
    documents, benchmark = df.where("doc_id IS NOT NULL").toPandas(), bench.toPandas()
    con.register("documents", documents), con.register("benchmark", benchmark.astype({"item_id": "Int64"}))
    sql = sorted(con.sql(f"SELECT {', '.join(cols)}, items_sha256 FROM ({dc.contamination_sql()})").fetchall())
    assert sql == sorted(tuple(x) for x in dc.contamination_report(df.where("doc_id IS NOT NULL"), bench).select(*cols, "items_sha256").collect())
    # many parts of short pieces find the same
    monkeypatch.setattr(dc, "PIECE_WORDS", 7), monkeypatch.setattr(dc, "PART_WORDS", 400)
    assert dc.automata(bench).count() > 2
    assert as_rows(tuple(x) for x in dc.contamination_report(df, bench).select(*cols).collect()) == expected
    found = dc.find_contamination(df, bench)
    assert found.columns == ["doc_id", "text", "row", "n_words", "spans", "items"]


def test_removal(spark):
    item = "One two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before é {item}, after 漢!", 1), (2, item, 2), (3, "clean text", 3), (4, None, 4), (5, "", 5), (6, "short item", 6),
            (7, f"x {item[:-7]} y Short  ITEM z", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, Items int")
    bench = spark.createDataFrame([(1, item), (2, "short, item")], "item_id bigint, text string")
    out = {r.doc_id: r.text for r in dc.decontaminate(df.drop("Items"), bench).collect()}
    assert out == {1: "Before é , after 漢!", 2: "", 3: "clean text", 4: None, 5: "", 6: "", 7: "x  y  z"}
    out = {r.doc_id: r.text for r in dc.decontaminate(df.drop("Items"), bench, max_span=5, max_cover=0.9).collect()}
    assert out == {1: "Before é , after 漢!", 3: "clean text", 4: None, 5: "", 7: "x  y Short  ITEM z"}


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r)[1:4] for r in dc.contamination_report(docs, none).collect()] == [(3, 0, 0)]
    assert dc.contamination_report(docs.limit(0), none).count() == 0
    assert dc.contamination_report(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id bigint, text string")).count() == 0
