"""Spelling variant grouping against a plain count and comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from zonecast.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    near = {w: [x for x in words if x != w and is_near(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def typos(r, word, letters):
    i = r.randrange(len(word) + 1)
    return r.choice([word[:i] + r.choice(letters) + word[i:], word[:i] + word[i + 1:], word[:i] + r.choice(letters) + word[i + 1:]])


def corpus(seed, letters, n=400):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(25)]
    base += [base[0][::-1], "x" * 300, "x" * 301, "élèveÿ", "ÉlÈveÿ"]
    words = []
    for b in base:
        few = [b, *(typos(r, b, letters) for _ in range(8))]
        few += [typos(r, few[1], letters), typos(r, few[2], letters)]
        for w in few:
            words += [w] * r.choice([4, 5, 6, 7, 30, 200])
    r.shuffle(words)
    sep = [" ", "\n", ", ", "1", "漢", "_", "Ā"]
    docs = [(i, "".join((w.upper() if r.random() < .1 and w.isascii() else w) + r.choice(sep) for w in words[i::n])) for i in range(n)]
    return docs + [(None, docs[0][1]), (5, None), (6, ""), (7, "  12 _"), docs[3], docs[3]]


@pytest.mark.parametrize("seed,letters,small", [(1, "abcdeéß÷", True), (2, "ab", True), (3, "abcdefghijklmnopqrstuvwxyzÀÿ", False)])
def test_report_equals_brute_force(spark, seed, letters, small, monkeypatch):
    if small:
        monkeypatch.setattr(spelling, "CELL_WORDS", 12), monkeypatch.setattr(spelling, "BUCKET", 2), monkeypatch.setattr(spelling, "SAMPLE_PER_CELL", 2)
        monkeypatch.setattr(spelling, "SAMPLE_WORDS", 60), monkeypatch.setattr(spelling, "COMPARED", 500)
    docs = corpus(seed, letters)
    want = brute(counted(docs))
    assert any(f and f != root for _, f, root, *_ in want) or seed != 1  # chains
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id bigint, text string, word string, n int").repartition(6)
    got = spelling.spelling_report(df).collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_slices_and_flushes_count_alike(monkeypatch):
    text = " ".join(["abcdef", "ghijkl1mnopqr", "ÉÉÉÉÉÉ"] * 50)
    whole = spelling.damaged_words(3, text)
    monkeypatch.setattr(spelling, "SLICE", 7)
    assert spelling.damaged_words(3, text) == whole and whole["abcdef"] in (0, 50)


def test_box_pruned_search_finds_all_near_words():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abcde") for _ in range(7)).encode() for _ in range(3000)})
    shorter = sorted({w[:3] + w[4:] for w in words[::5]} | {w[::-1][:6] for w in words[::7]})
    points = spelling.letters(words, 7)
    for queries in (points, spelling.letters(shorter, 6)):
        found = {(int(i), int(j)) for a, b in spelling.near_pairs(points, queries) for i, j in zip(a, b)}
        names = [q.tobytes().decode() for q in queries]
        some = range(0, len(names), 40)
        assert {(i, j) for i, j in found if i in some} == {(i, j) for i in some for j in range(len(words)) if is_near(names[i], words[j].decode())}
    v = spelling.vectors(points)
    visited = sum(len(q) for _, q in spelling.search(spelling.build(v, 16), v, 1, 1))
    leaves = len(list(spelling.search(spelling.build(v, 16), np.zeros((1, spelling.LETTERS), np.int32), 99, 99)))
    assert visited < len(v) * leaves / 2


def test_no_words(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    assert spelling.spelling_report(df).count() == 0
    assert spelling.spelling_report(df.limit(0)).count() == 0
