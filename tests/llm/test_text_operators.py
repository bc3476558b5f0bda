"""Quality rules, line deduplication, Jaccard join and the pipeline against
brute force, on small tables with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing column names."""

import collections
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from zonecast.llm import components, line_dedup, ngram_join, quality_rules, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocab = ["the", "of", "and", "über", "naïve", "漢字", "a", "b", "c,", "x.", "The", "#", "!"]
    out = [None, "", " \t\n", "\n\n\n", "one", "…\n...\n- a\n* b", "#|$ % & <>", "a b c d e f g h a b c d e f g h i",
           "same line here of nine words to be kept\n" * 3, " ".join(["the of and"] * 4000)]
    for _ in range(n):
        lines = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 14))) for _ in range(r.randint(1, 5))]
        out.append(r.choice(["\n", "\n", "\n\n"]).join(lines))
    return out + out[:12] + [t.replace("the", "a", 1) for t in out[10:40]]


DOCS = "doc_id bigint, text string, n_words string, kept int, row string, key double"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7, "r", 0.5) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_quality_features_equal_sql(spark, docs):
    con = duckdb.connect()
    table = docs.select("doc_id", "text").toPandas()  # noqa: F841 - read by DuckDB
    con.register("documents", table)
    cols = ["doc_id", *quality_rules.FEATURES, *quality_rules.MORE_FEATURES, "base_failed", "kept"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({quality_rules.feature_sql()}) ORDER BY doc_id").fetchall()
    got = [tuple(r) for r in quality_rules.quality_features(docs).select(*cols).orderBy("doc_id").collect()]
    assert got == want


def test_quality_repeats_and_filter(spark, docs):
    one = spark.createDataFrame([(1, "a b c d e f g h " * 3)], "doc_id int, text string")
    assert quality_rules.quality_features(one).first()["n_repeat_words"] == 24
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    verdicts = quality_rules.quality_features(docs.select("doc_id", "text"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in verdicts.where("kept").collect())
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ lines
def near_words(a, b, least=line_dedup.MIN_WORDS):
    if a == b:
        return True
    if min(len(a), len(b)) < least:
        return False
    d = np.arange(len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(d[j + 1] + 1, new[-1] + 1, d[j] + (x != y)))
        d = np.array(new)
    return d[-1] <= 1


def brute_lines(rows):
    """Kept text, equal and near lines per row, in row order."""
    seen, out = [], {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, words.mix(np.array([0], np.uint64))[0])):
        keep, same, close = [], 0, 0
        for line in [] if text is None else text.split("\n"):
            w = WORD.findall(line)
            if w and any(w == s for s in seen):
                same += 1
            elif w and any(near_words(w, s) for s in seen):
                close += 1
            else:
                keep.append(line)
            if w:
                seen.append(w)
        out[doc_id, text] = (None if text is None else "\n".join(keep), same, close)
    return out


def line_corpus(seed, n):
    r = random.Random(seed)
    base = [[r.choice("abcdefghij") for _ in range(r.randint(6, 12))] for _ in range(25)]
    out = []
    for _ in range(n):
        lines = []
        for _ in range(r.randint(1, 4)):
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                i = r.randrange(len(w))
                w[i:i + r.randint(0, 1)] = [r.choice("klm")] * r.randint(0, 1)
            lines.append(r.choice([" ", "  ", "\t"]).join(w))
        out.append("\n".join(lines))
    return out


@pytest.mark.parametrize("seed", [1])
def test_lines_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(line_dedup, "VARIANTS_PER_BUCKET", 400)  # several buckets
    rows = list(enumerate([None, "", "\n \n", "short one", "short one", *line_corpus(seed, 150)]))
    rows.append((None, rows[20][1]))
    df = spark.createDataFrame([(i, t, 1, "k", 2.0) for i, t in rows + rows[30:33]],
                               "doc_id bigint, text string, n_lines int, key string, gone double").repartition(7)
    want = brute_lines(rows)
    out = line_dedup.dedup_lines(df)
    got = out.collect()
    assert len(got) == len(rows) + 3
    order = {t: (a, b, c) for (i, t), (a, b, c) in want.items() if i is None}  # the null id comes first
    assert order
    again = {}
    for r in got:
        again[r.doc_id] = (r.text, r.n_same, r.n_near)
    assert again == {i: v for (i, _), v in want.items()}
    assert [c for c in out.columns if c not in ("n_lines", "n_same", "n_near")] == ["doc_id", "text", "key", "gone"]


def test_lines_packed_in_small_runs_link_alike():
    """Whatever runs a task cuts its documents into, the same lines go."""
    docs = [(False, i, i, t.encode()) for i, t in enumerate(line_corpus(5, 80))]

    def gone(parts):
        import pyarrow as pa

        tables = collections.defaultdict(list)
        names = [x.split(" ")[0] for x in line_dedup.PACKED.split(", ")]
        for k, p in enumerate(parts):
            for row in line_dedup._pack(list(p), 4, k):
                tables[row[0]].append(dict(zip(names, row, strict=True)))
        out = set()
        for rows in tables.values():
            links = line_dedup._meet((None,), pa.Table.from_pylist(rows)).to_pylist()
            out |= {(x["later_key"], x["later_line"]) for x in links}
        return out

    one = gone([docs])
    assert one == gone([docs[i:i + 7] for i in range(0, 80, 7)]) == gone([docs[::2], docs[1::2]])
    assert one


def test_near_lines_share_a_half():
    found = collections.defaultdict(set)
    lines = sorted({w for t in line_corpus(6, 250) for w in t.split("\n")})
    w_line, whole, second, h_line, half = line_dedup.halves([x.encode() for x in lines])
    assert w_line.tolist() == list(range(len(lines))) and (np.diff(h_line) >= 0).all()
    v_line, v_whole, v_second = line_dedup.variants([x.encode() for x in lines])[:3]
    assert (v_line == w_line).all() and (v_whole == whole).all() and (v_second == second).all()
    for i, h in zip(h_line.tolist(), half.tolist(), strict=True):
        found[i].add(h)
    split = [x.split() for x in lines]
    assert all(len(found[i]) == (0 if len(w) < line_dedup.MIN_WORDS else 2 if len(w) == line_dedup.MIN_WORDS else 3) for i, w in enumerate(split))
    close = [(i, j) for i, j in itertools.combinations(range(len(lines)), 2)
             if split[i] != split[j] and abs(len(split[i]) - len(split[j])) < 2 and near_words(split[i], split[j])]
    assert len(close) > 100 and all(found[i] & found[j] for i, j in close)


def marked(parts, n_buckets=4):
    import pyarrow as pa

    tables, size = collections.defaultdict(list), 0
    names = [x.split(" ")[0] for x in line_dedup.PACKED_HALVES.split(", ")]
    for k, p in enumerate(parts):
        for row in line_dedup._pack_halves(list(p), n_buckets, k):
            tables[row[0]].append(dict(zip(names, row, strict=True)))
            size += sum(map(len, row[1:]))
    marks = {(x["key"], x["line"], x["same"]) for rows in tables.values() for x in line_dedup._meet_halves((None,), pa.Table.from_pylist(rows)).to_pylist()}
    same = {m[:2] for m in marks if m[2]}
    return same, {m[:2] for m in marks if not m[2]} - same, size


def test_halves_tell_alike_in_small_runs():
    """Whatever runs a task cuts its documents into, the same lines take part;
    of many lines with one half, two leave a run."""
    docs = [(False, i, i, t.encode()) for i, t in enumerate(line_corpus(5, 80))]
    one = marked([docs])
    assert one[0] and one[1]
    for parts in ([docs[i:i + 7] for i in range(0, 80, 7)], [docs[::2], docs[1::2]], [docs[i:i + 1] for i in range(79, -1, -1)], [docs, docs[5:9]]):
        assert marked(parts)[:2] == one[:2]
    hot = [(False, i, i, b"a b c d e f g h i " + str(i).encode() * 3) for i in range(3000)]
    same, close, _ = marked([hot])
    assert not same and len(close) == 3000
    rows = list(line_dedup._pack_halves(hot, 1, 0))
    assert len(rows) == 1 and len(rows[0][5]) // 4 <= 2 + 2 * 3000  # prefixes 5 and 4 in common, tails apart


def test_lines_without_a_near_one_send_less_than_their_text(spark):
    """Their variants stay away: 4 bytes a word and more before."""
    r = random.Random(3)
    word = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(4000)]
    texts_ = ["\n".join(" ".join(r.choice(word) for _ in range(60)) for _ in range(10)) for _ in range(300)]
    docs = [(False, i, i, t.encode()) for i, t in enumerate(texts_)]
    same, close, size = marked([docs])
    assert not same and not close and size < 0.4 * sum(map(len, texts_))
    before = sum(len(x) for row in line_dedup._pack(docs, 4, 0) for x in row[1:])
    assert before > 0.8 * sum(map(len, texts_))
    planted = [*texts_, texts_[7].replace(" ", " x ", 1)]  # one word more in its first line
    df = spark.createDataFrame(list(enumerate(planted)), "doc_id bigint, text string").repartition(4)
    got = {x.doc_id: (x.n_same, x.n_near, x.text) for x in line_dedup.dedup_lines(df).where("n_same + n_near > 0").collect()}
    assert got == {300: (9, 1, "")}


def test_repeated_rows_keep_the_first_of_repeated_lines(spark):
    twice = "a b c d e f g h\nx\na b c d e f g h"
    close = "b b c d e f g h\ny\nb b c d e f g k"
    rows = [(i, t) for i, t in ((1, twice), (2, close), (None, "z z\nz z")) for _ in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (r.text, r.n_same, r.n_near) for r in line_dedup.dedup_lines(df).collect()}
    want = {i: v for (i, _), v in brute_lines(rows).items()}
    assert got == want and want[1] == ("a b c d e f g h\nx", 1, 0) and want[None] == ("z z", 1, 0)


def test_lines_of_nothing(spark):
    out = line_dedup.dedup_lines(spark.createDataFrame([], "doc_id bigint, text string"))
    assert out.count() == 0
    assert line_dedup.near(b"a b c d e f g h", b"a b c d e f g h i") and not line_dedup.near(b"a b", b"a c")


# ---------------------------------------------------------------- shingles
def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset([tuple(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else [])


def brute_components(rows, n, num, den):
    sets = [shingles(t, n) if d is not None else frozenset() for d, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(shingles(t, n)), low.get(find(i))) for i, (d, t) in enumerate(rows)]


def shingle_corpus(seed):
    r = random.Random(seed)
    out = [None, "", "  ", "A b", "a B", "x", "one two three"]
    for _ in range(4):
        base = [r.choice("abcdefghijklmnop") + str(r.randrange(30)) for _ in range(60)]
        for _ in range(18):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 5])):
                w[r.randrange(60)] = "e" + str(r.randrange(1000))
            out.append(" ".join(w))
    return out + out[5:14] + [" ".join(f"w{i}" for i in range(3000))]


@pytest.mark.parametrize("n,num,den", [(3, 90, 100)])
def test_jaccard_equals_brute_force(spark, n, num, den):
    rows = list(enumerate(shingle_corpus(n)))
    rows += [(None, rows[10][1]), (3, rows[12][1]), rows[20]]
    df = spark.createDataFrame([(d, t, 1.0, "z") for d, t in rows], "doc_id bigint, text string, cls double, component string").repartition(4)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, n, num, den).collect()), key=str)
    assert got == sorted(brute_components(rows, n, num, den), key=str)


def test_keep_one(spark):
    rows = list(enumerate(shingle_corpus(9)))
    df = spark.createDataFrame([(d, t, "z") for d, t in [*rows, rows[30], (None, None), (None, None)]], "doc_id bigint, text string, key string")
    out = ngram_join.keep_one(df)
    want = sorted(d for d, n, c in brute_components(rows, 5, 80, 100) if c == d or not n)
    got = out.collect()
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in got) == 2
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_keep_one_leaves_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (2, long + " x"), (None, long), (None, long), (None, long + " x"), (3, "other words that link with nothing here")]
    out = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(x) for x in rows if x[0] != 2)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 330)]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        up[b] = a
    assert got == {x: find(x) for x in up if find(x) != x or any(find(y) == x and y != x for y in up)}


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    r = random.Random(4)
    vocab = [a + b for a in ("the", "of", "an", "to", "ing") for b in ("", "ra", "mo", "lis", "per", "non")] + ["the", "of", "and", "to", "in"] * 4
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(" ".join(r.choice(vocab) for _ in range(25)) for _ in range(6)), "en", "s", 0))
    rows += [(100 + i, rows[i][1], "en", "s", 0) for i in range(10)]  # copies
    rows += [(200 + i, rows[i][1] + "\n" + " ".join(r.choice(vocab) for _ in range(9)), "en", "s", 0) for i in range(5)]
    rows += [(300, None, "en", "s", 0), (301, "", None, None, None), (302, "### $$$ %%% " * 20, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert 4 <= len(pipeline.STAGES) <= 5
    state = docs
    for name, stage in pipeline.STAGES[:-1]:
        before = state.toPandas()
        state = pipeline.written(stage(spark, state, ""), f"test-{name}")
        assert state.columns == docs.columns
        after = {x.doc_id: x.text for x in state.collect()}
        if name == "quality_rules":
            assert set(after) == set(before.doc_id) - {300, 301, 302}
        elif name == "line_dedup":
            want = brute_lines(list(zip(before.doc_id, before.text, strict=True)))
            assert after == {i: t for (i, _), (t, *_) in want.items() if WORD.search(t)}
        else:
            found = brute_components(list(zip(before.doc_id, before.text, strict=True)), 5, 80, 100)
            assert set(after) == {d for d, _, c in found if c == d}
    packed = pipeline.STAGES[-1][1](spark, state, "").collect()
    assert {x.doc_id for x in packed} == {x.doc_id for x in state.collect()}


# ------------------------------------------------------------ word hashes
def thue_morse(n, zero="a", one="b"):
    return [one if bin(i).count("1") % 2 else zero for i in range(n)]


def test_words_and_lines_of_alike_structure_stay_apart(spark):
    for n in (1 << 10, 1 << 11, 1 << 12):
        word, other = "".join(thue_morse(n)), "".join(thue_morse(n, "b", "a"))
        assert len(set(words.word_hashes([word.encode(), other.encode()], lower=True)[0].tolist())) == 2
    line, turned = " ".join(thue_morse(1024, "foo", "bar")), " ".join(thue_morse(1024, "bar", "foo"))
    docs = spark.createDataFrame(list(enumerate([word, other, line, turned], 1)), "doc_id bigint, text string")
    assert [(r.n_same, r.n_near) for r in line_dedup.dedup_lines(docs).collect()] == [(0, 0)] * 4
    pair = spark.createDataFrame([(1, "one two " + word), (2, "one two " + other)], "doc_id bigint, text string")
    assert {r.component_id for r in ngram_join.jaccard_components(pair).collect()} == {1, 2}
    assert ngram_join.keep_one(pair).count() == 2


def test_words_hash_alike_wherever_they_stand():
    r = random.Random(2)
    texts_ = [" ".join("".join(r.choice("abé漢") for _ in range(r.choice([1, 3, 64, 65, 200]))) for _ in range(r.randint(0, 9))).encode() for _ in range(60)]
    h, at = words.word_hashes(texts_, lower=True)
    seen = {}
    for i, t in enumerate(texts_):
        for w, x in zip(t.split(), h[at[i]:at[i + 1]].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
