"""Spelling variant grouping: k-d trees over letter-count vectors.

Words are counted over all texts.  Two words are near if one inserted, deleted
or replaced letter turns one into the other.  Then their letter-count vectors
differ by one letter more and one less at most (L1 distance two, one for an
insertion), so near words of one length, and of each pair of lengths L and
L + 1, are found by range searches: a k-d tree over the vectors of the words of
a length splits letters at whole counts, and a search goes on into a half only
while the letters it would have to gain and to lose for that half's box are at
most one each (gain one, lose none towards the longer words).  The words of the
buckets reached are compared letter by letter.

The tree's top is the same for all tasks: its splits come from a bounded sample
of the words (SAMPLE_WORDS; they decide how even the cells are, never what is
found) and cut each length into cells of about CELL_WORDS words.  A word goes
to its own cell, and to search to every cell that its box reaches; a cell's
task builds the rest of the tree and reduces what it finds to one row per word
(how many near words, and the most frequent), so no list of pairs leaves it.
More searches of a word reach a cell's neighbours than the cell has words;
CELL_WORDS bounds both but for words that are anagrams of each other, which no
tree over counts can part.

A word's form is its most frequent near word (ties: the least by code points)
if that one is RATIO times as frequent at least; its root is the last word that
forms lead to.  Frequencies grow by RATIO with each step, so chains are short;
they are doubled by joins until none changes.

Defined cases: null and empty texts have no words; a null doc_id is the empty
string in the damage's key; repeated rows count each; very long texts are read
in slices that end where words do, very long words like others; an empty table
gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import tidy, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NO_LETTER = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(65, 91)}
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE = 199
SLICE = 1 << 20  # characters of a text looked at together
WORDS_HELD = 200_000  # distinct words that a task counts before it passes them on
SAMPLE_WORDS, SAMPLE_PER_CELL = 200_000, 8
CELL_WORDS = 25_000
BUCKET = 16
COMPARED = 1 << 22  # letters compared at once
LETTER = np.zeros(256, np.int64)  # place of a letter's count in the vector
LETTER[range(97, 123)] = range(26)
LETTER[range(0xC0, 0x100)] = range(26, 90)
LETTERS = 90
FAR = 1 << 30


# ------------------------------------------------------------------ counting
def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SLICE:
        gap = NO_LETTER.search(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def damaged_words(doc_id, text: str) -> Counter:
    """How often each word of a text occurs after damage: of the words whose
    CRC-32 of ``doc_id:word`` DAMAGE divides, one letter goes."""
    key = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for part in _slices(text):
        for word, n in Counter(RUN.findall(part.translate(_LOWER))).items():
            h = zlib.crc32(word.encode(), key)
            if h % DAMAGE == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= MIN_LETTERS:
                out[word] += n
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1), strict=True):
            if text.is_valid:
                held.update(damaged_words(doc_id.as_py(), text.as_py()))
            if len(held) > WORDS_HELD:
                yield passed_on()
    if held:
        yield passed_on()


def frequent_words(docs: DataFrame) -> DataFrame:
    """word, n of the words of MIN_LETTERS letters or more that occur
    MIN_COUNT times or more in the texts of ``docs`` (doc_id, text)."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tidy(_counts), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --------------------------------------------------------------------- trees
def letters(words: list[bytes], length: int) -> np.ndarray:
    """The words' letters (Latin-1 bytes), one row a word."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letter counts, one row a word."""
    out = np.zeros((len(rows), LETTERS), np.int32)
    step = max(1, COMPARED // max(1, rows.shape[1]))
    for at in range(0, len(rows), step):
        part = rows[at:at + step]
        cell = np.arange(len(part))[:, None] * LETTERS + LETTER[part]
        out[at:at + step] = np.bincount(cell.reshape(-1), minlength=len(part) * LETTERS).reshape(-1, LETTERS)
    return out


def _split(v: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part the vectors most evenly; None if all
    are equal."""
    best, found = 0, None
    low, high = v.min(axis=0), v.max(axis=0)
    for d in np.flatnonzero(low < high).tolist():
        below = np.cumsum(np.bincount(v[:, d] - low[d]))[:-1]
        t = int(np.argmin(np.abs(2 * below - len(v))))
        even = min(below[t], len(v) - below[t])
        if even > best:
            best, found = even, (d, int(low[d]) + t)
    return found


def build(v: np.ndarray, size: int, numbers: np.ndarray | None = None) -> list:
    """A k-d tree: [letter, count, left, right], or [numbers] of up to ``size``
    (or only equal) vectors; left has counts up to ``count``."""
    numbers = np.arange(len(v)) if numbers is None else numbers
    root: list = []
    stack = [(root, numbers)]
    while stack:
        node, mine = stack.pop()
        split = _split(v[mine]) if len(mine) > size else None
        if split is None:
            node.append(mine)
            continue
        left = v[mine, split[0]] <= split[1]
        node.extend([*split, [], []])
        stack += [(node[2], mine[left]), (node[3], mine[~left])]
    return root


def search(tree: list, v: np.ndarray, gain: int, lose: int) -> Iterator[tuple[object, np.ndarray]]:
    """Per leaf, those of the vectors ``v`` that gain ``gain`` and lose
    ``lose`` letters at most on the way into its box."""
    none = np.zeros(len(v), np.int32)
    stack = [(tree, np.arange(len(v)), none, none, {}, {})]
    while stack:
        node, q, gained, lost, low, high = stack.pop()
        if len(node) == 1:
            yield node[0], q
            continue
        d, t, left, right = node
        x = v[q, d]
        less = lost - np.maximum(0, x - high.get(d, FAR)) + np.maximum(0, x - t)
        more = gained - np.maximum(0, low.get(d, 0) - x) + np.maximum(0, t + 1 - x)
        if (on := less <= lose).any():
            stack.append((left, q[on], gained[on], less[on], low, high | {d: t}))
        if (on := more <= gain).any():
            stack.append((right, q[on], more[on], lost[on], low | {d: t + 1}, high))


def near_pairs(points: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers of near words; the queries are as long as the
    points or one letter shorter."""
    if not len(points) or not len(queries):
        return
    same = points.shape[1] == queries.shape[1]
    for mine, q in search(build(vectors(points), BUCKET), vectors(queries), 1, int(same)):
        step = max(1, COMPARED // (len(mine) * points.shape[1]))
        for at in range(0, len(q), step):
            part = q[at:at + step]
            a, b = queries[part][:, None, :], points[mine][None, :, :]
            if same:
                hit = (a != b).sum(axis=2) == 1
            else:  # the letters before and after the one more
                before = np.logical_and.accumulate(a == b[:, :, :-1], axis=2).sum(axis=2)
                after = np.logical_and.accumulate((a == b[:, :, 1:])[:, :, ::-1], axis=2).sum(axis=2)
                hit = before + after >= queries.shape[1]
            i, j = np.nonzero(hit)
            if len(i):
                yield part[i], mine[j]


# --------------------------------------------------------------------- cells
def top_trees(words: DataFrame) -> dict[int, list]:
    """Per length of more than CELL_WORDS words, a tree whose leaves are
    numbered cells."""
    counts = words.groupBy(F.length("word").alias("length")).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    large = {r["length"]: r["count"] for r in counts.where(F.col("count") > CELL_WORDS).collect()}  # at most words / CELL_WORDS
    every = -(-total // SAMPLE_WORDS) or 1
    sample = words.where(F.length("word").isin(list(large)) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0)) if large else words.limit(0)
    by_length: dict[int, list[bytes]] = {}
    for r in sample.select("word").toLocalIterator():  # about SAMPLE_WORDS words
        by_length.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    trees = {}
    for length, some in by_length.items():
        cells = -(-large[length] // CELL_WORDS)
        tree = build(vectors(letters(some, length)), max(SAMPLE_PER_CELL, -(-len(some) // cells)))
        for k, leaf in enumerate(_leaves(tree)):
            leaf[0] = k
        trees[length] = tree
    return trees


def _leaves(tree: list) -> list[list]:
    if len(tree) == 1:
        return [tree]
    return _leaves(tree[2]) + _leaves(tree[3])


POINT, ALIKE, SHORTER = range(3)
VISITS = "length int, cell int, kind int, word binary, n bigint"


def _visits(trees: dict[int, list]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [w.encode("latin-1") for w in b.column(0).to_pylist()]
            n, sizes = b.column(1).to_numpy(), np.array([len(w) for w in words])
            for length in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == length)
                step = max(1, COMPARED // length)
                for at in range(0, len(mine), step):
                    yield visits(length, [words[i] for i in mine[at:at + step].tolist()], n[mine[at:at + step]])

    def visits(length: int, words: list[bytes], n: np.ndarray) -> pa.RecordBatch:
        v = vectors(letters(words, length))
        own, out = np.full(len(words), -1), []
        for cell, q in search(trees.get(length, [0]), v, 0, 0):
            own[q] = cell
            out.append((q, length, cell, POINT))
        for cell, q in search(trees.get(length, [0]), v, 1, 1):
            out.append((q[own[q] != cell], length, cell, ALIKE))  # points search their own cell as they are
        for cell, q in search(trees.get(length + 1, [0]), v, 1, 0):
            out.append((q, length + 1, cell, SHORTER))
        i = np.concatenate([x[0] for x in out])
        columns = [np.repeat(np.array([x[k] for x in out], np.int32), [len(x[0]) for x in out]) for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([words[k] for k in i.tolist()], pa.binary()), pa.array(n[i])],
                                          names=["length", "cell", "kind", "word", "n"])

    return run


NEAR = "word string, n_near bigint, form_n bigint, form string"


def _near(table: pa.Table) -> pa.Table:
    """One cell's words and visitors -> per word how many near words the cell
    tells of, and the first of them by (n descending, word)."""
    words, n, kind = table.column("word").to_pylist(), table.column("n").to_numpy(), table.column("kind").to_numpy()
    by_rank = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[by_rank] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)

    def found(of: np.ndarray, near: np.ndarray) -> None:
        np.add.at(count, of, 1)
        np.minimum.at(best, of, rank[near])

    point, alike, shorter = np.flatnonzero(kind == POINT), np.flatnonzero(kind != SHORTER), np.flatnonzero(kind == SHORTER)
    if len(point):
        length = len(words[point[0]])
        points = letters([words[i] for i in point.tolist()], length)
        for q, p in near_pairs(points, letters([words[i] for i in alike.tolist()], length)):
            found(alike[q], point[p])
        for q, p in near_pairs(points, letters([words[i] for i in shorter.tolist()], length - 1)):
            found(shorter[q], point[p])
            found(point[p], shorter[q])
    has = np.flatnonzero(count)
    first = by_rank[best[has]]
    return pa.table({"word": pa.array([words[i].decode("latin-1") for i in has.tolist()], pa.string()), "n_near": pa.array(count[has]),
                     "form_n": pa.array(n[first], pa.int64()), "form": pa.array([words[i].decode("latin-1") for i in first.tolist()], pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near_n, near (its most frequent near word, ties to the
    least) of the ``words`` (word, n; distinct) that have near words."""
    trees = top_trees(words)
    shared = words.sparkSession.sparkContext.broadcast(trees)  # bounded by the sample
    # a cell's rows are few and its search is long: tasks by the number of cells, not by bytes
    n_tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(len(_leaves(t)) for t in trees.values()))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _visits(shared.value)(batches)

    met = words.select("word", "n").mapInArrow(tidy(visits), VISITS).repartition(n_tasks, "length", "cell").groupBy("length", "cell").applyInArrow(_near, NEAR)
    met = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best"))
    return met.select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.form").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for ``forms`` (word, form): the last word that forms lead to.
    Every round doubles the steps taken."""
    now, left = written(forms.toDF("word", "root"), "roots"), -1
    while left:
        on = now.toDF("root", "next")
        now = written(now.select("word", "root").join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        left = now.where("moved").count()
        now = now.select("word", "root")
    return now


def spelling_forms(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every one of ``words`` (word, n;
    distinct)."""
    near = near_words(words)
    is_form = F.col("near_n") >= RATIO * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    return formed.join(roots(formed.where("form IS NOT NULL").select("word", "form")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_report(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the frequent words of ``docs``."""
    words = written(frequent_words(docs.select("doc_id", "text")), "spelling-words")
    return spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_sql(crc_sql: str, crc32: str) -> str:
    """DuckDB SQL of the query over ``documents``; ``crc_sql`` defines a table
    crc for ``crc32``, the CRC-32 of column ``key``."""
    lower = "translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE {crc_sql},
t AS (SELECT doc_id, {lower} AS w FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)),
u AS (SELECT w, n, coalesce(doc_id::VARCHAR, '') || ':' || w AS key FROM (SELECT doc_id, w, count(*) AS n FROM t GROUP BY ALL)),
h AS (SELECT w, n, {crc32} AS h FROM u, crc),
d AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN w[:(h % length(w))] || w[(h % length(w)) + 2:] ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
x AS (SELECT word, n, k, word[:k - 1] || word[k + 1:] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM v)),
p AS (SELECT a.word AS a, b.word AS b, b.n AS n FROM x a JOIN x b ON a.less = b.less AND a.k = b.k AND a.word <> b.word
      UNION SELECT v.word, x.word, x.n FROM v JOIN x ON x.less = v.word UNION SELECT x.word, v.word, v.n FROM v JOIN x ON x.less = v.word),
b AS (SELECT a AS word, count(*) AS n_near, min((-n, b)) AS best FROM p GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {RATIO} * n THEN best[2] END AS form,
        CASE WHEN -best[1] >= {RATIO} * n THEN -best[1] END AS form_n FROM v LEFT JOIN b ON b.word = v.word),
r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL"""
