"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds ``100 * numerator / denominator`` of counted features, in
whole numbers.  Features and verdict are Spark expressions only; no user
function runs, nothing is shuffled, each row is judged on its own.

Defined cases: a null text counts as empty; a text without words has all
counts 0 and fails the base rule (under 20 words).  Rows repeat as often as
in the input.  Input columns that carry the name of an output column are
replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import SPACE_CLASS, free_name

BASE_MIN_WORDS = 20
BASE_MAX_REPEAT_PCT = 30
WINDOW = 8

# Frequent function words of English, French, German, Spanish.
STOP_WORDS = (
    "the of and to in is that on for with as are be by or was at it an this "
    "le la les de des du et un une en que qui est au pour dans "
    "der die das und ist mit den von zu ein eine nicht sie es "
    "el los las y del se por con una su"
).split()

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_FEATURES = ("n_lines", "n_marks", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines")


@dataclass(frozen=True)
class Rule:
    """Kept rows have low <= 100 * numerator / denominator <= high, looked at
    only where the denominator reaches ``at_least``."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    at_least: int = 1


RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("marks", "n_marks", "n_words", None, 60),
    Rule("stop_words", "n_stop_words", "n_words", 3, None, 50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50, 2),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90, 2),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30, 4),
)


def rule_column(rule: Rule) -> Column:
    num, den = F.col(rule.numerator) * 100, F.col(rule.denominator)
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (num >= den * rule.low)
    if rule.high is not None:
        ok = ok & (num <= den * rule.high)
    return (den < rule.at_least) | ok


def base_failed() -> Column:
    return (F.col("n_words") < BASE_MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_MAX_REPEAT_PCT)


def _repeat_words(win: Column) -> Column:
    """Words covered by windows whose hash occurs at least twice: sort the
    (hash, position) pairs, keep positions beside an equal hash, and add up
    the uncovered stretch that each one opens."""
    pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def beside(pairs):
        return F.transform(pairs, lambda x, i: F.when(
            (F.get(pairs, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])), x["p"]))

    # one-element transforms bind a value once, so that it isn't evaluated per element
    pos = F.transform(F.array(pairs), lambda ps: F.sort_array(F.filter(beside(ps), lambda p: p.isNotNull())))
    covered = F.transform(pos, lambda ps: F.aggregate(
        F.transform(ps, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(ps, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x))
    return F.get(covered, F.lit(0))


def quality_features(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the counted features, ``base_failed``, one boolean
    ``rule_<name>`` per rule and ``kept``.

    Windows are compared by a 64-bit hash over the 64-bit hashes of their
    words; within one text of 20,000 words a false match has a chance of
    about 1e-11."""
    outputs = [*FEATURES, *MORE_FEATURES, "base_failed", *(f"rule_{r.name}" for r in rules), "kept"]
    names = {x.lower() for x in outputs}
    rest = [c for c in docs.columns if c.lower() not in names]
    t, words, lines, hashes, win = (free_name(docs, f"__{x}") for x in ("text", "words", "lines", "hashes", "windows"))
    keep = [F.col(f"`{c}`") for c in rest]
    space = " \t\n\u000b\f\r"
    bare = F.btrim(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(space))
    df = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(t),
                     F.when(bare == "", F.array().cast("array<string>"))
                     .otherwise(F.split(bare, f"[{SPACE_CLASS}]+")).alias(words))
    df = df.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")))
    df = df.withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    # the partition id keeps a caller's filter on a feature above this point;
    # below it, the filter would work out the windows again for each use
    df = df.withColumn(win, F.when(
        (F.size(hashes) > WINDOW) & (F.spark_partition_id() >= 0),
        F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")))
    stop = STOP_WORDS + [w.capitalize() for w in STOP_WORDS]

    def long(c):
        return c.cast("bigint")

    df = df.select(
        *keep,
        long(F.size(words)).alias("n_words"),
        long(F.aggregate(F.col(words), F.lit(0), lambda a, w: a + F.length(w))).alias("word_chars"),
        long(F.regexp_count(F.col(t), F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(F.col(lines)))).alias("n_dup_lines"),
        long(F.when(F.size(F.array_distinct(F.col(win))) == F.size(win), F.lit(0))
             .otherwise(_repeat_words(F.col(win)))).alias("n_repeat_words"),
        long(F.size(lines)).alias("n_lines"),
        long(F.regexp_count(F.col(t), F.lit("[!?]"))).alias("n_marks"),
        long(F.size(F.filter(F.col(words), lambda w: w.isin(stop)))).alias("n_stop_words"),
        long(F.size(F.filter(F.col(lines), lambda x: x.rlike(f"^[{SPACE_CLASS}]*[-*•]")))).alias("n_bullet_lines"),
        long(F.size(F.filter(F.col(lines), lambda x: x.rlike(rf"(\.\.\.|…)[{SPACE_CLASS}]*$")))).alias("n_ellipsis_lines"),
    )
    df = df.select("*", base_failed().alias("base_failed"), *[rule_column(r).alias(f"rule_{r.name}") for r in rules])
    verdict = ~F.col("base_failed")
    for r in rules:
        verdict = verdict & F.col(f"rule_{r.name}")
    return df.withColumn("kept", verdict)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with.  The
    row travels as one struct, so that no column name can clash."""
    row = "__row" if text != "__row" else "__row_"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{text}`").alias("__t"))
    # a filter that reads a nondeterministic column stays above the projections;
    # pushed down it would repeat every feature's expression inside itself
    judged = quality_features(packed, "__t", rules).withColumn("__part", F.spark_partition_id())
    return judged.where(F.col("kept") & (F.col("__part") >= 0)).select(f"{row}.*")


def feature_sql(source: str = "documents") -> str:
    """DuckDB SQL of the features and the verdict for every row of ``source``
    (columns doc_id, text); ``rn`` numbers the rows."""
    stop = ",".join(f"'{w}'" for w in STOP_WORDS + [w.capitalize() for w in STOP_WORDS])
    sp = SPACE_CLASS
    rules = []
    for r in RULES:
        parts = [f"{r.numerator} * 100 >= {r.denominator} * {r.low}" if r.low is not None else None,
                 f"{r.numerator} * 100 <= {r.denominator} * {r.high}" if r.high is not None else None]
        both = " AND ".join(p for p in parts if p)
        rules.append(f"({r.denominator} < {r.at_least} OR ({both}))")
    return f"""
WITH q_src AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM {source}),
q_w AS (SELECT rn, doc_id, t, regexp_extract_all(t, '[^{sp}]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{sp}]')) AS l FROM q_src),
q_win AS (SELECT rn, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
          FROM (SELECT rn, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM q_w WHERE len(w) >= {WINDOW})),
q_dup AS (SELECT rn, i FROM q_win QUALIFY count(*) OVER (PARTITION BY rn, s) > 1),
q_rep AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest(range(i, i + {WINDOW})) AS p FROM q_dup) GROUP BY rn),
q_f AS (SELECT q_w.rn, doc_id, len(w)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(q_rep.n, 0)::BIGINT AS n_repeat_words,
  len(l)::BIGINT AS n_lines,
  len(regexp_extract_all(t, '[!?]'))::BIGINT AS n_marks,
  len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
  len(list_filter(l, lambda x: regexp_matches(x, '^[{sp}]*[-*•]')))::BIGINT AS n_bullet_lines,
  len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[{sp}]*$')))::BIGINT AS n_ellipsis_lines
  FROM q_w LEFT JOIN q_rep ON q_rep.rn = q_w.rn),
q_b AS (SELECT *, (n_words < {BASE_MIN_WORDS} OR n_repeat_words * 100 > n_words * {BASE_MAX_REPEAT_PCT}) AS base_failed FROM q_f)
SELECT *, (NOT base_failed AND {" AND ".join(rules)}) AS kept FROM q_b"""
