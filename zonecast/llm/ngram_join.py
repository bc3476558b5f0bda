"""N-gram Jaccard join: rare-first prefix filtering.

A document's set holds the 64-bit hashes of its distinct word n-grams.  Two
documents link when ``den * intersection >= num * union``.

1. Counts.  Every task counts its n-grams in BUCKETS hash buckets; the sums,
   on a logarithmic scale, are one byte a bucket: a table of fixed size that
   orders n-grams from rare to frequent (ties by hash).  Any fixed order gives
   right results; this one keeps prefixes rare.
2. Prefixes.  Documents with equal sets form a class; a class keeps the first
   ``size - ceil(t * size) + 1`` n-grams in that order.  Two classes that link
   share an n-gram there.
3. First wave.  Each shared n-gram links its classes to one of them, the one
   that has it earliest, where the length, positional and suffix filters
   allow; these pairs are verified and joined to components.  That is linear
   in the prefixes, however large a group of near copies is.
4. Second wave.  Pairs that share a prefix n-gram but lie in different
   components, filtered alike, are verified too.  What isn't verified lies in
   one component already, so components are those of all links.

The suffix filter compares PARITY bits: bit k is the parity of the n-grams that
hash to k.  Bits that differ between two sets are at most their symmetric
difference, whose size a link bounds.
Pairs are verified once, on whole sets, by the classes' smallest documents.
Sets are hashed anew in the tasks that read the texts; a bitmap of fixed size
tells them which documents take part, and the join drops its false hits.

Defined cases: A-Z are lower-cased; a text with fewer words than n is one
n-gram, a null text or one without words is an empty set and links with
nothing; rows with a null doc_id link with nothing and have a null component;
rows that repeat an id are documents of their own; other columns aren't
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .util import free_name, release, row_key, rows_of, tidy, written
from .words import U, mix, pieces, word_hashes

BUCKETS = 1 << 20
CHUNK = 1 << 14  # buckets a row of counts holds
PARITY = 2048  # bits of the suffix filter; FOLDED to 256 they travel with the n-grams
FOLDED = ["p0", "p1", "p2", "p3"]
BITMAP = 1 << 23
SETS = ("key bigint, doc_id bigint, cls bigint, size int, p0 bigint, p1 bigint, p2 bigint, p3 bigint, "
        "parity array<bigint>, prefix array<bigint>")


def need(num: int, den: int, sizes):
    """Least intersection of two sets of ``sizes`` n-grams in sum that link:
    i * den >= num * (sizes - i)."""
    return -(-num * sizes // (num + den))


def ngram_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    factors = mix(np.arange(1, n + 1).astype(U)) | U(1)
    for a, b in pieces(texts):
        h, at = word_hashes(texts[a:b], lower=True)
        m = max(0, len(h) - n + 1)
        grams = sum((h[k:k + m] * factors[k] for k in range(n)), np.zeros(m, U))
        grams = mix(grams)
        for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if j - i >= n:
                yield np.unique(grams[i:j - n + 1])
            elif j > i:  # fewer words: the sequence as one, told apart by its length
                yield mix((h[i:j] * factors[:j - i]).sum(dtype=U, keepdims=True) + U(j - i))
            else:
                yield np.zeros(0, U)


def _texts(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.binary()).to_pylist()


def gram_order(docs: DataFrame, n: int) -> np.ndarray:
    """One byte per hash bucket: how frequent its n-grams are, over all of
    ``docs``, in eighths of octaves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            waiting, size = [], 0
            for s in ngram_sets(_texts(b.column(0)), n):
                waiting.append((s & U(BUCKETS - 1)).astype(np.int64))
                size += len(s)
                if size >= BUCKETS:
                    total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
                    waiting, size = [], 0
            if waiting:
                total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
        rows = [(k, total[k * CHUNK:(k + 1) * CHUNK].astype("<u4").tobytes()) for k in range(BUCKETS // CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([c for _, c in rows])],
                                         names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(c, "<u4").astype(np.int64)
        if sums:
            scaled = [np.minimum(255, 8 * np.log2(1 + v)).astype(np.uint8).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(scaled)], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    rows = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(tidy(count), schema).repartition("chunk").mapInArrow(tidy(add), schema)
    out = np.zeros(BUCKETS, np.uint8)
    for r in rows.collect():  # BUCKETS bytes in all
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return out


def _class_of(s: np.ndarray) -> int:
    """64-bit key of a set: sum of its hashes mixed anew, mixed with its size."""
    return int(mix(mix(s + U(0x5851F42D4C957F2D)).sum(dtype=U, keepdims=True) + U(len(s))).astype(np.int64)[0])


def prefixes(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """SETS: per document its class, set size, parity bits and prefix."""
    order = docs.sparkSession.sparkContext.broadcast(gram_order(docs, n).tobytes())  # BUCKETS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(order.value, np.uint8)
        for b in batches:
            cls, size, folded, parity, prefix = [], [], [], [], []
            for s in ngram_sets(_texts(b.column(1)), n):
                k = len(s) - -(-num * len(s) // den) + 1 if len(s) else 0
                keys = rank[(s & U(BUCKETS - 1)).astype(np.int64)]
                first = np.argsort(keys, kind="stable")[:k]  # s is sorted, so ties go by hash
                cls.append(_class_of(s))
                size.append(len(s))
                odd = (np.bincount((s >> U(53)).astype(np.int64), minlength=PARITY) & 1).astype(np.uint8)
                parity.append(np.packbits(odd, bitorder="little").view("<i8"))
                folded.append(np.bitwise_xor.reduce(parity[-1].reshape(-1, len(FOLDED)), axis=0))
                prefix.append(s[first].astype(np.int64))
            if cls:
                yield pa.RecordBatch.from_arrays(
                    [b.column(2), b.column(0), pa.array(cls, pa.int64()), pa.array(size, pa.int32()),
                     *(pa.array(c) for c in np.ascontiguousarray(np.array(folded).T)),
                     pa.array(parity, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                    names=["key", "doc_id", "cls", "size", *FOLDED, "parity", "prefix"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       row_key(docs["doc_id"], docs["text"])).mapInArrow(tidy(run), SETS)


def _may_link(num: int, den: int, a: str, b: str) -> Column:
    """Length and positional filter for an n-gram at positions ``a``_pos and
    ``b``_pos of two prefixes."""
    x, y, p, q = (F.col(c) for c in (f"{a}_size", f"{b}_size", f"{a}_pos", f"{b}_pos"))
    most = F.least(p, q) + 1 + F.least(x - p - 1, y - q - 1)
    length = (F.least(x, y) * den >= F.greatest(x, y) * num)
    return length & (most * (num + den) >= (x + y) * num)


def _may_link_still(num: int, den: int, differ: Column) -> Column:
    """The suffix filter, given how many parity bits of a and b differ."""
    total = F.col("a_size") + F.col("b_size")
    return (total - differ) * (num + den) >= total * num * 2


def _folded_differ() -> Column:
    return sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in FOLDED), F.lit(0))


def _suffix_filter(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose parity bits leave room for a link."""
    a, b = classes.select("cls", "size", "parity").toDF("a", "a_size", "a_bits"), classes.select("cls", "size", "parity").toDF("b", "b_size", "b_bits")
    differ = F.aggregate(F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").where(_may_link_still(num, den, differ)).select("a", "b")


def _taking_part(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    ids = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    return classes.select("cls", "low").join(ids, "cls")


def _bitmap(members: DataFrame) -> np.ndarray:
    """Bits at the hashes of the documents: BITMAP bits, whatever their number."""
    h = F.pmod(F.xxhash64("low"), F.lit(BITMAP))
    words = members.groupBy(F.shiftright(h, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(low), {BITMAP}) & 63 as int))")).alias("v"))
    out = np.zeros(BITMAP // 64, np.int64)
    for r in words.collect():
        out[r["w"]] = r["v"]
    return out


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    members = written(_taking_part(pairs, classes), "jaccard-members")
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(members).tobytes())  # BITMAP / 8 bytes

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(bits.value, np.uint64)
        for b in batches:
            slot = b.column(2).to_numpy()
            hit = (bitmap[slot >> 6] >> (slot & 63).astype(U)) & U(1) == 1
            b = b.filter(pa.array(hit))
            if not b.num_rows:
                continue
            found = list(ngram_sets(_texts(b.column(1)), n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_class_of(s) for s in found], pa.int64()),
                 pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())], names=["low", "cls", "grams"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("low"), docs["text"].cast("string").alias("text"),
                        F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(BITMAP)).alias("slot")).where("low IS NOT NULL")
    found = texts.mapInArrow(tidy(sets), "low bigint, cls bigint, grams binary").join(members, ["cls", "low"], "left_semi").dropDuplicates(["cls"])
    found = written(found.select("cls", "grams"), "jaccard-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in rows_of(whole, 500)):
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both * den >= num * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok))

    left, right = found.toDF("a", "x"), found.toDF("b", "y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(verify), "a bigint, b bigint")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def link_components(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(members, components): key, doc_id, cls and size per document; cls,
    label (of its component) and component (smallest doc_id) per class."""
    docs = docs.select("doc_id", "text")
    sets = written(prefixes(docs, n, num, den), "jaccard-sets")
    classes = written(sets.where("size > 0 AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("low"), F.first("size").alias("size"), F.first("parity").alias("parity"),
        *[F.first(c).alias(c) for c in FOLDED],
        F.first("prefix").alias("prefix")), "jaccard-classes")

    # prefix n-grams that several classes share, with the class that has each one earliest
    grams = classes.select("cls", "size", F.posexplode("prefix").alias("pos", "gram"))
    pivots = (grams.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("pos", "cls", "size")).alias("p"))
              .where("k > 1").select("gram", F.col("p.cls").alias("q"), F.col("p.pos").alias("q_pos"), F.col("p.size").alias("q_size")))
    shared = written(grams.join(pivots, "gram"), "jaccard-grams")
    release(docs.sparkSession)

    # first wave: every class with its n-grams' pivots
    star = shared.withColumnsRenamed({"pos": "c_pos", "size": "c_size"}).where("cls <> q").where(_may_link(num, den, "c", "q"))
    star = written(_suffix_filter(star.select(*_pair("cls", "q")).distinct(), classes, num, den), "jaccard-star")
    links = written(_verified(docs, star, classes, n, num, den), "jaccard-links")
    first = written(components(links.toDF("u", "v")), "jaccard-components")
    release(docs.sparkSession)  # the first wave's shuffle files

    # second wave: pairs across components
    known = classes.select("cls", *FOLDED).join(first.toDF("cls", "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    labelled = shared.select("gram", "cls", "pos", "size").join(known, "cls")
    still = labelled.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("gram")
    some = labelled.join(still, "gram")
    a, b = (some.select(F.col("gram").alias(f"{s}_gram"), F.col("cls").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("pos", "size", "comp", *FOLDED)])
            for s in ("a", "b"))
    cross = a.join(b, (F.col("a_gram") == F.col("b_gram")) & (F.col("a") < F.col("b")) & (F.col("a_comp") != F.col("b_comp"))
                   & _may_link(num, den, "a", "b") & _may_link_still(num, den, _folded_differ()))
    cross = cross.select("a", "b").distinct().join(star, ["a", "b"], "left_anti")  # those are verified
    cross = written(_suffix_filter(cross, classes, num, den), "jaccard-cross")
    more = written(_verified(docs, cross, classes, n, num, den), "jaccard-more")
    joined = components(first.toDF("u", "v").union(more.toDF("u", "v")))

    labels = classes.select("cls", "low").join(joined.toDF("cls", "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    lows = labels.groupBy("label").agg(F.min("low").alias("component"))
    return sets.select("key", "doc_id", "cls", "size"), labels.join(lows, "label").select("cls", "label", "component")


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    members, found = link_components(docs, n, num, den)
    return members.join(found, "cls", "left").select(
        "doc_id", F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without those that link, over any number of links,
    to a document with a smaller (doc_id, row key); of repeated rows one
    stays.  Documents that link with nothing by definition all stay."""
    key, alone, nth = (free_name(docs, x) for x in ("key", "alone", "nth"))
    members, found = link_components(docs, n, num, den)
    # rows with a null doc_id link with nothing, whatever their text
    members = members.join(found, "cls", "left").withColumn("label", F.when(F.col("doc_id").isNotNull(), F.col("label")))
    least = (members.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("least"))
             .select(F.col("least.key").alias(key), F.lit(False).alias(alone)))
    keep = members.where("label IS NULL").select(F.col("key").alias(key), F.lit(True).alias(alone)).distinct().union(least)
    rows = docs.withColumn(key, row_key(docs["doc_id"], docs["text"])).join(keep, key)
    rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    return rows.where(F.col(alone) | (F.col(nth) == 1)).select(*docs.columns)
