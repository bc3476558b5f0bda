"""Sharding by extendible hashing.

A row's 60 hash bits come from md5 of its key.  Start with one bucket; a
bucket whose rows exceed the byte limit splits on its next hash bit, others
stay as they are.  The directory lists all prefixes of the greatest depth
reached and the bucket each points to, so that rows find their shard by one
equi-join on their prefix.

Work: one pass that sums bytes per prefix a few bits finer than the limit
calls for (the sums of coarser prefixes follow from it), and further passes
only over the rows of prefixes that are still too large.  Rows that no bit
separates (one key with many rows) are cut by running bytes instead, which
needs no window over the key: counts per range partition, then offsets.

Defined cases: a row larger than the limit has a shard of its own; a null key
hashes as its own value, a null text has 0 bytes; repeated rows are placed one
by one; an empty table gives no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import prefix_sums
from .util import free_name, written

BITS = 60
LIMIT = 16 << 20
FINER = 5  # bits below log2(total / limit)
STEP = 8


def key_hash(key: Column) -> Column:
    """The first 60 bits of md5, as a bigint."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("\x00null"))), 1, 15), 16, 10).cast("bigint")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def _bits(prefix: Column, depth: Column) -> Column:
    """The prefix written as ``depth`` binary digits; '' for depth 0."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def _cells(rows: DataFrame, depth: int) -> DataFrame:
    """Bytes, rows and hash range of each prefix of ``depth`` bits."""
    return rows.groupBy(_prefix(F.col("h"), depth).alias("cell")).agg(
        F.sum("b").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))


def _local_depth(cells: DataFrame, depth: int, limit: int, least: int) -> DataFrame:
    """``cells`` with ``d``: the smallest depth from ``least`` on at which the
    bucket around the cell fits the limit; null if not even the cell does."""
    up = cells.withColumn("d", F.explode(F.sequence(F.lit(least), F.lit(depth))))
    up = up.withColumn("p", F.expr(f"shiftright(cell, {depth} - d)"))
    sums = up.groupBy("d", "p").agg(F.sum("bytes").alias("s"))
    fit = up.join(sums, ["d", "p"]).where(F.col("s") <= limit).groupBy("cell").agg(F.min("d").alias("d"))
    return cells.join(fit, "cell", "left")


def _directory(rows: DataFrame, limit: int, total: int) -> list[tuple[int, DataFrame]]:
    """(depth, entries) per pass: entries hold cell, shard, its depth, bytes
    and rows; ``cut`` marks cells of one hash that no bit splits; the others
    without a shard are looked up in the next pass."""
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    out, least = [], 0
    while True:
        cells = written(_local_depth(written(_cells(rows, depth), "shard-cells"), depth, limit, least), "shard-depths")
        cells = cells.withColumn("cut", F.col("d").isNull() & (F.col("lo") == F.col("hi")))
        cells = cells.withColumn("shard", _bits(F.expr(f"shiftright(cell, {depth} - d)"), F.col("d")))
        sizes = cells.where("d IS NOT NULL").groupBy("shard").agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        out.append((depth, cells.join(sizes, "shard", "left").select(
            "cell", "shard", F.col("d").alias("shard_depth"), "shard_bytes", "shard_rows", "cut")))
        deeper = cells.where("d IS NULL AND NOT cut")
        if depth == BITS or deeper.isEmpty():
            return out
        rows = rows.join(deeper.select(F.col("cell").alias("__c")), _prefix(F.col("h"), depth) == F.col("__c"), "left_semi")
        least, depth = depth + 1, min(BITS, depth + STEP)


def _cut_by_bytes(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """Shards for rows of hashes that exceed the limit alone.  Rows over half
    the limit get a shard each; the others are cut where the running bytes of
    their hash pass another half of the limit, so no shard exceeds it."""
    half = limit // 2
    rows = rows.withColumn("__big", (F.col("__b") > half).cast("long")) \
        .withColumn("__small", F.when(F.col("__b") > half, 0).otherwise(F.col("__b")))
    runs = prefix_sums(rows, order, ["__big", "__small"], by=["__h"])
    part = F.when(F.col("__big") == 1, F.concat(F.lit("!"), F.col("__big_cum"))) \
        .otherwise(F.concat(F.lit("#"), F.floor((F.col("__small_cum") - F.col("__small")) / half)))
    runs = runs.withColumn("shard", F.concat(_bits(F.col("__h"), F.lit(BITS)), part))
    sizes = runs.groupBy("shard").agg(F.sum("__b").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    return runs.join(sizes, "shard").withColumn("shard_depth", F.lit(BITS))


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with shard, shard_depth, shard_bytes and shard_rows (input
    columns of these names are replaced).  ``shard`` is the bucket's hash
    prefix in binary digits, with a suffix where one hash alone is too large."""
    outputs = ["shard", "shard_depth", "shard_bytes", "shard_rows"]
    row = free_name(docs, "__row")
    rest = [c for c in docs.columns if c.lower() not in outputs]
    size = F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias(row), key_hash(F.col(f"`{key}`")).alias("__h"),
                       size.alias("__b"), F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("__t"))
    rows = base.select(F.col("__h").alias("h"), F.col("__b").alias("b"))
    total = rows.agg(F.sum("b")).first()[0] or 0
    left, parts = base, []
    levels = _directory(rows, limit, total)
    for k, (depth, entries) in enumerate(levels):
        found = left.join(entries, _prefix(F.col("__h"), depth) == F.col("cell"))
        parts.append(found.where("shard IS NOT NULL").select(row, *outputs))
        if not entries.where("cut").isEmpty():
            order = [F.col("__h"), F.col("__t"), F.col("__b")]
            parts.append(_cut_by_bytes(found.where("cut").select(row, "__h", "__t", "__b"), order, limit).select(row, *outputs))
        left = found.where("shard IS NULL AND NOT cut").select(base.columns)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(f"{row}.*", F.col("shard"), F.col("shard_depth").cast("int").alias("shard_depth"),
                      "shard_bytes", "shard_rows")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a shard fits the limit, so one task writes it."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


def shard_sql(limit: int = LIMIT, source: str = "documents") -> str:
    """DuckDB SQL for tables in which no single hash exceeds the limit."""
    return f"""
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 15))::BIGINT AS h FROM {source}),
u AS (SELECT r.*, d::INTEGER AS d, h >> ({BITS} - d)::INTEGER AS p FROM r, range(0, 31) t(d)),
node AS (SELECT d, p, sum(n_bytes)::BIGINT AS s, count(*)::BIGINT AS n FROM u GROUP BY d, p),
fit AS (SELECT u.*, s, n, row_number() OVER (PARTITION BY u.doc_id ORDER BY u.d) AS rk
        FROM u JOIN node ON node.d = u.d AND node.p = u.p WHERE s <= {limit})
SELECT doc_id, n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d, '0') END AS shard, d AS shard_depth,
  s AS shard_bytes, n AS shard_rows FROM fit WHERE rk = 1"""
