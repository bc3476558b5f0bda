"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator with production parameters to the whole
intended table; the digest columns are derived from the operator's output.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from . import bpe, chat_format, conversation_repair, decontamination, line_dedup, ngram_join, packing, quality_rules, sharding, spelling, token_files, topk_search, warc
from .util import scratch_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUALITY_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   "base_failed", "kept", "n_lines", "n_marks", "n_stop_words"]


@query
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_features(docs).select(*QUALITY_COLUMNS)


ORACLE["op1_quality_rules"] = f"SELECT {', '.join(QUALITY_COLUMNS)} FROM ({quality_rules.feature_sql()})"


@query
def op7_chat_formatting(spark, sf_dir):
    rows = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_turns(rows))


@query
def op8_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.assign_shards(docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")))
    return out.select("doc_id", "n_bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")


ORACLE["op8_sharding"] = sharding.shard_sql()


@query
def op3_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLE["op3_exact_topk"] = topk_search.topk_sql()


@query
def op2_warc(spark, sf_dir):
    folder = scratch_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_warc(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32_sql(hex_digest: str) -> str:
    """DuckDB SQL: base32 of a SHA-1 in hex, five bits at a time."""
    return (f"list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
            f"(('0x' || substr({hex_digest}, (k // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - k % 4 * 5) & 31)::INTEGER + 1, 1)), "
            f"'string_agg', '')")


ORACLE["op2_warc"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {_base32_sql("sha1(coalesce(html, ''))")} AS payload_digest
           FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS rep FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = rep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = rep THEN NULL ELSE rep END AS refers_to FROM r"""


@query
def op6_bpe(spark, sf_dir):
    path = vocabulary("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, path, decoded="decoded")  # one pass; bpe.decode does the second half alone
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


@query
def op9_token_files(spark, sf_dir):
    folder = scratch_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_token_files(docs, folder, vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, folder)


@query
def op5_ngram_jaccard(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query
def op4_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_same", "n_near", F.md5("text").alias("kept_md5"))


ORACLE["op4_line_dedup"] = line_dedup.line_sql()


@query
def op11_conversation_repair(spark, sf_dir):
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(rows)


ORACLE["op11_conversation_repair"] = conversation_repair.repair_sql()


@query
def op13_decontamination(spark, sf_dir):
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_decontamination"] = decontamination.contamination_sql()


@query
def op12_spelling(spark, sf_dir):
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


ORACLE["op12_spelling"] = spelling.spelling_sql(conversation_repair.CRC_SQL, conversation_repair.crc32_sql("key"))
