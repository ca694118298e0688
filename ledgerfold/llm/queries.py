"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import bpe, chat_format, collocations, exact_dedup, language_id, lexical_search, license_scan
from ledgerfold.llm import mixing, secret_scan, simhash_dedup, substring_dedup, topk_search, url_filter
from ledgerfold.llm.common import table
from ledgerfold.sources.staging import stage

# The rules of the URL query, and the conversation its chat query adds.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
QUERY_STEP = 50


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.search_top_k(vectors, F.pmod("vec_id", F.lit(QUERY_STEP)) == 0)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = stage(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sized")
    return mixing.mix_sized(sized).select("doc_id", "size", "source_size", "target", "taken")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs, license_scan.learn(docs)).withColumnRenamed("id", "doc_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    narrow = docs.select("doc_id", "text")
    return language_id.identify(spark, narrow, language_id.learn(docs)).select(
        "doc_id", language_id.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{CONTROL_TEXT}'), (-1L, 1L, 'assistant', '{CONTROL_TEXT}')"
        " AS added(conv_id, turn, role, text)"
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat_format.conversation_digests(chat_format.chat_windows(conversations))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    random = secret_scan.KINDS.index("random")

    def of_kind(kind: str):
        number = secret_scan.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != random)
    return secret_scan.scan_secrets(docs).select(
        F.col("id").alias("doc_id"),
        *[of_kind(kind) for kind in secret_scan.KINDS],
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
    )


def codec() -> bpe.Codec:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.make_codec(path, public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(spark, docs, codec(), keep=["doc_id"])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).drop("text")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.cut_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search_ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_exact_topk,
        op2_source_mix,
        op3_license_scan,
        op4_url_filter,
        op5_language_id,
        op6_chat_format,
        op7_simhash_dedup,
        op8_secret_scan,
        op9_byte_bpe,
        op10_exact_dedup,
        op11_substring_dedup,
        op12_lexical_search,
        op13_collocations,
    )
    return {query.__name__: query for query in found}
