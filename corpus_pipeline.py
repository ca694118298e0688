"""From a table of documents to tokens: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerfold.llm import bpe, exact_dedup, language_id, mixing, simhash_dedup
from ledgerfold.llm.common import table
from ledgerfold.llm.queries import codec
from ledgerfold.sources.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a language; the rest goes."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    return simhash_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.emit_mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and lang with the number of tokens and the digests of ids and decoded bytes."""
    return bpe.round_trip_digests(spark, docs, codec(), keep=["doc_id", "source", "lang"])


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("byte-level BPE", encode_tokens),
]

# Language ID, SimHash and BPE have no counterpart in SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
