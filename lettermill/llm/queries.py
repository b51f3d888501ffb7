"""Registered queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm import conversations, embeddings, fingerprints, langid, lexical, licenses, lm, packing, personal, sentencepieces, simhash, substrings, toxicity
from lettermill.llm.oracle import ORACLE

BYTE_BPE = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by all evidence; documents by text and source, as the pipeline takes them."""
    documents = _table(spark, sf_dir, "documents")
    model = langid.fit_text_model(documents)
    number = F.lit(None).cast("long")
    pages = langid.identify_pages(_table(spark, sf_dir, "pages"), model).withColumn("doc_id", number)
    return langid.identify_documents(documents, model).withColumn("page_id", number).unionByName(pages)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    narrow = docs.select("doc_id", "text", toxicity.held_out().alias("held_out"))
    return toxicity.with_toxicity(narrow, model).select("doc_id", "held_out", "score", "predicted")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_versions(_table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", lm.held_out().alias("held_out"))
    return lm.with_scores(docs, lm.fit(docs.filter(~lm.held_out())))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal_data(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_sentencepieces": op2_sentencepieces,
    "op3_langid": op3_langid,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprints": op5_fingerprints,
    "op6_licenses": op6_licenses,
    "op7_lm": op7_lm,
    "op8_packing": op8_packing,
    "op9_embeddings": op9_embeddings,
    "op10_substrings": op10_substrings,
    "op11_lexical": op11_lexical,
    "op12_conversations": op12_conversations,
    "op13_personal": op13_personal,
}
__all__ = ["ORACLE", "QUERIES"]
