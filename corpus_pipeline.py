"""Raw documents to packed token sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm import langid, packing, simhash, substrings, toxicity
from lettermill.plans.joins import checked_join
from lettermill.session import staged

BYTE_BPE = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity models reject. They learn from the marks of rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    scored = toxicity.with_toxicity(docs, toxicity.fit(docs, labels))
    return scored.filter("predicted = 0").select(*docs.columns)


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, or whose language the evidence leaves open.

    With labels of fewer than two languages there is nothing to tell apart and all stay.
    """
    if docs.filter("text is not null and lang is not null").select("lang").distinct().limit(2).count() < 2:
        return docs
    found = langid.identify_documents(docs, langid.fit_text_model(docs))
    rejected = found.filter((F.col("lang") == "und") | (F.col("posterior") < langid.MIN_POSTERIOR))
    return _without(docs, rejected.select("doc_id"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (three-word shingles, three differing bits) the smallest id stays."""
    groups = simhash.near_duplicates(docs)
    return _without(docs, groups.filter("doc_id != component_id").select("doc_id"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut word sequences that stand in an earlier document, too; the document stays, ``n_chars`` follows."""
    kept = substrings.without_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences; one row per piece."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("toxicity", without_toxic),
    ("language_id", in_known_language),
    ("simhash", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]

ORACLE_SQL = None  # models, fingerprints and token ids are beyond SQL; tests compare with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without ``ids``, which are broadcast only if few.

    Rows with a null id stay; an id with several texts is one document, so all of its rows go.
    """
    return checked_join(docs, staged(ids.distinct(), "rejected"), "doc_id", "left_anti")
