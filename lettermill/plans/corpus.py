"""Corpus build: mailboxes to a chat corpus with counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.operators.bodies import header_projection, nested_body
from lettermill.operators.examples import build_examples
from lettermill.operators.filtering import with_status
from lettermill.operators.language import LanguageModel, map_language
from lettermill.operators.reports import observed_stats, with_observed_counters
from lettermill.operators.splitting import train_val_split
from lettermill.session import scratch_path, staged
from lettermill.sources.jsonl import write_examples
from lettermill.sources.mailbox import check_mailboxes, read_messages, small_batches, stage_messages, with_message_index

PLACE = ("source", "file", "block_start", "pos")  # order of a message, without an index
JUDGED_COLUMNS = (*PLACE, "subject", "to_addr", "clean", "n_words", "status", "language")


def judge_messages(messages: DataFrame, model: LanguageModel) -> DataFrame:
    """Parsed messages to one judged row each: a single narrow projection."""
    judged = with_status(nested_body(header_projection(messages)))
    accepted = F.col("status") == "ok"
    detected = model.with_language(judged, "clean", only=accepted)
    return detected.withColumn("language", F.when(accepted, map_language(F.col("lang_detected"))))


def mailbox_key(source: Column) -> Column:
    """Short name of a mailbox for its output folder: its stem, and a digest of the whole path."""
    stem = F.regexp_replace(F.regexp_extract(source, r"([^/]*)$", 1), r"\.mbox$", "")
    short = F.left(F.regexp_replace(stem, r"[^\p{L}\p{N}._-]+", "_"), F.lit(60))
    return F.concat(short, F.lit("-"), F.left(F.md5(source.cast("binary")), F.lit(8)))


def build_corpus(
    spark: SparkSession,
    mailboxes: str,
    output: str,
    model: LanguageModel,
    limit: int | None = None,
    any_name: bool = False,
) -> DataFrame:
    """Mailboxes to ``output/mailbox=.../*.json``; returns the run counters.

    Judged messages are written once, and counted as they are written; the
    corpus reads that table, so nothing expensive runs twice and a lost executor
    repeats one stage only. With a ``limit`` parsed messages are written first,
    because their places in the mailbox are counted. ``output/_mailboxes``
    holds the whole path of every mailbox name. No mailbox at all is an error.
    """
    check_mailboxes(spark, mailboxes, any_name)
    if limit:
        messages = stage_messages(spark, mailboxes, scratch_path(spark, "messages"), limit, any_name)
        messages = with_message_index(messages, limit)
    else:
        messages = read_messages(spark, mailboxes, any_name=any_name)
    judged, seen = with_observed_counters(judge_messages(messages, model).select(*JUDGED_COLUMNS))
    with small_batches(spark):
        judged = staged(judged, "judged")
    named = judged.filter(F.col("status") == "ok").withColumn("mailbox", mailbox_key(F.col("source")))
    write_examples(build_examples(named, keep=("mailbox",)), output, by="mailbox")
    boxes = judged.select("source").distinct().withColumn("mailbox", mailbox_key(F.col("source")))
    boxes.write.parquet(f"{output.rstrip('/')}/_mailboxes")
    return observed_stats(spark, seen)


def split_corpus(examples: DataFrame, output: str, ratio: float, seed: int, id_col: str | None = None) -> None:
    """Write ``output/split=train`` and ``output/split=validation``."""
    write_examples(train_val_split(examples, id_col, ratio, seed), output, by="split")
