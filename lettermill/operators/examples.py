"""Chat-format training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import RECIPIENT_PROMPT, SUBJECT_PROMPT, SYSTEM_PROMPT


def user_prompt(subject: Column, to_addr: Column) -> Column:
    recipient = F.when(to_addr != "", F.concat(F.lit(RECIPIENT_PROMPT), to_addr)).otherwise(F.lit(""))
    return F.concat(F.lit(SUBJECT_PROMPT), subject, recipient)


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_examples(accepted: DataFrame, language: str = "language", keep: tuple[str, ...] = ()) -> DataFrame:
    """``messages`` and ``metadata`` from accepted e-mails, plus the columns in ``keep``."""
    return accepted.select(
        *keep,
        F.array(
            turn("system", F.lit(SYSTEM_PROMPT)),
            turn("user", user_prompt(F.col("subject"), F.col("to_addr"))),
            turn("assistant", F.col("clean")),
        ).alias("messages"),
        F.struct(
            F.col(language).alias("language"),
            F.col("n_words").cast("int").alias("word_count"),
            F.col("subject").alias("subject"),
        ).alias("metadata"),
    )


def assistant_texts(examples: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per assistant turn; a missing content counts as ''."""
    turns = examples.select(*keep, F.posexplode("messages").alias("turn", "message"))
    return turns.filter(F.col("message.role") == "assistant").select(
        *keep, "turn", F.coalesce("message.content", F.lit("")).alias("text")
    )
