"""Message bodies from part rows or nested parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.functions import mime


def header_projection(messages: DataFrame) -> DataFrame:
    """Subject and recipient columns from the ``headers`` map."""
    return messages.withColumns(
        {
            "subject": mime.header(F.col("headers"), "Subject"),
            "to_addr": mime.header(F.col("headers"), "To"),
        }
    )


def drop_attachments(parts: DataFrame) -> DataFrame:
    """Part rows left after attachments of multipart messages are skipped."""
    return parts.filter(~(F.col("multipart") & mime.is_attachment(F.col("disposition"))))


def choose_body(messages: DataFrame, parts: DataFrame, key: str = "msg_id") -> DataFrame:
    """Body per message from part rows; messages without a usable part keep NULL.

    ``min_by`` combines on the map side, so a message with very many parts sends
    one row per task. The payload is converted after the choice, once per message.
    """
    best = (
        parts.filter(
            mime.is_candidate(F.col("content_type"), F.col("disposition"), F.col("multipart"))
            & F.col("payload").isNotNull()
        )
        .groupBy(key)
        .agg(
            F.min_by(
                F.struct("content_type", "payload"),
                mime.preference(F.col("content_type"), F.col("part_no")),
            ).alias("chosen")
        )
        .select(
            key,
            F.col("chosen.content_type").alias("body_type"),
            mime.body_text(F.col("chosen.content_type"), F.col("chosen.payload")).alias("body"),
        )
    )
    return messages.join(best, key, "left")


def nested_body(messages: DataFrame) -> DataFrame:
    """Body per message from its own ``parts`` array: a narrow projection."""
    chosen = messages.withColumn("_chosen", mime.chosen_part(F.col("parts"), F.col("multipart")))
    return chosen.withColumns(
        {
            "body_type": F.col("_chosen.content_type"),
            "body": mime.body_text(F.col("_chosen.content_type"), F.col("_chosen.payload")),
        }
    ).drop("_chosen")
