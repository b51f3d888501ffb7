"""New e-mails judged as they arrive, by the same columns as the batch build.

Cleaning, filtering, language and example building are row-wise, so they need no
state and no watermark; the file sink with its checkpoint writes each row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lettermill.operators.examples import build_examples
from lettermill.operators.filtering import accepted
from lettermill.operators.language import LanguageModel, map_language


def stream_examples(emails: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """Examples from a (streaming) DataFrame with ``subject``, ``to_addr`` and ``body``."""
    with_language = model.with_language(accepted(emails), "clean")
    return build_examples(with_language.withColumn("language", map_language(F.col("lang_detected"))), keep=keep)


def write_stream(examples: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append to a JSON-lines corpus; processes what is there and stops."""
    return (
        examples.writeStream.format("json")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .trigger(availableNow=True)
        .start()
    )
