"""Chat corpus as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField(
            "messages",
            T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])),
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("language", T.StringType()),
                    T.StructField("word_count", T.IntegerType()),
                    T.StructField("subject", T.StringType()),
                ]
            ),
        ),
    ]
)
CORRUPT = "_corrupt_record"


def read_examples(spark: SparkSession, path: str, schema: T.StructType = EXAMPLE_SCHEMA) -> DataFrame:
    """Examples with a fixed schema, no inference pass.

    Absent fields are NULL. A line that is not JSON is kept in ``_corrupt_record``
    instead of ending the run; ``readable`` and ``rejects`` tell them apart.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def write_examples(df: DataFrame, path: str, by: str | None = None, mode: str = "errorifexists") -> None:
    """One JSON object per line, UTF-8, non-ASCII as it is, NULL fields kept.

    ``by`` makes one folder per value (mailbox, split). The rebalance hint lets
    the adaptive planner split a value that holds most rows over several files and
    put small values together, which a plain repartition by the column cannot.
    The mode ``dynamic`` replaces the folders of the values that ``df`` holds and no others.
    """
    rows = df.hint("rebalance", by) if by else df
    writer = rows.write.mode("overwrite" if mode == "dynamic" else mode).option("ignoreNullFields", "false")
    if mode == "dynamic":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(by) if by else writer).json(path)


def read_split(spark: SparkSession, path: str, value: str, by: str = "split") -> DataFrame:
    """One folder of a partitioned corpus, without listing the others."""
    return read_examples(spark, f"{path.rstrip('/')}/{by}={value}").drop(by)


def readable(examples: DataFrame) -> DataFrame:
    """Lines that are JSON, without the reject column.

    A line whose messages could be read stays even if another field has a wrong type.
    """
    good = F.col("messages").isNotNull() | F.col(CORRUPT).isNull()
    return examples.filter(good).drop(CORRUPT)


def rejects(examples: DataFrame) -> DataFrame:
    return examples.filter(F.col("messages").isNull() & F.col(CORRUPT).isNotNull())


def read_any_shape(spark: SparkSession, path: str) -> DataFrame:
    """``(value, _corrupt_record)``: every line as a VARIANT, whatever keys it has.

    Nothing is cut to a schema, so keys that this library does not know pass
    through ``write_any_shape`` unchanged. A line that is not JSON, repeats a key
    or is not an object with a list of messages has a null value and is kept
    in ``_corrupt_record``; blank lines are left out. ``known_fields`` reads the usual columns.
    """
    value = F.try_parse_json("line")
    messages = F.try_variant_get(value, "$.messages", "array<variant>")
    lines = spark.read.text(path).filter(F.btrim("value") != "").withColumnRenamed("value", "line")
    good = messages.isNotNull()
    return lines.select(F.when(good, value).alias("value"), F.when(~good, F.col("line")).alias(CORRUPT))


def write_any_shape(examples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The values as JSON lines again, keys in alphabetical order; rejects are not written."""
    examples.filter("value is not null").select(F.to_json("value").alias("value")).write.mode(mode).text(path)


def known_fields(examples: DataFrame) -> DataFrame:
    """``examples`` with ``messages`` and ``metadata`` as the fixed schema has them; what a line lacks, or has in another type, is NULL."""
    message = "struct<role: string, content: string>"
    fields = {"language": "string", "word_count": "int", "subject": "string"}
    messages = F.transform(
        F.try_variant_get("value", "$.messages", "array<variant>"), lambda m: F.try_variant_get(m, "$", message)
    )
    metadata = F.struct(*[F.try_variant_get("value", f"$.metadata.{name}", kind).alias(name) for name, kind in fields.items()])
    held = F.try_variant_get("value", "$.metadata", "variant")
    has_metadata = held.isNotNull() & ~F.is_variant_null(held)
    return examples.withColumns({"messages": messages, "metadata": F.when(has_metadata, metadata)})
