"""Language of a text from word profiles, and keyword language flags.

The model hashes words into a fixed number of buckets, so it stays the same
size however large the vocabulary of the corpus is. It is applied as a literal
inside one projection: no token rows, no join, no shuffle of the texts.
"""

from __future__ import annotations

from dataclasses import dataclass
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import (
    DUTCH_INDICATORS,
    ENGLISH_INDICATORS,
    KEPT_LANGUAGES,
    LANGUAGE_SAMPLE_CHARS,
    UNKNOWN_LANGUAGE,
)
from lettermill.functions.text import contains_any, words

HASH_DIGITS = 3  # hexadecimal digits of the word hash: 4,096 buckets
PER_MILLION = 1_000_000
MAX_LANGUAGES = 64


def word_bucket(word: Column) -> Column:
    return F.conv(F.left(F.md5(word.cast("binary")), F.lit(HASH_DIGITS)), 16, 10).cast("int")


def word_profile(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Occurrences of each word in each language."""
    return (
        labelled.select(F.col(lang).alias("lang"), F.explode(words(F.col(text))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bucket_profile(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Share of each hash bucket in each language, in words per million."""
    counts = (
        word_profile(labelled, text, lang)  # each distinct word is hashed once
        .groupBy("lang", word_bucket(F.col("word")).alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("lang"))  # at most 4,096 rows a language
    return counts.select("lang", "bucket", (F.col("n") * PER_MILLION).alias("n"), total.alias("total")).select(
        "lang", "bucket", F.expr("n div total").alias("score")
    )


@dataclass(frozen=True)
class LanguageModel:
    """Bucket scores per language: 4,096 integers each, whatever the corpus size."""

    scores: dict[str, list[int]]

    @classmethod
    def fit(cls, labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
        """Learn from all labelled texts.

        Rows without a text or a label are left out. Nothing to learn from is an
        error, and so are more than ``MAX_LANGUAGES``, which bounds the model.
        """
        known = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
        counts = known.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
        if not 1 <= len(counts) <= MAX_LANGUAGES:
            raise ValueError(f"{len(counts) or 'no'} labelled languages; 1 to {MAX_LANGUAGES} can be learned")
        scores: dict[str, list[int]] = {row[0]: [0] * 16**HASH_DIGITS for row in counts}
        for row in bucket_profile(known, text, lang).collect():  # languages x 4,096 at most
            scores[row["lang"]][row["bucket"]] = row["score"]
        return cls(dict(sorted(scores.items())))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as a small Parquet table."""
        spark.createDataFrame(list(self.scores.items()), "lang string, scores array<bigint>").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LanguageModel:
        rows = spark.read.parquet(path).collect()  # one row a language
        return cls(dict(sorted((r["lang"], list(r["scores"])) for r in rows)))

    def with_language(
        self, df: DataFrame, text: str, out: str = "lang_detected", only: Column | None = None
    ) -> DataFrame:
        """Best language of the first 500 characters; ties go to the first name.

        Rows where ``only`` does not hold are not scored and get NULL.
        """
        sample = F.left(F.col(text), F.lit(LANGUAGE_SAMPLE_CHARS))
        buckets = F.transform(words(sample if only is None else F.when(only, sample)), word_bucket)
        names = {lang: f"_score_{i}" for i, lang in enumerate(self.scores)}
        scored = df.withColumn("_buckets", buckets).withColumns(
            {names[lang]: _total_score(F.col("_buckets"), values) for lang, values in self.scores.items()}
        )
        columns = [F.col(c) for c in names.values()]
        best = F.greatest(*columns) if len(columns) > 1 else columns[0]
        pick = F.when(best.isNull(), F.lit(None) if only is not None else F.lit(UNKNOWN_LANGUAGE)).when(
            best <= 0, F.lit(UNKNOWN_LANGUAGE)
        )
        for lang, name in names.items():
            pick = pick.when(F.col(name) == best, F.lit(lang))
        return scored.withColumn(out, pick).drop("_buckets", *names.values())


def _total_score(buckets: Column, values: list[int]) -> Column:
    table = F.from_json(F.lit(json.dumps(values)), "array<bigint>")  # folded to one literal
    return F.aggregate(buckets, F.lit(0).cast("long"), lambda acc, b: acc + F.get(table, b))


def map_language(lang: Column) -> Column:
    """Keep Dutch and English, everything else is unknown."""
    return F.when(lang.isin(KEPT_LANGUAGES), lang).otherwise(F.lit(UNKNOWN_LANGUAGE))


def language_flags(lower: Column) -> dict[str, Column]:
    """Substring tests on the lower-case text; a text can have both flags or none."""
    return {
        "is_dutch": contains_any(lower, DUTCH_INDICATORS),
        "is_english": contains_any(lower, ENGLISH_INDICATORS),
    }
