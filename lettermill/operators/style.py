"""Writing-style report: phrases, words, length, formality, punctuation, languages.

All measures of a text are computed in one projection and summed in one
aggregate; all phrases and words are counted in one more. The report reads its
input twice whatever the number of sections, and both passes combine on the
map side, so a phrase that occurs in a third of all texts is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import (
    CASUAL_WORDS,
    CONTRACTIONS,
    FORMAL_PHRASES,
    PHRASE_DISPLAY_CHARS,
    SAMPLE_DISPLAY_CHARS,
    SAMPLE_POOL,
    SAMPLE_SIZE,
    SPLIT_SEED,
    STOP_WORDS,
    TOP_PHRASES,
    TOP_WORDS,
)
from lettermill.functions.text import (
    count_substring,
    count_substrings,
    ellipsize,
    first_line,
    last_line,
    plain_words,
    strip,
    word_count,
)
from lettermill.operators.language import language_flags
from lettermill.plans.parallelism import with_columns_once
from lettermill.plans.ranking import seeded_key

PHRASE_COUNTS = ("contractions", "formal", "casual")


def written(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts that are not blank, stripped."""
    return df.withColumn(text, strip(F.col(text))).filter(F.col(text) != "")


def _with_lower(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_lower``, which forty substring tests share."""
    return with_columns_once(written(df, text), {"_lower": F.lower(F.col(text))})


def phrase_counts(lower: Column) -> dict[str, Column]:
    return {
        "contractions": count_substrings(lower, CONTRACTIONS),
        "formal": count_substrings(lower, FORMAL_PHRASES),
        "casual": count_substrings(lower, CASUAL_WORDS),
    }


def formality_label(contractions: Column, formal: Column) -> Column:
    return (
        F.when(contractions > formal * 2, "CASUAL")
        .when(formal > contractions * 2, "FORMAL")
        .otherwise("BALANCED")
    )


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(column)


def formality_counts(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    """Contractions, formal phrases and casual words with the label they give."""
    features = _with_lower(df, text).select(*groups, *[c.alias(n) for n, c in phrase_counts(F.col("_lower")).items()])
    totals = features.groupBy(*groups).agg(*[_total(c) for c in PHRASE_COUNTS])
    return totals.withColumn("label", formality_label(F.col("contractions"), F.col("formal")))


def punctuation_stats(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    features = written(df, text).select(
        *groups,
        count_substring(F.col(text), "!").alias("exclamations"),
        count_substring(F.col(text), "?").alias("questions"),
    )
    return features.groupBy(*groups).agg(
        _total("exclamations"),
        _total("questions"),
        F.avg("exclamations").alias("avg_exclamations"),
        F.avg("questions").alias("avg_questions"),
    )


def length_stats(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    lengths = written(df, text).select(*groups, word_count(F.col(text)).alias("n_words"))
    return lengths.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("texts"),
        F.avg("n_words").alias("avg_words"),
        F.min("n_words").alias("min_words"),
        F.max("n_words").alias("max_words"),
    )


def language_indicators(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    """Texts with Dutch and with English keywords, and their percentages."""
    flags = _with_lower(df, text).select(*groups, *[c.alias(n) for n, c in language_flags(F.col("_lower")).items()])
    counts = flags.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if("is_dutch").alias("dutch"),
        F.count_if("is_english").alias("english"),
    )
    return counts.withColumns(
        {
            f"{lang}_percent": F.try_divide(F.col(lang).cast("double"), F.col("texts").cast("double")) * 100.0
            for lang in ("dutch", "english")
        }
    )


def top_openings(df: DataFrame, text: str = "text", n: int = TOP_PHRASES) -> DataFrame:
    return _top_phrases(written(df, text).select(first_line(F.col(text)).alias("phrase")), n)


def top_closings(df: DataFrame, text: str = "text", n: int = TOP_PHRASES) -> DataFrame:
    return _top_phrases(written(df, text).select(last_line(F.col(text)).alias("phrase")), n)


def _top_phrases(phrases: DataFrame, n: int) -> DataFrame:
    return (
        phrases.groupBy("phrase")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .orderBy(F.desc("n"), "phrase")
        .limit(n)
        .withColumn("shown", ellipsize(F.col("phrase"), PHRASE_DISPLAY_CHARS))
    )


def top_words(df: DataFrame, text: str = "text", n: int = TOP_WORDS) -> DataFrame:
    return (
        df.select(F.explode(plain_words(F.col(text))).alias("word"))
        .filter(~F.col("word").isin(STOP_WORDS))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(n)
    )


def sample_texts(
    df: DataFrame,
    id_col: str,
    text: str = "text",
    n: int = SAMPLE_SIZE,
    pool: int = SAMPLE_POOL,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Seeded random sample out of the first ``pool`` texts, cut for display."""
    return (
        written(df, text)
        .select(id_col, text)
        .orderBy(id_col)
        .limit(pool)
        .orderBy(seeded_key(seed, F.col(id_col)), id_col)
        .limit(n)
        .select(id_col, ellipsize(F.col(text), SAMPLE_DISPLAY_CHARS).alias("sample"))
    )


def style_features(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Every per-text measure in one projection over non-blank texts."""
    body = F.col(text)
    columns = {
        "n_words": word_count(body),
        **phrase_counts(F.col("_lower")),
        "exclamations": count_substring(body, "!"),
        "questions": count_substring(body, "?"),
        **{name: flag.cast("int") for name, flag in language_flags(F.col("_lower")).items()},
    }
    return _with_lower(df, text).select(*keep, *[c.alias(n) for n, c in columns.items()])


def style_totals(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    """One row per group with the totals and averages of all measures."""
    sums = ("n_words", *PHRASE_COUNTS, "exclamations", "questions", "is_dutch", "is_english")
    totals = (
        style_features(df, *groups, text=text)
        .groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.min("n_words").alias("min_words"),
            F.max("n_words").alias("max_words"),
            *[_total(c) for c in sums],
        )
        .withColumnsRenamed({"n_words": "total_words", "is_dutch": "dutch", "is_english": "english"})
    )

    def per_text(name: str, factor: float = 1.0) -> Column:
        return F.try_divide(F.col(name).cast("double"), F.col("texts").cast("double")) * F.lit(factor)

    return totals.withColumns(
        {
            "avg_words": per_text("total_words"),
            "avg_exclamations": per_text("exclamations"),
            "avg_questions": per_text("questions"),
            "dutch_percent": per_text("dutch", 100.0),
            "english_percent": per_text("english", 100.0),
            "label": formality_label(F.col("contractions"), F.col("formal")),
        }
    )


def _top_items(df: DataFrame, groups: tuple[str, ...], text: str) -> DataFrame:
    """Openings, closings and words counted in one pass, best of each section.

    Plain words consist of letters, so one leading sign tells openings and
    closings from them in a single string key.
    """
    body = F.col(text)
    marks = {"<": "opening", ">": "closing"}
    phrases = [F.concat(F.lit("<"), first_line(body)), F.concat(F.lit(">"), last_line(body))]
    key, mark = F.col("_key"), F.left("_key", F.lit(1))
    section = F.when(mark == "<", marks["<"]).when(mark == ">", marks[">"]).otherwise("word")
    counts = (
        written(df, text)
        .select(*groups, F.explode(F.concat(F.array(*phrases), plain_words(body))).alias("_key"))
        .filter(~key.isin(STOP_WORDS))
        .groupBy(*groups, "_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *groups,
            section.alias("section"),
            F.when(mark.isin(*marks), F.substr(key, F.lit(2))).otherwise(key).alias("item"),
            "n",
        )
        .filter((F.col("section") == "word") | (F.col("n") > 1))
    )
    order = Window.partitionBy(*groups, "section").orderBy(F.desc("n"), "item")
    # rows per section are limited on the map side before the window
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(TOP_WORDS, TOP_PHRASES))
    limit = F.when(F.col("section") == "word", TOP_WORDS).otherwise(TOP_PHRASES)
    return ranked.filter(F.col("rank") <= limit).select(
        *groups, "section", "item", F.col("n").cast("double").alias("value")
    )


def full_style_report(df: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """``style_report`` with the number of all texts, blank ones included, and the sample section.

    A sample row has the cut text as item and the id as value.
    """
    total = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("count").alias("section"), F.lit("all_texts").alias("item"), "value"
    )
    sample = sample_texts(df, id_col, text).select(
        F.lit("sample").alias("section"), F.col("sample").alias("item"), F.col(id_col).cast("double").alias("value")
    )
    return style_report(df, text=text).unionByName(total).unionByName(sample)


def style_report(df: DataFrame, *groups: str, text: str = "text") -> DataFrame:
    """The whole report as ``(section, item, value)`` rows, per group if asked."""
    sections = {
        "count": ["texts"],
        "length": ["avg_words", "min_words", "max_words"],
        "formality": list(PHRASE_COUNTS),
        "punctuation": ["exclamations", "questions", "avg_exclamations", "avg_questions"],
        "language": ["dutch", "english", "dutch_percent", "english_percent"],
    }

    def row(section: str, item: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value")
        )

    rows = [row(s, F.lit(m), F.col(m)) for s, metrics in sections.items() for m in metrics]
    rows.append(row("style", F.col("label"), F.lit(1)))
    scalars = style_totals(df, *groups, text=text).select(*groups, F.inline(F.array(*rows)))
    return scalars.unionByName(_top_items(df, groups, text))
