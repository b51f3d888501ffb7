"""Counts, shares and averages over the corpus.

Every report is one aggregate with map-side combining; shares divide the
aggregated rows, never the data. Empty input gives NULL averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.functions.text import is_blank


def _share(part: Column, whole: Column) -> Column:
    """Percent; NULL if there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def _rows() -> Column:
    return F.count(F.lit(1))


COUNTERS = ("total", "processed", "skipped_empty", "skipped_short", "failed", "total_words")


def counters() -> list[Column]:
    """Aggregates of ``COUNTERS`` over ``status`` and ``n_words``; words count accepted rows only."""
    ok = F.col("status") == "ok"
    return [
        _rows().alias("total"),
        F.count_if(ok).alias("processed"),
        F.count_if(F.col("status") == "empty").alias("skipped_empty"),
        F.count_if(F.col("status") == "short").alias("skipped_short"),
        F.count_if(F.col("status") == "error").alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("n_words"))), F.lit(0)).cast("long").alias("total_words"),
    ]


def processing_stats(judged: DataFrame) -> DataFrame:
    """Run counters from ``status`` and ``n_words``."""
    return stats_of_counters(judged.agg(*counters()))


def stats_of_counters(counted: DataFrame) -> DataFrame:
    """Run counters from rows of ``COUNTERS``, such as those of single mailboxes."""
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS])
    average = F.try_divide(F.col("total_words").cast("double"), F.col("processed").cast("double"))
    return sums.withColumn("avg_words", average)


def with_observed_counters(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """``judged`` with counters that are taken as its rows are written, so that no second read is needed.

    Write the result as it is: each partition then counts once, when its task
    first succeeds, however often tasks are retried. A shuffle in between could
    count the rows of a stage that runs again.
    """
    seen = Observation("run counters")
    return judged.observe(seen, *counters()), seen


def observed_stats(spark: SparkSession, seen: Observation) -> DataFrame:
    """Run counters of a DataFrame that has been written; waits for the write."""
    row = seen.get
    return stats_of_counters(spark.createDataFrame([tuple(row[c] for c in COUNTERS)], ", ".join(f"{c} long" for c in COUNTERS)))


def language_distribution(df: DataFrame, language: str = "language", within: tuple[str, ...] = ()) -> DataFrame:
    """Rows and percent per language, over everything or inside each group of ``within``.

    Most frequent first; equal counts in order of the name.
    """
    counts = df.groupBy(*within, language).agg(_rows().alias("n"))
    total = F.sum("n").over(Window.partitionBy(*within))  # one row a group and language
    return counts.withColumn("percent", _share(F.col("n"), total)).orderBy(*within, F.desc("n"), language)


def split_stats(df: DataFrame, split: str = "split", n_words: str = "n_words") -> DataFrame:
    return df.groupBy(split).agg(
        _rows().alias("examples"),
        F.sum(n_words).cast("long").alias("total_words"),
        F.avg(n_words).alias("avg_words"),
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    counts = df.groupBy(split).agg(_rows().alias("examples"))
    total = F.sum("examples").over(Window.partitionBy())  # one row a split
    return counts.withColumn("percent", _share(F.col("examples"), total))


def text_counts(df: DataFrame, group: str, text: str = "text") -> DataFrame:
    return df.groupBy(group).agg(
        _rows().alias("texts"),
        F.count_if(~is_blank(F.coalesce(F.col(text), F.lit("")))).alias("non_blank"),
    )


def training_budget(
    df: DataFrame,
    configs: list[tuple[int, int, int, int]],
    seconds_per_step: int,
) -> DataFrame:
    """Steps and hours for ``(batch_size, accumulation, workers, epochs)`` choices."""
    grid = F.array(
        *[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("batch_size", "accumulation", "workers", "epochs"), c)])
            for c in configs
        ]
    )
    effective = F.col("batch_size") * F.col("accumulation") * F.col("workers")
    return (
        df.agg(_rows().alias("examples"))
        .select("examples", F.inline(grid))
        .withColumn("effective_batch", effective)
        .withColumn("steps", F.expr("examples div effective_batch * epochs"))
        .withColumn("hours", F.col("steps") * seconds_per_step / F.lit(3600.0).cast("double"))
    )
