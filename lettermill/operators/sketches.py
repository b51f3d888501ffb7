"""Small summaries kept per mailbox and merged later: frequent items with bounds, and quantiles of lengths.

A summary of a group has a fixed size, so a corpus that grows by mailboxes is
reported again from the old summaries and those of the new mailboxes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.text import word_count
from lettermill.operators.style import written

ENTRIES = 1_000  # items that a summary keeps
ACCURACY = 4_096  # size of a quantile summary; ranks are within about 1.7 / ACCURACY ** 0.9 of all values
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


def frequent_items(rows: DataFrame, by: list[str], item: str, size: int = ENTRIES) -> DataFrame:
    """``(*by, entries, slack)``: the ``size`` most frequent items of every group, with counts.

    ``entries`` holds ``(item, n, over)``: the true count is ``n`` to ``n + over``. An
    item that is not among them occurs ``slack`` times at most. Null items do not
    count; a null group is a group. Equal counts go in the order of the items. Counts are taken
    per item over the cluster, and each task sends on its best ``size`` only, so a hot group is spread.
    """
    counts = rows.filter(F.col(item).isNotNull()).groupBy(*by, F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return _kept(counts.withColumn("over", F.lit(0).cast("long")), by, size)


def merged_items(sketches: DataFrame, by: list[str], size: int = ENTRIES) -> DataFrame:
    """One summary per ``by`` of several; bounds stay true whatever is merged first.

    An item that a summary lacks may have occurred ``slack`` times in it.
    """
    slack = sketches.groupBy(*by).agg(F.sum("slack").alias("all_slack"))
    held = (
        sketches.select(*by, "slack", F.inline("entries"))
        .groupBy(*by, "item")
        .agg(F.sum("n").alias("n"), F.sum("over").alias("over"), F.sum("slack").alias("here"))
    )
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in by]
    joined = held.join(slack, same(held, slack)).select(
        *[held[c] for c in by], "item", "n", (F.col("over") + F.col("all_slack") - F.col("here")).alias("over"), "all_slack"
    )
    return _kept(joined, by, size, F.max("all_slack"))


def _kept(counts: DataFrame, by: list[str], size: int, slack: Column | None = None) -> DataFrame:
    order = [F.desc(F.col("n") + F.col("over")), F.desc("n"), F.asc("item")]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = counts.withColumn("rank", rank).filter(F.col("rank") <= size + 1)
    entry = F.when(F.col("rank") <= size, F.struct("rank", "item", "n", "over"))
    left_out = F.coalesce(F.max(F.when(F.col("rank") > size, F.col("n") + F.col("over"))), F.lit(0))
    return first.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["item"].alias("item"), e["n"].alias("n"), e["over"].alias("over"))).alias("entries"),
        (left_out if slack is None else F.greatest(left_out, slack)).cast("long").alias("slack"),
    )


def most_frequent(sketches: DataFrame, by: list[str], k: int) -> DataFrame:
    """``(*by, item, lower, upper, certain)``: the ``k`` items with the highest lower bounds.

    ``certain`` tells that the item is among the ``k`` most frequent: fewer than
    ``k`` others, kept or not, could occur more often than its lower bound.
    """
    entries = F.transform("entries", lambda e: F.struct((-e["n"]).alias("order"), e["item"].alias("item"), e["n"].alias("lower"), (e["n"] + e["over"]).alias("upper")))
    rows = sketches.select(*by, "slack", entries.alias("e"))
    lists = rows.select(*by, "slack", F.slice(F.array_sort("e"), 1, k).alias("top"), F.transform("e", lambda x: x["upper"]).alias("uppers"))
    shown = lists.select(*by, "slack", "uppers", F.inline("top"))
    above = F.size(F.filter("uppers", lambda u: u > F.col("lower"))) - (F.col("upper") > F.col("lower")).cast("int")
    return shown.select(*by, "item", "lower", "upper", ((above < k) & (F.col("slack") <= F.col("lower"))).alias("certain"))


def length_sketches(texts: DataFrame, by: list[str], text: str = "text", accuracy: int = ACCURACY) -> DataFrame:
    """``(*by, lengths)``: quantile summary of the words of the texts that are not blank; exact up to ``accuracy`` texts."""
    counted = written(texts, text).select(*by, word_count(F.col(text)).cast("long").alias("n_words"))
    return counted.groupBy(*by).agg(F.kll_sketch_agg_bigint("n_words", F.lit(accuracy)).alias("lengths"))


def merged_lengths(sketches: DataFrame, by: list[str], accuracy: int = ACCURACY) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("lengths", F.lit(accuracy)).alias("lengths"))


def length_quantiles(sketches: DataFrame, by: list[str], quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``(*by, texts, quantile, n_words)``: the smallest length that at least this share of the texts does not exceed."""
    values = F.array(*[
        F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_bigint("lengths", F.lit(q)).alias("n_words")) for q in quantiles
    ])
    return sketches.select(*by, F.kll_sketch_get_n_bigint("lengths").alias("texts"), F.inline(values))
