"""Is a difference between two cohorts real? Poisson bootstrap of per-text means, in one pass.

In every replicate a text counts as often as a Poisson number says that is
drawn from a hash of its id, so no resampled table is made and the result does not depend on
the partitioning. Sums are of whole numbers, hence exact in any order.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import SPLIT_SEED
from lettermill.operators.style import style_features

REPLICATES = 200
LEVEL = 0.95
_CHUNKS = 8  # replicates drawn from one digest, 16 bits each
#: A draw of 16 bits gives as many as it reaches of these: the distribution function of a Poisson number of mean 1.
STEPS = [s for k in range(9) if (s := int(65536 * sum(exp(-1) / factorial(j) for j in range(k + 1)))) < 65536]


def poisson_counts(seed: int, id_text: Column, replicates: int) -> Column:
    """Array with the count of a text in every replicate, from its id."""
    digests = F.transform(
        F.sequence(F.lit(0), F.lit(-(-replicates // _CHUNKS) - 1)),
        lambda j: F.md5(F.concat(F.lit(f"{seed}-"), j.cast("string"), F.lit("-"), id_text).cast("binary")),
    )
    bits = F.flatten(F.transform(digests, lambda d: F.array(*[F.conv(F.substring(d, 4 * i + 1, 4), 16, 10).cast("int") for i in range(_CHUNKS)])))
    reached = lambda u: sum(((u >= s).cast("int") for s in STEPS[1:]), (u >= STEPS[0]).cast("int"))
    return F.transform(F.slice(bits, 1, replicates), reached)


def bootstrap_delta(
    df: DataFrame, cohort: str, left: str, right: str, id_col: str | Column, measures: dict[str, Column],
    replicates: int = REPLICATES, level: float = LEVEL, seed: int = SPLIT_SEED,
) -> DataFrame:
    """``(measure, left_value, right_value, delta, low, high, different)`` of the means of whole-number ``measures``.

    ``low`` to ``high`` holds the delta (right less left) in ``level`` of the
    replicates; ``different`` says that it leaves out 0. Rows of one id (null is one too) are drawn together.
    Null measures count as 0; other cohorts are left out. Where a cohort has no texts its mean, the delta
    and the interval are null. ``replicates`` times two rows leave the map side, whatever the input.
    """
    ids = F.col(id_col) if isinstance(id_col, str) else id_col
    counts = poisson_counts(seed, F.coalesce(ids.cast("string"), F.lit("")), replicates)
    values = {f"_{i}": F.coalesce(c.cast("long"), F.lit(0)) for i, c in enumerate(measures.values())}
    rows = df.filter(F.col(cohort).isin(left, right)).select(
        (F.col(cohort) == right).alias("side"), *[c.alias(n) for n, c in values.items()], F.concat(F.array(F.lit(1)), counts).alias("counts")
    )
    drawn = rows.select("side", *values, F.posexplode("counts").alias("replicate", "count")).filter("count > 0")
    sums = drawn.groupBy("replicate", "side").agg(F.sum("count").alias("n"), *[F.sum(F.col("count") * F.col(c)).alias(c) for c in values])
    long = sums.select("replicate", "side", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), (F.col(c).cast("double") / F.col("n").cast("double")).alias("mean")) for m, c in zip(measures, values)
    ])))
    sides = long.groupBy("measure", "replicate").agg(
        *[F.max(F.when(F.col("side") == side, F.col("mean"))).alias(name) for name, side in (("l", False), ("r", True))]
    ).withColumn("delta", F.col("r") - F.col("l"))
    plain = lambda c: F.max(F.when(F.col("replicate") == 0, F.col(c)))
    deltas = F.sort_array(F.collect_list(F.when(F.col("replicate") > 0, F.col("delta"))))  # one a replicate
    summary = sides.groupBy("measure").agg(
        plain("l").alias("left_value"), plain("r").alias("right_value"), plain("delta").alias("delta"), deltas.alias("d")
    )
    tail = F.floor(F.round(F.size("d") * (1 - level) / 2, 9)).cast("int")
    summary = summary.withColumns({"low": F.get("d", tail), "high": F.get("d", F.size("d") - 1 - tail)})
    return summary.drop("d").withColumn("different", (F.col("low") > 0) | (F.col("high") < 0))


STYLE_MEASURES = ("n_words", "contractions", "formal", "casual", "exclamations", "questions", "is_dutch", "is_english")


def style_significance(df: DataFrame, cohort: str, left: str, right: str, id_col: Column, text: str = "text") -> DataFrame:
    """``bootstrap_delta`` of the style measures per text; blank texts are left out."""
    features = style_features(df.withColumn("_id", id_col), cohort, "_id", text=text)
    return bootstrap_delta(features, cohort, left, right, "_id", {m: F.col(m) for m in STYLE_MEASURES})
