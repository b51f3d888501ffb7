"""Seeded shuffle and exact train/validation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import SPLIT_SEED, TRAIN_RATIO
from lettermill.plans.ranking import content_key, find_cut, seeded_key, with_position
from lettermill.session import staged

COPIES_PER_BLOCK = 65_536  # copies of the row at the cut that one task writes
TRAIN = "train"
VALIDATION = "validation"


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = SPLIT_SEED) -> DataFrame:
    """Adds ``position``, the place of the row in a reproducible random order."""
    keyed = df.withColumn("_key", seeded_key(seed, F.col(id_col)))
    return with_position(keyed, "_key", id_col).drop("_key")


def split_label(ids: DataFrame, id_col: str, ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED) -> Column:
    """Label column from the unique ids of ``ids``, usable on any table with ``id_col``.

    Small jobs on the id column find the key at the cut; the label is then a
    comparison with a literal, so labelling needs no join and no shuffle.
    """
    key = seeded_key(seed, F.col(id_col))
    cut = find_cut(ids.select(key.alias("key")), ratio)
    if cut.key is None:
        return F.lit(TRAIN if cut.size else VALIDATION)
    if cut.take != cut.copies:
        raise ValueError(f"{id_col} is not unique: {cut.copies} rows share the value at the cut")
    return F.when(key <= cut.key, TRAIN).otherwise(VALIDATION)


def train_val_split(
    df: DataFrame, id_col: str | None = None, ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED
) -> DataFrame:
    """Adds ``split``; exactly ``int(n * ratio)`` rows are train.

    Without an id column rows are ordered by a hash of their content, which is
    computed for the key column once and for the labels once; copies of the row
    at the cut are shared out. A NULL in the id column is an error.
    """
    if id_col:
        return df.withColumn("split", split_label(df, id_col, ratio, seed))
    key = content_key(seed, df)
    cut = find_cut(staged(df.select(key.alias("key")), "keys"), ratio)
    if cut.key is None:
        return df.withColumn("split", F.lit(TRAIN if cut.size else VALIDATION))
    if cut.take == cut.copies:
        return df.withColumn("split", F.when(key <= cut.key, TRAIN).otherwise(VALIDATION))
    others = df.filter(key != cut.key).withColumn("split", F.when(key < cut.key, TRAIN).otherwise(VALIDATION))
    # The copies are equal, so any `take` of them will do: count them out anew.
    one = df.filter(key == cut.key).limit(1)
    block = F.sequence(F.lit(0), F.lit((cut.copies - 1) // COPIES_PER_BLOCK))
    blocks = one.withColumn("_block", F.explode(block)).repartition("_block")
    first = F.col("_block") * COPIES_PER_BLOCK
    last = F.least(first + COPIES_PER_BLOCK - 1, F.lit(cut.copies - 1))
    copies = blocks.withColumn("_copy", F.explode(F.sequence(first, last)))
    label = F.when(F.col("_copy") < cut.take, TRAIN).otherwise(VALIDATION)
    return others.unionByName(copies.select(*df.columns, label.alias("split")))
