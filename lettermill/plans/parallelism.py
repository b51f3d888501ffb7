"""Keep work spread out and computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cores when the input has fewer splits than cores.

    A Parquet file with one row group, or a gzip file, is one task however many
    cores there are. Inputs with enough splits, any large one, are returned as
    they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for expensive columns that later filters and columns refer to.

    The optimizer copies a projected expression into every filter pushed below
    it. The output of a generator is not copied, so each value is computed once.
    """
    once = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], once)
