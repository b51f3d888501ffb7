"""Exact ranks in hash order without sorting everything in one task.

A hash key spreads rows evenly over its prefixes. A histogram of prefixes, of
fixed size, gives every prefix its first rank; only rows that share a prefix
are ever sorted together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4  # hexadecimal digits per level: 65,536 buckets
BUCKET_ROWS = 1_000_000  # a fuller bucket is divided once more


def seeded_key(seed: int, value: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), value.cast("string")).cast("binary"))


def content_key(seed: int, df: DataFrame) -> Column:
    """Key for rows without an id: equal rows get equal keys."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return F.sha2(F.concat(F.lit(f"{seed}-"), row).cast("binary"), 256)


@dataclass(frozen=True)
class Cut:
    """Where the first ``size`` of ``total`` keys end: ``take`` of ``copies`` rows with ``key`` are in."""

    total: int
    size: int
    key: str | None
    take: int
    copies: int


def find_cut(keys: DataFrame, ratio: float) -> Cut:
    """Locate the cut after ``int(total * ratio)`` keys of the single column ``key``.

    Three scans of the key column at most; each brings back one row.
    """
    first = _histogram(keys, F.left("key", F.lit(PREFIX)))
    nulls = F.sum(F.when(F.col("bucket").isNull(), F.col("rows")))
    total, missing = first.agg(F.coalesce(F.sum("rows"), F.lit(0)), nulls).first()
    if missing:
        raise ValueError(f"{missing} rows have a NULL id")
    size = int(total * ratio)
    if size == 0 or size == total:
        return Cut(total, size, None, 0, 0)
    bucket, need, rows = _bucket_of(first, size)
    inside = keys.filter(F.left("key", F.lit(PREFIX)) == bucket)
    if rows > BUCKET_ROWS:
        finer = F.left("key", F.lit(2 * PREFIX))
        bucket, need, _ = _bucket_of(_histogram(inside, finer), need)
        inside = inside.filter(finer == bucket)
    key, take, copies = _bucket_of(_histogram(inside, F.col("key")), need)
    return Cut(total, size, key, take, copies)


def _histogram(keys: DataFrame, bucket: Column) -> DataFrame:
    return keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def _bucket_of(histogram: DataFrame, rank: int) -> tuple[str, int, int]:
    """Bucket that holds the 1-based ``rank``, the rank inside it, and its rows."""
    upto = F.sum("rows").over(Window.orderBy("bucket"))  # one row a bucket, fixed number
    row = (
        histogram.withColumn("upto", upto)
        .filter((F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank))
        .first()
    )
    return row["bucket"], rank - (row["upto"] - row["rows"]), row["rows"]


def with_position(df: DataFrame, key: str, *ties: str) -> DataFrame:
    """0-based position of every row in the order of ``key``, then ``ties``."""
    prefix = F.left(key, F.lit(PREFIX))
    start = F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = _histogram(df, prefix).select(
        F.col("bucket").alias("_bucket"), F.coalesce(start, F.lit(0)).alias("_start")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key, *ties))
    return (
        df.withColumn("_bucket", prefix)
        .join(F.broadcast(starts), "_bucket")  # 65,536 rows at most
        .withColumn("position", (F.col("_start") + rank - 1).cast("long"))
        .drop("_bucket", "_start")
    )
