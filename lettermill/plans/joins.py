"""Joins with a side whose size is counted before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def checked_join(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``right`` only if it has at most ``max_rows`` rows, else a shuffled join.

    The shuffled join relies on adaptive skew handling for hot keys of ``left``.
    ``right`` should be narrow and cheap to count, such as an aggregate or a table.
    """
    small = right.limit(max_rows + 1).count() <= max_rows
    return left.join(F.broadcast(right) if small else right, on, how)
