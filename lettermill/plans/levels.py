"""Joining the ordered parts of a group step by step, so that no step gathers a whole endless group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 1024


def joined_in_levels(
    rows: DataFrame, keys: list[str], at: str, value: str, combine: Callable[[Column], Column]
) -> DataFrame:
    """One row per ``keys`` with all values in the order of the whole number ``at`` (null counts as 0).

    ``combine`` joins an ordered array of values into one. Neighbouring parts are
    joined first, ``FAN_IN`` at most by their numbers, then neighbouring results, until one is left.
    """
    rows = rows.select(*keys, F.coalesce(F.col(at).cast("long"), F.lit(0)).alias("_at"), value)
    highest = rows.agg(F.max(F.abs("_at"))).first()[0] or 0
    while True:
        parts = F.sort_array(F.collect_list(F.struct("_at", value)))
        rows = (
            rows.groupBy(*keys, F.expr(f"_at div {FAN_IN}").alias("_at"))
            .agg(parts.alias("_parts"))
            .select(*keys, "_at", combine(F.col(f"_parts.{value}")).alias(value))
        )
        highest //= FAN_IN
        if highest == 0:
            return rows.drop("_at")
