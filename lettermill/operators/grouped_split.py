"""Train/validation split that keeps linked rows on one side, with sizes as exact as the groups allow."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import SPLIT_SEED, TRAIN_RATIO
from lettermill.operators.splitting import TRAIN, VALIDATION
from lettermill.plans.linked import key_links, linked_groups
from lettermill.plans.ranking import seeded_key
from lettermill.session import staged

SUM_BITS = 1 << 18  # reach of the exact subset sums, in rows
SUM_ITEMS = 2_048  # bundles of equal groups that they consider, smallest first
BUCKET_GROUPS = 4_096  # groups of one size that are ranked together, about


def reachable_sum(items: list[tuple[int, int]], target: int) -> list[int]:
    """How many of each ``(size, count)`` to take, so that the sum is as near ``target`` as any; below it on a tie.

    Bounded subset sums as bits of one number: bit i stands for the sum i. Counts
    are taken in bundles of 1, 2, 4, ... groups; it ends once the target is reached.
    """
    top = 2 * target + max((s for s, _ in items), default=0) + 1
    mask, reach, steps = (1 << top + 1) - 1, 1, []
    for number, (size, count) in enumerate(items):
        bundle = 1
        while count and not reach >> target & 1:
            bundle = min(bundle, count)
            steps.append((number, size * bundle, bundle, reach))
            reach |= reach << size * bundle & mask
            count -= bundle
            bundle *= 2
    off = next(d for d in range(target + 1) if reach >> target - d & 1)
    over = next((d for d in range(1, off) if reach >> target + d & 1), None)
    at, taken = target - off if over is None else target + over, [0] * len(items)
    for number, size, bundle, before in reversed(steps):
        if not before >> at & 1:
            at -= size
            taken[number] += bundle
    return taken


def allot(sizes: dict[int, int], target: int) -> dict[int, int]:
    """How many groups of each size go to the first side; ``sizes`` counts the groups by size.

    Going down from the largest size, each takes its share of the target plus
    what is still owed, so all sizes are on both sides where they can be and the
    error stays below half of the largest group. What is then left is made good exactly, where the
    groups allow it, by bounded subset sums: over all groups if there are at most
    ``SUM_BITS`` rows, else by exchanging small groups.
    """
    total, taken, passed, chosen = sum(s * c for s, c in sizes.items()), 0, 0, {}
    for size in sorted(sizes, reverse=True):
        passed += size * sizes[size]
        owed = 2 * passed * target - 2 * taken * total
        chosen[size] = max(0, min(sizes[size], (owed + size * total) // (2 * size * total)))
        taken += size * chosen[size]
    if taken == target:
        return chosen
    order = sorted(sizes)
    if total <= SUM_BITS:
        found = reachable_sum([(s, sizes[s]) for s in order], target)
        better = dict(zip(order, found))
        return better if abs(sum(s * n for s, n in better.items()) - target) < abs(taken - target) else chosen
    return _exchanged(sizes, chosen, target - taken)


def _exchanged(sizes: dict[int, int], chosen: dict[int, int], missing: int) -> dict[int, int]:
    """``chosen`` with small groups put in and taken out, so that ``missing`` rows come in if possible."""
    sign = 1 if missing > 0 else -1
    order = sorted(sizes)
    order = order[: max(1, bisect_left(order, SUM_BITS // 4))][:SUM_ITEMS]
    spare = lambda s: sizes[s] - chosen[s] if sign > 0 else chosen[s]
    back = lambda s: sizes[s] - spare(s)
    best = (abs(missing), chosen)
    # groups that go the other way first: none, or one of the small sizes
    for other in (0, *[s for s in order if back(s)]):
        if not best[0] or abs(missing) + other > SUM_BITS:
            break
        items = [(s, min(spare(s), (abs(missing) + other) // s + 1)) for s in order if s != other and spare(s)]
        found = reachable_sum(items, abs(missing) + other)
        moved = sum(s * n for (s, _), n in zip(items, found)) - other
        if abs(abs(missing) - moved) < best[0]:
            change = {s: n for (s, _), n in zip(items, found)}
            if other:
                change[other] = -1
            best = (abs(abs(missing) - moved), {s: n + sign * change.get(s, 0) for s, n in chosen.items()})
    return best[1]


def grouped_split(
    df: DataFrame, id_col: str, keys: list[Column], ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED
) -> DataFrame:
    """Adds ``group_id`` and ``split``; rows linked by equal keys, directly or through others, share both.

    ``group_id`` is the smallest id of the group. A row without keys is a group
    of its own; rows of one id are one group, a NULL id is an error. About
    ``int(n * ratio)`` rows are train, as near as the groups allow (``allot``); among
    groups of a size the seeded hash of ``group_id`` decides, so the split does not
    depend on the partitioning. Columns of these names are replaced; an empty table stays empty.

    The number of different sizes is at most the root of twice the rows; only
    their counts come to the driver. Groups are ranked by hash prefixes, a few thousand at a time.
    """
    ids = staged(df.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")), "ids")
    missing = ids.filter("_id is null").select("_n").first()
    if missing:
        raise ValueError(f"{missing[0]} rows have a NULL id")
    linked = linked_groups(key_links(df, id_col, keys)).select(F.col("node").alias("_id"), F.col("group").alias("_linked"))
    members = staged(ids.join(linked, "_id", "left").select("_id", "_n", F.coalesce("_linked", "_id").alias("group_id")), "members")
    groups = members.groupBy("group_id").agg(F.sum("_n").alias("size")).withColumn("key", seeded_key(seed, F.col("group_id")))
    groups = staged(groups, "groups")
    sizes = dict(groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect())  # few different sizes, see above
    target = int(sum(s * c for s, c in sizes.items()) * ratio)
    labels = _labelled(groups, sizes, allot(sizes, target))
    sides = staged(members.join(labels, "group_id").select("_id", "group_id", "split"), "sides")
    kept = [c for c in df.columns if c not in ("group_id", "split")]
    return df.select(*kept, F.col(id_col).alias("_id")).join(sides, "_id").drop("_id")


def _labelled(groups: DataFrame, sizes: dict[int, int], chosen: dict[int, int]) -> DataFrame:
    """``(group_id, split)``: the first ``chosen`` groups of each size in the order of their keys are train."""
    spark = groups.sparkSession
    digits = lambda c: next(d for d in range(33) if 16**d * BUCKET_GROUPS >= c)
    rows = {"size": list(sizes), "digits": [digits(c) for c in sizes.values()], "take": [chosen[s] for s in sizes]}
    classes = spark.createDataFrame(pa.table(rows, pa.schema([(c, pa.int64()) for c in rows])))
    bucketed = groups.join(F.broadcast(classes), "size").withColumn("bucket", F.expr("left(key, cast(digits as int))"))  # a row a size
    upto = F.sum("n").over(Window.partitionBy("size").orderBy("bucket"))
    histogram = bucketed.groupBy("size", "take", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    cut = histogram.filter((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take"))).select(
        "size", F.col("bucket").alias("cut"), (F.col("take") - F.col("upto") + F.col("n")).alias("need")
    )
    marked = staged(bucketed.join(F.broadcast(cut), "size", "left"), "marked-groups")
    label = lambda inside: F.when(inside, TRAIN).otherwise(VALIDATION).alias("split")
    whole = marked.filter("cut is null or bucket != cut").select("group_id", label(F.col("bucket") < F.col("cut")))
    rank = F.row_number().over(Window.partitionBy("size").orderBy("key", "group_id"))
    at_cut = marked.filter("bucket = cut").withColumn("rank", rank).select("group_id", label(F.col("rank") <= F.col("need")))
    return whole.unionByName(at_cut)
