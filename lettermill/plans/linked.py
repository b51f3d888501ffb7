"""Groups of rows that share keys, found by random contraction.

In every round each node moves onto the neighbour (or itself) that comes first
in an order drawn anew, and the links are redrawn between the nodes that are
left. A constant share of the nodes goes in each round, whatever the shape of a
group, chains included. Nothing is collected. All tables that are joined are
written ones, so the planner knows their sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.session import staged


def key_links(rows: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    """Links ``(a, b)`` from every row to the smallest id with an equal key; null keys link nothing.

    A key held by any number of rows gives one link a row.
    """
    held = F.array(*[F.struct(F.lit(i).alias("i"), key.alias("key")) for i, key in enumerate(keys)])
    held = rows.select(F.col(id_col).alias("a"), F.inline(held)).filter("key is not null").distinct()
    held = staged(held, "keys")
    least = held.groupBy("i", "key").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return held.join(staged(least, "shared-keys"), ["i", "key"]).select("a", "b")


def linked_groups(links: DataFrame) -> DataFrame:
    """``(node, group)`` of every node of ``links (a, b)``; the group is its smallest node.

    Each round writes its links, which cuts the lineage, and shrinks them.
    Links of a node with itself count for nothing.
    """
    links = staged(links.filter("a != b").distinct(), "links")
    hops: list[DataFrame] = []
    while not links.isEmpty():
        first = lambda c: F.struct(F.xxhash64(F.lit(len(hops)), c).alias("h"), F.col(c).alias("n"))
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(first("b")).alias("m"))
        hops.append(staged(least.select(F.col("a").alias("node"), F.least("m", first("a"))["n"].alias("to")), "hops"))
        for end in ("a", "b"):
            step = hops[-1].select(F.col("node").alias(end), "to")
            links = links.join(step, end).drop(end).withColumnRenamed("to", end)
        links = staged(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not hops:
        return links.select(F.col("a").alias("node"), F.col("b").alias("group"))
    moved = hops[0].withColumnRenamed("to", "at")
    for hop in hops[1:]:
        step = hop.select(F.col("node").alias("at"), "to")
        moved = moved.join(step, "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    moved = staged(moved, "moved")
    names = staged(moved.groupBy("at").agg(F.min("node").alias("group")), "group-names")
    return moved.join(names, "at").select("node", "group")
