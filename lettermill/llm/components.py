"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)``; the component is its smallest node.

    Alternating large-star and small-star steps: links are re-hung on ever
    smaller nodes until each component is one star. A step is a minimum per
    node (combined before the shuffle) and a join back, which adaptive
    execution splits where a hub has very many links. Every round is written
    to the shared folder, which cuts the lineage. Null ends and self-links are
    ignored; no links give no rows.
    """
    links = _tidy(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))
    links = staged(links, "links")
    seen = None
    while (state := _state(links)) != seen and state[0]:
        seen = state
        links = staged(_small_star(_large_star(links)), "links")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _tidy(links: DataFrame) -> DataFrame:
    return links.filter(F.col("hi") != F.col("lo")).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node hang on the smallest of its neighbourhood."""
    ends = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        links.select(F.col("lo").alias("u"), F.col("lo").alias("v"))
    )
    least = ends.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, F.col("lo") == F.col("u"))
    return _tidy(joined.select("hi", F.col("m").alias("lo")))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    least = links.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    joined = links.join(least, F.col("hi") == F.col("u"))
    return _tidy(
        joined.select(F.inline(F.array(*[F.struct(F.col(c).alias("hi"), F.col("m").alias("lo")) for c in ("hi", "lo")])))
    )


class LocalGroups:
    """Union of numbered items inside one task; the label of a group is its smallest number."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            self.parent[x] = self.parent[up]
            x = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.parent, a, b)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Items that are not their own label, and their labels."""
        items = np.arange(len(self.parent))
        labels = self.roots(items)
        other = labels != items
        return items[other], labels[other]
