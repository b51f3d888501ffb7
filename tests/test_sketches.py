"""Mergeable summaries: bounds hold for every item, whatever is merged first."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lettermill.operators import sketches as sk

SCHEMA = "author string, box int, word string"


def make(seed, n=6000):
    rng = random.Random(seed)
    pick = lambda: f"w{min(int(rng.paretovariate(0.7)), 900)}"
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(5), pick()) for _ in range(n)]
    return rows + [("c", 1, "only"), ("c", 2, None), ("d", 1, None)]


def bounds(df):
    """Per author: entry bounds, and the bound of all others."""
    return {r["author"]: ({e["item"]: (e["n"], e["n"] + e["over"]) for e in r["entries"]}, r["slack"]) for r in df.collect()}


def assert_true(found, rows):
    for author, (items, slack) in found.items():
        true = Counter(w for a, _, w in rows if a == author and w is not None)
        for word, n in true.items():
            low, high = items.get(word, (0, slack))
            assert low <= n <= high, (author, word)


@pytest.mark.parametrize("size", [1, 7, 60, 2000])
def test_bounds_hold_for_all_items_and_merge_orders(spark, size):
    rows = make(size)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    per_box = sk.frequent_items(df, ["author", "box"], "word", size)
    assert all(len(r["entries"]) <= size for r in per_box.collect())
    at_once = bounds(sk.merged_items(per_box, ["author"], size))
    early = sk.merged_items(per_box.filter("box < 3"), ["author"], size)
    late = sk.merged_items(per_box.filter("box >= 3"), ["author"], size)
    in_steps = bounds(sk.merged_items(early.unionByName(late), ["author"], size))
    direct = bounds(sk.frequent_items(df, ["author"], "word", size))
    assert set(at_once) == set(in_steps) == set(direct) == {"a", "b", "c", None}
    for found in (at_once, in_steps, direct):
        assert_true(found, rows)
    if size == 2000:
        assert at_once == direct and all(slack == 0 for _, slack in at_once.values())


def test_certain_items_are_among_the_most_frequent(spark):
    rows = make(3)
    per_box = sk.frequent_items(spark.createDataFrame(rows, SCHEMA), ["author", "box"], "word", 40)
    shown = sk.most_frequent(sk.merged_items(per_box, ["author"], 40), ["author"], 5).collect()
    for author in ("a", "b", None):
        true = Counter(w for a, _, w in rows if a == author)
        fifth = sorted(true.values(), reverse=True)[4]
        mine = [r for r in shown if r["author"] == author]
        assert len(mine) == 5 and sum(r["certain"] for r in mine) >= 2
        assert all(true[r["item"]] >= fifth for r in mine if r["certain"])


@pytest.mark.parametrize("parts", [2, 9])
def test_quantile_ranks_are_within_the_bound(spark, parts):
    values = spark.range(40_000).select(F.lit("a").alias("author"), (F.col("id") % parts).alias("box"), F.expr("repeat('w ', 1 + cast(id * 7919 % 997 as int))").alias("text"))
    per_box = sk.length_sketches(values, ["author", "box"], accuracy=200)
    early, late = (sk.merged_lengths(per_box.filter(c), ["author"], 200) for c in ("box = 0", "box > 0"))
    true = sorted(1 + i * 7919 % 997 for i in range(40_000))
    for merged in (sk.merged_lengths(per_box, ["author"], 200), sk.merged_lengths(late.unionByName(early), ["author"], 200)):
        for r in sk.length_quantiles(merged, ["author"]).collect():
            assert r["texts"] == 40_000
            below = sum(v < r["n_words"] for v in true) / 40_000
            upto = sum(v <= r["n_words"] for v in true) / 40_000
            assert below - 0.03 <= r["quantile"] <= upto + 0.03


def test_few_texts_are_exact_and_empty_tables_have_no_rows(spark):
    texts = spark.createDataFrame([("a", 1, "x " * n) for n in (5, 1, 3, 9)] + [("a", 2, None), ("b", 1, "  ")], "author string, box int, text string")
    found = sk.length_quantiles(sk.merged_lengths(sk.length_sketches(texts, ["author", "box"]), ["author"]), ["author"], (0.25, 0.5, 0.51, 1.0))
    assert [tuple(r) for r in found.collect()] == [("a", 4, 0.25, 1), ("a", 4, 0.5, 3), ("a", 4, 0.51, 5), ("a", 4, 1.0, 9)]
    none = sk.frequent_items(spark.createDataFrame([], SCHEMA), ["author"], "word")
    assert sk.most_frequent(sk.merged_items(none, ["author"]), ["author"], 3).count() == 0
    assert sk.length_sketches(texts.limit(0), ["author"]).count() == 0
